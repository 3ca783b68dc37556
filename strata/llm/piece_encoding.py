"""Exact merge-type piece encoding of whole texts by backtracking, and decoding.

A merge-type model replaces, again and again, the adjacent pair of pieces whose joined piece
has the best score (the leftmost of ties). A run of pieces is that procedure's result exactly
if each piece merges from its own characters and each adjacent pair stays apart when the two
are merged from characters together: merges inside a stretch never depend on what stands
outside it, so the first merge over a border would show in the pair already.

Encoding therefore needs no merge queue:

* an Aho-Corasick pass gives the longest piece that begins at each character;
* from the left the longest piece is taken that ends at a position not known to fail and
  that is compatible with the piece before it, else the next shorter piece is tried;
* when none is left, the position is marked in a bitfield of failed positions and the piece
  before is taken back. No position fails twice, so the work is linear in the text.

Compatibility is checked by merging the two pieces' characters anew, up to the first merge
over their border; answers are remembered in a bounded table. Characters without a piece
become byte pieces and part the text, as no merge crosses them. Nor does a merge cross a
border whose two characters stand side by side in no piece; the text is cut at some such
borders into units, and a bounded cache per worker answers units that come again.

Normalisation (space marks, prefix) is the library's own; its encoder and decoder are not used.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._tables import prepare

SPACE = "▁"
#: Entries of the unit cache and of the pair table of a worker; longer units are not kept.
UNIT_CACHE, PAIR_CACHE, UNIT_CHARS = 1 << 19, 1 << 20, 64


class _Units(dict):
    """Bounded cache: unit -> its ids as int32 bytes, encoded on first use."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, unit: str) -> bytes:
        out = array("i", self.encode(unit)).tobytes()
        if len(unit) <= UNIT_CHARS:
            if len(self) >= UNIT_CACHE:
                self.clear()
            self[unit] = out
        return out


class PieceModel:
    """A merge-type (BPE) piece model with its automaton; built once per worker."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        lib = SentencePieceProcessor(model_file=path)
        self.normalise = lib.normalize
        size = lib.get_piece_size()
        names = [lib.id_to_piece(i) for i in range(size)]
        byte_ids = [i for i in range(size) if lib.is_byte(i)]
        mute = [i for i in range(size) if lib.is_control(i)]
        plain = [i for i in range(size) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        self.unknown = lib.unk_id()
        self.bytes_of = {int(names[i][3:5], 16): i for i in byte_ids}
        ids = {names[i]: i for i in plain}
        if not all(c in ids for p in ids for c in p):
            raise ValueError("a piece holds a character that is no piece itself")
        # smaller is merged first
        levels = {s: k for k, s in enumerate(sorted({lib.get_score(i) for i in plain}, reverse=True))}
        self.order = {names[i]: levels[lib.get_score(i)] for i in plain}
        self.names = names
        own = {p: i for p, i in ids.items() if len(p) == 1 or self._merges_whole(p)}
        self.single = {p for p in own if len(p) == 1}
        automaton = ahocorasick.Automaton()
        for p, i in own.items():
            automaton.add_word(p, (i, len(p)))
        automaton.make_automaton()
        self.matches = automaton.iter
        # the longest shorter piece that begins as each piece does
        self.shorter = {i: next((own[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in own), -1) for p, i in own.items()}
        self.length = {i: len(p) for p, i in own.items()}
        self.units_of = self._units(ids)
        self.apart: dict[int, bool] = {}
        self.units = _Units(self._encode_unit)
        # decoding: what every id stands for, as UTF-8
        self.sound = [n.replace(SPACE, " ").encode() for n in names]
        for i in mute:
            self.sound[i] = b""
        if self.unknown >= 0:
            self.sound[self.unknown] = " ⁇ ".encode()
        for b, i in self.bytes_of.items():
            self.sound[i] = bytes([b])
        self.mute = frozenset(mute)
        self.is_byte = frozenset(byte_ids)
        self.prefixed = self.normalise("a").startswith(SPACE)

    @staticmethod
    def _units(pieces):
        """A function that cuts a text where no piece, and so no merge, can stand across the
        cut: before space marks, around line ends, and after letters before those signs that
        follow a letter in no piece. Each cut is used only if the pieces allow it."""
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            return lambda text: [text] if text else []
        letter = r"[^\W\d_]"
        after = {c for p in pieces for c in re.findall(f"(?<={letter})[^{SPACE}]", p)}
        signs = "".join(re.escape(chr(c)) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in after)
        line = "" if any("\n" in p for p in pieces) else "\n"
        return re.compile((f"{SPACE}*+{letter}++(?=[{signs}])|" if signs else "") + ("\n+|" if line else "")
                          + f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+").findall

    def _merges_whole(self, piece: str) -> bool:
        return len(self.merged(piece)) == 1

    def merged(self, text: str, border: int = 0) -> list[str]:
        """Pieces after all merges of a short text, the best pair first; with ``border``,
        an empty list as soon as a merge joins what stands on its two sides."""
        sym, get = list(text), self.order.get
        while len(sym) > 1:
            best = at = None
            for i in range(len(sym) - 1):
                r = get(sym[i] + sym[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at is None:
                break
            if border:
                left = sum(map(len, sym[:at + 1]))
                if left == border:
                    return []
            sym[at:at + 2] = [sym[at] + sym[at + 1]]
        return sym

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.apart.get(key)
        if known is None:
            left = self.names[a]
            known = bool(self.merged(left + self.names[b], len(left)))
            if len(self.apart) >= PAIR_CACHE:
                self.apart.clear()
            self.apart[key] = known
        return known

    def _backtrack(self, text: str) -> list[int]:
        """Ids of a stretch whose characters are all pieces."""
        n = len(text)
        longest = [0] * n
        for end, (i, size) in self.matches(text):  # by end, so the last one written is the longest
            longest[end + 1 - size] = i
        failed = bytearray(n + 1)
        length, shorter, compatible, apart = self.length, self.shorter, self.compatible, self.apart.get
        out: list[int] = []
        pos, piece = 0, longest[0]
        while pos < n:
            before = out[-1] if out else -1
            while True:
                end = pos + length[piece]
                if not failed[end] and (before < 0 or (apart(before << 32 | piece) or compatible(before, piece))):
                    out.append(piece)
                    pos = end
                    if pos < n:
                        piece = longest[pos]
                    break
                piece = shorter[piece]
                if piece < 0:
                    failed[pos] = 1
                    piece = out.pop()
                    pos -= length[piece]
                    break
        return out

    def _encode_unit(self, unit: str) -> list[int]:
        single = self.single
        if single.issuperset(unit):
            return self._backtrack(unit)
        out: list[int] = []
        start = 0
        for k, c in enumerate(unit):
            if c not in single:
                if k > start:
                    out += self._backtrack(unit[start:k])
                out += [self.bytes_of[b] for b in c.encode()] if self.bytes_of else [self.unknown]
                start = k + 1
        return out + (self._backtrack(unit[start:]) if start < len(unit) else [])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        return np.frombuffer(b"".join(map(self.units.__getitem__, self.units_of(self.normalise(text)))), np.int32)

    def decode(self, ids: list[int]) -> str:
        """Text of ids: the prefix space goes, bytes that form no character read U+FFFD each."""
        try:
            text = b"".join(map(self.sound.__getitem__, ids)).decode() if self.mute.isdisjoint(ids) else self._runs(ids)
        except UnicodeDecodeError:
            text = self._runs(ids)
        if self.prefixed and text.startswith(" "):
            first = next(i for i in ids if i not in self.mute)
            if first not in self.is_byte and first != self.unknown:
                return text[1:]
        return text

    def _runs(self, ids: list[int]) -> str:
        """Byte pieces are read run by run; a control piece ends a run."""
        return "".join(_lenient(b"".join(self.sound[i] for i in run)) if byte else "".join(self.sound[i].decode() for i in run)
                       for byte, run in groupby(ids, self.is_byte.__contains__))


def _lenient(raw: bytes) -> str:
    out = ""
    while raw:
        try:
            return out + raw.decode()
        except UnicodeDecodeError as e:
            out += raw[:e.start].decode() + "�"
            raw = raw[e.start + 1:]
    return out


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>, decoded)``, one row per input row: each whole text's piece
    ids without begin or end, and the text that these ids decode to.

    Null texts count as empty: no ids, an empty text. Repeated rows are each encoded, an empty
    table gives no rows, other columns are not read. Texts are encoded one by one; memory
    follows the longest text and the bounded caches. ``model_path`` must exist on every worker.
    """
    prepare(docs.sparkSession)

    def run(batches):
        model = piece_model(model_path)
        for batch in batches:
            ids = [model.encode(t or "") for t in batch.column(1).to_pylist()]
            offs = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(offs), pa.array(flat, pa.int32())),
                 pa.array([model.decode(x.tolist()) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
                .mapInArrow(run, "doc_id long, ids array<int>, decoded string"))


def digest(encoded: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of ``encode_texts``."""
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
