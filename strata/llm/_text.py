"""Words of Arrow text columns as flat numpy arrays.

All operators that read whole texts share this: a batch of texts becomes one array of
64-bit word hashes plus a word count per text, without a Python object per word. Work
is done on slices of a few megabytes, so memory does not depend on the batch size (one
very long text makes a slice of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_M = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_PIECE = 1 << 18


def _byte_table(is_word) -> np.ndarray:
    """Byte -> itself with A-Z lower-cased, or 0 where the byte separates words."""
    out = np.zeros(256, np.uint8)
    for b in range(256):
        if is_word(b):
            out[b] = b + 32 if 65 <= b <= 90 else b
    return out


#: Words ``[^\x20\x09-\x0D]+`` (bytes of multi-byte characters are never separators).
SPACED = _byte_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Words of ASCII letters, digits and all characters from U+0080 on.
ALNUM = _byte_table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A
                    or b >= 0x80)
# NUL is a word character of SPACED; it must not look like a separator. Byte 0xFF never
# occurs in UTF-8, so it can stand for NUL inside the hashes.
SPACED[0] = 0xFF


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    size, step = 1, np.uint64(base)
    while size < n:  # doubling: out[size:2*size] = out[:size] * base**size
        m = min(size, n - size)
        out[size:size + m] = out[:m] * step
        step = np.uint64((int(step) * int(step)) & _MASK)
        size += m
    return out


_P = _powers(_M, _PIECE)
_PINV = _powers(pow(_M, -1, 1 << 64), _PIECE)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Words:
    """Words of a slice of texts: ``counts[i]`` words belong to text ``i``."""

    first: int            # index of the slice's first text in the batch
    counts: np.ndarray    # words per text
    starts: np.ndarray    # byte span of every word in ``data``
    ends: np.ndarray
    data: np.ndarray      # the slice's bytes, lower-cased, separators 0

    def offsets(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.counts)))

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """64-bit hash of every word, or of its first ``prefix`` bytes."""
        ends = self.ends if prefix is None else np.minimum(self.ends, self.starts + prefix)
        return mix(span_hashes(self.data, self.starts, ends))

    def words(self) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist())]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash modulo 2**64 of each byte span (spans ascending, not overlapping)."""
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)
    while i < n:
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + _PIECE - 1, side="right")))
        hi = int(ends[j - 1])
        size = hi - lo
        p, pinv = (_P, _PINV) if size <= _PIECE else (
            _powers(_M, size), _powers(pow(_M, -1, 1 << 64), size))
        cum = np.empty(size + 1, np.uint64)
        cum[0] = 0
        np.cumsum(np.multiply(data[lo:hi], p[:size], dtype=np.uint64), out=cum[1:])
        s = starts[i:j] - lo
        out[i:j] = (cum[ends[i:j] - lo] - cum[s]) * pinv[s]
        i = j
    return out


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and the texts' offsets; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.fill_null("").cast(pa.large_string())
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = col.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``max_bytes`` bytes (a longer text stands alone)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + max_bytes, side="right")) - 1)
        yield i, j
        i = j


def split_words(col, table: np.ndarray, max_bytes: int = 1 << 21) -> Iterator[Words]:
    """The words of every text of ``col``, slice by slice and whole."""
    raw, offs = text_bytes(col)
    for i, j in slices(offs, max_bytes):
        data = table[raw[offs[i]:offs[j]]]
        cuts = offs[i:j + 1] - offs[i]
        word = data != 0
        start = word.copy()
        start[1:] &= ~word[:-1]
        end = word.copy()
        end[:-1] &= ~word[1:]
        inner = cuts[(cuts > 0) & (cuts < len(data))]
        start[inner] |= word[inner]
        end[inner - 1] |= word[inner - 1]
        starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        bounds = np.searchsorted(starts, cuts)
        yield Words(i, np.diff(bounds), starts, ends, data)


def shingles(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of every text, and how many each text has.

    A text of fewer words (but not none) has its whole sequence as one shingle.
    """
    n = len(h)
    offs = np.concatenate(([0], np.cumsum(counts)))
    per = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    step = np.uint64(0xD6E8FEB86659FD93)
    acc = np.zeros(n, np.uint64)
    if n >= k:
        m = n - k + 1
        for i in range(k):
            acc[:m] = acc[:m] * step + h[i:i + m]
    acc = mix(acc)
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        v = 0
        for x in h[offs[i]:offs[i + 1]].tolist():
            v = (v * 0xA0761D6478BD642F + x + 1) & _MASK
        acc[offs[i]] = mix(np.array([v], np.uint64))[0]
    pos = np.repeat(offs[:-1] - np.concatenate(([0], np.cumsum(per)))[:-1], per) + np.arange(per.sum())
    return acc[pos], per


def binary_rows(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of ``flat`` as one binary cell each (no Python object per cell)."""
    flat = np.ascontiguousarray(flat)
    offs = np.concatenate(([0], np.cumsum(counts.astype(np.int64)))) * flat.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(counts),
                                 [None, pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(flat)]
                                 ).cast(pa.binary())


class HashTable:
    """Open-addressing table of 64-bit keys for vectorised lookups (-1: not there)."""

    def __init__(self, keys: np.ndarray):
        """``keys``: distinct uint64; position i answers for key i."""
        bits = max(4, int(2 * max(1, len(keys)) - 1).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.slot = np.full(1 << bits, -1, np.int32)
        todo = np.arange(len(keys), dtype=np.int32)
        at = self._home(keys)
        while len(todo):
            free = self.slot[at] < 0
            # of several keys for one free slot, the last written stays
            self.slot[at[free]] = todo[free]
            self.keys[at[free]] = keys[todo[free]]
            lost = self.slot[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & self.mask

    def _home(self, h: np.ndarray) -> np.ndarray:
        return ((h * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        at = self._home(h)
        s = self.slot[at]
        hit = (s >= 0) & (self.keys[at] == h)
        out = np.where(hit, s, np.int32(-1))
        todo = np.flatnonzero((s >= 0) & ~hit)  # few keys are not at their first place
        at = (at[todo] + 1) & self.mask
        while len(todo):
            s = self.slot[at]
            hit = (s >= 0) & (self.keys[at] == h[todo])
            out[todo[hit]] = s[hit]
            go = (s >= 0) & ~hit
            todo, at = todo[go], (at[go] + 1) & self.mask
        return out
