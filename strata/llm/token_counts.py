"""Token counts of whole texts by a two-tier lookup on the map side.

The pre-tokens are the runs between ASCII white space: the tokenizer drops white space
and no token crosses it, so a text's count is the sum over its runs.

* Tier 1 is a compact table of the corpus's most frequent runs with their token counts,
  broadcast to the workers. Its size is a parameter (``frequent`` runs of at most
  ``run_bytes`` bytes), so the broadcast is bounded whatever the corpus holds.
* Tier 2 is a bounded cache per worker: runs missing from the table are encoded once by
  the tokenizer library, in batches, and remembered.

No pre-token is shuffled to count a text. The frequent runs come from a pass over all
texts in which each task keeps a bounded summary of its own runs (space-saving: when it
is full, the rarer half goes) and sends its ``frequent`` best; only these summaries meet.
Which runs are in the table changes speed alone, never a count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._tables import most_frequent, prepare, written
from strata.llm._text import slices, text_bytes


#: Runs that go to the library as one text.
JOINED = 64


def _encode_json(path: str, runs: list[str]) -> list[int]:
    """Tokens of each run. Plain ASCII runs are encoded many in one text, between blanks that no token
    crosses: a token belongs to the run it starts in. Runs with special strings, which may take
    blanks in, and with other characters go alone."""
    t = _tokenizer(path)
    special = _special(path)
    plain = [i for i, r in enumerate(runs) if r.isascii() and not any(x in r for x in special)]
    out = np.full(len(runs), -1, np.int64)
    for k in range(0, len(plain), JOINED):
        at = plain[k:k + JOINED]
        own = [runs[i] for i in at]
        e = t.encode(" ".join(own), add_special_tokens=False)
        ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
        starts = np.fromiter((a for a, _ in e.offsets), np.int64, len(e))
        out[at] = np.bincount(np.searchsorted(ends, starts, side="right"), minlength=len(own))
    for i in np.flatnonzero(out < 0).tolist():
        out[i] = len(t.encode(runs[i], add_special_tokens=False))
    return out.tolist()


@lru_cache(maxsize=2)
def _special(path: str) -> list[str]:
    return [a.content for a in _tokenizer(path).get_added_tokens_decoder().values()]


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _runs(col) -> Iterable[tuple[int, np.ndarray, list[bytes], np.ndarray]]:
    """Per slice of texts: the index of its first text, where each text's runs begin (and the last
    one's end), the distinct runs, and for each place which of them stands there. Texts that
    begin or end with white space, or are empty, have empty runs."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    col = col.fill_null("").cast(pa.large_string())
    _, offs = text_bytes(col)
    for i, j in slices(offs, 1 << 22):
        split = pc.ascii_split_whitespace(col.slice(i, j - i))
        coded = split.flatten().dictionary_encode()
        begins = np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False)))).astype(np.int64)
        yield i, begins, coded.dictionary.cast(pa.large_binary()).to_pylist(), coded.indices.to_numpy(zero_copy_only=False)


def frequent_runs(docs: DataFrame, text_col: str, frequent: int, run_bytes: int,
                  summary: int = 1 << 17) -> list[bytes]:
    """The most frequent runs over all texts, at most ``frequent`` of them, by falling count."""
    prepare(docs.sparkSession)

    def summarise(batches):
        seen: Counter = Counter()
        for batch in batches:
            for _, _, runs, at in _runs(batch.column(0)):
                for w, n in zip(runs, np.bincount(at, minlength=len(runs)).tolist()):
                    seen[w] = seen.get(w, 0) + n
                if len(seen) > 2 * summary:
                    seen = Counter(dict(seen.most_common(summary)))
        seen.pop(b"", None)
        best = [(w, n) for w, n in seen.most_common(frequent) if len(w) <= run_bytes]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in best], pa.binary()),
                                          pa.array([n for _, n in best], pa.int64())], ["run", "n"])

    sums = written(docs.select(text_col).mapInArrow(summarise, "run binary, n long")
                       .groupBy("run").agg(F.sum("n").alias("n")), "runs")
    best = most_frequent(sums, "n", frequent).collect()  # at most ``frequent`` short runs
    return [bytes(r.run) for r in sorted(best, key=lambda r: (-r.n, bytes(r.run)))]


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048, frequent: int = 1 << 14, run_bytes: int = 64,
                 cache: int = 1 << 18) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per input row.

    Null texts count as empty: zero bytes and tokens. Special strings inside a text are
    handled as the library does by default. Repeated rows are each counted; an empty
    table gives no rows; other columns are not read. The tokenizer must drop white space
    (``word_bpe_49k.json`` does); ``tokenizer_path`` must exist on every worker.
    """
    spark = docs.sparkSession
    runs = frequent_runs(docs, text_col, frequent, run_bytes)
    counts = _encode_json(tokenizer_path, [r.decode() for r in runs])
    # One blob and two small arrays instead of a pickled dictionary.
    table = spark.sparkContext.broadcast(
        (b" ".join(runs), np.array(counts, np.int32).tobytes()))

    def count(batches):
        blob, sizes = table.value
        known = dict(zip(blob.split(b" "), np.frombuffer(sizes, np.int32).tolist())) if sizes else {}
        known[b""] = 0
        held: dict[bytes, int] = {}
        for batch in batches:
            n_tokens = np.zeros(batch.num_rows, np.int64)
            for first, begins, runs, at in _runs(batch.column(1)):
                get, rare = known.get, held.get
                lens = [rare(w) if (v := get(w)) is None else v for w in runs]
                missing = [i for i, v in enumerate(lens) if v is None]
                if missing:
                    new = _encode_json(tokenizer_path, [runs[i].decode() for i in missing])
                    for i, v in zip(missing, new):
                        lens[i] = v
                    if len(held) + len(new) > cache:
                        held = {}
                    held |= zip([runs[i] for i in missing], new)
                sums = np.concatenate(([0], np.cumsum(np.array(lens, np.int64)[at])))
                n_tokens[first:first + len(begins) - 1] = sums[begins[1:]] - sums[begins[:-1]]
            _, offs = text_bytes(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(np.diff(offs)), pa.array(n_tokens),
                 pa.array(n_tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
                .mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"))
