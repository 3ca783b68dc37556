"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` cuts the corpus into segments of whole documents (about
``segment_words`` words). A segment holds its own inverted index: its terms in order, and
for each the ascending positions of all its occurrences, so every token of every text has
its posting. Segments are built where the documents are and nothing is shuffled.

A search asks every segment for test windows (runs of consecutive words):

1. a window with a term that the segment lacks is dropped by looking up all terms at once;
2. for the others the offset-adjusted position lists are intersected from the rarest term
   on. What is left are exact phrase matches;
3. ``proximity_matches`` keeps, from the same lists, the places where all terms of a window
   lie within a span in any order.

Windows come in blocks of at most ``BLOCK``, one broadcast and one pass over the segments a
block; all blocks are searched. Terms are 64-bit word hashes: a false match needs equal
hashes at every word of a window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm._tables import partition_id, prepare, written
from strata.llm._text import ALNUM, split_words

_GAP = 64  # positions left free between documents: no phrase or span crosses them
BLOCK = 1 << 17  # windows a pass
SEGMENT = ("segment long, terms binary, counts binary, deltas binary, "
           "starts array<int>, doc_ids array<long>, n_words array<long>")


@dataclass(frozen=True)
class Index:
    """``segments``: one row a segment. ``terms`` are sorted 64-bit hashes as differences,
    ``counts`` their occurrences, ``deltas`` the positions of term after term as
    differences (the first one of a term counts from 0)."""

    segments: DataFrame

    @property
    def docs(self) -> DataFrame:
        """``(segment, start, doc_id, n_words)``, one row per document."""
        z = F.explode(F.arrays_zip("starts", "doc_ids", "n_words")).alias("z")
        return self.segments.select("segment", z).select(
            "segment", F.col("z.starts").alias("start"), F.col("z.doc_ids").alias("doc_id"), F.col("z.n_words").alias("n_words"))


def _posting_lists(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted terms, their counts, and all positions by term (ascending within a term)."""
    order = np.argsort(h, kind="stable")
    h, at = h[order], at[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    return h[first], np.diff(np.concatenate((first, [len(h)]))), at


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_words: int = 1 << 20) -> Index:
    """Index every word of every text (null texts have none)."""
    prepare(docs.sparkSession)

    def index(batches):
        segment = partition_id() << 33
        hashes, places, ids, starts, counts, held = [], [], [], [], [], 0

        def flush():
            nonlocal segment, held
            if ids:
                terms, n, at = _posting_lists(np.concatenate(hashes), np.concatenate(places))
                first = np.concatenate(([0], np.cumsum(n)))[:-1]
                deltas = np.diff(at, prepend=0).astype(np.int32)
                deltas[first] = at[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([segment]), pa.array([np.diff(terms, prepend=np.uint64(0)).tobytes()], pa.binary()),
                     pa.array([n.astype(np.int32).tobytes()], pa.binary()), pa.array([deltas.tobytes()], pa.binary()),
                     pa.array([np.concatenate(starts).astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())),
                     pa.array([np.concatenate(counts)], pa.list_(pa.int64()))],
                    ["segment", "terms", "counts", "deltas", "starts", "doc_ids", "n_words"])
            for x in (hashes, places, ids, starts, counts):
                x.clear()
            segment, held = segment + 1, 0

        for batch in batches:
            for w in split_words(batch.column(1), ALNUM, max_bytes=min(1 << 21, 8 * segment_words)):
                n, offs = w.counts.astype(np.int64), w.offsets()
                start = held + np.concatenate(([0], np.cumsum(n + _GAP)))[:-1]
                hashes.append(w.hashes())
                places.append(np.arange(offs[-1]) + np.repeat(start - offs[:-1], n))
                ids.append(batch.column(0).slice(w.first, len(n)))
                starts.append(start)
                counts.append(n)
                held = int(start[-1] + n[-1] + _GAP)
                if held >= segment_words:
                    yield from flush()
        yield from flush()

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return Index(written(source.mapInArrow(index, SEGMENT), "index", compression="zstd"))


def windows_of(items: DataFrame, width: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, terms array)``: runs of ``width`` consecutive words of each
    item; an item of fewer words, but not none, is one window. Repeated windows and
    repeated items stay apart only by their item id."""
    prepare(items.sparkSession)

    def cut(batches):
        for batch in batches:
            for w in split_words(batch.column(1), ALNUM):
                h, offs = w.hashes().view(np.int64), w.offsets()
                for i in range(len(w.counts)):
                    own = h[offs[i]:offs[i + 1]]
                    if not len(own):
                        continue
                    runs = [own] if len(own) < width else [own[s:s + width] for s in range(len(own) - width + 1)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(0)[w.first + i].as_py()] * len(runs), pa.string()),
                         pa.array(runs, pa.list_(pa.int64()))], ["item_id", "terms"])

    return (items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("t"))
                 .mapInArrow(cut, "item_id string, terms array<long>").distinct())


class _Segment:
    """A segment's lists, looked up for a block of windows."""

    def __init__(self, row: dict):
        self.segment = row["segment"]
        self.terms = np.cumsum(np.frombuffer(row["terms"], np.uint64))
        self.n = np.frombuffer(row["counts"], np.int32).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.n)))
        self.deltas = np.frombuffer(row["deltas"], np.int32)
        self.starts = np.array(row["starts"], np.int64)
        self.doc_ids = pa.array(row["doc_ids"], pa.int64())

    def find(self, vocab: np.ndarray) -> np.ndarray:
        """Row of each term, -1 where the segment lacks it."""
        if not len(self.terms):
            return np.full(len(vocab), -1)
        at = np.minimum(np.searchsorted(self.terms, vocab), len(self.terms) - 1)
        return np.where(self.terms[at] == vocab, at, -1)

    def places(self, row: int) -> np.ndarray:
        return np.cumsum(self.deltas[self.first[row]:self.first[row + 1]], dtype=np.int64)

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        """Document of each position (documents without words have starts of their own)."""
        return np.searchsorted(self.starts, at, side="right") - 1


def _blocks(windows: DataFrame) -> Iterator[list]:
    """The windows in blocks by hash, each about ``BLOCK`` at most."""
    windows = written(windows, "windows")
    n = windows.count()
    blocks = -(-n // BLOCK) if n <= BLOCK else -(-n * 5 // (4 * BLOCK))  # room for uneven hashes
    for b in range(blocks):
        own = windows if blocks == 1 else windows.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == b)
        yield own.orderBy("item_id", "terms").collect()


def _search(index: Index, windows: DataFrame, meet, schema: str) -> DataFrame:
    """``meet(segment, items, rows, order)`` per segment and block: ``rows`` are the live
    windows' term rows, ``order`` their terms from the rarest on."""
    spark = index.segments.sparkSession
    out = []
    for block in _blocks(windows):
        sizes = np.array([len(r["terms"]) for r in block])
        flat = np.array([t for r in block for t in r["terms"]], np.int64).view(np.uint64)
        vocab, at = np.unique(flat, return_inverse=True)
        shared = spark.sparkContext.broadcast(([r["item_id"] for r in block], sizes, vocab, at.astype(np.int32)))

        def run(batches, shared=shared):
            items, sizes, vocab, at = shared.value
            offs = np.concatenate(([0], np.cumsum(sizes)))
            for batch in batches:
                for row in batch.to_pylist():
                    seg = _Segment(row)
                    rows = seg.find(vocab)[at]
                    for i in np.flatnonzero(np.minimum.reduceat(rows, offs[:-1]) >= 0).tolist():
                        own = rows[offs[i]:offs[i + 1]]
                        yield from meet(seg, items[i], own, np.argsort(seg.n[own], kind="stable"))

        out.append(index.segments.drop("n_words").mapInArrow(run, schema))
    if not out:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, out)


def phrase_matches(index: Index, windows: DataFrame) -> DataFrame:
    """Exact occurrences: ``(segment, start, doc_id, item_id, first, last)``, word
    positions inside the document, one row per window and place."""

    def meet(seg, item, rows, order):
        at = None  # candidate places of the window's first word
        for k in order.tolist():
            own = seg.places(rows[k]) - k
            at = own if at is None else at[own[np.minimum(np.searchsorted(own, at), len(own) - 1)] == at]
            if not len(at):
                return
        doc = seg.doc_of(at)
        first = at - seg.starts[doc]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), seg.segment)), pa.array(seg.starts[doc]), seg.doc_ids.take(pa.array(doc)),
             pa.array([item] * len(at), pa.string()), pa.array(first), pa.array(first + len(rows) - 1)],
            ["segment", "start", "doc_id", "item_id", "first", "last"])

    return _search(index, windows, meet, "segment long, start long, doc_id long, item_id string, first long, last long")


def proximity_matches(index: Index, windows: DataFrame, span: int) -> DataFrame:
    """``(doc_id, item_id, first, last)``: for every occurrence of a window's rarest term,
    the first stretch of ``span`` words of the document that holds it and all other
    distinct terms of the window, in any order. ``span`` is at most 64."""
    if not 1 <= span <= _GAP:
        raise ValueError(f"span must be 1 to {_GAP}")
    none = np.iinfo(np.int64).max

    def meet(seg, item, rows, order):
        uniq = list(dict.fromkeys(rows[order].tolist()))
        anchors = seg.places(uniq[0])
        others = [seg.places(r) for r in uniq[1:]]
        best = np.full(len(anchors), none)
        for shift in range(span - 1, -1, -1):  # the stretch starts at anchor - shift
            lo = anchors - shift
            ok = best == none
            for own in others:
                k = np.searchsorted(own, lo)
                ok &= (k < len(own)) & (own[np.minimum(k, len(own) - 1)] < lo + span)
            best[ok] = lo[ok]
        hit = best < none
        if hit.any():
            doc = seg.doc_of(anchors[hit])
            first = best[hit] - seg.starts[doc]
            yield pa.RecordBatch.from_arrays(
                [seg.doc_ids.take(pa.array(doc)), pa.array([item] * len(first), pa.string()),
                 pa.array(np.maximum(first, 0)), pa.array(first + span - 1)], ["doc_id", "item_id", "first", "last"])

    return _search(index, windows, meet, "doc_id long, item_id string, first long, last long").distinct()


def contamination(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document row: ``doc_id, n_words, n_hit, items`` (ids as sorted strings).

    ``n_hit`` counts words inside any occurrence of a window of any item. Null and empty
    texts have no words and hit nothing; an empty benchmark or table gives zeros or no
    rows. Items with null ids count under no id (their words are still hit). Repeated
    rows are each reported. Other columns are not read.
    """
    index = build_index(docs, id_col, text_col)
    hits = written(phrase_matches(index, windows_of(items, width, item_col, item_text)), "phrases")
    # Words covered by the union of the occurrences of one document row.
    spans = hits.select("segment", "start", "first", "last").distinct()
    w = Window.partitionBy("segment", "start").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    covered = (spans.withColumn("_seen", F.coalesce(F.max("last").over(w), F.lit(-1)))
                    .withColumn("_new", F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("_seen") + 1, F.col("first")) + 1))
                    .groupBy("segment", "start").agg(F.sum("_new").alias("n_hit")))
    named = hits.groupBy("segment", "start").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    return (index.docs.join(covered, ["segment", "start"], "left").join(named, ["segment", "start"], "left")
                 .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items")))
