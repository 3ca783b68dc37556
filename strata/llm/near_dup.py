"""MinHash near-duplicates with sequential Bayesian verification.

1. Every whole text becomes its set of distinct k-word shingles (64-bit hashes), a
   128-bit key of that set and a MinHash signature of one byte a value. Texts with
   equal sets fold into one class; only class representatives go on.
2. Signatures are banded. First each bucket's members are paired with one pivot (rows in
   proportion to the bucket), and the verified links are folded into components. Buckets
   whose members then lie in one component are finished: a group of thousands of copies
   never meets pair by pair.
3. Members of different components that still share a bucket are compared inside tasks,
   in chunks of at most ``chunk`` members against each other, and each pair only in its
   first common band. Nothing is capped: every pair of components that shares a bucket
   is decided.
4. A candidate pair's signatures are compared batch by batch. After each batch the Beta
   posterior of the similarity decides: if it reaches the threshold with probability
   below ``miss``, the pair is pruned.
5. Survivors are verified exactly on the full shingle sets, and components of the
   verified links give the classes.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._components import components
from strata.llm._tables import prepare, shuffle_partitions, written
from strata.llm._text import SPACED, shingles, split_words


@dataclass(frozen=True)
class NearDupParams:
    """``k`` words a shingle; link at similarity >= ``num``/``den``.

    ``bands`` x ``rows`` signature values: a pair exactly at 0.8 shares no bucket with
    probability (1 - 0.8**6)**40 = 5e-6. ``miss`` is the posterior probability of a link
    below which a pair is pruned; ``batch`` values are compared at a time; ``chunk``
    members of a bucket, and sets of ``unit`` shingles a side, are held by a task at a time.
    """

    k: int = 5
    num: int = 4
    den: int = 5
    bands: int = 40
    rows: int = 6
    batch: int = 24
    miss: float = 1e-4
    chunk: int = 1024
    unit: int = 1 << 20
    seed: int = 17

    @property
    def values(self) -> int:
        return self.bands * self.rows


def _hash_params(p: NearDupParams) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(p.seed)
    return (rng.integers(0, 1 << 32, p.values, dtype=np.uint32) | np.uint32(1),
            rng.integers(0, 1 << 32, p.values, dtype=np.uint32))


def minhash(sets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Signature of one set of 64-bit hashes: under each of len(a) maps the minimum,
    mixed down to a byte (two sets agree with probability S + (1 - S) / 256)."""
    x = (sets ^ (sets >> np.uint64(32))).astype(np.uint32)
    best = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        v = x[i:i + 512, None] * a
        v += b
        np.minimum(best, v.min(axis=0), out=best)
    return ((best * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def shingle_sets(col, k: int):
    """Per text of an Arrow string column: its sorted distinct shingle hashes."""
    for w in split_words(col, SPACED):
        sh, per = shingles(w.hashes(), w.counts, k)
        offs = np.concatenate(([0], np.cumsum(per)))
        for i in range(len(per)):
            yield np.unique(sh[offs[i]:offs[i + 1]])


def signatures(docs: DataFrame, p: NearDupParams, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``(id, text_key, n, key, sig)`` for every row; ``key`` and ``sig`` are null for empty
    sets, ``text_key`` is a hash of the text."""
    prepare(docs.sparkSession)

    def sign(batches):
        a, b = _hash_params(p)
        for batch in batches:
            ns, keys, sigs = [], [], []
            for s in shingle_sets(batch.column(2), p.k):
                ns.append(len(s))
                keys.append(_set_key(s))
                sigs.append(minhash(s, a, b).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ns, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(sigs, pa.binary())], ["id", "text_key", "n", "key", "sig"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_key"),
                        F.col(text_col).alias("t"))
                .mapInArrow(sign, "id long, text_key long, n long, key binary, sig binary"))


def _signature_rows(col, p: NearDupParams) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, p.values)


def bands_of(reps: DataFrame, p: NearDupParams) -> DataFrame:
    """``(bkey, id, n)``: one row per band; ``bkey`` holds the band and its six bytes."""

    def cut(batches):
        band = np.arange(p.bands, dtype=np.int64)
        for batch in batches:
            sig = _signature_rows(batch.column(2), p).reshape(-1, p.bands, p.rows).astype(np.int64)
            key = np.tile(band, (len(sig), 1))
            for r in range(p.rows):
                key = (key << 8) | sig[:, :, r]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.reshape(-1)), pa.array(np.repeat(batch.column(0).to_numpy(), p.bands)),
                 pa.array(np.repeat(batch.column(1).to_numpy(), p.bands))], ["bkey", "id", "n"])

    return reps.select("id", "n", "sig").mapInArrow(cut, "bkey long, id long, n long")


@lru_cache(maxsize=None)
def prune_below(total: int, batch: int, num: int, den: int, miss: float) -> tuple[int, ...]:
    """For each batch end m: the fewest agreements of m that keep a pair.

    With a uniform prior the posterior after M of m agreements is Beta(M+1, m-M+1), and
    P(p >= t) is the chance that m+1 Bernoulli(t) trials show at most M successes; t is
    the agreement probability of one-byte values at the threshold.
    """
    t = num / den + (1 - num / den) / 256
    out = []
    for m in range(batch, total + 1, batch):
        acc, keep = 0.0, m + 1
        for x in range(m + 1):
            acc += math.exp(math.lgamma(m + 2) - math.lgamma(x + 1) - math.lgamma(m + 2 - x)
                            + x * math.log(t) + (m + 1 - x) * math.log1p(-t))
            if acc >= miss:
                keep = x
                break
        out.append(keep)
    return tuple(out)


def _sequential(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, p: NearDupParams) -> np.ndarray:
    """Positions of the pairs (x[i], y[j]) that survive the batch-by-batch test."""
    live = np.arange(len(i))
    seen = np.zeros(len(i), np.int64)
    for s, least in enumerate(prune_below(p.values, p.batch, p.num, p.den, p.miss)):
        cut = slice(s * p.batch, (s + 1) * p.batch)
        seen[live] += (x[i[live], cut] == y[j[live], cut]).sum(axis=1)
        live = live[seen[live] >= least]
        if not len(live):
            break
    return live


def _size_ok(n, m, p: NearDupParams):
    """Set sizes alone already bound the similarity."""
    return (n * p.den >= m * p.num) & (m * p.den >= n * p.num)


def _pivot_pairs(buckets: DataFrame, reps: DataFrame, p: NearDupParams) -> DataFrame:
    """Survivors among the pairs of a bucket's members with its smallest member."""

    def compare(batches):
        for batch in batches:
            if batch.num_rows:
                at = np.arange(batch.num_rows)
                live = _sequential(_signature_rows(batch.column(2), p), _signature_rows(batch.column(3), p),
                                   at, at, p)
                yield batch.select([0, 1]).take(pa.array(live))

    pivot = buckets.groupBy("bkey").agg(F.min(F.struct("id", "n")).alias("_m"))
    pivot = pivot.select("bkey", F.col("_m.id").alias("a"), F.col("_m.n").alias("na"))
    pairs = (buckets.join(pivot, "bkey")
                    .filter((F.col("id") != F.col("a")) & _size_ok(F.col("n"), F.col("na"), p))
                    .select("a", F.col("id").alias("b")).distinct())
    sigs = reps.select("id", "sig")
    return (pairs.join(sigs.toDF("a", "sa"), "a").join(sigs.toDF("b", "sb"), "b")
                 .select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long"))


def _bucket_pairs(mixed: DataFrame, reps: DataFrame, p: NearDupParams) -> DataFrame:
    """Survivors among all pairs of members of different components in one bucket, as
    blocks: rows of two arrays ``(a, b)`` of equal length.

    ``mixed``: ``(bkey, id, n, comp)``. A bucket is dealt out as pairs of chunks.
    """
    sizes = mixed.groupBy("bkey").agg(F.ceil(F.count(F.lit(1)) / F.lit(p.chunk)).cast("int").alias("c"))
    mine = F.pmod(F.xxhash64("id"), F.col("c")).cast("int")
    dealt = (mixed.join(sizes, "bkey").withColumn("_mine", mine)
                  .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
                  .select("bkey", F.least("_mine", "_other").alias("lo"), F.greatest("_mine", "_other").alias("hi"),
                          (F.col("_mine") > F.col("_other")).alias("right"), "id", "n", "comp"))
    dealt = (dealt.join(reps.select("id", "sig"), "id")
                  .select("bkey", "lo", "hi", "right", "id", "n", "comp", "sig"))

    def meet(rows: pa.Table):
        """One pair of chunks: its surviving pairs."""
        band = rows.column("bkey")[0].as_py() >> (8 * p.rows)
        ids, n, comp = (rows.column(c).to_numpy() for c in ("id", "n", "comp"))
        right = rows.column("right").to_numpy(zero_copy_only=False)
        same = rows.column("lo")[0].as_py() == rows.column("hi")[0].as_py()
        sig = _signature_rows(rows.column("sig"), p)
        xs = np.arange(len(ids)) if same else np.flatnonzero(~right)
        ys = xs if same else np.flatnonzero(right)
        for s in range(0, len(xs), 128):
            x = xs[s:s + 128]
            open_ = (comp[x][:, None] != comp[ys]) & _size_ok(n[x][:, None], n[ys], p)
            if same:
                open_ &= ids[x][:, None] < ids[ys]
            i, j = np.nonzero(open_)
            i, j = x[i], ys[j]
            live = _sequential(sig, sig, i, j, p)
            i, j = i[live], j[live]
            first = np.zeros(len(i), bool)
            for t in range(0, len(i), 4096):
                cut = slice(t, t + 4096)
                agree = (sig[i[cut]] == sig[j[cut]]).reshape(-1, p.bands, p.rows).all(axis=2)
                first[cut] = agree.argmax(axis=1) == band
            i, j = i[first], j[first]
            # One row a block of pairs, cut so that each side's sets stay small together.
            part = [(np.cumsum(n) // p.unit)[np.searchsorted(own, at)]
                    for at, own, n in ((i, np.unique(i), n[np.unique(i)]), (j, np.unique(j), n[np.unique(j)]))]
            for u, v in sorted(set(zip(part[0].tolist(), part[1].tolist()))):
                at = (part[0] == u) & (part[1] == v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i[at]]], pa.list_(pa.int64())), pa.array([ids[j[at]]], pa.list_(pa.int64()))],
                    ["a", "b"])

    def runs(batches):
        """Rows arrive sorted by (bkey, lo, hi); a run may cross batches."""
        held: list[pa.Table] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            k, lo, hi = (t.column(c).to_numpy() for c in ("bkey", "lo", "hi"))
            cut = np.flatnonzero((k[1:] != k[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
            edges = [0, *cut.tolist(), len(k)]
            for s, e in zip(edges, edges[1:]):
                key = (k[s], lo[s], hi[s])
                if key != last and held:
                    yield from meet(pa.concat_tables(held).combine_chunks())
                    held = []
                last = key
                held.append(t.slice(s, e - s))
        if held:
            yield from meet(pa.concat_tables(held).combine_chunks())

    keys = ("bkey", "lo", "hi")
    return (dealt.repartition(shuffle_partitions(mixed.sparkSession), *keys)
                 .sortWithinPartitions(*keys).mapInArrow(runs, "a array<long>, b array<long>"))


def _set_key(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _sets_of(ids: DataFrame, reps: DataFrame, docs: DataFrame, p: NearDupParams) -> DataFrame:
    """``(id, s)``: the full shingle sets of the classes in ``ids``, from whole texts."""
    prepare(docs.sparkSession)

    def sets(batches):
        for batch in batches:
            own, cells = [], []
            for node, key, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    shingle_sets(batch.column(2), p.k)):
                if _set_key(s) == key:  # an id may repeat with another text
                    own.append(node)
                    cells.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(cells, pa.binary())],
                                             ["id", "s"])

    need = reps.join(ids.distinct(), "id").select("id", "key", F.col("rep").alias("doc"))
    return written(docs.join(need, "doc").select("id", "key", "t")
                       .mapInArrow(sets, "id long, s binary").dropDuplicates(["id"]), "near-sets")


def _linked(x: np.ndarray, y: np.ndarray, p: NearDupParams) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return p.den * both >= p.num * (len(x) + len(y) - both)


def _exact_pairs(pairs: DataFrame, reps: DataFrame, docs: DataFrame, p: NearDupParams) -> DataFrame:
    """Pairs ``(a, b)`` whose full shingle sets reach the threshold."""

    def verify(batches):
        for batch in batches:
            keep = [_linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), p)
                    for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("id")), reps, docs, p)
    return (pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
                 .select("a", "b", "sa", "sb").mapInArrow(verify, "a long, b long"))


def _exact_blocks(blocks: DataFrame, reps: DataFrame, docs: DataFrame, p: NearDupParams) -> DataFrame:
    """Verified links of blocks ``(unit, a array, b array)``.

    A block's sets travel once to the task that decides its pairs. Links whose ends the
    block has already connected are not tested again: they change no component.
    """

    def decide(a, b, sets):
        root: dict[int, int] = {}

        def find(v):
            while root.get(v, v) != v:
                root[v] = v = root.get(root[v], root[v])
            return v

        found = []
        for u, v in zip(a, b):
            x, y = find(u), find(v)
            if x != y and u in sets and v in sets and _linked(sets[u], sets[v], p):
                root[max(x, y)] = min(x, y)
                found.append((u, v))
        return pa.RecordBatch.from_arrays(
            [pa.array([u for u, _ in found], pa.int64()), pa.array([v for _, v in found], pa.int64())], ["a", "b"])

    def verify(batches):
        """Rows arrive sorted by unit, a unit's member rows before its pairs."""
        sets: dict[int, np.ndarray] = {}
        unit = None
        for batch in batches:
            for u, i, s, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                if u != unit:
                    unit, sets = u, {}
                if s is not None:
                    sets[i] = np.frombuffer(s, np.uint64)
                else:
                    yield decide(a, b, sets)

    member = blocks.select("unit", F.explode(F.array_distinct(F.concat("a", "b"))).alias("id"))
    sets = _sets_of(member.select("id"), reps, docs, p)
    rows = (member.join(sets, "id").select("unit", "id", "s", F.lit(None).cast("array<long>").alias("a"),
                                           F.lit(None).cast("array<long>").alias("b"))
            .unionByName(blocks.select("unit", F.lit(None).cast("long").alias("id"),
                                       F.lit(None).cast("binary").alias("s"), "a", "b")))
    return (rows.repartition(shuffle_partitions(blocks.sparkSession), "unit")
                .sortWithinPartitions(F.col("unit"), F.col("s").isNull())
                .mapInArrow(verify, "a long, b long"))


def links(docs: DataFrame, reps: DataFrame, p: NearDupParams) -> DataFrame:
    """Verified links ``(a, b)`` that connect the representatives as all links would.

    ``docs``: ``(doc, t)``; ``reps``: ``(id, rep, key, n, sig)``, one row per class, where
    ``rep`` is the ``doc`` that carries the class's set.
    """
    rows = bands_of(reps, p)
    shared = rows.groupBy("bkey").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("bkey")
    buckets = written(rows.join(shared, "bkey"), "near-buckets")
    live = written(_pivot_pairs(buckets, reps, p), "near-live")
    found = written(_exact_pairs(live, reps, docs, p), "near-links")
    comp = components(found)
    mixed = buckets.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    mixed = written(mixed, "near-mixed")
    several = (mixed.groupBy("bkey").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                    .filter("lo <> hi").select("bkey"))
    blocks = written(_bucket_pairs(mixed.join(several, "bkey"), reps, p)
                     .withColumn("unit", F.monotonically_increasing_id()), "near-blocks")
    return found.unionByName(written(_exact_blocks(blocks, reps, docs, p), "near-links"))


def near_duplicates(docs: DataFrame, p: NearDupParams = NearDupParams(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept, text_key`` (the
    last a hash of the text, which tells rows of one id apart).

    ``component_id`` is the smallest id reachable over links (its own included) and
    ``kept`` marks it. Texts without words (null, empty) have an empty set and link with
    nothing. Repeated rows fold into their class; rows that repeat an id with the same
    set are all marked alike. A row whose id is null takes its class's id if a row with
    an id has the same set, else its component is null and it is kept. An empty table
    gives an empty result. Other columns are not read.
    """
    sig = written(signatures(docs, p, id_col, text_col), "near-sig")
    classes = written(sig.filter("key is not null").groupBy("key").agg(F.min("id").alias("rep"))
                         .withColumn("node", F.monotonically_increasing_id()), "near-classes")
    named = classes.filter("rep is not null")
    # One signature per class: that of a row which carries the class's smallest id.
    reps = written(sig.join(named.withColumnRenamed("rep", "id"), ["key", "id"])
                      .dropDuplicates(["node"])
                      .select(F.col("node").alias("id"), F.col("id").alias("rep"), "key", "n", "sig"),
                   "near-reps")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("t"))
    comp = components(links(texts, reps, p)).toDF("node", "comp")
    comp = comp.join(named.select("node", "rep"), "node")
    first = comp.groupBy("comp").agg(F.min("rep").alias("first"))
    smallest = comp.join(first, "comp").select("node", "first")
    by_key = classes.join(smallest, "node", "left").select("key", F.coalesce("first", "rep").alias("cid"))
    out = sig.select("id", "n", "key", "text_key").join(by_key, "key", "left")
    cid = F.coalesce("cid", "id")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                      cid.alias("component_id"), F.col("id").eqNullSafe(cid).alias("kept"), "text_key")
