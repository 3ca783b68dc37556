"""Approximate nearest neighbours: NN-descent graph and greedy graph search.

Layout. Nodes lie in shards, leaves of a projection tree over a bounded number of sample
nodes; a node's number is its shard and its place there, so everybody knows who holds a
node. A shard's vectors, codes and lists are arrays in one row each. Work is done where
these lie: rows of arrays travel between shards (``_met``), never a row per vector, edge
or candidate.

Building. Vectors are normalised and quantised to one byte a component (only the graph is
built from these; results are scored on the original vectors). A start graph comes from a
few projection trees: vectors of one leaf meet. Then NN-descent: every node joins with its
neighbours and a sample of the nodes that name it, all of these meet, and a node keeps the
best ``degree`` it has met. Only meetings with something new take part, so the rounds
shrink; building stops when hardly any list changes. Memory per node is bounded by the
degree, and every vector is a node.

Searching. A query that is itself a node starts there, others at the nearest of a bounded
set of seeds. Each round asks the graph's shards for the neighbours of the best unexpanded
nodes of a query's beam, has the new ones scored by the shards that hold their vectors, and
keeps the best ``beam``. It ends when nothing in any beam is unexpanded. All queries take
part in each round, so the number of jobs does not grow with them; every row is a candidate.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm._tables import shuffle_partitions, written


@dataclass(frozen=True)
class AnnParams:
    """``degree`` neighbours a node; ``projections`` trees whose start leaves hold up to four
    times ``block``; at most ``rounds`` rounds, fewer once less than ``settled`` of all
    neighbours changed; in a meeting each member gets its ``offers`` best. ``beam`` nodes are kept
    per query, ``expand`` expanded at a time, and up to ``query_block`` queries share a task's
    arrays. A search returns fewer than ``ids_kept`` rows a query."""

    degree: int = 30
    projections: int = 6
    block: int = 256
    rounds: int = 8
    settled: float = 0.02
    offers: int = 6
    beam: int = 256
    expand: int = 64
    seeds: int = 256
    query_block: int = 1 << 14
    ids_kept: int = 101
    seed: int = 9


@dataclass(frozen=True)
class AnnIndex:
    """``vectors``: (id, v array<double>), all rows; ``members``: (node, id, _r), the ``ids_kept``
    smallest ids of each node in order, which goes by its smallest; ``shards``: (dest, keys, codes, exact),
    a row per shard with its nodes' ids and vectors; ``graph``: rows of the nodes' neighbours,
    both ways; ``parts``: tasks over the shards."""

    vectors: DataFrame
    members: DataFrame
    shards: DataFrame
    graph: DataFrame
    dim: int
    parts: int


def usable(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """``(id, v array<double>)`` of the vectors that take part, and their length.

    Null ids, null vectors, vectors with null or non-finite components, zero vectors and
    vectors of another length than the most frequent one take no part; of rows that repeat
    an id the smallest vector counts.
    """
    v = F.col("v")
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
              .filter(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                      & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(v, lambda x: x != 0)))
    # vectors are sorted by id only where an id repeats
    if rows.groupBy("id").count().filter("count > 1").limit(1).count():
        rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    rows = written(rows, "ann-vectors")
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = top["d"] if top else 1
    return rows.filter(F.size("v") == dim), dim


# ---------------------------------------------------------------- rows of arrays

#: ``dest``: the shard, block or bucket a row goes to; ``src``: the one it comes from.
MESSAGE = "dest int, kind int, src int, data binary"
OWN, CODES, LISTS, EDGES, MEMBERS, ASKED, TOLD, OFFERS, COUNT, BEAMS, FRONT, NEAR, SCORED, EXACT, ENDED = range(15)
_FLUSH = 8 << 20


def _pack(*arrays) -> bytes:
    return pickle.dumps(arrays, 5)


def _rows(found: Iterable[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size from tuples whose last member is binary."""
    held, size = [], 0
    for row in found:
        held.append(row)
        size += len(row[-1])
        if size > _FLUSH:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in held], _schema(names))
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in held], _schema(names))


def _schema(names: list[str]) -> pa.Schema:
    kinds = {"dest": pa.int32(), "kind": pa.int32(), "src": pa.int32()}
    return pa.schema([(x, kinds.get(x, pa.binary())) for x in names])


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _sent(rows: DataFrame, step: Callable, schema: str = MESSAGE) -> DataFrame:
    """What ``step(dest, arrays)`` makes of each row of ``(dest, data)``."""
    names = _names(schema)

    def run(batches):
        yield from _rows((out for batch in batches for d, x in zip(batch.column(0).to_pylist(), batch.column(1))
                          for out in step(d, pickle.loads(x.as_buffer()))), names)

    return rows.mapInArrow(run, schema)


def _met(rows: DataFrame, parts: int, step: Callable, schema: str = MESSAGE) -> DataFrame:
    """What ``step(dest, {kind: [(src, arrays)]})`` makes of the rows that meet at each ``dest``."""
    names = _names(schema)

    def groups(batches):
        at, got = None, {}
        for batch in batches:
            dest, kind, src = (batch.column(i).to_pylist() for i in range(3))
            for j, x in enumerate(batch.column(3)):
                if at is not None and dest[j] != at:
                    yield at, got
                    got = {}
                at = dest[j]
                got.setdefault(kind[j], []).append((src[j], pickle.loads(x.as_buffer())))
        if at is not None:
            yield at, got

    def run(batches):
        yield from _rows((out for at, got in groups(batches) for out in step(at, got)), names)

    # dests are numbered through, so this deals them evenly
    placed = rows.repartitionById(parts, F.pmod("dest", F.lit(parts)).cast("int"))
    return placed.sortWithinPartitions("dest", "kind", "src").mapInArrow(run, schema)


def _as_rows(df: DataFrame, col: str, kind: int) -> DataFrame:
    return df.select("dest", F.lit(kind).alias("kind"), F.lit(-1).alias("src"), F.col(col).alias("data"))


def _of(rows: DataFrame, kind: int) -> DataFrame:
    return rows.filter(F.col("kind") == kind)


def _deal(owner: np.ndarray, *cols: np.ndarray) -> Iterator[tuple]:
    """``(owner, cols of it)`` for each owner."""
    if len(owner):
        order = np.argsort(owner.astype(np.uint16) if owner.max() < 1 << 16 else owner, kind="stable")
        yield from _runs(owner[order], *(c[order] for c in cols))


def _runs(owner: np.ndarray, *cols: np.ndarray) -> Iterator[tuple]:
    """The same where each owner's entries come one after the other."""
    ends = [0, *(np.flatnonzero(owner[1:] != owner[:-1]) + 1).tolist(), len(owner)]
    for a, b in zip(ends, ends[1:]):
        if b > a:
            yield (int(owner[a]), *(c[a:b] for c in cols))


def _cat(parts: list, dtype) -> np.ndarray:
    return np.concatenate(parts).astype(dtype, copy=False) if parts else np.zeros(0, dtype)


def _thin(n: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in four bytes, if they fit."""
    return n.astype(np.uint32) if not n.size or n.max() < 1 << 32 else n


# ---------------------------------------------------------------- numbers and nearness

#: A node's number is its shard, then its place there, 20 bits each at most.
_PLACE = 20
_PLACES = (1 << _PLACE) - 1
_NUMBERS = (1 << 2 * _PLACE) - 1
#: Entries that are ranked at once.
_ENTRIES = (1 << 24) - 1
#: A cosine in whole steps, so that a pair has one nearness wherever it meets. What differs by
#: less than the codes can tell is as near.
_STEPS = 14
_TOP = (1 << _STEPS) - 1


def _steps(s: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((s.astype(np.float64) + 1) * (1 << _STEPS - 1)), 0, _TOP).astype(np.uint32)


def _above(steps: np.ndarray) -> np.ndarray:
    """The cosine from which on something is nearer than ``steps``."""
    return ((steps.astype(np.float64) + 0.5) / (1 << _STEPS - 1) - 1).astype(np.float32)


def _rank(at: np.ndarray) -> np.ndarray:
    """Place of each entry among those of its ``at``, which come one after the other."""
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else np.zeros(0, np.int64)
    return np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))


def _hash(a: np.ndarray, b: np.ndarray, c: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(c)
        for k in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x = (x ^ (x >> np.uint64(33))) * np.uint64(k)
        return x ^ (x >> np.uint64(33))


def _nearest(at: np.ndarray, n: np.ndarray, s: np.ndarray, k: int) -> np.ndarray:
    """Of entries ``(at, n, s in steps)`` the best ``k`` distinct ``n`` of each ``at``: where they
    are, by ``at`` and nearness; of equal ones the first. ``at`` below 2 ** 20. As near ones come
    in an order of each ``at``'s own, else many that lie in one place would all name the same few."""
    if len(at) > _ENTRIES:  # the place of an entry is to fit into the key
        mid = np.uint64(np.median(at))
        low, high = np.flatnonzero(at < mid), np.flatnonzero(at >= mid)
        if len(low) and len(high):
            return np.concatenate([i[_nearest(at[i], n[i], s[i], k)] for i in (low, high)])
        order = np.lexsort((n, _hash(at, n, 0), _TOP - s.astype(np.int64), at))
        a, m = at[order], n[order]
        order = order[np.concatenate(([True], (a[1:] != a[:-1]) | (m[1:] != m[:-1])))]
        return order[_rank(at[order]) < k]
    key = (at.astype(np.uint64) << np.uint64(44)) | ((_TOP - s.astype(np.uint64)) << np.uint64(24)) | np.arange(len(at), dtype=np.uint64)
    key.sort()
    i = (key & np.uint64(_ENTRIES)).astype(np.int64)
    key >>= np.uint64(24)
    same = key[1:] == key[:-1]
    if same.any():
        tied = np.zeros(len(i), bool)
        tied[1:] |= same
        tied[:-1] |= same
        tied = np.flatnonzero(tied)
        own = i[tied]
        i[tied] = own[np.lexsort((n[own], _hash(at[own], n[own], 0), key[tied]))]
        i = i[np.concatenate(([True], ~(same & (n[i[1:]] == n[i[:-1]]))))]
    return i[_rank(at[i]) < k]


def _codes(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte a component of the normalised vectors, and the scales; sums of products of the
    codes stay whole numbers of float32."""
    levels = min(127, int(np.sqrt((1 << 24) / v.shape[1])))
    x = v / np.abs(v).max(axis=1, keepdims=True)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    scale = (np.abs(x).max(axis=1) / levels).astype(np.float32)
    return np.rint(x / scale[:, None]).astype(np.int8), scale


def _matrix(col, dim: int) -> np.ndarray:
    flat = col.flatten() if hasattr(col, "flatten") else col
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _short(v: np.ndarray) -> np.ndarray:
    """The same numbers in half the bytes, if they fit."""
    with np.errstate(over="ignore"):
        x = v.astype(np.float32)
    return x if (x == v).all() else v


# ---------------------------------------------------------------- trees

def _jitter(keys: np.ndarray) -> np.ndarray:
    """Parts nodes that lie in one place."""
    return (keys.view(np.uint64) >> np.uint64(48)).astype(np.float32) * np.float32(1e-6 / 65536)


def _tree(x: np.ndarray, jitter: np.ndarray, depth: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Normals and offsets of the splits of a tree, in the order of a heap."""
    normals, at = np.zeros(((1 << depth) - 1, x.shape[1]), np.float32), np.zeros((1 << depth) - 1, np.float32)
    inside = [np.arange(len(x))]
    for node in range(len(at)):
        i = inside[node]
        a, b = x[rng.choice(i, 2)] if len(i) > 1 else (rng.standard_normal(x.shape[1]), 0)
        normal = (a - b).astype(np.float32)
        if not normal.any():
            normal = rng.standard_normal(x.shape[1]).astype(np.float32)
        normals[node] = normal / np.sqrt((normal * normal).sum())
        y = x[i] @ normals[node] + jitter[i]
        at[node] = np.median(y) if len(i) else 0
        inside += [i[y < at[node]], i[y >= at[node]]]
    return normals, at


def _leaf(tree: tuple[np.ndarray, np.ndarray], x: np.ndarray, jitter: np.ndarray) -> np.ndarray:
    normals, at = tree
    node = np.zeros(len(x), np.int64)
    for _ in range(len(at).bit_length()):
        right = np.einsum("ij,ij->i", x, normals[node]) + jitter >= at[node]
        node = 2 * node + 1 + right
    return node - len(at)


def _leaves(x: np.ndarray, most: int, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Halves of halves until each holds up to ``most``."""
    todo = [np.arange(len(x))]
    while todo:
        i = todo.pop()
        if len(i) <= most:
            yield i
            continue
        a, b = x[rng.choice(i, 2, replace=False)]
        y = x[i] @ (a - b)
        order = np.argpartition(y, len(i) // 2)
        todo += [i[order[:len(i) // 2]], i[order[len(i) // 2:]]]


def _sharded(nodes: DataFrame, dim: int, n: int, p: AnnParams) -> tuple[DataFrame, int, list, int]:
    """Rows of shards, how many there may be, the trees, and the tasks over the shards."""
    parts = shuffle_partitions(nodes.sparkSession)
    size = max(1024, min(-(-n // parts), 1 << 14, (1 << 21) // dim))
    depth = max(0, int(np.ceil(np.log2(max(1, n) / size))))
    share = min(1.0, 32 * (1 << depth) / max(1, n))  # so that a split is at a median, near enough
    picked = nodes.filter(F.pmod(F.xxhash64("id", F.lit(p.seed + 1)), F.lit(1 << 20)) < int(np.ceil(share * (1 << 20))))
    t = picked.select("id", "h", "v").toArrow().sort_by("id") if depth else None
    trees = []
    for k in range(p.projections if depth else 1):
        if not depth:
            trees.append((np.zeros((0, dim), np.float32), np.zeros(0, np.float32)))
            continue
        q, scale = _codes(_matrix(t["v"].combine_chunks(), dim))
        trees.append(_tree(q * scale[:, None], _jitter(t["h"].to_numpy()), depth, np.random.default_rng(p.seed + k)))
    tree = trees[0]

    def place(batches):
        def found():
            for batch in batches:
                if not batch.num_rows:
                    continue
                v = _matrix(batch.column(2), dim)
                q, scale = _codes(v)
                h = batch.column(1).to_numpy()
                leaf = _leaf(tree, q * scale[:, None], _jitter(h))
                for d, *cols in _deal(leaf, batch.column(0).to_numpy(), h, q, scale, _short(v)):
                    yield d, OWN, 0, _pack(*cols)
        yield from _rows(found(), _names(MESSAGE))

    def settle(at, got):
        ids, h, q, scale, v = (np.concatenate([x[1][i] for x in got[OWN]]) for i in range(5))
        order = np.argsort(ids)
        yield at, _pack(ids[order], h[order]), _pack(q[order], scale[order], _jitter(h[order])), _pack(ids[order], v[order])

    tasks = min(1 << depth, 4 * parts)
    rows = _met(nodes.select("id", "h", "v").mapInArrow(place, MESSAGE), tasks, settle,
                "dest int, keys binary, codes binary, exact binary")
    return written(rows, "ann-shards"), 1 << depth, trees, tasks


def _places(shards: DataFrame) -> DataFrame:
    """``(id, h, i)``: the nodes' ids, hashes of their vectors, and numbers."""

    def run(batches):
        for batch in batches:
            for d, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, h = pickle.loads(x.as_buffer())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(h), pa.array((d << _PLACE) + np.arange(len(ids)))], ["id", "h", "i"])

    return shards.select("dest", "keys").mapInArrow(run, "id long, h long, i long")


# ---------------------------------------------------------------- building

def _lists(m: int, at: np.ndarray, n: np.ndarray, s: np.ndarray, new: np.ndarray, degree: int) -> tuple:
    """Arrays (neighbours or -1, steps, new) of ``m`` nodes from entries in order; they travel one up."""
    nb, near, fresh = np.full((m, degree), -1, np.int64), np.zeros((m, degree), np.uint32), np.zeros((m, degree), bool)
    r = _rank(at)
    nb[at, r], near[at, r], fresh[at, r] = n, s, new
    return nb, near, fresh


def _start(codes: DataFrame, count: int, trees: list, tasks: int, seeds: np.ndarray, p: AnnParams) -> DataFrame:
    """Lists of the best that each node meets in the leaves of the trees."""

    def send(at, arrays):
        q, scale, jitter = arrays
        x, i = q * scale[:, None], (at << _PLACE) + np.arange(len(q))
        for k in range(p.projections):
            leaf = _leaf(trees[k], x, jitter) if k < len(trees) else np.zeros(len(x), np.int64)
            for d, *cols in _deal(leaf, i, q, scale):
                yield k * count + d, OWN, at, _pack(*cols)

    def block(at, got):
        i, q, scale = (np.concatenate([x[1][j] for x in got[OWN]]) for j in range(3))
        x = q.astype(np.float32)
        rng = np.random.default_rng((p.seed, at))
        lot = rng.random((min(len(x), 4 * p.block),) * 2, np.float32) * np.float32(2 / _TOP)  # draws among as near ones
        offers = []
        for leaf in _leaves(x * scale[:, None], 4 * p.block, rng):
            k = min(p.degree, len(leaf) - 1)
            if k < 1:
                continue
            s = x[leaf] @ x[leaf].T
            s *= scale[leaf][:, None] * scale[leaf]
            np.fill_diagonal(s, -np.inf)
            top = np.argpartition(s + lot[:len(leaf), :len(leaf)], len(leaf) - k, axis=1)[:, len(leaf) - k:]
            offers.append((np.repeat(i[leaf], k), i[leaf][top].reshape(-1), _steps(np.take_along_axis(s, top, 1).reshape(-1))))
        if offers:
            a, n, s = (np.concatenate(c) for c in zip(*offers))
            for d, *cols in _deal(a >> _PLACE, (a & _PLACES).astype(np.uint32), n, s):
                yield d, OFFERS, at, _pack(cols[0], _thin(cols[1]), cols[2])

    def merge(at, got):
        m = len(got[CODES][0][1][0])
        a, n, s = (_cat([x[1][j] for x in got.get(OFFERS, [])], t) for j, t in enumerate((np.uint32, np.int64, np.uint32)))
        best = _nearest(a, n, s, p.degree)
        nb, near, new = _lists(m, a[best], n[best], s[best], np.ones(len(best), bool), p.degree)
        for j in np.flatnonzero(nb[:, 0] < 0):  # a node that met nobody begins at some seeds
            some = seeds[seeds != (at << _PLACE) + j][:p.degree]
            nb[j, :len(some)], new[j, :len(some)] = some, True
        yield at, LISTS, -1, _pack(_thin(nb + 1), near, new)

    blocks = _met(_sent(codes.select("dest", "data"), send), max(tasks, min(p.projections * count, 4 * tasks)), block)
    return written(_met(blocks.unionByName(codes), tasks, merge), "ann-graph")


def _pairs(arrays: tuple) -> tuple:
    """Edges of a shard's lists: place of the end that has it, the end named, its steps, new."""
    nb, near, new = arrays
    a, r = np.nonzero(nb)
    return a.astype(np.uint32), nb[a, r].astype(np.int64) - 1, near[a, r], new[a, r]


def _named(at: int, arrays: tuple) -> Iterator[tuple]:
    """A shard's lists, and for each other shard the edges that name its nodes."""
    yield at, LISTS, -1, _pack(*arrays)
    a, n, s, new = _pairs(arrays)
    away = np.flatnonzero(n >> _PLACE != at)
    for d, b, a_, *cols in _deal(n[away] >> _PLACE, (n[away] & _PLACES).astype(np.uint32), a[away], s[away], new[away]):
        yield d, EDGES, at, _pack(b, a_, *cols)


def _namers(at: int, got: dict) -> tuple:
    """Edges that name a shard's nodes: place of the end named, the other, steps, new."""
    a, n, s, new = _pairs(got[LISTS][0][1])
    here = np.flatnonzero(n >> _PLACE == at)
    own = ((n[here] & _PLACES).astype(np.uint32), (at << _PLACE) + a[here].astype(np.int64), s[here], new[here])
    others = ((b, (src << _PLACE) + a.astype(np.int64), s, new) for src, (b, a, s, new) in got.get(EDGES, []))
    return tuple(np.concatenate(c) for c in zip(own, *others))


def _round(lists: DataFrame, codes: DataFrame, tasks: int, p: AnnParams, rnd: int) -> DataFrame:
    """Lists after one round of local joins, and how many of their entries are new."""

    def members(at, got):
        """Of each node with something new the neighbours and a sample of those that name it, as
        large as the degree, new ones first. Each edge draws a rank by hash; the draw changes with the round."""
        nb, near, _ = got[LISTS][0][1]
        b, a, _, new = _namers(at, got)
        draw = _hash((at << _PLACE) + b.astype(np.int64), a, rnd)
        order = np.argsort(b.astype(np.uint64) << np.uint64(44) | (~new).astype(np.uint64) << np.uint64(43) | draw >> np.uint64(21))
        order = order[_rank(b[order]) < p.degree]
        fa, fn, _, fnew = _pairs(got[LISTS][0][1])
        c, m, new = np.concatenate((fa, b[order])), np.concatenate((fn, a[order])), np.concatenate((fnew, new[order]))
        key = c.astype(np.uint64) << np.uint64(41) | m.astype(np.uint64) << np.uint64(1) | (~new).astype(np.uint64)
        key.sort()
        key = key[np.concatenate(([True], key[1:] >> np.uint64(1) != key[:-1] >> np.uint64(1)))] if len(key) else key
        c, new = (key >> np.uint64(41)).astype(np.int64), key & np.uint64(1) == 0
        live = np.bincount(c, weights=new, minlength=len(nb))[c] > 0
        c, m, new = c[live], (key[live] >> np.uint64(1) & np.uint64(_NUMBERS)).astype(np.int64), new[live]
        worst = np.where(nb[:, -1] > 0, _above(near[:, -1]), np.float32(-2))
        yield at, MEMBERS, -1, _pack(_thin(c), _thin(m), new, worst)
        far = np.unique(m[m >> _PLACE != at])
        for d, place in _deal(far >> _PLACE, (far & _PLACES).astype(np.uint32)):
            yield d, ASKED, at, _pack(place)

    def tell(at, got):
        q, scale, _ = got[CODES][0][1]
        own = got[MEMBERS][0][1]
        yield at, MEMBERS, -1, _pack(*own)
        for src, (place,) in got.get(ASKED, []):
            yield src, TOLD, at, _pack(place, q[place], scale[place], own[3][place])

    def meet(at, got):
        c, m, new, worst = got[MEMBERS][0][1]
        c, m = c.astype(np.int64), m.astype(np.int64)
        q, scale, _ = got[CODES][0][1]
        told = [((src << _PLACE) + x[0].astype(np.int64), *x[1:]) for src, x in got.get(TOLD, [])]
        number = np.concatenate([(at << _PLACE) + np.arange(len(q)), *(x[0] for x in told)])
        q, scale, worst = (np.concatenate([own, *(x[j] for x in told)]) for own, j in ((q, 1), (scale, 2), (worst, 3)))
        if len(number) >= 1 << 22:
            raise ValueError(f"shard {at} meets {len(number)} nodes, more than a key has room for")
        order = np.argsort(number)
        local = order[np.searchsorted(number, m, sorter=order)]
        # centres with as many new members together, the new ones of a centre first
        fresh = np.bincount(c, weights=new).astype(np.int64)
        by = np.lexsort((~new, c, -fresh[c]))
        local, new, c = local[by], new[by], c[by]
        ends = np.append(np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1]))), len(c)) if len(c) else [0]
        kept, held = [], 0
        for lo in range(0, len(ends) - 1, 256):
            cut = ends[lo:lo + 257]
            sizes = np.diff(cut)
            g, w = len(sizes), sizes.max()
            wn = fresh[c[cut[0]]]
            loc = np.zeros((g, w), np.int64)
            there, isnew = np.zeros((g, w), bool), np.zeros((g, w), bool)
            row, place = np.repeat(np.arange(g), sizes), _rank(c[cut[0]:cut[-1]])
            loc[row, place], there[row, place], isnew[row, place] = local[cut[0]:cut[-1]], True, new[cut[0]:cut[-1]]
            x = q[loc].astype(np.float32)
            s = np.matmul(x, x[:, :wn].transpose(0, 2, 1))
            f = scale[loc]
            s *= f[:, :, None] * f[:, None, :wn]
            s[~(there[:, :, None] & isnew[:, None, :wn])] = -np.inf
            s[:, np.arange(wn), np.arange(wn)] = -np.inf
            bound = np.where(there, worst[loc], np.float32(np.inf))  # only what beats a member's worst
            for t, limit, a, b in ((s, bound, loc, loc[:, :wn]), (s.transpose(0, 2, 1), bound[:, :wn], loc[:, :wn], loc)):
                if b is loc:  # to each new member all old ones; the new ones have been offered
                    if (isnew == there).all():
                        continue
                    t = np.where(isnew[:, None, :], np.float32(-np.inf), t)
                if t.shape[2] > p.offers:
                    limit = np.maximum(limit, np.nextafter(np.sort(t, axis=2)[:, :, -p.offers], np.float32(-2)))
                i, j, k = np.nonzero(t > limit[:, :, None])
                kept.append((a[i, j].astype(np.uint64) << np.uint64(42)) | ((_TOP - _steps(t[i, j, k]).astype(np.uint64)) << np.uint64(22)) | b[i, k].astype(np.uint64))
                held += len(i)
            if held > 1 << 22:
                kept, held = [_kept(kept, p.degree)], 0
        if kept:
            key = _kept(kept, p.degree)
            a, n = number[(key >> np.uint64(42)).astype(np.int64)], number[(key & np.uint64((1 << 22) - 1)).astype(np.int64)]
            s = (_TOP - (key >> np.uint64(22) & np.uint64(_TOP))).astype(np.uint32)
            for d, a_, n_, s_ in _deal(a >> _PLACE, (a & _PLACES).astype(np.uint32), n, s):
                yield d, OFFERS, at, _pack(a_, _thin(n_), s_)

    def merge(at, got):
        arrays = got[LISTS][0][1]
        a, n, s, _ = _pairs(arrays)
        known = len(a)
        a, n, s = (np.concatenate([own, *(x[1][j] for x in got.get(OFFERS, []))]) for j, own in enumerate((a, n, s)))
        best = _nearest(a, n, s, p.degree)
        nb, near, new = _lists(len(arrays[0]), a[best], n[best], s[best], best >= known, p.degree)
        yield at, LISTS, -1, _pack(_thin(nb + 1), near, new)
        yield at, COUNT, int((best >= known).sum()), b""

    told = _met(_met(_sent(lists, _named), tasks, members).unionByName(codes), tasks, tell)
    offers = _met(told.unionByName(codes), tasks, meet)
    return written(_met(offers.unionByName(_as_rows(lists, "data", LISTS)), tasks, merge), "ann-graph")


def _kept(keys: list[np.ndarray], k: int) -> np.ndarray:
    """Of keys (who, nearness, whom) the first ``k`` distinct ones of each."""
    key = np.concatenate(keys)
    key.sort()
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    return key[_rank(key >> np.uint64(42)) < k]


def _both_ways(lists: DataFrame, tasks: int, p: AnnParams) -> DataFrame:
    """A list's own end stays whole, of those naming a node the degree nearest and as many drawn
    by hash: no node becomes a bottleneck, and one that only popular nodes are near to is found."""

    def merge(at, got):
        m = len(got[LISTS][0][1][0])
        b, a, s, _ = _namers(at, got)
        best = _nearest(b, a, s, p.degree)
        rest = np.delete(np.arange(len(b)), best)
        draw = _hash(b[rest], a[rest], 1)
        rest = rest[np.argsort(b[rest].astype(np.uint64) << np.uint64(44) | draw >> np.uint64(20))]
        best = np.concatenate((best, rest[_rank(b[rest]) < p.degree]))
        fa, fn, _, _ = _pairs(got[LISTS][0][1])
        key = np.unique(np.concatenate((fa, b[best])).astype(np.uint64) << np.uint64(44) | np.concatenate((fn, a[best])).astype(np.uint64))
        ends = np.concatenate(([0], np.cumsum(np.bincount((key >> np.uint64(44)).astype(np.int64), minlength=m))))
        yield at, LISTS, -1, _pack(ends, _thin(key & np.uint64(_NUMBERS)))

    return written(_met(_sent(lists, _named), tasks, merge), "ann-both")


def _seeds(places: DataFrame, p: AnnParams) -> np.ndarray:
    """A bounded set of nodes, by a hash of their ids."""
    return np.array([r["i"] for r in places.orderBy(F.xxhash64("id", F.lit(p.seed)), "id").limit(p.seeds).collect()], np.int64)


def build_index(df: DataFrame, p: AnnParams = AnnParams(), id_col: str = "vec_id", vec_col: str = "embedding") -> AnnIndex:
    """NN-descent graph over every usable vector of ``df``."""
    vectors, dim = usable(df, id_col, vec_col)
    # equal vectors have equal hashes, which are cheaper to sort by
    same = Window.partitionBy("h", "v").orderBy("id")
    # the limit on row_number is applied before the rows of a vector meet
    members = (vectors.withColumn("h", F.xxhash64("v")).withColumn("_r", F.row_number().over(same)).filter(F.col("_r") <= p.ids_kept)
                      .withColumn("node", F.min("id").over(same)))
    members = written(members, "ann-members")
    nodes = members.filter("_r = 1").select("id", "h", "v")
    n = nodes.count()
    shards, count, trees, tasks = _sharded(nodes, dim, n, p)
    codes = _as_rows(shards, "codes", CODES)
    lists = _start(codes, count, trees, tasks, _seeds(_places(shards), p), p)
    for rnd in range(p.rounds):
        both = _round(_of(lists, LISTS).select("dest", "data"), codes, tasks, p, rnd)
        lists = _of(both, LISTS)
        if (_of(both, COUNT).agg(F.sum("src")).first()[0] or 0) <= p.settled * p.degree * n:
            break
    graph = _both_ways(_of(lists, LISTS).select("dest", "data"), tasks, p)
    return AnnIndex(vectors, members.select("node", "id", "_r"), shards, graph, dim, tasks)


# ---------------------------------------------------------------- searching

def _search_all(index: AnnIndex, queries: DataFrame, n: int, p: AnnParams, k: int) -> DataFrame:
    """``(q, n, s)``: the best ``k`` nodes in the beam of each of the ``n`` queries ``(id, v, h)`` of distinct vectors.

    All queries go through one chain of rounds. Queries are dealt to buckets, which hold their
    beams: numbers, ids, scores, expanded or not. The best ``k`` nodes have the best ``k`` members.
    """
    dim, width = index.dim, max(p.beam, k)
    spark = queries.sparkSession
    buckets = max(1, -(-n // min(p.query_block, 256)))
    tasks = min(buckets, 4 * shuffle_partitions(spark))
    exact = _as_rows(index.shards, "exact", EXACT)
    places = _places(index.shards)

    # A query whose vector is a node starts there, the others at the bounded set of seeds.
    begin = (queries.join(places.groupBy("h").agg(F.min("i").alias("i")), "h", "left")
                    .select("id", "i", "v", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int").alias("b")))
    seeds = _seeds(places, p)

    def enter(batches):
        def found():
            for batch in batches:
                v = _matrix(batch.column(2), dim)
                i = batch.column(1).fill_null(-1).to_numpy()
                for d, q, at, x in _deal(batch.column(3).to_numpy(), batch.column(0).to_numpy(), i, _short(v)):
                    yield d, OWN, 0, _pack(q, at, x)
        yield from _rows(found(), _names(MESSAGE))

    def gather(at, got):
        q, i, v = (np.concatenate([x[1][j] for x in got[OWN]]) for j in range(3))
        order = np.argsort(q)
        q, i, v = q[order], i[order], v[order]
        m = len(q)
        yield at, BEAMS, -1, _pack(q, v, np.zeros((m, width), np.uint32), np.zeros((m, width), np.int64),
                                   np.full((m, width), -np.inf), np.ones((m, width), bool))
        lost = np.flatnonzero(i < 0)
        known = np.flatnonzero(i >= 0)
        yield at, NEAR, -1, _pack(np.concatenate((known, lost)), np.repeat((1, len(seeds)), (len(known), len(lost))),
                                  _thin(np.concatenate((i[known], np.tile(seeds, len(lost))))))

    def look(at, got):
        """The neighbours of the nodes asked for."""
        ends, nbrs = got[LISTS][0][1]
        for src, (q, place) in got.get(FRONT, []):
            size = ends[place + 1] - ends[place]
            i = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(ends[place], size)
            yield src, NEAR, at, _pack(q, size, nbrs[i])

    def ask(at, got):
        """Has what is not in a query's beam scored by the shards that hold it."""
        _, v, nodes, _, scores, _ = got[BEAMS][0][1]
        near = [x[1] for x in got.get(NEAR, [])]
        row, place = np.nonzero(nodes)
        q = _cat([row, *(np.repeat(x[0], x[1]) for x in near)], np.uint64)
        n = _cat([nodes[row, place] - 1, *(x[2] for x in near)], np.uint64)
        # by shard, query and place; what the beam has comes before what is near
        key = n >> np.uint64(_PLACE) << np.uint64(43) | q << np.uint64(_PLACE + 1) | (n & np.uint64(_PLACES)) << np.uint64(1)
        key[len(row):] |= np.uint64(1)
        key.sort()
        key = key[(key & np.uint64(1) == 1) & np.concatenate(([True], key[1:] >> np.uint64(1) != key[:-1] >> np.uint64(1)))]
        n, q = (key >> np.uint64(1)).astype(np.int64) & _PLACES, (key >> np.uint64(_PLACE + 1)).astype(np.int64) & 0x3FFFFF
        for d, q_, n_ in _runs((key >> np.uint64(43)).astype(np.int64), q, n):
            first = np.concatenate(([True], q_[1:] != q_[:-1]))
            rows = q_[first]
            yield d, NEAR, at, _pack(rows, v[rows], scores[rows, -1], np.diff(np.append(np.flatnonzero(first), len(q_))), n_.astype(np.uint32))

    def score(at, got):
        ids, x = got[EXACT][0][1]
        for src, (rows, v, worst, size, place) in got.get(NEAR, []):
            which = np.repeat(np.arange(len(rows)), size)
            s = np.concatenate([np.einsum("ij,ij->i", v[which[i:i + 8192]].astype(np.float64), x[place[i:i + 8192]].astype(np.float64))
                                for i in range(0, len(which), 8192)])
            good = np.flatnonzero(s >= worst[which])
            yield src, SCORED, at, _pack(rows[which[good]], (at << _PLACE) + place[good].astype(np.int64), ids[place[good]], s[good])

    def keep(at, got):
        """Beams with what was scored, the nodes to expand next, and the best of beams with none to expand."""
        q, v, nodes, ids, scores, done = got[BEAMS][0][1]
        row, place = np.nonzero(nodes)
        own = (row, nodes[row, place].astype(np.int64) - 1, ids[row, place], scores[row, place])
        r, n, i, s = (np.concatenate([c, *(x[1][j] for x in got.get(SCORED, []))]) for j, c in enumerate(own))
        d = np.concatenate((done[row, place], np.zeros(len(r) - len(row), bool)))
        order = np.lexsort((i, -s, r))
        rank = _rank(r[order])
        order, rank = order[rank < width], rank[rank < width]
        r, n, i, s, d = r[order], n[order], i[order], s[order], d[order]
        open_ = np.flatnonzero(~d)
        front = open_[_rank(r[open_]) < p.expand]
        d[front] = True
        nodes, ids, scores, done = (np.full(nodes.shape, x) for x in (0, 0, -np.inf, True))
        nodes[r, rank], ids[r, rank], scores[r, rank], done[r, rank] = n + 1, i, s, d
        live = np.zeros(len(q), bool)
        live[r[front]] = True
        over = np.flatnonzero(~live)
        if len(over):
            yield at, ENDED, -1, _pack(q[over], ids[over, :k], scores[over, :k], nodes[over, :k] > 0)
        if len(over) < len(q):
            yield at, BEAMS, -1, _pack(q[live], v[live], _thin(nodes[live]), ids[live], scores[live], done[live])
            at_row = np.cumsum(live) - 1
            for to, r_, n_ in _deal(n[front] >> _PLACE, at_row[r[front]], n[front] & _PLACES):
                yield to, FRONT, at, _pack(r_, n_)

    rows = _met(begin.select("id", "i", "v", "b").mapInArrow(enter, MESSAGE), tasks, gather)
    rows = written(rows, "ann-queries")
    beams, near, ended = _of(rows, BEAMS), _of(rows, NEAR), []
    while True:
        asked = _met(beams.unionByName(near), tasks, ask)
        scored = _met(asked.unionByName(exact), index.parts, score)
        rows = written(_met(scored.unionByName(beams), tasks, keep), "ann-beam")
        beams, front = _of(rows, BEAMS), _of(rows, FRONT)
        ended.append(_of(rows, ENDED))
        if not front.limit(1).count():
            break
        near = _met(front.unionByName(index.graph), index.parts, look)

    def best(batches):
        for batch in batches:
            for x in batch.column(0):
                q, ids, scores, there = pickle.loads(x.as_buffer())
                r, c = np.nonzero(there)
                yield pa.RecordBatch.from_arrays([pa.array(q[r]), pa.array(ids[r, c]), pa.array(scores[r, c])], ["q", "n", "s"])

    return reduce(DataFrame.unionByName, ended).select("data").mapInArrow(best, "q long, n long, s double")


def search(index: AnnIndex, queries: DataFrame, k: int, p: AnnParams = AnnParams()) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for every query.

    ``queries``: ``(id, v)`` as made by ``usable``. Nearness is the inner product in double
    precision on the original vectors; ties go to the smaller id; a query's own row is no
    candidate. An empty index or no queries give no rows.
    """
    if k >= p.ids_kept:
        raise ValueError("k must be below ids_kept")
    queries = queries.select("id", "v", F.xxhash64("v").alias("h"))
    firsts = queries.groupBy("h", "v").agg(F.min("id").alias("q"))
    firsts = written(firsts, "ann-queries")
    n = firsts.count()
    beams = _search_all(index, firsts.select(F.col("q").alias("id"), "v", "h"), n, p, k + 1)
    members = index.members.filter(F.col("_r") <= k + 1).select("node", "id")  # more of a node have no place
    order = Window.partitionBy("q").orderBy(F.desc("s"), "id")
    found = (beams.join(members, beams["n"] == members["node"]).select("q", "id", "s")
                  .withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k + 1))
    lists = found.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("_r", "id", "s"))).alias("l"))  # k + 1 each
    each = queries.select(F.col("id").alias("query_id"), "h", "v").join(firsts, ["h", "v"]).select("query_id", "q").join(lists, "q")
    others = F.slice(F.filter("l", lambda e: e["id"] != F.col("query_id")), 1, k)
    return each.select("query_id", F.posexplode(others).alias("rank", "e")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("e.id").alias("vec_id"), F.col("e.s").alias("score"))
