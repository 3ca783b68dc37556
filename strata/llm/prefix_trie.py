"""Prefix trie of conversations: every distinct beginning is a node with its totals.

A conversation becomes a row of turn ids. The rows are cut into shards by ranges of their
order, so the rows below a node stand together, in one shard or in neighbouring ones:

* a shard's rows become padded turn-id matrices of ``WIDTH`` columns at a time. A numpy
  lexsort orders them (ended rows first), the masks of changed cells are OR-accumulated along
  the columns and mark where nodes begin, and ``reduceat`` sums every depth's nodes, and
  from the deepest depth upwards their subtrees;
* only nodes on the paths of a shard's first and last row can reach into another shard.
  These two paths carry the shard's share of each of their nodes to the next level, where
  they are rows again: range-sharded, sorted and summed in the same way, until few enough
  are left for one task. A level leaves two rows of each shard, whatever the shard holds.

What a boundary node gets from several shards adds up: members, children and leaves and
savings below children that lie in one shard. What depends on the whole node (its own
savings, whether it is a leaf) is settled at the level where it is whole. A node is named by
its depth and its smallest member, which is unique.

A beginning that a third of all conversations share is an interior node of most shards'
first path: its rows are split by id as by any other cell. Its member list is hashed from
pieces of the shards in their order, one piece in memory at a time.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._tables import partition_id, prepare, shuffle_partitions, written

WIDTH = 16                 # columns of a padded matrix
EMPTY = hashlib.sha256(b"").hexdigest()
NONE = np.iinfo(np.int64).max
PIECE = 1 << 15            # bytes of a member list in one row
OUT = ("kind int, shard int, side int, depth int, conv_id long, n long, kids long, leaves long, saved long, parent long, "
       "pside int, sha string, part int, piece string, a array<long>, b array<long>, size array<long>, members array<long>, "
       "least array<long>, kids_in array<long>, leaves_in array<long>, saved_in array<long>, back_shard int, back_side int")
NODE, PATH, ENDS, BACK = range(4)


@dataclass(frozen=True)
class TrieParams:
    """``cells``: turns of a shard of conversations; ``shard_rows``: paths of a shard at the
    next levels (at least 4, so that every level leaves fewer)."""

    cells: int = 1 << 20
    shard_rows: int = 4096


def turn_sequences(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """``(conv_id, path, sizes)``: the turns of every conversation in order, each as a
    128-bit key of (role, text), and the code points of their texts.

    Order: turn (null first), then role, then text. Null roles and texts are empty ones; rows
    without a conversation id belong to none. Texts stay where they are, but for those that
    share conversation and turn with another row.
    """
    t = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.filter("conv_id is not null")
    tied = written(t.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("conv_id", "turn"), "trie-ties")
    same = F.lit("")
    if not tied.isEmpty():
        tied = tied.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"))
        t = t.join(tied, (t["conv_id"] == tied["_c"]) & t["turn"].eqNullSafe(tied["_t"]), "left")
        same = F.when(F.col("_c").isNotNull(), F.col("text")).otherwise("")
    row = F.struct("turn", "role", same.alias("same"), F.xxhash64(F.lit(1), "role", "text").alias("a"),
                   F.xxhash64(F.lit(2), "role", "text").alias("b"), F.length("text").alias("size"))
    got = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("r"))
    return got.select("conv_id", F.transform("r", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"))).alias("path"),
                      F.col("r.size").alias("sizes"))


def with_shared_heads(seq: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Conversations rebuilt: the first h turns come from conversation ``c - c % group`` (as
    many as it has, none if it is absent), the others are their own turns after the first h;
    h = crc32(decimal c) % ``most``."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    heads = seq.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("_lead"), F.slice("path", 1, most - 1).alias("_p"), F.slice("sizes", 1, most - 1).alias("_s"))
    both = seq.withColumn("_h", h).withColumn("_of", F.col("conv_id") - F.col("conv_id") % group)
    both = both.join(heads, both["_of"] == heads["_lead"], "left")

    def joined(head, own):
        first = F.slice(head, F.lit(1), F.col("_h"))
        rest = F.slice(own, F.col("_h") + 1, F.greatest(F.size(own) - F.col("_h"), F.lit(0)))
        return F.when(F.col("_lead").isNull(), rest).otherwise(F.concat(first, rest))

    return both.select("conv_id", joined("_p", "path").alias("path"), joined("_s", "sizes").alias("sizes"))


@dataclass
class Shard:
    """Rows of one shard. ``a``, ``b``: turn keys, row after row (``lengths`` each); the other
    arrays hold one cell a depth, from 0: ``lengths + 1`` a row."""

    lengths: np.ndarray
    a: np.ndarray
    b: np.ndarray
    size: np.ndarray
    members: np.ndarray
    least: np.ndarray
    kids: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray
    order: np.ndarray          # order of rows with equal paths
    off: np.ndarray = field(init=False)
    cell: np.ndarray = field(init=False)
    ids: np.ndarray = field(init=False)

    def __post_init__(self):
        self.off = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        self.cell = self.off + np.arange(len(self.lengths))
        # dense turn ids in the order of the keys; 0 pads
        by = np.lexsort((self.b, self.a))
        new = np.ones(len(by), bool)
        new[1:] = (self.a[by][1:] != self.a[by][:-1]) | (self.b[by][1:] != self.b[by][:-1])
        self.ids = np.empty(len(by), np.int64)
        self.ids[by] = np.cumsum(new)

    def edge(self, last: bool) -> int:
        """The first or last row of the shard's order."""
        rows, d = np.arange(len(self.lengths)), 0
        while True:
            live = self.lengths[rows] > d
            if last and not live.any() or not last and not live.all():
                rows = rows[~live]
                return int(rows[np.argmax(self.order[rows]) if last else np.argmin(self.order[rows])])
            rows = rows[live]
            ids = self.ids[self.off[rows] + d]
            rows, d = rows[ids == (ids.max() if last else ids.min())], d + 1


@dataclass
class Level:
    """Nodes of one depth, in the shard's order."""

    parent: np.ndarray
    size: np.ndarray
    members: np.ndarray
    least: np.ndarray
    kids: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray
    ended: np.ndarray          # rows that end here, by node and their order
    ended_node: np.ndarray
    open: np.ndarray | None = None


def levels_of(s: Shard, edges: tuple[int, ...]) -> tuple[list[Level], np.ndarray, list[list[int]]]:
    """All depths of a shard, the node of every cell, and each edge row's node by depth."""
    n = len(s.lengths)
    node = np.zeros(n, np.int64)
    node_at = np.zeros(len(s.cell) + len(s.ids), np.int64)
    levels: list[Level] = []
    paths: list[list[int]] = [[] for _ in edges]

    def add(rows: np.ndarray, begins: np.ndarray) -> None:
        d = len(levels)
        at = s.cell[rows] + d
        first = np.flatnonzero(begins)
        parent = node[rows[first]] if d else np.full(1, -1)
        node[rows] = np.cumsum(begins) - 1
        node_at[at] = node[rows]
        ended = rows[s.lengths[rows] == d]
        levels.append(Level(parent, s.size[at[first]], *(np.add.reduceat(x[at], first) if f else np.minimum.reduceat(x[at], first) for x, f in (
            (s.members, 1), (s.least, 0), (s.kids, 1), (s.leaves, 1), (s.saved, 1))), ended, node[ended]))
        for path, r in zip(paths, edges):
            if s.lengths[r] >= d:
                path.append(int(node[r]))

    begins = np.zeros(n, bool)
    begins[0] = True
    add(np.argsort(s.order, kind="stable"), begins)
    base = 0
    while True:
        rows = np.flatnonzero(s.lengths > base)
        if not len(rows):
            break
        width = int(min(WIDTH, s.lengths[rows].max() - base))
        matrix = np.zeros((len(rows), width), np.int64)
        for j in range(width):
            live = s.lengths[rows] > base + j
            matrix[live, j] = s.ids[s.off[rows[live]] + base + j]
        group = node[rows]
        by = np.lexsort((s.order[rows], *matrix.T[::-1], group))
        rows, matrix, group = rows[by], matrix[by], group[by]
        change = np.ones(matrix.shape, bool)
        change[1:] = matrix[1:] != matrix[:-1]
        change[1:, 0] |= group[1:] != group[:-1]
        begins = np.logical_or.accumulate(change, axis=1)
        for j in range(width):
            live = matrix[:, j] > 0
            add(rows[live], begins[live, j])
        base += width
    return levels, node_at, paths


def sum_up(levels: list[Level], paths: list[list[int]]) -> None:
    """Subtree totals, from the deepest depth upwards. Nodes on ``paths`` are open: they keep
    the sums of what lies whole below them and hand nothing up."""
    for d in range(len(levels) - 1, -1, -1):
        v = levels[d]
        v.open = np.zeros(len(v.members), bool)
        for p in paths:
            if len(p) > d:
                v.open[p[d]] = True
        whole = ~v.open
        v.leaves = np.where(whole & (v.kids == 0), 1, v.leaves)
        v.saved = v.saved + np.where(whole, (v.members - 1) * v.size, 0)
        if d:
            up = levels[d - 1]
            first = np.flatnonzero(np.concatenate(([True], v.parent[1:] != v.parent[:-1])))
            to = v.parent[first]
            up.kids[to] += np.add.reduceat(whole.astype(np.int64), first)
            up.leaves[to] += np.add.reduceat(np.where(whole, v.leaves, 0), first)
            up.saved[to] += np.add.reduceat(np.where(whole, v.saved, 0), first)


def _batch(rows: int, /, **cols) -> pa.RecordBatch:
    """A batch of ``OUT`` with the given columns, nulls elsewhere."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split(" ") for f in OUT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(cols[k], kinds[t]) if k in cols else pa.nulls(rows, kinds[t]) for k, t in fields],
                                      [k for k, _ in fields])


def shard_rows(s: Shard, shard: int, top: bool, ids: np.ndarray | None, back: np.ndarray | None):
    """Batches of ``OUT``: whole nodes, the two edge paths, the pieces of member lists of open
    nodes (``ids``: the conversations of the rows), and what every cell of an upper level's
    row belongs to (``back``: shard and side of the rows)."""
    edges = () if top else tuple(dict.fromkeys((s.edge(False), s.edge(True))))
    levels, node_at, paths = levels_of(s, edges)
    sum_up(levels, paths)

    def side_of(d: int, nodes: np.ndarray) -> np.ndarray:
        """Which edge path an open node is on (the first, if on both)."""
        first = paths[0][d] if paths and len(paths[0]) > d else -1
        return np.where(nodes == first, 0, 1)

    for d, v in enumerate(levels):
        sha = np.full(len(v.members), EMPTY, object)
        if ids is not None and len(v.ended):
            first = np.flatnonzero(np.concatenate(([True], v.ended_node[1:] != v.ended_node[:-1])))
            for lo, hi in zip(first, np.append(first[1:], len(v.ended))):
                k = v.ended_node[lo]
                text = ",".join(map(str, ids[v.ended[lo:hi]].tolist()))
                if v.open[k]:
                    parts = [text[i:i + PIECE] for i in range(0, len(text), PIECE)]
                    m, side = len(parts), int(side_of(d, np.array([k]))[0])
                    for i in range(0, m, 64):
                        some = parts[i:i + 64]
                        yield _batch(len(some), kind=[ENDS] * len(some), shard=[shard] * len(some), side=[side] * len(some),
                                     depth=[d] * len(some), part=list(range(i, i + len(some))), piece=some)
                else:
                    sha[k] = hashlib.sha256(text.encode()).hexdigest()
        own = np.flatnonzero(~v.open)
        up = levels[d - 1] if d else None
        for i in range(0, len(own), 1 << 15):
            k = own[i:i + (1 << 15)]
            parent = up.least[v.parent[k]] if d else np.zeros(1, np.int64)
            lost = up.open[v.parent[k]] if d else np.ones(1, bool)
            side = side_of(d - 1, v.parent[k]) if d else np.zeros(1, np.int64)
            yield _batch(len(k), kind=np.full(len(k), NODE), shard=np.full(len(k), shard), depth=np.full(len(k), d), conv_id=v.least[k],
                         n=v.members[k], kids=v.kids[k], leaves=v.leaves[k], saved=v.saved[k], sha=list(sha[k]),
                         parent=np.ma.array(parent, mask=lost).tolist(), pside=np.ma.array(side, mask=~lost if d else [True]).tolist())

    for side, (r, path) in enumerate(zip(edges, paths)):
        at = slice(s.off[r], s.off[r] + s.lengths[r])
        shared = [side == 1 and len(paths[0]) > d and paths[0][d] == k for d, k in enumerate(path)]
        pick = lambda name, none=0: [none if x else int(getattr(levels[d], name)[k]) for d, (k, x) in enumerate(zip(path, shared))]
        yield _batch(1, kind=[PATH], shard=[shard], side=[side], a=[s.a[at]], b=[s.b[at]], members=[pick("members")],
                     size=[[int(levels[d].size[k]) for d, k in enumerate(path)]], least=[pick("least", NONE)], kids_in=[pick("kids")],
                     leaves_in=[pick("leaves")], saved_in=[pick("saved")])

    if back is not None:
        for r in range(len(s.lengths)):
            k = node_at[s.cell[r]:s.cell[r] + s.lengths[r] + 1]
            lost = [bool(levels[d].open[x]) for d, x in enumerate(k)]
            m = len(k)
            yield _batch(m, kind=[BACK] * m, back_shard=[int(back[r, 0])] * m, back_side=[int(back[r, 1])] * m, depth=list(range(m)),
                         conv_id=[None if o else int(levels[d].least[x]) for d, (x, o) in enumerate(zip(k, lost))], shard=[shard] * m,
                         side=[int(side_of(d, np.array([x]))[0]) for d, x in enumerate(k)])


def _flat(cols: list, dtype=np.int64) -> np.ndarray:
    parts = [c.flatten().to_numpy(zero_copy_only=False) for c in cols]
    return np.concatenate(parts).astype(dtype) if parts else np.zeros(0, dtype)


def _sizes(cols: list) -> np.ndarray:
    return np.concatenate([np.diff(c.offsets.to_numpy()) for c in cols]).astype(np.int64)


def _conversation_shard(batches):
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    col = lambda k: [b.column(k) for b in held]
    ids = np.concatenate([c.to_numpy(zero_copy_only=False) for c in col(0)]).astype(np.int64)
    lengths = _sizes(col(1))
    cells = lengths + 1
    start = np.concatenate(([0], np.cumsum(cells)))[:-1]
    size = np.insert(_flat(col(3)), np.concatenate(([0], np.cumsum(lengths)))[:-1], 0)  # the root has no text
    zero = np.zeros(len(size), np.int64)
    assert len(size) == start[-1] + cells[-1]
    s = Shard(lengths, _flat(col(1)), _flat(col(2)), size, zero + 1, np.repeat(ids, cells), zero, zero, zero, ids)
    yield from shard_rows(s, partition_id(), False, ids, None)


def _path_shard(top: bool):
    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        col = lambda k: [b.column(k) for b in held]
        one = lambda k: np.concatenate([c.to_numpy(zero_copy_only=False) for c in col(k)]).astype(np.int64)
        back = np.stack([one(0), one(1)], 1)
        s = Shard(_sizes(col(2)), *(_flat(col(k)) for k in range(2, 10)), np.arange(len(back)))
        yield from shard_rows(s, partition_id(), top, None, back)

    return run


def _settled(nodes: DataFrame, known: DataFrame) -> DataFrame:
    """Nodes with the parents that only the next level could name."""
    own = nodes.filter("pside is null")
    k = known.select(F.col("shard").alias("_s"), F.col("side").alias("_i"), F.col("depth").alias("_d"), F.col("conv_id").alias("_p"))
    open_ = nodes.filter("pside is not null").drop("parent")
    open_ = open_.join(k, (open_["shard"] == k["_s"]) & (open_["pside"] == k["_i"]) & (open_["depth"] - 1 == k["_d"]))
    cols = ["conv_id", "depth", "n", "kids", "leaves", "saved", "sha"]
    return own.select(*cols, "parent").unionByName(open_.select(*cols, F.col("_p").alias("parent")))


def _upper(paths: DataFrame, p: TrieParams) -> tuple[DataFrame, DataFrame]:
    """Nodes that reach over shards, and the node ``(shard, side, depth) -> conv_id`` of every
    cell of ``paths``."""
    n = paths.count()
    top = n <= p.shard_rows
    rows = paths.withColumn("path", F.arrays_zip("a", "b"))
    # few paths: one task; a reader of one split holds at most ``shard_rows`` of them
    rows = rows.coalesce(1) if top else rows.repartitionByRange(-(-n // p.shard_rows), "path", "shard", "side")
    got = written(rows.select("shard", "side", "a", "b", "size", "members", "least", "kids_in", "leaves_in", "saved_in")
                      .mapInArrow(_path_shard(top), OUT), "trie-paths")
    back = got.filter(F.col("kind") == BACK)
    cells = back.select(F.col("back_shard").alias("shard"), F.col("back_side").alias("side"), "depth", "conv_id",
                        F.col("shard").alias("at"), F.col("side").alias("on"))
    nodes = got.filter(F.col("kind") == NODE)
    if top:
        return _settled(nodes.filter("pside is null"), cells), cells.drop("at", "on")
    above, known = _upper(got.filter(F.col("kind") == PATH), p)
    k = known.select(F.col("shard").alias("at"), F.col("side").alias("on"), "depth", F.col("conv_id").alias("_c"))
    cells = cells.join(k, ["at", "on", "depth"], "left").select("shard", "side", "depth", F.coalesce("conv_id", "_c").alias("conv_id"))
    return _settled(nodes, known).unionByName(above), cells


def _hashed(pieces: DataFrame) -> DataFrame:
    """SHA-256 of each open node's member list from its pieces in the shards' order."""
    def run(batches):
        at, digest, shard = None, None, None
        for batch in batches:
            for c, d, s, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if at != (c, d):
                    if at is not None:
                        yield row(at, digest)
                    at, digest, shard = (c, d), hashlib.sha256(), s
                elif s != shard:
                    digest.update(b",")
                    shard = s
                digest.update(text.encode())
        if at is not None:
            yield row(at, digest)

    def row(at, digest):
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int32()), pa.array([digest.hexdigest()])],
                                          ["conv_id", "depth", "sha"])

    return (pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "shard", "part")
                  .select("conv_id", "depth", "shard", "piece").mapInArrow(run, "conv_id long, depth int, sha string"))


def prefix_trie(seq: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """One row per node of ``(conv_id, path, sizes)`` rows (distinct ids): ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``.

    ``n_leaves`` and ``saved_tokens`` (the sum of members less one, times the code points of the
    node's last text) run over the node's subtree, itself included; ``ends_sha256`` is over the
    decimal ids of the members that end at the node, ascending, comma-joined (none: the empty
    string). Conversations without turns are members of the root alone. An empty table has
    no conversation, so no root and no rows. One conversation is one row, whatever its length.
    """
    spark = seq.sparkSession
    prepare(spark)
    rows = written(seq.select("conv_id", "path", "sizes"), "trie-rows")
    cells = rows.agg(F.sum(F.size("path") + 1)).first()[0] or 0
    shards = max(shuffle_partitions(spark), -(-cells // p.cells))
    dealt = rows.repartitionByRange(shards, "path", "conv_id")
    got = written(dealt.select("conv_id", "path.a", "path.b", F.col("sizes").cast("array<long>"))
                       .mapInArrow(_conversation_shard, OUT), "trie-shards")
    above, known = _upper(got.filter(F.col("kind") == PATH), p)
    known = written(known, "trie-known")
    pieces = got.filter(F.col("kind") == ENDS).select("shard", "side", "depth", "part", "piece").join(known, ["shard", "side", "depth"])
    ends = _hashed(pieces)
    above = above.drop("sha").join(ends, ["conv_id", "depth"], "left").withColumn("sha", F.coalesce("sha", F.lit(EMPTY)))
    every = _settled(got.filter(F.col("kind") == NODE), known).unionByName(above)
    return every.select("conv_id", F.col("depth").cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"),
                        F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
                        F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"))
