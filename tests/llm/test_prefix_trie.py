import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.llm.prefix_trie import TrieParams, prefix_trie, turn_sequences, with_shared_heads
from strata.llm.queries import op12_conversation_trie
from tests.llm.cases import SF, clashing

TURN = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()),
                   StructField("role", StringType()), StructField("text", StringType())])


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        lead = c - int(str(c)[-2:]) if c >= 0 else c + int(str(-c)[-2:])
        out[c] = own.get(lead, [])[:h] + v[h:]
    return out


def plain(seqs):
    """Every node from its definition."""
    nodes = defaultdict(list)
    for c, v in seqs.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    kids = defaultdict(int)
    for k in nodes:
        if k:
            kids[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in nodes.items():
        own = (len(m) - 1) * len(k[-1][1]) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += own
    out = []
    for k, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(k))
        out.append((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(df):
    assert df.columns == COLS and all(t == "bigint" for _, t in df.dtypes[:-1])
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, TURN).repartition(parts)


def test_query_equals_the_definition(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op12_conversation_trie(spark, SF)) == plain(rebuilt(rows))


def bushy(n, seed):
    """Conversations over few turns, so that many share beginnings, some of them whole."""
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(-300, 3000), n):
        hot = rng.random() < 0.4
        size = 9 if hot else rng.choice([1, 2, 3, 5, 40])
        out += [(c, t, "user" if t % 2 else None, "common" * t if hot else rng.choice(["x", "yy", "é😀", "", None])) for t in range(size)]
    return out


@pytest.mark.parametrize("parts, p", [(1, TrieParams()), (8, TrieParams(cells=50, shard_rows=4)), (40, TrieParams(shard_rows=7)), (200, TrieParams())])
def test_any_number_of_shards_and_levels(spark, parts, p):
    rows = bushy(150, parts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert got(prefix_trie(with_shared_heads(turn_sequences(table(spark, rows))), p)) == plain(rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_copies_of_one_conversation_over_all_shards(spark):
    """A member list longer than a piece, its node in every shard."""
    seqs = {c: [("u", "a"), ("v", "bb")][:1 + (c % 10 > 0)] for c in range(12_000)}
    rows = [(c, t, r, x) for c, v in seqs.items() for t, (r, x) in enumerate(v)]
    assert got(prefix_trie(turn_sequences(table(spark, rows)))) == plain(seqs)


def test_odd_rows(spark):
    long = [(7, t, "u", f"turn {t // 3}") for t in range(2_000)]
    rows = [(None, 0, "u", "lost"), (1, None, None, None), (1, 0, "u", "a"), (1, 0, "u", "a"), (1, 0, "u", "B"), (1, 0, "t", "z"), (1, None, "", ""),
            (2, 5, "u", ""), (200, 0, "u", "x" * 100_000), (201, 1, "u", "x" * 100_000), (201, 0, None, "é中😀"), (-5, 0, "u", "neg"), (-100, 0, "q", "head"),
            (9_000_000_000_000_000_001, 0, "u", "big")] + long
    df = clashing(table(spark, rows)).withColumn("path", F.lit("x")).withColumn("a", F.lit(1))
    assert got(prefix_trie(with_shared_heads(turn_sequences(df)))) == plain(rebuilt(rows))


def test_turnless_conversations_and_empty_table(spark):
    # every conversation's own turns end before its head does, and there is no head to take
    rows = [(c, 0, "u", "gone") for c in range(101, 140) if zlib.crc32(str(c).encode()) % 6]
    assert got(prefix_trie(with_shared_heads(turn_sequences(table(spark, rows))))) == plain(rebuilt(rows))
    assert got(prefix_trie(with_shared_heads(turn_sequences(table(spark, []))))) == []
