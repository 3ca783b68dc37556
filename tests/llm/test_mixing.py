import heapq
import random

from pyspark.sql import functions as F

from strata.llm.mixing import MixParams, apportion, mix
from tests.llm.cases import SF, clashing, docs, odd_rows


def sainte_lague(weights, seats):
    out = [0] * len(weights)
    heap = [(-w, i) for i, w in enumerate(weights) if w > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, i = heapq.heappop(heap)
        out[i] += 1
        heapq.heappush(heap, (-weights[i] / (2 * out[i] + 1), i))
    return out


def test_apportion_equals_highest_quotients(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for g in range(25):
        w = [rng.choice([0.0, 1.0, 2.0, 5.0, rng.random() * 100, 1e4]) for _ in range(rng.randint(1, 9))]
        seats = rng.choice([0, 1, 3, 17, 1000])
        rows += [(g, i, x, seats) for i, x in enumerate(w)]
        want[g] = sainte_lague(w, seats)
    df = spark.createDataFrame(rows, "g int, _order long, w double, seats long")
    got = {}
    for r in apportion(df, ["g"], "w", "seats").orderBy("g", "_order").collect():
        got.setdefault(r.g, []).append(r.quota)
    assert got == want


def targets(sizes, p):
    src = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    w = {s: p.weights[i % len(p.weights)] for i, s in enumerate(src)}
    fixed, live = {}, set(src)
    while live:
        level = (p.total * sum(sizes.values()) - sum(fixed.values())) / sum(w[s] for s in live)
        over = [s for s in live if w[s] * level > p.max_repeat * sizes[s]]
        if not over:
            break
        for s in over:
            fixed[s] = p.max_repeat * sizes[s]
            live.discard(s)
    return {s: fixed.get(s, w[s] * level if live else 0) for s in src}


def check(out, p):
    sizes = {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want = targets(sizes, p)
    for s, size in sizes.items():
        own = [r for r in out if r.source == s]
        assert all(r.source_size == size and abs(r.target - want[s]) < 1e-6 * max(1, want[s]) for r in own)
        assert all(0 <= r.taken <= p.max_repeat * r["size"] for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= 4 * p.block


def test_mix_of_documents_meets_targets_and_reruns_agree(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    p = MixParams(shard_words=2000)
    out = mix(table, p, keep=("doc_id", "source")).collect()
    assert len(out) == table.count()
    check(out, p)
    again = mix(table.repartition(5), p, keep=("doc_id", "source")).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_odd_rows_and_empty_table(spark):
    p = MixParams()
    df = clashing(docs(spark, odd_rows()))
    out = mix(df, p, keep=("doc_id", "source", "score", "size")).collect()
    assert len(out) == len(odd_rows())
    assert sum(r["size"] == 0 for r in out) == 4 and all(r.taken == 0 for r in out if r["size"] == 0)
    check(out, p)
    assert mix(docs(spark, [])).count() == 0
    silent = mix(docs(spark, [(1, None), (2, "")])).agg(F.sum("taken"), F.sum("target")).first()
    assert tuple(silent) == (0, 0)
