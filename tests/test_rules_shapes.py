"""Batch rules, spelling clusters, shapes and changing headers against plain definitions."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators.batch_rules import may_match, orphan_rows, rule_results, unique_violations
from strata.operators.components import components
from strata.operators.quality import relationships, run_suite, unique
from strata.operators.shapes import frequent_shapes, shape, summaries
from strata.operators.spellings import similar_labels, spelling_clusters
from strata.streaming.versions import SCHEMA_VERSION, ingest_versions, schema_versions


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k long, p string")


def test_batch_rules_equal_the_full_rules(spark):
    rng = random.Random(1)
    history = keyed(spark, [(i, None) for i in range(5000)])
    rows = [(rng.choice([rng.randrange(6000), 5000 + rng.randrange(500), None]), rng.choice(["a", "b", "zz", None])) for _ in range(700)]
    batch, parents = keyed(spark, rows), spark.createDataFrame([("a",), ("b",), (None,)], "p string")
    got = {r.rule: r.violations for r in rule_results(history, batch, "k", parents, "p").collect()}
    full = run_suite({"t": history.unionByName(batch), "b": batch, "d": parents}, [unique("t", "k"), relationships("b", "p", "d", "p")])
    assert got == {r.rule: r.violations for r in full.collect()}
    counts = Counter(k for k, _ in rows if k is not None)
    want = sorted((k, int(k < 5000), n) for k, n in counts.items() if n + (k < 5000) > 1)
    assert sorted(map(tuple, unique_violations(history, batch, "k").collect())) == want
    assert sorted(map(tuple, orphan_rows(batch, parents, "p").collect())) == [("zz", sum(p == "zz" for _, p in rows))]


def test_few_history_rows_leave_their_task(spark):
    history, batch = keyed(spark, [(i, None) for i in range(20_000)]), keyed(spark, [(i, None) for i in range(100, 200)])
    near = {r.k for r in may_match(history, batch, "k").collect()}
    assert set(range(100, 200)) <= near and len(near) < 100 + 20_000 / 10
    assert may_match(history, batch.limit(0), "k").count() == 0
    assert unique_violations(history.limit(0), batch, "k").count() == 0


def test_keys_that_the_history_violates_already_are_not_new(spark):
    history = keyed(spark, [(1, None), (1, None), (2, None)])
    assert [tuple(r) for r in unique_violations(history, keyed(spark, [(1, None), (2, None), (3, None)]), "k").collect()] == [(2, 1, 1)]


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 301), (301, 302), (302, 300), (500, 500)]
    rng.shuffle(pairs)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, **{i: 300 for i in (300, 301, 302)}, 500: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("alphabet", ["ab", "abcdef", "aé中 "])
def test_all_similar_pairs_are_found(spark, alphabet):
    rng = random.Random(len(alphabet))
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(250)}
    got = {(r.a, r.b, r.distance) for r in similar_labels(spark.createDataFrame([(w,) for w in words] * 2 + [(None,), ("",)], "label string")).collect()}
    want = set()
    for a in words:
        for b in words:
            if a < b and min(len(a), len(b)) >= 3:
                d = distance(a, b)
                if d <= (2 if max(len(a), len(b)) >= 8 else 1):
                    want.add((a, b, d))
    assert got == want and want


def test_clusters_are_named_by_their_usual_spelling(spark):
    rows = ["Despacho"] * 5 + ["Despaho"] * 2 + ["Despachos", "despacho"] + ["Sentença"] * 3 + ["Sentenca"] + ["Outro"]
    got = {r.label: (r.cluster, r.n_rows, r.n_labels) for r in spelling_clusters(spark.createDataFrame([(x,) for x in rows], "t string"), "t").collect()}
    assert got == {"Despacho": ("Despacho", 5, 4), "Despaho": ("Despacho", 2, 4), "Despachos": ("Despacho", 1, 4), "despacho": ("Despacho", 1, 4),
                   "Sentença": ("Sentença", 3, 2), "Sentenca": ("Sentença", 1, 2)}


def test_shapes(spark):
    values = ["AB-123 x", "abcDEF", "", "12/3/2024", "Ã9"]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v string")
    assert [r[0] for r in df.select(shape(F.col("v"))).collect()] == ["A-9 a", "aA", "", "9/9/9", "Ã9", None]


@pytest.mark.parametrize("keep", [21, 1000])
def test_frequent_shapes_are_exact(spark, keep):
    """Many shapes of one value each, few of many, whatever the summaries drop."""
    rng = random.Random(keep)
    odd = lambda i: "".join(c * (1 + (i >> k & 1)) for k, c in enumerate("-_.:;/+*#!?"))
    rows = [(rng.choice(["12", "ab 1", "X", odd(rng.randrange(2000))]), rng.choice([None, "2024-01-01", "1/2/2024"])) for _ in range(6000)]
    got = {(r.column_name, r.shape): (r.n, r.n_values) for r in frequent_shapes(spark.createDataFrame(rows, "a string, b string").repartition(5), share=0.05, keep=keep).collect()}
    fold = {"12": "9", "ab 1": "a 9", "X": "A", "2024-01-01": "9-9-9", "1/2/2024": "9/9/9"}
    want = {}
    for name, values in (("a", [r[0] for r in rows]), ("b", [r[1] for r in rows if r[1] is not None])):
        for s, n in Counter(fold.get(v, v) for v in values).items():
            if n >= 0.05 * len(values):
                want[(name, s)] = (n, len(values))
    assert got == want and len(want) == 5


def test_summaries_are_bounded(spark):
    df = spark.range(20_000).select(F.lit("c").alias("column_name"), F.repeat(F.lit("-"), (F.col("id") % 5000).cast("int")).alias("shape")).coalesce(1)
    assert summaries(df, 50).count() <= 101
    with pytest.raises(ValueError, match="keep"):
        frequent_shapes(spark.range(3).select(F.col("id").cast("string")), share=0.01, keep=100)


def land(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def test_headers_change_from_delivery_to_delivery(spark, tmp_dir):
    places = (f"{tmp_dir}/in", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt")
    land(f"{tmp_dir}/in/a.csv", "k,v\n1,x\n2,NA\n")
    land(f"{tmp_dir}/in/b.csv", 'v,k,"n ""o"""\n"y\nz",3,7\n')
    assert sorted((r.k, r.v) for r in ingest_versions(spark, *places).select("k", F.coalesce("v", F.lit("-")).alias("v")).collect()) == [
        ("1", "x"), ("2", "-"), ("3", "y\nz")]
    land(f"{tmp_dir}/in/c.csv", "k\r\n4\r\n")
    land(f"{tmp_dir}/in/d.csv", "k,v\n5,w\n")
    out = ingest_versions(spark, *places)
    assert set(out.columns) == {"k", "v", 'n "o"', SCHEMA_VERSION}
    assert sorted(r.k for r in out.collect()) == ["1", "2", "3", "4", "5"]
    assert sorted((r.n_rows, r.has_v) for r in schema_versions(out).collect()) == [(1, False), (1, True), (3, True)]
    assert ingest_versions(spark, *places).count() == 5  # nothing new
