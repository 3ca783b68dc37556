"""Tables kept up to date from batches equal the tables built from all rows."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.asof import as_of_join
from strata.operators.bitmaps import daily_sets, distinct_between
from strata.operators.deltas import add_states, group_state, report, signed_changes
from strata.operators.keymap import load_key_map, new_keys, with_key
from strata.plans import tpch
from strata.sinks.partitions import touched_partitions, upsert_partitions
from tests.conftest import SF_SMALL


def test_ids_stay_and_new_ones_are_dense(spark, tmp_dir):
    path = f"{tmp_dir}/map"
    first = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 1)], "k string, n int")
    one = {(r.k, r.n): r.id for r in load_key_map(first, path, ["k", "n"]).collect()}
    assert sorted(one.values()) == [1, 2, 3] and one[("a", 2)] < one[("b", 1)]
    second = first.unionByName(spark.createDataFrame([("A", 0), (None, None), ("zz", 9), (None, 3)], "k string, n int"))
    two = {(r.k, r.n): r.id for r in load_key_map(second, path, ["k", "n"]).collect()}
    assert {k: two[k] for k in one} == one and sorted(two.values()) == [1, 2, 3, 4, 5, 6]
    files = sorted(os.listdir(path))
    load_key_map(second, path, ["k", "n"])
    assert sorted(os.listdir(path)) == files  # nothing new, nothing written
    got = with_key(second, spark.read.parquet(path), ["k", "n"]).collect()
    assert all(r.id == two[(r.k, r.n)] for r in got) and len(got) == 8
    assert new_keys(second.limit(0), None, ["k", "n"]).count() == 0


def table(spark, rows):
    return spark.createDataFrame(rows, "key long, value string, version int, part int")


def stamps(path):
    return {f"{d}/{n}": os.path.getmtime(f"{d}/{n}") for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_only_touched_partitions_are_rewritten(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    rows = [(i, f"v{i}", 1, i % 5 if i % 7 else None) for i in range(100)] + [(500, "alone", 1, 9)]
    table(spark, rows).write.partitionBy("part").parquet(path)
    before = stamps(path)
    batch = [(3, "changed", 2, 3), (1000, "new", 2, 3), (500, "moved", 2, 1), (8, "stale", 0, 3), (None, "no key", 2, 1)]
    updates = table(spark, batch)
    assert sorted(map(str, touched_partitions(spark.read.parquet(path), updates, "key", "part"))) == ["1", "3", "9"]
    upsert_partitions(spark, path, updates, "key", "version", "part")
    want = {r[0]: r for r in rows}
    for r in batch:
        if r[0] not in want or r[2] > want[r[0]][2]:
            want[r[0]] = r
    got = sorted((tuple(r) for r in spark.read.parquet(path).select("key", "value", "version", "part").collect()), key=str)
    assert got == sorted(want.values(), key=str)
    after = stamps(path)
    untouched = {f: t for f, t in before.items() if not any(f"part={p}/" in f for p in (1, 3, 9))}
    assert untouched and all(after.get(f) == t for f, t in untouched.items())
    assert not any("part=9/" in f for f in after)  # its only row went elsewhere
    assert upsert_partitions(spark, path, table(spark, []), "key", "version", "part") == []


def test_an_upsert_that_is_run_again_changes_nothing(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    table(spark, [(i, "a", 1, i % 3) for i in range(10)]).write.partitionBy("part").parquet(path)
    batch = table(spark, [(1, "b", 2, 2), (5, "b", 2, None)])
    read = lambda: sorted(str(tuple(r)) for r in spark.read.parquet(path).select("key", "value", "part").collect())
    upsert_partitions(spark, path, batch, "key", "version", "part")
    once = read()
    upsert_partitions(spark, path, batch, "key", "version", "part")
    assert read() == once and len(once) == 10


DAY = dt.date(2020, 1, 1)


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_version_valid_at_each_time(spark, parts):
    rng = random.Random(parts)
    day = lambda n: None if n is None else DAY + dt.timedelta(n)
    versions = []
    for k in range(8):
        starts = sorted(rng.sample(range(100), rng.randint(0, 6)))
        versions += [(k, day(s), day(e), f"{k}-{s}") for s, e in zip(starts, [*starts[1:], rng.choice([None, 120])])]
    hot = [(1, day(rng.randrange(110)), i) for i in range(300)]  # one key has most rows
    rows = hot + [(rng.choice([*range(10), None]), day(rng.choice([None, *range(130)])), 1000 + i) for i in range(200)] + hot[:5]
    v = spark.createDataFrame(versions, "k long, valid_from date, valid_to date, name string")
    r = spark.createDataFrame(rows, "k long, t date, n int")
    got = as_of_join(r, v, "k", "t", ["name"], num_partitions=parts).collect()

    def of(k, t):
        own = [x for x in versions if x[0] == k and t is not None and x[1] <= t]
        best = max(own, key=lambda x: x[1], default=None)
        return best[3] if best and (best[2] is None or t < best[2]) else None

    assert sorted(map(str, ((x.k, x.t, x.n, x.name) for x in got))) == sorted(map(str, ((k, t, n, of(k, t)) for k, t, n in rows)))


def test_versions_that_begin_together_and_empty_sides(spark):
    v = spark.createDataFrame([(1, DAY, "a"), (1, DAY, "b"), (None, DAY, "c"), (1, None, "d")], "k long, valid_from date, name string")
    r = spark.createDataFrame([(1, DAY), (1, DAY - dt.timedelta(1))], "k long, t date")
    got = as_of_join(r, v, "k", "t", ["name"], valid_to=None)
    assert sorted(map(str, got.collect())) == sorted(map(str, spark.createDataFrame([(1, DAY, "b"), (1, DAY - dt.timedelta(1), None)],
                                                                                     "k long, t date, name string").collect()))
    assert as_of_join(r.limit(0), v, "k", "t", ["name"], valid_to=None).count() == 0
    assert [x.name for x in as_of_join(r, v.limit(0), "k", "t", ["name"], valid_to=None).collect()] == [None, None]
    with pytest.raises(ValueError, match="in the rows already"):
        as_of_join(r.withColumn("name", F.lit(1)), v, "k", "t", ["name"])


def cases(spark, rows):
    return spark.createDataFrame(rows, "id long, g string, days long")


def test_report_state_follows_any_batches(spark):
    rng = random.Random(3)
    now = {i: (i, rng.choice("ab"), rng.choice([None, 1, 5])) for i in range(60)}
    state = group_state(cases(spark, list(now.values())), ["g"], "days")
    for _ in range(3):
        batch = [(i, rng.choice(["a", "b", "c", None]), rng.choice([None, 2, 9])) for i in rng.sample(range(80), 25)]
        changes = signed_changes(cases(spark, list(now.values())), cases(spark, batch), "id")
        state = add_states(state, group_state(changes, ["g"], "days"))
        now |= {r[0]: r for r in batch}
    want = group_state(cases(spark, list(now.values())), ["g"], "days")
    assert sorted(map(str, state.collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, report(state).collect())) == sorted(map(str, report(want).collect()))


def test_groups_that_lose_all_rows_go(spark):
    one = cases(spark, [(1, "a", 3), (2, "b", 0)])
    gone = signed_changes(one, cases(spark, [(1, "a", None), (2, "b", None)]), "id")
    assert add_states(group_state(one, ["g"], "days"), group_state(gone, ["g"], "days")).count() == 0
    with pytest.raises(TypeError, match="whole numbers"):
        group_state(spark.createDataFrame([(1, 0.5)], "g int, x double"), ["g"], "x")


@pytest.mark.parametrize("dense", [1, 40, 100_000])
def test_distinct_over_any_days(spark, dense):
    rng = random.Random(dense)
    day = lambda n: DAY + dt.timedelta(n)
    rows = [(rng.choice(["x", "y", None]), day(rng.randrange(12)), rng.choice([rng.randrange(90), rng.randrange(-70_000, 70_000), 5_000_000_000])) for _ in range(3000)]
    df = spark.createDataFrame([*rows, ("x", None, 1), ("x", day(2), None)], "g string, d date, id long")
    sets = daily_sets(df, ["g"], "d", "id", dense)
    for lo, hi in ((0, 11), (3, 5), (7, 7), (20, 30)):
        want = {}
        for g, d, i in rows:
            if day(lo) <= d <= day(hi):
                want.setdefault(g, set()).add(i)
        got = {r.g: r.n_distinct for r in distinct_between(sets, ["g"], day(lo), day(hi)).collect()}
        assert got == {g: len(s) for g, s in want.items()}
    every = {i for _, _, i in rows}
    assert distinct_between(sets, [], day(0), day(11)).first()[0] == len(every)


def test_event_ids_are_unique(spark):
    ids = tpch.normalised(spark, SF_SMALL).movimentacao.select("event_id")
    assert ids.distinct().count() == ids.count() > 0


def test_queried_events_are_numbered_in_order(spark):
    from strata.plans.bound_queries import norm_events

    rows = sorted(map(tuple, norm_events(spark, SF_SMALL).collect()))
    assert [r[0] for r in rows] == list(range(1, len(rows) + 1)) and len(rows) > 1000
    keys = [(case, kind, day is None, str(day)) for _, case, kind, day in rows]
    assert keys == sorted(keys)


def test_one_table_of_the_event_model_builds_no_other(spark, tmp_path):
    from strata.operators.counts import table_counts
    from strata.plans.normalise import LayeredModel

    class Kept(dict):
        def __init__(self, makers):
            super().__init__()
            self.makers = makers

        def __missing__(self, name):
            self[name] = self.makers[name]()
            return self[name]

    class Raw(dict):
        def __missing__(self, name):
            self[name] = tpch.RAW[name](spark, SF_SMALL)
            return self[name]

    raw = Raw()
    model = LayeredModel(spark, raw, Kept)
    assert model.classe.count() == 5 and set(model._layer) == {"classe"} and set(raw) == {"classes"}
    assert dict(table_counts(model.tables()).collect()) == dict(tpch.normalised(spark, SF_SMALL, materialize=False).counts.collect())


def test_casts_of_odd_numbers_and_short_years(spark):
    from strata.functions import parse_mixed_date, safe_int

    ints = {"0x0": 0, "0x00fF": 255, "0X1_0": 16, "0x": None, "0xffffffffffffffff1": None, "0x0000000000000000000001": 1, "0b101": 5, "0b2": None,
            "0b" + "1" * 65: None, "12.5": 13, " 7 ": 7, "x": None, "": None, "1_000": 1000}
    days = {"1/2/3": "0001-02-03", "31/12/99": "0099-12-31", "123-4-5": "0123-04-05", "2020/1/2 10:30": "2020-01-02", "0000-01-01": None,
            "2021-02-29": None, "29/02/2020": "2020-02-29", "n/d": None, "": None, "--": None, " 5/6/2001 ": "2001-06-05"}
    df = spark.createDataFrame([(k,) for k in {**ints, **days}], "v string")
    got = {r.v: (r.i, str(r.d) if r.d else None) for r in df.select("v", safe_int("v").alias("i"), parse_mixed_date("v").alias("d")).collect()}
    assert {k: got[k][0] for k in ints} == ints and {k: got[k][1] for k in days} == days
