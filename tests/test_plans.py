"""Plan-shape checks: the physical plans we want at scale."""

from strata.plans import bound_queries as B
from strata.plans import reports as R
from strata.plans import tpch
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    p = df._jdf.queryExecution().executedPlan()
    p.execute().count()                       # let AQE finalise this very plan
    text = p.toString()
    return text.split("== Initial Plan ==")[0]


def test_no_cartesian_product_anywhere(spark):
    for name, fn in B.QUERIES.items():
        p = plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name


def test_scans_prune_and_push_down(spark):
    p = plan(tpch.close_events(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,A)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string,l_shipdate:timestamp_ntz>" in p
    assert "partial_min" in p                  # first closing pre-aggregated before its shuffle


def test_dedup_and_survivors_are_aggregates_not_windows(spark):
    lazy = tpch.model(spark, SF_SMALL, materialize=False)
    for name in ("stg_classes", "stg_cases", "stg_events"):
        p = plan(lazy[name])
        assert "Window" not in p, name
    assert "partial_min(struct" in plan(lazy["stg_classes"])


def test_flagship_broadcasts_every_dimension_and_never_shuffles_the_fact(spark):
    m = tpch.model(spark, SF_SMALL)
    p = final_plan(R.by_district_class_year(m))
    assert p.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in p
    # the only shuffles are the aggregate's and the final sort's
    assert p.count("Exchange hashpartitioning") == 1
    assert p.count("Exchange rangepartitioning") == 1


def test_fanout_counts_events_before_joining(spark):
    m = tpch.model(spark, SF_SMALL)
    p = final_plan(R.fanout(m, m["stg_events"]))
    assert "partial_count" in p
    assert p.index("partial_count") > 0


def test_normalised_event_ids_need_no_sort_and_no_shuffle_of_the_events(spark):
    n = tpch.normalised(spark, SF_SMALL, materialize=False)
    p = final_plan(n.movimentacao)
    assert "Window [" not in p and "rangepartitioning" not in p
    assert "monotonically_increasing_id" in p
