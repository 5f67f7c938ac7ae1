"""Plan assertions over the whole catalogue (built-in paths stay JVM-side)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from kestrel.plans.cache import plan_text

# queries whose semantics need Python (the UDF surface, the segment fold, generated sub-frames)
PYTHON_OK = {"udf_map", "group_apply", "udaf_fold", "udaf_fold_count", "udaf_fold_amounts",
             "kv_string", "upsert_merge", "upsert_merge_orders",
             "flat_map_records", "gen_from_functions", "ordered_fold"}
PY_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
            "FlatMapCoGroupsInPandas", "PythonUDF")

QUERIES = E.queries()


def test_no_query_leaves_data_cached(spark):
    for name in ("cached_reuse",):
        QUERIES[name](spark, SF_SMALL).collect()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_OK:
        assert not any(n in plan for n in PY_NODES), name


@pytest.mark.parametrize("name", ["word_count", "group_mean", "tumbling_counter", "blocked_sum",
                                  "fold_nested_sum", "search_first", "value_counts"])
def test_partial_aggregation_before_exchange(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "partial_" in plan                         # map-side half of the aggregate
    assert sum(plan.count(a) for a in ("HashAggregate", "SortAggregate")) >= 2


@pytest.mark.parametrize("name", ["filter_isin", "loc_label", "loc_range", "range_slice",
                                  "group_mean_filtered", "parquet_scan"])
def test_filters_reach_the_scan(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")]
    assert pushed, plan
    assert any(tok in ln for ln in pushed for tok in ("In(", "EqualTo", "GreaterThan",
                                                      "LessThan")), pushed


def test_spread_is_a_no_op_on_large_inputs(spark):
    from kestrel.sources.tables import spread
    many = spark.range(0, 1000, numPartitions=64)
    assert spread(many, "id") is many                    # enough splits: no shuffle added
    few = spark.range(0, 1000, numPartitions=1)
    assert "Exchange" in plan_text(spread(few, "id"))


def test_blocked_sum_reads_the_data_once(spark):
    q = QUERIES["blocked_sum"](spark, SF_SMALL)
    q.collect()                                          # final adaptive plan after execution
    assert "ReusedExchange" in plan_text(q)
