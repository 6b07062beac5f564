"""Plan-shape checks for the scale properties the operators rely on.

Plans are taken with automatic broadcasts off, i.e. the plan Spark would
choose when no input is small.
"""
import pytest

import __spark_entry__ as E
from streamfold.plans import catalog

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_pairwise_joins_in_any_query(no_auto_broadcast):
    spark = no_auto_broadcast
    for name, fn in ((n, E.queries()[n]) for n in catalog.QUERIES):
        p = _plan(fn(spark, SF))
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, name


def test_keyed_merges_combine_map_side(no_auto_broadcast):
    spark = no_auto_broadcast
    for name in ("merge_latest_nonnull", "upsert_last_row", "declarative_spec", "spec_wide_upsert"):
        p = _plan(E.queries()[name](spark, SF))
        assert "partial_max_by" in p, name


def test_asof_windows_are_per_key_and_chunk_or_span(no_auto_broadcast):
    spark = no_auto_broadcast
    p = _plan(E.queries()["enrich_asof"](spark, SF))
    assert "hashpartitioning(symbol" in p and "_chunk" in p and "_span" in p
    # the only window partitioned by the key alone runs over span rows, after partial aggregates
    assert "partial_max_by" in p and "BroadcastExchange" not in p


def test_asof_scans_each_input_once(no_auto_broadcast):
    """The chunk rows and the last join read the exchange of the union."""
    spark = no_auto_broadcast
    for name in ("enrich_asof", "pct_change"):
        df = E.queries()[name](spark, SF)
        df.collect()
        final = _plan(df).split("== Initial Plan ==")[0]
        assert final.count("FileScan parquet") == 2 and final.count("ReusedExchange") == 2, name


def test_top_k_ranks_within_salted_groups_first(no_auto_broadcast):
    spark = no_auto_broadcast
    p = _plan(E.queries()["runs_top20"](spark, SF))
    assert "hashpartitioning(pipeline_id#" in p and "_salt" in p


def test_registered_queries_stay_in_the_jvm(no_auto_broadcast):
    """No Python evaluation in any registered (batch) query: every
    expression runs in whole-stage codegen or built-in operators."""
    spark = no_auto_broadcast
    python_ops = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                  "FlatMapCoGroupsInPandas", "PythonUDF")
    for name, fn in ((n, E.queries()[n]) for n in catalog.QUERIES):
        p = _plan(fn(spark, SF))
        assert not any(op in p for op in python_ops), name
