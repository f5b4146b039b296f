"""Physical plans: no cross joins, pruned scans, no Python where Spark has an expression."""

import pytest

from quipu import storage
from quipu.operators import ordering, quantiles, schedule
from quipu.plans import load

FOLDER = "/root/testdata/sf0.001"
QUERIES = load()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    if name not in ("matmul", "corr_matrix", "scan_csv_strings", "scan_json_large"):  # dense blocks, and lines joined in order
        assert "Python" not in text and "InPandas" not in text


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["filter_and"](spark, FOLDER))
    assert "EqualTo(p_type,ECONOMY)" in text and "GreaterThan(p_size,25)" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string,p_size:int>" in text


def test_facts_are_summed_before_the_join(spark):
    text = plan(QUERIES["sql_join_group"](spark, FOLDER))
    join = text.index("Join")
    assert "partial_count" in text[join:]  # below the join in the tree


def test_summary_reads_the_facts_once(spark):
    text = plan(QUERIES["sales_summary"](spark, FOLDER))
    assert text.count("lineitem.parquet") == 1


@pytest.mark.parametrize("name", ["set_intersect", "set_difference"])
def test_repeats_are_folded_below_the_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert text[text.index("Join") :].count("HashAggregate") >= 4


def test_top_k_is_taken_per_task(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_k"](spark, FOLDER))


@pytest.mark.parametrize("name", ["describe", "box_stats", "cron_expand", "row_slice", "actor_ranking", "mat_sort_axis"])
def test_legs_before_stored_tables(spark, name, monkeypatch):
    """Also the plans that run while a query is declared, with no table small enough to broadcast."""
    legs = []

    def watched(df, label):
        legs.append(plan(df))
        return storage.stage(df, label)

    for module in (ordering, quantiles, schedule):
        monkeypatch.setattr(module, "stage", watched)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        legs.append(plan(QUERIES[name](spark, FOLDER)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(legs) > 1
    for text in legs:
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "Python" not in text and "InPandas" not in text
