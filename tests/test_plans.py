"""Plan properties the scale design relies on (checked on the executed plans)."""

import pytest

import __spark_entry__ as E
from pyspark.sql import functions as F

from tableflow.functions.hashing import salted_key
from tableflow.operators import data_profile, join_on, rows_to_cells, salt_cells
from tests.conftest import SF_SMALL

QUERIES = E.queries()


def _final_plan(df) -> str:
    df.collect()  # runs this frame's own execution, so AQE's final plan is shown
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_prefix_filter_reaches_parquet(spark):
    plan = _final_plan(QUERIES["prefix_filter"](spark, SF_SMALL))
    assert "StringStartsWith(p_name,red)" in plan
    assert "ReadSchema: struct<p_name:string,p_type:string,p_size:int>" in plan


def test_join_filters_and_pruning_reach_parquet(spark):
    plan = _final_plan(QUERIES["join_inner"](spark, SF_SMALL))
    assert "o_totalprice" not in plan and "c_acctbal" not in plan  # unused columns are not read
    orders, customer = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("orders", "customer"))
    picked = join_on(orders, customer, {"o_custkey": "c_custkey"}, "inner").where("o_orderstatus = 'F' AND c_mktsegment = 'BUILDING'")
    plan = _final_plan(picked.select("o_orderkey", "c_name"))
    assert "EqualTo(o_orderstatus,F)" in plan and "EqualTo(c_mktsegment,BUILDING)" in plan


@pytest.mark.parametrize("key", ["rename_cols", "drop_cols", "cast_schema", "select_rename", "clean_price",
                                 "round_cols", "safe_names", "salt_key", "cell_codec", "line_chunk",
                                 "src_parquet", "prefix_filter"])
def test_projection_operators_do_not_shuffle(spark, key):
    plan = _final_plan(QUERIES[key](spark, SF_SMALL))
    assert "Exchange" not in plan


def test_inline_table_is_broadcast(spark):
    plan = _final_plan(QUERIES["src_inline"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_profile_shuffles_no_values_for_moments(spark):
    """One scan for counts and moments, keyed by column; one for the distinct values."""
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plan = _final_plan(data_profile(e))
    assert plan.count("FileScan parquet") == 2
    moments = [x for x in plan.split("Exchange hashpartitioning") if "partial_stddev_samp" in x]
    assert moments and "partial_count" in plan
    assert _final_plan(data_profile(e, approx=True)).count("FileScan parquet") == 1


def test_wide_profile_plans(spark):
    wide = spark.range(50).select(*[(F.col("id") % (k + 1)).alias(f"c{k}") for k in range(200)])
    rows = data_profile(wide).collect()
    assert [r.distinct_count for r in rows] == [min(k + 1, 50) for k in range(200)]


@pytest.mark.parametrize("key", ["string_index", "one_hot", "assemble"])
def test_labels_join_without_moving_the_fact_table(spark, key):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        plan = _final_plan(QUERIES[key](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert not [x for x in plan.split("\n") if "Exchange hashpartitioning(o_orderpriority" in x]


def test_cell_scans_push_into_the_stored_table(spark):
    plan = _final_plan(QUERIES["cells_scan_columns"](spark, SF_SMALL))
    assert "In(qualifier, [c_mktsegment,c_name])" in plan and "EqualTo(family,cf)" in plan
    plan = _final_plan(QUERIES["cells_prefix_filter"](spark, SF_SMALL))
    assert "StringStartsWith(value,red)" in plan and "EqualTo(qualifier,p_name)" in plan
    assert "ReadSchema: struct<rowkey:string>" in _final_plan(QUERIES["cells_row_keys"](spark, SF_SMALL))


def test_filters_and_joins_pass_a_salt(spark):
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    cells = rows_to_cells(customer, "c_custkey", ["c_name"])
    plan = _final_plan(salt_cells(cells, 16).where("rowkey = '7'"))
    below = plan.split("Expand", 1)[1]  # the key's filter is below the cells, next to the scan
    assert "Filter (isnotnull(c_custkey" in below and "= 7)" in below.split("FileScan")[0]
    other = customer.select(salted_key("c_custkey", 16).alias("k"))
    assert customer.join(other, salted_key("c_custkey", 16) == F.col("k")).count() == customer.count()


def test_aggregates_are_partial(spark):
    plan = _final_plan(QUERIES["cells_upsert"](spark, SF_SMALL))
    assert "partial_max_by" in plan
