"""Registered queries: each callable takes (spark, sf_dir) and returns a DataFrame.

Every query reads whole generated tables (or data Spark derives from them).
Round-trip queries write to a fresh directory under the shared checkpoint dir
and read the result back.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.defaults import DEFAULT_MAX_LINE_LENGTH, LONG_LINE_LENGTH
from tableflow.operators import (
    aggregate,
    append_cell_writes,
    read_latest_cells,
    assemble,
    cast_schema,
    cells_long,
    cells_prefix_filter,
    cells_to_rows,
    create_cell_table,
    data_profile,
    distinct_values,
    drop_cols,
    encoding_profile,
    explode_lines,
    fit_labels,
    index_labels,
    indexed_prefix_filter,
    join_mapped,
    join_on,
    line_profile,
    merge_profiles,
    null_count,
    null_rows,
    one_hot,
    parse_amount,
    profile_parts,
    prefix_filter,
    read_bulk,
    rename_cols,
    round_cols,
    row_keys,
    rows_to_cells,
    safe_names,
    salt_cells,
    scan_columns,
    schema_conformance,
    select_rename,
    string_index,
    top_n,
    upsert_cells,
    with_case,
    write_bulk,
    write_cells,
    write_indexed_cells,
)
from tableflow.functions.hashing import salted_key
from tableflow.operators.cells import salt_of
from tableflow.operators.charsets import charset_advice, fit_charsets
from tableflow.operators.features import category_count
from tableflow.operators.joins import split_skew_join
from tableflow.operators.quality import PROFILE_PART_SCHEMA
from tableflow.functions.text import chunk_text
from tableflow.plans.tables import load
from tableflow.session import scratch_path
from tableflow.sinks import insert_partitions, to_csv, to_parquet
from tableflow.sources import (
    inline_table,
    month_labels,
    read_csv,
    read_monthly_output,
    read_parquet,
    readin_monthly,
    split_by_month,
    write_changed_months,
    write_monthly,
    write_monthly_tables,
)
from tableflow.streaming import (
    FlowSpec,
    read_closed,
    read_flow_output,
    run_flows,
    start_closing,
    wait_until_closed,
    write_spool,
)

Query = Callable[[SparkSession, str], DataFrame]

# Bands over the order prices: lower bound inclusive, upper exclusive.
PRICE_BANDS = [
    (0, 10_000, "small"),
    (10_000, 100_000, "medium"),
    (100_000, 300_000, "large"),
]
PRICE_DEFAULT = "very large"

SALT_BUCKETS = 16
CELL_COLUMNS_CUSTOMER = ["c_name", "c_mktsegment", "c_nationkey"]
CELL_COLUMNS_PART = ["p_name", "p_type", "p_size"]
PREFIX = "red"
LONG_LINE_LIMIT = LONG_LINE_LENGTH
DEFAULT_LINE_LIMIT = DEFAULT_MAX_LINE_LENGTH
SPOOL_CHARSET = "windows-1252"


def _price_conditions(col: str) -> list[tuple[Callable[[DataFrame], Column], str]]:
    return [
        (lambda df, lo=lo, hi=hi: (df[col] >= lo) & (df[col] < hi), label)
        for lo, hi, label in PRICE_BANDS
    ]


# ---------------------------------------------------------------- flagship


def q_entry_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = load(spark, sf_dir, "customer")
    bucketed = with_case(orders, "price_band", _price_conditions("o_totalprice"), PRICE_DEFAULT)
    joined = join_mapped(bucketed, customer, {"o_custkey": "c_custkey"}, how="left",
                         sel=["c_custkey", "c_mktsegment"])
    agg = aggregate(joined, ["price_band", "c_mktsegment"], {
        "o_orderkey": {"n_orders": "count"},
        "o_totalprice": {"least_total": "min", "greatest_total": "max"},
        "o_custkey": {"n_customers": "countDistinct"},
    })
    return top_n(agg, 10, "n_orders", tie_breaker=["price_band", "c_mktsegment"])


# ---------------------------------------------------------------- sources / sinks


def q_src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "csv")
    to_csv(load(spark, sf_dir, "customer"), out + "/", "customer", sep="|")
    return read_csv(spark, out + "/", "customer", sep="|")


def q_src_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, sf_dir.rstrip("/") + "/", "lineitem.parquet")


# A small hand-made label table for the order priorities.
PRIORITY_LABELS = [
    ("1-URGENT", "rush"),
    ("2-HIGH", "rush"),
    ("3-MEDIUM", "normal"),
    ("4-NOT SPECIFIED", "normal"),
]


def q_src_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = inline_table(spark, PRIORITY_LABELS, "o_orderpriority string, handling string")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    joined = join_on(orders, labels, "o_orderpriority", how="left")
    return aggregate(joined, ["o_orderpriority", "handling"], {"o_orderkey": {"n_orders": "count"}})


def q_sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a note that holds quotes, line ends, blanks, empty texts and NULLs."""
    out = scratch_path(spark, "sink-csv")
    orders = load(spark, sf_dir, "orders")
    note = (F.when(F.col("o_orderstatus") == "F", F.lit(' say "hi",\r\nnext line\n\\ '))
            .when(F.col("o_orderstatus") == "O", F.lit("")))
    to_csv(orders.withColumn("note", note), out, mode="overwrite", multi_line=True)
    schema = ", ".join(f"{name} {kind}" for name, kind in orders.dtypes) + ", note string"
    return read_csv(spark, out, schema=schema, multiLine=True)


def q_sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "sink-parquet")
    to_parquet(load(spark, sf_dir, "lineitem"), out, mode="overwrite")
    return read_parquet(spark, out)


def _orders_some_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate"))
    return load(spark, sf_dir, "orders").withColumn("o_orderdate", date)


def _month_fn(df: DataFrame) -> DataFrame:
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))


def q_monthly_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "monthly")
    split_by_month(_orders_some_undated(spark, sf_dir), "o_orderdate", root, "orders")
    return readin_monthly(spark, root, "orders", _month_fn, start_month=1, end_month=12, layout="hive", undated=True)


def q_monthly_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-month results written as ``orders_status_MM`` tables, read back."""
    root = scratch_path(spark, "monthly-src")
    split_by_month(_orders_some_undated(spark, sf_dir), "o_orderdate", root, "orders")
    out = scratch_path(spark, "monthly-tables")
    locs = write_monthly_tables(spark, root, "orders", _month_fn, out, "orders_status", layout="hive", undated=True)
    parts = [spark.read.parquet(loc).withColumn("month", F.lit(loc[-2:])) for loc in locs]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


def q_monthly_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve monthly tables of orders whose columns come, go and widen, read as one."""
    root = scratch_path(spark, "monthly-drift")
    orders = load(spark, sf_dir, "orders")
    price, code = F.col("o_totalprice"), F.col("o_orderkey") % 100
    key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    quarters = [
        [key.cast("int").alias("o_orderkey"), F.floor(price).cast("int").alias("o_totalprice"), status, code.cast("int").alias("o_code")],
        [key, F.round(price, 2).cast("decimal(12,2)").alias("o_totalprice"), priority, status, code.alias("o_code")],
        [key, price, priority, F.concat(F.lit("c"), code.cast("string")).alias("o_code")],
        [key, price, status, priority, F.concat(F.lit("c"), code.cast("string")).alias("o_code")]]
    for mm in month_labels():
        of_month = orders.where(F.date_format("o_orderdate", "MM") == mm)
        of_month.select(*quarters[(int(mm) - 1) // 3]).write.parquet(f"{root}/orders_{mm}")
    return readin_monthly(spark, root, "orders", lambda month: month, widen=True)


def q_monthly_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly results written twice: between the runs one order of March changes, so the second
    run computes March alone.  ``run`` tells which run wrote a month."""
    root, out = scratch_path(spark, "monthly-changing"), scratch_path(spark, "monthly-changed")
    orders = load(spark, sf_dir, "orders")
    split_by_month(orders, "o_orderdate", root, "orders")

    def counted(run: int) -> Callable[[DataFrame], DataFrame]:
        return lambda month: aggregate(month, "o_orderstatus", {"o_orderkey": {"n_orders": "count"}}).withColumn("run", F.lit(run))

    write_changed_months(spark, root, "orders", counted(1), out, "orders_status", layout="hive")
    march = orders.where(F.date_format("o_orderdate", "MM") == "03")
    first = march.agg(F.min("o_orderkey")).first()[0]
    status = F.when(F.col("o_orderkey") == F.lit(first), "X").otherwise(F.col("o_orderstatus"))
    changed = march.withColumn("o_orderstatus", status)
    write_monthly(changed.withColumn("month", F.lit("03")), f"{root}/orders")
    write_changed_months(spark, root, "orders", counted(2), out, "orders_status", layout="hive")
    months = [spark.read.parquet(f"{out}/orders_status_{mm}").withColumn("month", F.lit(mm)) for mm in month_labels()]
    return reduce(DataFrame.unionByName, months)


def q_catalog_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in a catalog table partitioned by month, then the months of the second quarter
    replaced by their finished orders; the table is read through the catalog."""
    path = scratch_path(spark, "catalog-orders")
    name = "orders_by_month_" + path[-12:]
    orders = load(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "MM").alias("month"), "o_orderstatus")
    insert_partitions(orders, name, path, ["month"])
    spring = orders.where(F.col("month").isin("04", "05", "06") & (F.col("o_orderstatus") == "F"))
    insert_partitions(spring.withColumn("o_orderstatus", F.lit("done")), name, path, ["month"])
    return spark.table(name)


def q_monthly_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "monthly-out")
    orders = load(spark, sf_dir, "orders")
    monthly = orders.select("o_orderkey", "o_orderstatus",
                            F.date_format("o_orderdate", "MM").alias("month"))
    write_monthly(monthly, out)
    return read_monthly_output(spark, out)


# ---------------------------------------------------------------- cells


def _customer_cells(spark: SparkSession, sf_dir: str, value_format: str = "text") -> DataFrame:
    return rows_to_cells(load(spark, sf_dir, "customer"), "c_custkey", CELL_COLUMNS_CUSTOMER,
                         value_format=value_format)


def _part_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_to_cells(load(spark, sf_dir, "part"), "p_partkey", CELL_COLUMNS_PART)


def q_rows_to_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _customer_cells(spark, sf_dir, value_format="bytes")
    return cells.select("rowkey", "family", "qualifier", F.hex("value").alias("value_hex"))


def _stored(spark: SparkSession, cells: DataFrame) -> DataFrame:
    """The cells as a stored table: created if missing, written in scan order, read through the catalog."""
    path = scratch_path(spark, "cells")
    name = "cells_" + os.path.basename(path).rpartition("-")[2]
    create_cell_table(spark, name, path)
    write_cells(cells, path)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def q_cells_scan_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_columns(_stored(spark, _customer_cells(spark, sf_dir)), ["c_name", "c_mktsegment"])


def q_cells_row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_keys(_stored(spark, _customer_cells(spark, sf_dir)))


def q_cells_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _stored(spark, _customer_cells(spark, sf_dir))
    return aggregate(cells, [], {"qualifier": {"n_cells": "count"}, "rowkey": {"n_rows": "countDistinct"}})


def q_cells_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells_long(_customer_cells(spark, sf_dir))


def q_cells_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _customer_cells(spark, sf_dir, value_format="bytes")
    return cells_to_rows(cells, {"c_name": "utf8", "c_mktsegment": "utf8", "c_nationkey": "int4"},
                         key_name="c_custkey")


def q_prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    return prefix_filter(part, "p_name", PREFIX).select("p_name", "p_type", "p_size")


def q_cells_prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells_prefix_filter(_stored(spark, _part_cells(spark, sf_dir)), "p_name", PREFIX)


def q_cells_indexed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix filter through an index of values beside cells in row-key order."""
    path = scratch_path(spark, "indexed-cells")
    write_indexed_cells(_part_cells(spark, sf_dir), path)
    return indexed_prefix_filter(spark, path, "p_name", PREFIX)


def q_cells_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer cells as the base version, then every event writes the cells
    ``event_type`` and ``props`` of its user; per cell the latest write wins."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    customer = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", epoch.alias("ts"), F.lit(-1).cast("bigint").alias("event_id")
    )
    base = rows_to_cells(customer, "c_custkey", ["c_name", "c_mktsegment"], carry=["ts", "event_id"])
    writes = rows_to_cells(load(spark, sf_dir, "events"), "user_id", ["event_type", "props"],
                           carry=["ts", "event_id"])
    return upsert_cells(base, writes, ["ts", "event_id"])


def q_cells_store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert of ``cells_upsert`` through a stored, append-only cell table:
    customer cells are appended first, the event writes later; reading
    resolves the last write per cell."""
    store = scratch_path(spark, "cell-store")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    customer = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", epoch.alias("ts"), F.lit(-1).cast("bigint").alias("event_id")
    )
    order = ["ts", "event_id"]
    append_cell_writes(rows_to_cells(customer, "c_custkey", ["c_name", "c_mktsegment"], carry=order), store, order)
    append_cell_writes(rows_to_cells(load(spark, sf_dir, "events"), "user_id", ["event_type", "props"], carry=order),
                       store, order)
    return read_latest_cells(spark, store, order)


def _salted_customer_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of customers some of whose segments are NULL or empty; neither makes a cell."""
    segment = F.col("c_mktsegment")
    customer = load(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.when(segment == "MACHINERY", F.lit("")).when(segment != "BUILDING", segment))
    cells = rows_to_cells(customer, "c_custkey", CELL_COLUMNS_CUSTOMER, drop_empty=True)
    return salt_cells(cells, SALT_BUCKETS)


def q_salt_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    return customer.select("c_custkey", salted_key("c_custkey", SALT_BUCKETS).alias("salted"))


def q_salted_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _salted_customer_cells(spark, sf_dir).select("salt", "salted", "qualifier", "value")


def q_bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "bulk")
    write_bulk(_salted_customer_cells(spark, sf_dir), out)
    return read_bulk(spark, out).select(salt_of("salted").alias("salt"), "salted", "qualifier", "value")


def q_cell_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tableflow.functions.codec import bytes4_to_int, bytes_to_text, int_to_bytes4, text_to_bytes

    c = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.floor("c_acctbal").cast("int").alias("acct_int")
    )
    enc = c.select(
        "c_custkey",
        int_to_bytes4("c_nationkey").alias("nation_b"),
        int_to_bytes4("acct_int").alias("acct_b"),
        text_to_bytes("c_name").alias("name_b"),
    )
    return enc.select(
        "c_custkey",
        F.hex("nation_b").alias("nation_hex"),
        bytes4_to_int("nation_b").alias("nation_back"),
        F.hex("acct_b").alias("acct_hex"),
        bytes4_to_int("acct_b").alias("acct_back"),
        F.hex("name_b").alias("name_hex"),
        bytes_to_text("name_b").alias("name_back"),
    )


# ---------------------------------------------------------------- columns


def q_rename_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_cols(load(spark, sf_dir, "orders"),
                       {"o_orderkey": "order_key", "o_custkey": "cust_key", "not_there": "x"})


def q_drop_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_cols(load(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderdate", "not_there"])


def _orders_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text: keys with a fraction, prices too large for an int, dates with
    one-digit fields or a time after them, and text that is no date."""
    o = load(spark, sf_dir, "orders")
    date = F.col("o_orderdate")
    return o.select(
        F.concat(F.col("o_orderkey").cast("string"),
                 F.when(F.col("o_orderstatus") == "F", F.lit(".7")).otherwise(F.lit(""))).alias("o_orderkey"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(date, "d/M/yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(date, "dd/MM/yyyy 10:00"))
        .when(F.col("o_orderpriority") == "5-LOW", F.date_format(date, "yyyy.MM.dd"))
        .otherwise(F.date_format(date, "dd/MM/yyyy")).alias("o_orderdate"),
        "o_orderpriority",
        "o_orderstatus",
        (F.col("o_orderkey") * 100_000).cast("string").alias("overflowing"),
    )


def q_cast_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {
        "o_orderkey": "bigint",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "int",
        "overflowing": "int",
        "not_there": "int",
    }
    return cast_schema(_orders_as_text(spark, sf_dir), schema)


def q_select_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    return customer.select(*select_rename(["c_custkey", "c_name", "c_mktsegment"],
                                          {"c_custkey": "custkey", "c_name": "customer_name"}))


def q_case_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    b = with_case(orders, "price_band", _price_conditions("o_totalprice"), PRICE_DEFAULT)
    return aggregate(b, "price_band", {"o_orderkey": {"n_orders": "count"}})


def _events_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.withColumn("event_type", F.nullif(F.col("event_type"), F.lit("error")))


def q_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_rows(_events_with_nulls(spark, sf_dir), "event_type", ["user_id", "event_type"])


def q_null_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_count(_events_with_nulls(spark, sf_dir), ["event_type", "value"])


def q_clean_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    # whole and fractional amounts; the fraction is cut off
    amount = F.when(F.col("o_orderstatus") == "F", F.format_number(F.floor("o_totalprice"), 0)).otherwise(
        F.concat(F.format_number(F.floor("o_totalprice"), 0), F.lit(".50")))
    # pending orders carry another currency tag, which the pattern must not match
    price = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("MYR "), amount)).otherwise(
        F.concat(F.lit("RM "), amount)
    )
    return parse_amount(o.select("o_orderkey", price.alias("price")), "price", "prices")


def q_round_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    text = p.select("p_partkey", (F.col("p_retailprice") / F.col("p_size")).cast("string").alias("unit_price"))
    return round_cols(text, {"unit_price": 3})


def q_safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order key"),
        F.col("o_totalprice").alias("total price (usd)"),
        F.col("o_orderstatus").alias("status;code"),
    )
    return safe_names(o)


# ---------------------------------------------------------------- joins


def q_join_using_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"), "o_totalprice")
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return join_on(o, c, "custkey", how="left")


def q_join_using_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    counts = aggregate(e, ["user_id", "event_type"], {"event_id": {"n_events": "count"}})
    return join_on(e, counts, ["user_id", "event_type"], how="left")


def _orders_some_keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))
    return load(spark, sf_dir, "orders").select("o_orderkey", key.alias("o_custkey"), "o_orderstatus")


def _customers_some_keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey"))
    return load(spark, sf_dir, "customer").withColumn("c_custkey", key)


def _join_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders and customers; many on either side have a NULL key or no partner."""
    left = _orders_some_keyless(spark, sf_dir).select("o_orderkey", "o_custkey")
    return left, _customers_some_keyless(spark, sf_dir).select("c_custkey", "c_name")


def q_join_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-column key map with a renamed and dropped right key, some keys NULL."""
    events = _events_with_nulls(spark, sf_dir).select("event_id", "user_id", "event_type")
    counts = aggregate(events.where(F.col("event_type") != "view"), ["user_id", "event_type"],
                       {"event_id": {"n_events": "count"}})
    counts = rename_cols(counts, {"user_id": "uid"})
    return join_mapped(events, counts, {"user_id": "uid", "event_type": "event_type"}, how="left",
                       sel=["uid", "event_type", "n_events"], rename={"event_type": "kind"})


def q_join_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = _customers_some_keyless(spark, sf_dir)
    return join_mapped(o, c, {"o_custkey": "c_custkey"}, how="left", sel=["c_custkey", "c_name"])


def q_join_mapped_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = _customers_some_keyless(spark, sf_dir)
    return join_mapped(o, c, {"o_custkey": "c_custkey"}, how="left", sel=["c_custkey", "c_name"], drop=False)


def q_join_select_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf_dir, "customer")
    return join_mapped(
        o, c, {"o_custkey": "c_custkey"}, how="left",
        sel=["c_custkey", "c_name", "c_mktsegment"],
        rename={"c_custkey": "ck", "c_name": "customer_name"},
        drop=False,
    )


def q_join_skew_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events joined to per-key figures: the event types "click" and "view" are keys of
    about a fifth of the rows each and split; types by user are many cold keys."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    key = F.when(kind.isin("click", "view"), kind).otherwise(F.concat_ws("-", kind, user))
    events = load(spark, sf_dir, "events").select("event_id", key.alias("key"), "user_id")
    per_key = aggregate(events, "key", {"event_id": {"n_key": "count"}, "user_id": {"users_key": "countDistinct"}})
    return split_skew_join(events, per_key.checkpoint(), "key", how="left", buckets=8, min_share=0.05)


def _skew_outer(how: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        kind, user = F.col("event_type"), F.col("user_id").cast("string")
        key = F.when(kind.isin("click", "view"), kind).when(kind != "error", F.concat_ws("-", kind, user))
        events = load(spark, sf_dir, "events").select("event_id", key.alias("key"))
        segment, customer = F.col("c_mktsegment"), F.col("c_custkey")
        partner = (F.when(customer == 5, "click").when(segment == "MACHINERY", "nothing")
                   .when(segment != "AUTOMOBILE", F.concat(F.lit("purchase-"), customer.cast("string"))))
        customers = load(spark, sf_dir, "customer").select(partner.alias("key"), "c_custkey", "c_name")
        return split_skew_join(events, customers, "key", how=how, buckets=8, min_share=0.05)
    q.__name__ = f"q_join_skew_{how}"
    q.__doc__ = f"""A {how} join whose hot keys are on the left ("click", "view", one of them without a partner),
    on the right ("nothing", without a partner) and NULL on both sides."""
    return q


def _join_how(how: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        left, right = _join_sides(spark, sf_dir)
        return join_on(left, right, {"o_custkey": "c_custkey"}, how=how)
    q.__name__ = f"q_join_{how}"
    return q


# ---------------------------------------------------------------- aggregates


def q_agg_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return aggregate(li, ["l_returnflag", "l_linestatus"], {
        "l_quantity": "sum",
        "l_orderkey": "countDistinct",
        "l_extendedprice": "max",
        "l_discount": "min",
    })


def q_agg_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    agg = aggregate(c, "c_nationkey", {
        "c_name": {"n_customers": "count"},
        "c_acctbal": {"min_bal": "min", "max_bal": "max", "avg_bal": "mean", "sum_bal": "sum"},
        "c_mktsegment": {"n_segments": "countDistinct"},
    })
    return agg.withColumns({"avg_bal": F.round("avg_bal", 4), "sum_bal": F.round("sum_bal", 2)})


def q_agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    agg = aggregate(e, [], {
        "event_id": {"n_events": "count"},
        "user_id": {"n_users": "countDistinct"},
        "value": {"total_value": "sum", "mean_value": "mean"},
    })
    return agg.withColumns({"total_value": F.round("total_value", 2), "mean_value": F.round("mean_value", 4)})


def q_distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(load(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


def q_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_n(o, 10, "o_totalprice", tie_breaker=["o_orderkey"])


# ---------------------------------------------------------------- quality


def q_profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of the events of each kind, stored one after the other and merged; the merged estimate
    of distinct values is held against the exact count of the whole table."""
    events = _events_with_nulls(spark, sf_dir)
    store = scratch_path(spark, "profile-parts")
    kind = F.col("event_type")
    for arriving in (kind.isin("click", "view"), ~kind.isin("click", "view") | kind.isNull()):
        profile_parts(events.where(arriving), kind).write.mode("append").parquet(store)
    merged = merge_profiles(spark.read.schema(PROFILE_PART_SCHEMA).parquet(store))
    exact = data_profile(events).select("column", F.col("distinct_count").alias("exact_count"))
    close = F.abs(F.col("distinct_count") - F.col("exact_count")) <= 0.05 * F.col("exact_count")
    return merged.join(exact, "column").select(
        "column", "datatype", "count", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"), "min", "max", "null_count",
        close.alias("distinct_close"))


def q_data_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_profile(_events_with_nulls(spark, sf_dir), digits=4)


# The declared customer schema checked by schema_conformance.
DECLARED_CUSTOMER = {
    "c_custkey": "bigint",
    "c_name": "bigint",
    "c_nationkey": "int",
    "c_acctbal": "decimal(5,2)",
    "c_mktsegment": "string",
    "c_phone": "string",
}


def q_schema_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_conformance(load(spark, sf_dir, "customer"), DECLARED_CUSTOMER)


def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_lines(load(spark, sf_dir, "documents"), "text", keep=["doc_id", "source"], with_number=True)


def q_line_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_profile(_document_lines(spark, sf_dir), "source")


def q_line_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _document_lines(spark, sf_dir)
    return lines.select(
        "doc_id", "line_no",
        F.posexplode(chunk_text("line", DEFAULT_LINE_LIMIT)).alias("chunk_no", "chunk"),
    )


def q_encoding_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    spool = scratch_path(spark, "spool-cp1252")
    docs = load(spark, sf_dir, "documents")
    write_spool(docs, spool, "lang", charset=SPOOL_CHARSET)
    lines = spark.read.text(spool, lineSep="\n")  # read as UTF-8: cp1252 bytes are invalid
    return encoding_profile(lines, "lang")


def q_charset_advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of documents by source and language, in the bytes of the language's charset; the charsets
    are learned from the files of the sources that end in an even digit and advised for all files."""
    docs = load(spark, sf_dir, "documents").withColumn("text", F.regexp_replace("text", r"[^\x00-\xFF]", "?"))
    lines = explode_lines(docs, "text", keep=["source", "lang"])
    line, lang = F.col("line"), F.col("lang")
    charset = F.when(lang == "en", "UTF-16LE").when(lang == "de", "ISO-8859-2").when(lang == "es", "windows-1252").otherwise("UTF-8")
    # a-ogonek, l-stroke, z-dot and s-acute of ISO-8859-2 have the bytes that these four have in ISO-8859-1
    polish = F.translate(line, "\u00e4\u00f6\u00fc\u00df", "\u00b1\u00b3\u00bf\u00b6")
    value = (F.when(lang == "en", F.encode(line, "UTF-16LE")).when(lang == "de", F.encode(polish, "ISO-8859-1"))
             .when(lang == "es", F.encode(line, "ISO-8859-1")).otherwise(F.encode(line, "UTF-8")))
    files = lines.select(F.concat_ws("-", "source", "lang").alias("file"), charset.alias("known"), value.alias("value"), "source")
    model = fit_charsets(files.where(F.col("source").rlike("[02468]$")), "known").checkpoint()
    return charset_advice(files, model, "file").withColumnRenamed("name", "file")


# ---------------------------------------------------------------- features


def _indexed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return string_index(o, "o_orderpriority", "priority_idx")


def q_string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _indexed_orders(spark, sf_dir).select("o_orderkey", "o_orderpriority", "priority_idx")


def _early_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored dictionary of the customers that ordered before 1996."""
    early = load(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    return fit_labels(early, "o_custkey", scratch_path(spark, "labels"))


def q_string_index_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders indexed by a dictionary fitted on the early ones; other customers are one label more."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return index_labels(o, _early_labels(spark, sf_dir), "o_custkey", "cust_idx", handle_unseen="keep")


def q_string_index_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of all orders indexed by the fitted dictionary; orders of other customers are left out."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    spool, root = scratch_path(spark, "order-spool"), scratch_path(spark, "order-index")
    orders.write.parquet(spool)
    arriving = spark.readStream.schema(orders.schema).parquet(spool)
    indexed = index_labels(arriving, _early_labels(spark, sf_dir), "o_custkey", "cust_idx", handle_unseen="skip")
    out = f"{root}/data"
    (indexed.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).start(out).awaitTermination())
    return spark.read.schema(indexed.schema).parquet(out)


def q_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = _indexed_orders(spark, sf_dir).select("o_orderkey", "priority_idx")
    return one_hot(idx, "priority_idx", "priority_vec", as_columns=True)


def q_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = _indexed_orders(spark, sf_dir)
    enc = one_hot(idx, "priority_idx", "priority_vec")
    feats = assemble(enc, ["priority_idx", "priority_vec", "o_totalprice"], "features", as_array=True)
    # the index, its vector without the last category, the price
    width = category_count(idx, "priority_idx") + 1
    return feats.select("o_orderkey", *[F.col("features")[i].alias(f"feature_{i}") for i in range(width)])


# ---------------------------------------------------------------- streaming


def _run_doc_flows(spark: SparkSession, sf_dir: str, flow_col: Column, flows: dict[str, dict],
                   text: Column | None = None) -> DataFrame:
    """Spool the documents (one directory per flow, one spool per charset),
    run one streaming query per flow to completion, and read back what the
    sinks committed."""
    root = scratch_path(spark, "flows")
    docs = load(spark, sf_dir, "documents").withColumn("flow", flow_col)
    if text is not None:
        docs = docs.withColumn("text", text)
    spools = {}
    for charset in {opts.get("charset") for opts in flows.values()}:
        spools[charset] = os.path.join(root, "spool-" + (charset or "utf8"))
        wanted = [n for n, o in flows.items() if o.get("charset") == charset]
        for name in wanted:  # a flow without documents still has its directory
            spark.createDataFrame([], "value string").write.mode("append").text(os.path.join(spools[charset], f"flow={name}"))
        write_spool(docs.filter(F.col("flow").isin(wanted)), spools[charset], "flow", charset=charset)
    specs = {
        name: FlowSpec(
            spool_dir=os.path.join(spools[opts.get("charset")], f"flow={name}"),
            sink_dir=os.path.join(root, "sink", name),
            charset=opts.get("charset"),
            max_line_length=opts.get("max_line_length", DEFAULT_LINE_LIMIT),
        )
        for name, opts in flows.items()
    }
    run_flows(spark, specs)
    out = None
    for name, spec in specs.items():
        # one output set per base name, which is that of a spool file
        base = F.col("basename").rlike(r"^part-[0-9a-z.-]+\.txt$").alias("from_spool_file")
        part = read_flow_output(spark, spec).select(F.lit(name).alias("flow"), "value", base)
        out = part if out is None else out.unionByName(part)
    return out


def q_stream_spool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_doc_flows(spark, sf_dir, F.lit("docs"), {"docs": {}})


def q_stream_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_doc_flows(spark, sf_dir, F.lit("docs_cp1252"), {"docs_cp1252": {"charset": SPOOL_CHARSET}})


def q_stream_wide_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spool in UTF-16LE: lines end at two bytes, not at one."""
    return _run_doc_flows(spark, sf_dir, F.lit("docs_utf16"), {"docs_utf16": {"charset": "UTF-16LE"}})


def q_stream_line_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_doc_flows(spark, sf_dir, F.lit("long_lines"),
                          {"long_lines": {"max_line_length": LONG_LINE_LIMIT}})


# Flows by document language: plain ones, a windows-1252 spool, one with the
# raised line limit, and one for every other language and for none.
OTHER_FLOW = "other"
MULTI_FLOWS = {
    OTHER_FLOW: {},
    "en": {},
    "es": {},
    "de": {"charset": SPOOL_CHARSET},
    "fr": {"max_line_length": LONG_LINE_LIMIT},
}


def q_stream_idle_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents arrive as a stream, named by their source; each name is closed
    when it has been idle for a second.  Figures of a name that was opened again are added."""
    root = scratch_path(spark, "closing")
    lines = explode_lines(load(spark, sf_dir, "documents"), "text", keep=["source"])
    lines.write.parquet(f"{root}/spool")
    arriving = spark.readStream.schema(lines.schema).parquet(f"{root}/spool")
    query = start_closing(arriving, f"{root}/closed", f"{root}/checkpoint", 1, 0.5, "source", "line")
    try:
        wait_until_closed(query)
    finally:
        query.stop()
    return read_closed(spark, f"{root}/closed").groupBy("name").agg(
        F.sum("n_lines").alias("n_lines"), F.sum("n_chars").alias("n_chars"))


def q_stream_multi_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flow per language; a text in ten has no language, some lines end in a carriage return."""
    lang = F.when(F.col("doc_id") % 10 != 0, F.col("lang"))
    named = [name for name in MULTI_FLOWS if name != OTHER_FLOW]
    flow = F.when(lang.isin(named), lang).otherwise(F.lit(OTHER_FLOW))
    return _run_doc_flows(spark, sf_dir, flow, MULTI_FLOWS, F.when(F.col("doc_id") % 7 == 0, F.replace(
        F.col("text"), F.lit("\n"), F.lit("\r\n"))).otherwise(F.col("text")))


# ---------------------------------------------------------------- registry


def registry() -> dict[str, Query]:
    return {
        "entry_flagship": q_entry_flagship,
        "src_csv": q_src_csv,
        "src_parquet": q_src_parquet,
        "src_inline": q_src_inline,
        "sink_csv": q_sink_csv,
        "sink_parquet": q_sink_parquet,
        "monthly_pipeline": q_monthly_pipeline,
        "monthly_tables": q_monthly_tables,
        "catalog_partitions": q_catalog_partitions,
        "monthly_drift": q_monthly_drift,
        "monthly_changed": q_monthly_changed,
        "monthly_write": q_monthly_write,
        "rows_to_cells": q_rows_to_cells,
        "cells_scan_columns": q_cells_scan_columns,
        "cells_row_keys": q_cells_row_keys,
        "cells_row_count": q_cells_row_count,
        "cells_long": q_cells_long,
        "cells_to_rows": q_cells_to_rows,
        "prefix_filter": q_prefix_filter,
        "cells_prefix_filter": q_cells_prefix_filter,
        "cells_indexed_filter": q_cells_indexed_filter,
        "cells_upsert": q_cells_upsert,
        "cells_store_upsert": q_cells_store_upsert,
        "salt_key": q_salt_key,
        "salted_cells": q_salted_cells,
        "bulk_load": q_bulk_load,
        "cell_codec": q_cell_codec,
        "rename_cols": q_rename_cols,
        "drop_cols": q_drop_cols,
        "cast_schema": q_cast_schema,
        "select_rename": q_select_rename,
        "case_bucket": q_case_bucket,
        "null_rows": q_null_rows,
        "null_count": q_null_count,
        "clean_price": q_clean_price,
        "round_cols": q_round_cols,
        "safe_names": q_safe_names,
        "join_using_one": q_join_using_one,
        "join_using_list": q_join_using_list,
        "join_composite": q_join_composite,
        "join_mapped": q_join_mapped,
        "join_mapped_keep": q_join_mapped_keep,
        "join_select_rename": q_join_select_rename,
        "join_skew_split": q_join_skew_split,
        "join_skew_right": _skew_outer("right"),
        "join_skew_full": _skew_outer("full"),
        "join_inner": _join_how("inner"),
        "join_right": _join_how("right"),
        "join_full": _join_how("full"),
        "join_semi": _join_how("left_semi"),
        "join_anti": _join_how("left_anti"),
        "agg_flat": q_agg_flat,
        "agg_nested": q_agg_nested,
        "agg_global": q_agg_global,
        "distinct_values": q_distinct_values,
        "top_n": q_top_n,
        "data_profile": q_data_profile,
        "profile_merged": q_profile_merged,
        "schema_conformance": q_schema_conformance,
        "line_profile": q_line_profile,
        "line_chunk": q_line_chunk,
        "encoding_profile": q_encoding_profile,
        "charset_advice": q_charset_advice,
        "string_index": q_string_index,
        "string_index_fitted": q_string_index_fitted,
        "string_index_stream": q_string_index_stream,
        "one_hot": q_one_hot,
        "assemble": q_assemble,
        "stream_spool": q_stream_spool,
        "stream_charset": q_stream_charset,
        "stream_wide_charset": q_stream_wide_charset,
        "stream_line_chunk": q_stream_line_chunk,
        "stream_multi_flow": q_stream_multi_flow,
        "stream_idle_close": q_stream_idle_close,
    }
