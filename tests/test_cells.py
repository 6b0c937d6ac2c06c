import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableflow.functions import bytes4_to_int, digits_required, int_to_bytes4, java_string_hash, salted_key
from tableflow.operators import (
    cells_prefix_filter, cells_to_rows, indexed_prefix_filter, key_ranges, prefix_filter, read_bulk, row_keys, rows_to_cells, salt_cells,
    scan_columns, upsert_cells, write_bulk, write_indexed_cells,
)
from tableflow.operators.cells import create_cell_table
from tableflow.session import scratch_path


def _jhash(s: str) -> int:
    h = 0
    for ch in s:
        h = (31 * h + ord(ch)) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def test_java_hash_matches_jvm_rule(spark):
    words = ["1", "2", "Customer#000000001", "polygenelubricants", "", "héllo"]
    df = spark.createDataFrame([(w,) for w in words], "k string")
    got = [r.h for r in df.select(java_string_hash("k").alias("h")).collect()]
    assert got == [_jhash(w) for w in words]
    # UTF-16 rule: a supplementary character counts as two code units
    sup = spark.createDataFrame([("a\U0001F600",), (None,)], "k string").select(java_string_hash("k").alias("h"))
    units = "a\U0001F600".encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (31 * h + int.from_bytes(units[i:i + 2], "big")) & 0xFFFFFFFF
    assert [r.h for r in sup.collect()] == [h - (1 << 32) if h >= (1 << 31) else h, None]
    assert got[3] == -2147483648
    # abs in bigint: Int.MinValue does not stay negative
    salted = df.select(salted_key("k", 10).alias("s")).collect()[3].s
    assert salted.startswith("8:")
    assert digits_required(2) == 1 and digits_required(16) == 2 and digits_required(101) == 3


def test_salted_cells_golden(spark, person):
    # X2: 2 salts, key kept as a cell, sorted layout
    cells = rows_to_cells(person, "key", key_as_cell=True, drop_empty=True)
    salted = salt_cells(cells, 2)
    got = sorted((r.salted, r.qualifier, r.value, r.salt) for r in salted.collect())
    assert len(got) == 20
    assert sorted({g[0] for g in got}) == ["0:2", "0:4", "1:1", "1:3"]
    assert ("1:1", "age", "51", "1") in got and ("0:4", "occupation", "farmer", "0") in got


def test_bulk_round_trip(spark, person):
    salted = salt_cells(rows_to_cells(person, "key", key_as_cell=True), 2)
    path = scratch_path(spark, "bulk-test")
    write_bulk(salted, path, num_files=2)
    back = read_bulk(spark, path)
    assert back.schema["salt"].dataType.simpleString() == "string"
    assert sorted(map(tuple, back.select(*salted.columns).collect())) == sorted(map(tuple, salted.collect()))
    # each written file is sorted on its key range
    parts = back.select("salted", "qualifier", "value", F.input_file_name().alias("f")).collect()
    files = {}
    for r in parts:
        files.setdefault(r.f, []).append((r.salted, r.qualifier, r.value))
    for rows in files.values():
        assert rows == sorted(rows)


def test_put_cells_scan_and_typed_read(spark, person):
    cells = rows_to_cells(person, "key", value_format="bytes")  # Put job: key not a cell
    assert row_keys(cells).count() == 4
    assert scan_columns(cells, ["name", "occupation"]).count() == 8
    wide = cells_to_rows(cells, {"name": "utf8", "occupation": "utf8", "age": "int4"}, key_name="key")
    got = sorted(tuple(r) for r in wide.collect())
    assert got[0] == ("1", "Oskar", "baker", 51)


def test_prefix_filter_wide_and_cells(spark, person):
    # names that start with a prefix
    wide = prefix_filter(person, "name", "Os").select("name", "occupation", "age")
    assert [tuple(r) for r in wide.collect()] == [("Oskar", "baker", 51)]
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "StartsWith" in plan
    cells = rows_to_cells(person, "key")
    kept = cells_prefix_filter(cells, "name", "Os")
    assert {r.rowkey for r in kept.collect()} == {"1"}
    no_name = rows_to_cells(person.withColumn("name", F.when(F.col("key") == 2, None).otherwise(F.col("name"))), "key")
    assert {r.rowkey for r in cells_prefix_filter(no_name, "name", "Os", keep_missing=True).collect()} == {"1", "2"}
    assert {r.rowkey for r in cells_prefix_filter(no_name, "name", "Os").collect()} == {"1"}


def test_upsert_last_write_wins(spark):
    # N4
    base = spark.createDataFrame(
        [("r1", "cf", "a", "old", 1), ("r1", "cf", "b", "keep", 1), ("r2", "cf", "a", "", 1)],
        "rowkey string, family string, qualifier string, value string, seq bigint",
    )
    upd = spark.createDataFrame(
        [("r1", "cf", "a", "new", 2), ("r1", "cf", "a", "newer", 3), ("r2", "cf", "a", None, 4)],
        "rowkey string, family string, qualifier string, value string, seq bigint",
    )
    got = {(r.rowkey, r.qualifier): r.value for r in upsert_cells(base, upd, ["seq"]).collect()}
    assert got == {("r1", "a"): "newer", ("r1", "b"): "keep", ("r2", "a"): ""}


def test_int_codec(spark):
    # N5
    vals = [0, 32, -32, 2147483647, -2147483648]
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    out = df.select(F.hex(int_to_bytes4("x")).alias("h"), bytes4_to_int(int_to_bytes4("x")).alias("b")).collect()
    assert [r.h for r in out] == ["00000000", "00000020", "FFFFFFE0", "7FFFFFFF", "80000000"]
    assert [r.b for r in out] == vals


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.text(min_size=0, max_size=8), st.integers(-2**31, 2**31 - 1)),
                min_size=1, max_size=12, unique_by=lambda t: t[0]))
def test_cells_round_trip_property(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string, n int")
    cells = rows_to_cells(df, "k", ["s", "n"], value_format="bytes")
    back = cells_to_rows(cells, {"s": "utf8", "n": "int4"}, key_name="k").select(F.col("k").cast("int"), "s", "n")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_create_table_if_missing(spark):
    path = scratch_path(spark, "cell-table")
    assert create_cell_table(spark, "cells_t1", path) is True
    assert create_cell_table(spark, "cells_t1", path) is False


def test_cell_store_append_resolve_compact(spark):
    from tableflow.operators import append_cell_writes, compact_cells, read_latest_cells

    schema = "rowkey string, family string, qualifier string, value string, seq bigint"
    store = scratch_path(spark, "cell-store")
    append_cell_writes(spark.createDataFrame(
        [("r1", "cf", "a", "v1", 1), ("r1", "cf", "b", "b1", 1)], schema), store, ["seq"])
    append_cell_writes(spark.createDataFrame(
        [("r1", "cf", "a", "v2", 2), ("r2", "cf", "a", "x", 2)], schema), store, ["seq"])
    got = {(r.rowkey, r.qualifier): r.value for r in read_latest_cells(spark, store, ["seq"]).collect()}
    assert got == {("r1", "a"): "v2", ("r1", "b"): "b1", ("r2", "a"): "x"}
    new = compact_cells(spark, store, scratch_path(spark, "cell-store-v2"), ["seq"])
    compacted = {(r.rowkey, r.qualifier): (r.value, r.seq) for r in spark.read.parquet(new).collect()}
    assert compacted[("r1", "a")] == ("v2", 2) and len(compacted) == 3
    import pytest
    with pytest.raises(ValueError):
        compact_cells(spark, store, store, ["seq"])


def test_salt_of(spark, person):
    from tableflow.operators.cells import salt_of

    salted = salt_cells(rows_to_cells(person, "key"), 2)
    assert all(r.a == r.b for r in salted.select(salt_of("salted").alias("a"), F.col("salt").alias("b")).collect())


def test_null_and_empty_cells(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y")], "k int, a string, b string")
    put = {(r.rowkey, r.qualifier): r.value for r in rows_to_cells(df, "k").collect()}
    assert put == {("1", "b"): "x", ("2", "a"): "", ("2", "b"): "y"}
    bulk = {(r.rowkey, r.qualifier) for r in rows_to_cells(df, "k", drop_empty=True, key_as_cell=True).collect()}
    assert bulk == {("1", "k"), ("1", "b"), ("2", "k"), ("2", "b")}


def test_bulk_hash_ordering(spark, person):
    salted = salt_cells(rows_to_cells(person, "key", key_as_cell=True), 2)
    path = scratch_path(spark, "bulk-hash")
    write_bulk(salted, path, num_files=3, ordering="hash")
    back = read_bulk(spark, path)
    assert sorted(map(tuple, back.select(*salted.columns).collect())) == sorted(map(tuple, salted.collect()))
    rows = back.select("salted", "qualifier", "value", F.input_file_name().alias("f")).collect()
    files = {}
    for r in rows:
        files.setdefault(r.f, []).append((r.salted, r.qualifier, r.value))
    assert all(v == sorted(v) for v in files.values())
    # all cells of one row key sit in one file
    owner = {}
    for f, v in files.items():
        for salted_key, _, _ in v:
            owner.setdefault(salted_key, set()).add(f)
    assert all(len(fs) == 1 for fs in owner.values())


def _scanned(df):
    """Rows that the scan of a plan without a shuffle gave to its filter."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_an_index_of_values_gives_row_key_ranges_that_are_pushed_down(spark):
    rows = [(f"k{i:05d}", f"{'red' if 700 <= i < 720 else 'blue'} {i}", str(i % 7)) for i in range(4000)]
    cells = rows_to_cells(spark.createDataFrame(rows, "key string, colour string, size string"), "key")
    path = scratch_path(spark, "indexed")
    write_indexed_cells(cells, path, num_files=20)
    got = indexed_prefix_filter(spark, path, "colour", "red")
    want = cells_prefix_filter(cells, "colour", "red")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect())) and want.count() == 40
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rowkey,k007" in plan and "LessThanOrEqual(rowkey,k007" in plan
    found = spark.read.parquet(f"{path}/index").where("qualifier = 'colour' AND value LIKE 'red%'")
    (low, high), = key_ranges(found, 1)
    assert 40 <= _scanned(spark.read.parquet(f"{path}/cells").where(F.col("rowkey").between(low, high))) < cells.count() / 4
    assert indexed_prefix_filter(spark, path, "colour", "green").count() == 0
    assert indexed_prefix_filter(spark, path, "absent", "red").count() == 0


def test_key_ranges_cover_all_keys_and_are_few(spark):
    rng = random.Random(1)
    for keys in (["a"], ["", "b", "ba"], [f"{rng.randint(0, 10 ** 9)}" for _ in range(3000)], ["same" * 10] * 50, [f"p{'x' * 40}{k}" for k in range(200)]):
        ranges = key_ranges(spark.createDataFrame([(k,) for k in keys], "rowkey string"), 16)
        assert 1 <= len(ranges) <= 16 and all(any(a <= k <= b for a, b in ranges) for k in keys)
        assert all(low[1] < high[0] for low, high in zip(ranges, ranges[1:]))
    assert key_ranges(spark.createDataFrame([], "rowkey string")) == []
