"""Values and shapes that a plain path loses: NULLs, line ends, hot keys, odd labels."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tableflow.functions.casting import safe_try_cast, try_text_to_timestamp
from tableflow.functions.hashing import digits_required, java_string_hash
from tableflow.operators import assemble, data_profile, one_hot, parse_amount, select_rename, string_index
from tableflow.operators.joins import hot_keys, split_skew_join
from tableflow.sinks import to_csv
from tableflow.sources import inline_table, read_csv, readin_monthly, split_by_month, write_monthly_tables
from tableflow.streaming import FlowSpec, read_flow_output, run_flows, write_spool


def test_inline_rows_follow_one_rule_whatever_their_number(spark):
    for n in (1, 10_001):
        with pytest.raises(Exception, match="FIELD_DATA_TYPE_UNACCEPTABLE"):
            inline_table(spark, [("5", "x")] * n, "a int, b string")
        t = inline_table(spark, [(5, "x"), (None, None)] * n, "a int, b string")
        assert t.count() == 2 * n and t.schema["a"].nullable
    assert inline_table(spark, [], "a int").count() == 0


def test_hot_keys_are_those_with_the_share(spark):
    even = spark.range(150).withColumnRenamed("id", "k")
    assert hot_keys(even, ["k"], 0.01) == []
    mixed = spark.range(1000).select(F.when(F.col("id") < 300, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    assert hot_keys(mixed, ["k"], 0.3) == [(-1,)] and hot_keys(mixed, ["k"], 0.301) == []
    assert hot_keys(mixed.limit(0), ["k"], 0.5) == []


def test_equal_rows_of_a_hot_key_use_all_buckets(spark):
    left = spark.range(4000).select(F.lit(7).alias("k"))
    right = spark.createDataFrame([(7, "seven"), (8, "eight")], "k int, name string")
    out = split_skew_join(left, right, "k", buckets=8)
    assert out.count() == 4000 and out.select("name").distinct().collect()[0][0] == "seven"
    placed = left.withColumn("b", F.pmod(F.monotonically_increasing_id(), F.lit(8)))
    assert placed.select("b").distinct().count() == 8


def test_skew_join_with_maps_nulls_and_cold_keys(spark):
    rows = [(1, {"a": k}) for k in range(40)] + [(None, {"b": 1})] * 40 + [(k, None) for k in range(2, 20)]
    left = spark.createDataFrame(rows, "k int, m map<string,int>")
    right = spark.createDataFrame([(k, str(k)) for k in range(0, 10)], "k int, name string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = split_skew_join(left, right, "k", how, buckets=4, min_share=0.2)
        want = left.join(right, "k", how)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_hot_has_one_rule_for_odd_indexes(spark):
    known = string_index(spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "c string"), "c", "i").select("i")
    for base in (known, spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "i double")):
        odd = base.select(F.when(F.col("i") != 1.0, F.col("i")).alias("i", metadata=base.schema["i"].metadata))
        for as_columns in (True, False):
            with pytest.raises(Exception, match="no category"):
                one_hot(odd, "i", "v", as_columns=as_columns).collect()
            kept = one_hot(odd, "i", "v", as_columns=as_columns, handle_invalid="keep", drop_last=False)
            for r in kept.collect():
                values = [r[f"v_{k}"] for k in range(4)] if as_columns else r.v.toArray().tolist()
                assert values == [float(k == (3 if r.i is None else r.i)) for k in range(4)]


def test_assemble_names_its_rule_for_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    with pytest.raises(Exception):
        assemble(df, ["a", "b"]).collect()
    assert assemble(df, ["a", "b"], handle_invalid="skip").count() == 1
    assert assemble(df, ["a", "b"], handle_invalid="keep").count() == 2


def test_large_label_tables_split_hot_labels(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("c"), "id")
    want = sorted(map(tuple, string_index(df, "c", "i").collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        got = string_index(df, "c", "i")
        assert got.columns == ["c", "id", "i"] and sorted(map(tuple, got.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_without_a_date_have_their_own_month(spark, tmp_path):
    df = spark.createDataFrame([(k, None if k % 2 else dt.date(2024, 1 + k, 1)) for k in range(10)], "k int, d date")
    split_by_month(df, "d", str(tmp_path), "t")
    back = readin_monthly(spark, str(tmp_path), "t", lambda x: x, layout="hive", undated=True)
    assert sorted((r.k, r.month) for r in back.collect()) == [(k, "00" if k % 2 else f"{1 + k:02d}") for k in range(10)]
    locs = write_monthly_tables(spark, str(tmp_path), "t", lambda x: x, str(tmp_path / "out"), "o", layout="hive", undated=True)
    assert [os.path.basename(x) for x in locs] == ["o_00", *[f"o_{m:02d}" for m in range(1, 13)]]
    assert spark.read.parquet(locs[0]).count() == 5


TEXTS = ["a", "", None, 'q"uo"te', "com,ma", "back\\slash", " blanks ", "'", "\\", "ü\tb"]


def test_csv_gives_values_back(spark, tmp_path):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k int, t string")
    back = read_csv(spark, to_csv(df, str(tmp_path / "a")), schema="k int, t string")
    assert {r.k: r.t for r in back.collect()} == dict(enumerate(TEXTS))
    broken = spark.createDataFrame([(1, "a\nb"), (2, "c\r\nd"), (3, "e\rf")], "k int, t string")
    with pytest.raises(Exception, match="line break in column t"):
        to_csv(broken, str(tmp_path / "b"))
    loc = to_csv(broken, str(tmp_path / "c"), multi_line=True)
    back = read_csv(spark, loc, schema="k int, t string", multiLine=True)
    assert {r.k: r.t for r in back.collect()} == {1: "a\nb", 2: "c\r\nd", 3: "e\rf"}


def test_carriage_returns_pass_a_flow(spark, tmp_path):
    docs = spark.createDataFrame([("f", "a\rb\nc\r\nd")], "flow string, text string")
    write_spool(docs, str(tmp_path / "spool"), "flow")
    spec = FlowSpec(str(tmp_path / "spool" / "flow=f"), str(tmp_path / "sink"))
    run_flows(spark, {"f": spec})
    out = read_flow_output(spark, spec).collect()
    assert sorted(r.value for r in out) == ["a\rb", "c\r", "d"]
    files = {n for n in os.listdir(tmp_path / "spool" / "flow=f") if n.startswith("part")}
    assert {r.basename for r in out} <= files


@pytest.mark.parametrize("charset", ["utf-16", "utf_32", "UTF16", "UCS-2", "x-UTF-16LE-BOM"])
def test_wide_charsets_without_a_byte_order_are_refused(charset):
    with pytest.raises(ValueError, match="byte order"):
        FlowSpec("a", "b", charset=charset)


def test_a_failing_flow_stops_the_others(spark, tmp_path):
    docs = spark.createDataFrame([("good", "x"), ("bad", "é")], "flow string, text string")
    write_spool(docs, str(tmp_path / "spool"), "flow", charset="windows-1252")
    spec = {n: FlowSpec(str(tmp_path / "spool" / f"flow={n}"), str(tmp_path / n)) for n in ("bad", "good")}
    endless = FlowSpec(str(tmp_path / "spool" / "flow=good"), str(tmp_path / "endless"), available_now=False, interval_seconds=1)
    with pytest.raises(RuntimeError, match="flow bad failed"):
        run_flows(spark, {"bad": spec["bad"], "good": spec["good"], "endless": endless})
    assert not spark.streams.active
    assert [r.value for r in read_flow_output(spark, spec["good"]).collect()] == ["x"]


def test_structs_are_told_apart_to_the_microsecond(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    df = spark.createDataFrame([((t,),), ((t + dt.timedelta(microseconds=1),),), ((t,),), (None,)], "s struct<t:timestamp_ntz>")
    assert data_profile(df).collect()[0].distinct_count == 3
    df = df.select(F.struct(F.col("s.t").cast("timestamp").alias("t")).alias("s"))
    assert data_profile(df).collect()[0].distinct_count == 3


def _java_hash(s):
    h = 0
    data = s.encode("utf-16-be")
    for k in range(0, len(data), 2):
        h = (h * 31 + data[k] * 256 + data[k + 1]) % (1 << 32)
    return h - (1 << 32) if h >= 1 << 31 else h


def test_salt_hash_follows_utf16_units(spark):
    keys = ["", "1", "abc", "ü", "😀", "a😀b", "polygenelubricants", "\U0010ffff", "x" * 300, "日本"]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k string")
    got = {r.k: r.h for r in df.select("k", java_string_hash("k").alias("h")).collect()}
    assert got == {**{k: _java_hash(k) for k in keys}, None: None}
    assert [digits_required(n) for n in (2, 10, 11, 100, 101)] == [1, 1, 2, 2, 3]


def test_select_rename_takes_one_name_as_text(spark):
    df = spark.createDataFrame([(1, 2, 3)], "c_name int, b int, c int")
    assert df.select(*select_rename("c_name", {"b": "B"})).columns == ["B", "c_name"]
    assert df.select(*select_rename("*", {"b": "B"})).columns == ["B"]
    assert df.select(*select_rename(["c", "b"], {"b": "B"})).columns == ["B", "c"]
    assert df.select(*select_rename("b")).columns == ["b"] and df.select(*select_rename()).columns == df.columns


CASTS = [("12.7", 12), ("-12.7", -12), ("+5", 5), (".5", 0), ("-.5", 0), ("7.", 7), (" 8 ", 8), ("99999999999", None), ("1e3", None),
         ("1.2.3", None), ("", None), (".", None), ("x", None), ("1 2", None), (None, None), ("265000.50", 265000)]


def test_text_to_integers_keeps_the_whole_part(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(CASTS)], "k int, t string")
    got = {r.k: r.v for r in df.select("k", safe_try_cast(F.col("t"), "int", "string").alias("v")).collect()}
    assert got == {k: v for k, (_, v) in enumerate(CASTS)}
    amount = parse_amount(spark.createDataFrame([("RM 265,000.50",), ("RM 7",), ("EUR 5",)], "p string"), "p", "n")
    assert [r.n for r in amount.collect()] == [265000, 7, None]


DATES = [("05/01/2020", dt.datetime(2020, 1, 5)), ("5/1/2020", dt.datetime(2020, 1, 5)), ("05/01/2020 10:00", dt.datetime(2020, 1, 5)),
         ("31/02/2020", None), ("5.1.2020", None), ("5/1/20", None), ("", None), (None, None), ("5/13/2020", None)]


def test_dates_with_fewer_digits_or_text_after_them(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(DATES)], "k int, t string")
    got = {r.k: r.v for r in df.select("k", try_text_to_timestamp(F.col("t"), "dd/MM/yyyy").alias("v")).collect()}
    assert got == {k: v for k, (_, v) in enumerate(DATES)}
    named = spark.createDataFrame([("05 Jan 2020",), ("5 Jan 2020",)], "t string")
    assert [r.v for r in named.select(try_text_to_timestamp(F.col("t"), "dd MMM yyyy").alias("v")).collect()] == [dt.datetime(2020, 1, 5), None]


@pytest.mark.parametrize("target,bits", [("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64)])
def test_casts_at_the_bounds_of_a_type(spark, target, bits):
    top = 1 << (bits - 1)
    near = [top - 1, top, -top, -top - 1, 0, top - 2, 10 * top, -10 * top]
    texts = [str(x) for x in near] + [f"+{top - 1}", f"000{top - 1}", f"{top - 1}.9", f"-000{top}", f"{top}.0", "9" * 40, "-0"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = {r.k: r.v for r in df.select("k", safe_try_cast(F.col("t"), target, "string").alias("v")).collect()}
    for k, t in enumerate(texts):
        value = int(t.split(".")[0])
        assert got[k] == (value if -top <= value < top else None), t


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(20,2)"])
def test_numbers_out_of_bounds_are_null_and_others_as_cast(spark, kind):
    values = ["2147483647", "2147483648", "-2147483648", "-2147483649", "0", "7", "9000000000"] + ([] if kind == "bigint" else ["2147483647.5", "-2147483648.5", "1.9"])
    df = spark.createDataFrame([(v,) for v in values], "t string").select(F.col("t").cast(kind).alias("x"))
    df = df.union(spark.createDataFrame([(None,)], "t string").select(F.col("t").cast(kind)))
    rows = df.select(safe_try_cast(F.col("x"), "int", df.dtypes[0][1]).alias("a"), F.col("x").try_cast("int").alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]
    if kind == "double":
        odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (-float("inf"),)], "x double")
        assert [r.v for r in odd.select(safe_try_cast(F.col("x"), "int", "double").alias("v")).collect()] == [None] * 3


def test_dates_of_the_exact_pattern_and_loose_ones(spark):
    texts = {"05/01/2020": "2020-01-05", "5/1/2020": "2020-01-05", "05/01/2020 10:00": "2020-01-05", " 05/01/2020": "2020-01-05",
             "31/02/2020": None, "05-01-2020": None, "05/01/20": None, "x": None, "": None, "2020-01-05": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.d for r in df.select("t", try_text_to_timestamp(F.col("t"), "dd/MM/yyyy").cast("date").cast("string").alias("d")).collect()}
    assert got == texts
