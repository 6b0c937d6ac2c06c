"""Months whose columns differ: lattice of types, one projection each."""

import functools
import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.session import scratch_path
from tableflow.sources import common_type, conform, joined_schema, readin_monthly, schema_drift

KINDS = ["tinyint", "smallint", "int", "bigint", "decimal(5,2)", "decimal(38,0)", "decimal(38,30)", "float", "double", "string", "boolean", "date",
         "timestamp", "timestamp_ntz", "binary", "array<int>", "array<string>", "struct<a:int>", "struct<a:bigint,b:string>", "map<string,int>", "void"]


@functools.cache
def _type(text):
    return T.NullType() if text == "void" else T._parse_datatype_string(text)


@pytest.mark.parametrize("a,b,wanted", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"), ("bigint", "float", "double"),
    ("float", "double", "double"), ("int", "decimal(5,2)", "decimal(12,2)"), ("bigint", "decimal(38,30)", "double"),
    ("decimal(5,2)", "decimal(6,4)", "decimal(7,4)"), ("decimal(5,2)", "double", "double"), ("int", "string", "string"),
    ("boolean", "int", "string"), ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("timestamp", "timestamp_ntz", "string"), ("date", "int", "string"), ("void", "date", "date"), ("array<int>", "array<double>", "array<double>"),
    ("array<int>", "int", "string"), ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"),
    ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("binary", "string", "string")])
def test_common_types(spark, a, b, wanted):
    assert common_type(_type(a), _type(b)).simpleString() == wanted


def test_the_order_of_months_does_not_matter_and_a_type_is_its_own_upper_bound(spark):
    for a, b in itertools.product(KINDS, KINDS):
        assert common_type(_type(a), _type(b)).simpleString().split("<")[0] == common_type(_type(b), _type(a)).simpleString().split("<")[0]
        joined = common_type(_type(a), _type(b))
        assert common_type(joined, _type(a)) == joined and common_type(joined, joined) == joined
    for a, b, c in itertools.product(KINDS[:5] + KINDS[7:14], repeat=3):
        left = common_type(common_type(_type(a), _type(b)), _type(c)).simpleString()
        assert left in (common_type(_type(a), common_type(_type(b), _type(c))).simpleString(), "string", "double")


def test_months_with_added_dropped_and_widened_columns(spark):
    root = scratch_path(spark, "drift-t")
    tables = {
        "01": spark.createDataFrame([(1, 5, "a", (1,), [1])], "id int, n int, gone string, s struct<x:int>, l array<int>"),
        "02": spark.createDataFrame([(2 ** 40, 1.5, None, [2.5])], "ID bigint, n double, s struct<x:int>, l array<double>"),
        "03": spark.createDataFrame([(3, Decimal("7.25"), (2, "y"), "new", True)], "id int, n decimal(5,2), s struct<x:bigint,y:string>, `a.b` string, f boolean"),
        "04": spark.createDataFrame([(None, None, None, 9)], "id int, n int, `a.b` string, f int"),
    }
    for mm, t in tables.items():
        t.write.parquet(f"{root}/t_{mm}")
        t.write.parquet(f"{root}/h/month={mm}")
    with pytest.raises(Exception):
        readin_monthly(spark, root, "t", lambda m: m, 1, 4).collect()
    for table, layout in (("t", "suffix"), ("h", "hive")):
        out = readin_monthly(spark, root, table, lambda m: m, 1, 4, layout=layout, widen=True)
        kinds = dict(out.dtypes)
        assert kinds == {"id": "bigint", "n": "double", "gone": "string", "s": "struct<x:bigint,y:string>", "l": "array<double>", "a.b": "string",
                         "f": "string", "month": "string"}
        rows = {r.month: r for r in out.collect()}
        assert tuple(rows["01"])[:4] == (1, 5.0, "a", (1, None)) and rows["01"].l == [1.0] and rows["01"].f is None
        assert (rows["02"].id, rows["02"].n, rows["02"].s, rows["02"].gone) == (2 ** 40, 1.5, None, None)
        assert (rows["03"].n, tuple(rows["03"].s), rows["03"]["a.b"], rows["03"].f) == (7.25, (2, "y"), "new", "true")
        assert tuple(rows["04"])[:2] == (None, None) and rows["04"].f == "9"
    drift = {(r.column, r.label): (r.found_type, r.joined_type) for r in schema_drift(tables).collect()}
    assert drift["n", "03"] == ("decimal(5,2)", "double") and drift["gone", "02"] == (None, "string") and len(drift) == 7 * 4


def test_a_function_sees_the_joined_schema_and_files_of_a_month_may_differ(spark):
    root = scratch_path(spark, "drift-t")
    spark.createDataFrame([(1, 2)], "id int, n int").write.parquet(f"{root}/t_01")
    spark.createDataFrame([(2,)], "id int").write.parquet(f"{root}/t_02")
    spark.createDataFrame([(3, "x")], "id int, c string").write.mode("append").parquet(f"{root}/t_02")
    out = readin_monthly(spark, root, "t", lambda m: m.agg(F.sum("n").alias("n"), F.count("c").alias("c"), F.count("*").alias("rows")), 1, 2, widen=True)
    assert sorted(map(tuple, out.collect()), key=str) == [(2, 0, 1, "01"), (None, 1, 2, "02")]


def test_pruning_and_pushdown_stay(spark):
    root = scratch_path(spark, "drift-t")
    spark.range(10).selectExpr("id", "CAST(id AS int) AS n", "'x' AS wide").write.parquet(f"{root}/t_01")
    spark.range(10).selectExpr("id", "'y' AS wide").write.parquet(f"{root}/t_02")
    out = readin_monthly(spark, root, "t", lambda m: m, 1, 2, widen=True).where("id > 3").select("id", "n")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan.split("ReadSchema")[1].split("\n")[0] and "GreaterThan(id,3)" in plan


def test_nested_values_become_text_beside_text_and_names_must_be_single(spark):
    df = spark.createDataFrame([([1, 2], None), (None, (1,))], "v array<int>, s struct<x:int>")
    wanted = joined_schema([df.schema, T.StructType([T.StructField("v", T.StringType()), T.StructField("s", T.StringType())])])
    assert [tuple(r) for r in conform(df, wanted).collect()] == [("[1,2]", None), (None, '{"x":1}')]
    with pytest.raises(ValueError, match="twice"):
        joined_schema([T.StructType([T.StructField("a", T.LongType()), T.StructField("A", T.LongType())])])
