import os

import pytest
from pyspark.sql import functions as F

from tableflow.sinks import create_table_if_missing, insert_partitions, to_csv, to_jdbc, to_parquet
from tableflow.sources import (
    inline_table, read_csv, read_jdbc, read_monthly_output, read_parquet, readin_monthly, write_monthly,
)
from tableflow.session import scratch_path


def test_csv_round_trip_all_text(spark, person):
    root = scratch_path(spark, "csv-t") + "/"
    to_csv(person, root, "person")
    back = read_csv(spark, root, "person")
    assert back.dtypes == [(c, "string") for c in person.columns]
    assert sorted(r.name for r in back.collect()) == ["Lin", "Noor", "Oskar", "Teo"]
    typed = read_csv(spark, root, "person", infer_schema=True)
    assert dict(typed.dtypes)["age"] == "int"


def test_parquet_round_trip(spark, person):
    root = scratch_path(spark, "pq-t") + "/"
    to_parquet(person, root, "person")
    assert sorted(map(tuple, read_parquet(spark, root, "person").collect())) == sorted(map(tuple, person.collect()))


def test_inline_table(spark):
    df = inline_table(spark, [("Low", "x")], "prize_range string, category string")
    assert df.first().prize_range == "Low"


def test_jdbc_round_trip_in_process_derby(spark, person):
    # Derby in-memory DB lives inside this JVM only: local-mode check of the sink
    url = "jdbc:derby:memory:tableflow_t;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    to_jdbc(person, url, "PERSON", mode="overwrite", properties=props)
    to_jdbc(person, url, "PERSON", mode="append", properties=props)
    back = read_jdbc(spark, url, "PERSON", properties=props)
    assert back.count() == 8
    part = read_jdbc(spark, url, "PERSON", properties=props, partition_column="KEY",
                     lower_bound=1, upper_bound=5, num_partitions=2)
    assert part.rdd.getNumPartitions() == 2 and part.count() == 8


def test_monthly_reads_only_requested_months(spark):
    # N7: t_01..t_04, months 2..3
    root = scratch_path(spark, "monthly-t")
    for m in range(1, 5):
        spark.range(m * 10).select(F.col("id"), (F.col("id") * 1.5).alias("v")).write.parquet(
            os.path.join(root, f"t_{m:02d}"))
    seen = []

    def fn(df):
        seen.append(1)
        return df.agg(F.count("*").alias("n"), F.sum("v").alias("s"))

    out = readin_monthly(spark, root, "t", fn, 2, 3)
    got = sorted((r.month, r.n) for r in out.collect())
    assert got == [("02", 20), ("03", 30)] and len(seen) == 2
    paths = " ".join(out.inputFiles())
    assert "t_02" in paths and "t_03" in paths and "t_01" not in paths and "t_04" not in paths


def test_monthly_write_dynamic_overwrite(spark):
    out = scratch_path(spark, "monthly-w")
    df = spark.createDataFrame([(1, "01"), (2, "02")], "id int, month string")
    write_monthly(df, out)
    write_monthly(spark.createDataFrame([(3, "02")], "id int, month string"), out)
    got = sorted((r.id, r.month) for r in read_monthly_output(spark, out).collect())
    assert got == [(1, "01"), (3, "02")]


def test_catalog_table(spark, person):
    path = scratch_path(spark, "tbl")
    person.write.parquet(path)
    assert create_table_if_missing(spark, "person_t", "key INT, name STRING, age INT, gender STRING, occupation STRING", path)
    assert not create_table_if_missing(spark, "person_t", "key INT", path)
    assert spark.table("person_t").count() == 4


def test_postgres_url_and_quoting():
    from tableflow.sinks import postgres_url, quote_ident

    assert postgres_url("db.example:5432", "sales") == "jdbc:postgresql://db.example:5432/sales"
    assert quote_ident("db.my table") == "`db`.`my table`"


def test_monthly_hive_layout_prunes(spark):
    from tableflow.sources import split_by_month

    root = scratch_path(spark, "monthly-h")
    df = spark.createDataFrame(
        [(1, "2020-01-05 00:00:00"), (2, "2020-02-05 00:00:00"), (3, "2020-02-07 00:00:00"), (4, "2020-11-01 00:00:00")],
        "id int, d string").withColumn("d", F.col("d").cast("timestamp_ntz"))
    split_by_month(df, "d", root, "t")
    out = readin_monthly(spark, root, "t", lambda m: m.agg(F.count("*").alias("n")), 2, 11, layout="hive")
    got = sorted((r.month, r.n) for r in out.collect() if r.n)
    assert got == [("02", 2), ("11", 1)]
    feb = readin_monthly(spark, root, "t", lambda m: m.select("id"), 2, 2, layout="hive")
    plan = feb._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "= 02)" in plan


def test_write_monthly_tables_named_per_month(spark):
    from tableflow.sources import write_monthly_tables

    root = scratch_path(spark, "monthly-in")
    for m in range(1, 4):
        spark.range(m * 5).select(F.col("id"), (F.col("id") * 2.0).alias("v")).write.parquet(os.path.join(root, f"t_{m:02d}"))
    out = scratch_path(spark, "monthly-named")
    locs = write_monthly_tables(spark, root, "t", lambda d: d.agg(F.count("*").alias("n")), out, "t_summary", 2, 3)
    assert [os.path.basename(p) for p in locs] == ["t_summary_02", "t_summary_03"]
    assert [spark.read.parquet(p).first().n for p in locs] == [10, 15]


def test_partitioned_sinks_and_typed_csv(spark, person):
    root = scratch_path(spark, "sinks-part") + "/"
    to_parquet(person, root, "by_gender", partition_by=["gender"])
    back = read_parquet(spark, root, "by_gender")
    assert sorted(r.gender for r in back.select("gender").distinct().collect()) == ["f", "m"]
    to_csv(person, root, "semi", sep=";", partition_by=["gender"])
    typed = read_csv(spark, root, "semi", sep=";", schema="key int, name string, age int, occupation string, gender string")
    assert typed.filter("gender = 'm'").count() == 2 and dict(typed.dtypes)["age"] == "int"


def test_partitions_of_a_catalog_table_are_replaced_one_by_one(spark):
    path = scratch_path(spark, "partitioned")
    name = "parts_" + path[-12:]
    rows = [("01", 1, "a"), ("02", 2, "b"), (None, 3, "c")]
    assert insert_partitions(spark.createDataFrame(rows, "month string, `k k` int, v string"), name, path, ["month"]) == ["k k", "v", "month"]
    insert_partitions(spark.createDataFrame([("x", 9, "02"), ("y", 8, "05")], "v string, `k k` int, month string"), name, path, ["month"])
    insert_partitions(spark.createDataFrame([], "v string, `k k` int, month string"), name, path, ["month"])
    assert sorted(map(tuple, spark.table(name).collect()), key=str) == [(1, "a", "01"), (3, "c", None), (8, "y", "05"), (9, "x", "02")]
    # the setting of the session does not matter, and partitions are pruned through the catalog
    plan = spark.table(name).where("month = '02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    for bad in ("v string, month string", "v string, `k k` int, month string, more int"):
        with pytest.raises(ValueError, match="are not those"):
            insert_partitions(spark.createDataFrame([], bad), name, path, ["month"])
    with pytest.raises(ValueError, match="must be some"):
        insert_partitions(spark.createDataFrame([], "a int"), name, path, ["month"])
