"""Only changed months are computed again."""

from pyspark.sql import functions as F

from tableflow.session import scratch_path
from tableflow.sources import fingerprint, write_changed_months

SCHEMA = "id long, s string, m map<string,int>, a array<double>"
ROWS = [(1, "a", {"x": 1}, [1.0]), (2, None, None, None), (2, None, None, None), (None, "", {}, [])]


def _print(df, version=""):
    return tuple(fingerprint(df, version).first())


def test_a_fingerprint_is_of_the_rows_not_of_their_order(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert _print(df) == _print(df.repartition(7)) == _print(df.orderBy(F.desc("id")))
    others = [ROWS[:3], ROWS + ROWS[:1], ROWS + ROWS[1:3], [(1, "a", {"x": 2}, [1.0]), *ROWS[1:]], [(1, "", None, [1.0]), *ROWS[1:]], []]
    prints = {_print(spark.createDataFrame(r, SCHEMA)) for r in others} | {_print(df), _print(df, "v2"), _print(df.drop("a"))}
    assert len(prints) == len(others) + 3
    assert _print(spark.createDataFrame([], SCHEMA))[:3] == (0, 0, 0)
    # NULL moves between columns, and equal rows in pairs, are seen
    pair = "a long, b long"
    assert _print(spark.createDataFrame([(1, None)], pair)) != _print(spark.createDataFrame([(None, 1)], pair))
    assert _print(spark.createDataFrame([(1, 1), (1, 1)], pair)) != _print(spark.createDataFrame([(2, 2), (2, 2)], pair))


def test_one_changed_row_runs_one_month(spark):
    root = scratch_path(spark, "changes-t")
    for mm in ("01", "02", "03"):
        spark.range(50).selectExpr("id", f"'{mm}' AS v").write.parquet(f"{root}/t_{mm}")
    ran = []

    def fn(month):
        ran.append(month)
        return month.groupBy("v").agg(F.sum("id").alias("total of ids"))

    def run(**options):
        ran.clear()
        got = write_changed_months(spark, root, "t", fn, f"{root}/out", "r", 1, 3, **options)
        assert len(ran) == sum(got.values())
        return [mm for mm, done in got.items() if done]

    assert run() == ["01", "02", "03"] and run() == []
    spark.range(50).selectExpr("id + IF(id = 7, 1, 0) AS id", "'02' AS v").write.mode("overwrite").parquet(f"{root}/t_02")
    assert run() == ["02"]
    assert spark.read.parquet(f"{root}/out/r_02").first()[1] == sum(range(50)) + 1
    # the same rows in other files are no change; another function is, and so is another column
    spark.range(50).selectExpr("id", "'03' AS v").repartition(5).write.mode("overwrite").parquet(f"{root}/t_03")
    assert run() == []
    assert run(version="2") == ["01", "02", "03"] and run(version="2") == []
    spark.range(50).selectExpr("CAST(id AS int) AS id", "'01' AS v").write.mode("overwrite").parquet(f"{root}/t_01")
    assert run(version="2") == ["01"]


def test_a_run_that_failed_does_the_month_again(spark):
    root = scratch_path(spark, "changes-t")
    spark.range(5).write.parquet(f"{root}/t_01")
    try:
        write_changed_months(spark, root, "t", lambda m: m.select(F.raise_error(F.lit("stop"))), f"{root}/out", "r", 1, 1)
    except Exception:
        pass
    assert write_changed_months(spark, root, "t", lambda m: m, f"{root}/out", "r", 1, 1) == {"01": True}
    assert spark.read.parquet(f"{root}/out/r_01").count() == 5
