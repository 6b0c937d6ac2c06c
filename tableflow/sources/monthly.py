"""Monthly batches: tables ``<table>_01 .. _12`` (or ``month=MM`` partitions),
a user function applied to each month on its own, one output per month.

Each month is read once (a separate path, or partition pruning on a
``month`` partition column), so no month is scanned twice, and the per-month
results are planned as one union and written with dynamic partition
overwrite in one job.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.operators.columns import safe_names
from tableflow.sources.drift import conform_all

MonthFn = Callable[[DataFrame], DataFrame]


#: Label of rows without a date.
UNDATED = "00"


def month_labels(start_month: int = 1, end_month: int = 12, undated: bool = False) -> list[str]:
    """``01`` .. ``12``; ``undated`` puts the label of rows without a date first."""
    if not 1 <= start_month <= end_month <= 12:
        raise ValueError("months must satisfy 1 <= start <= end <= 12")
    return [UNDATED] * undated + [f"{m:02d}" for m in range(start_month, end_month + 1)]


def month_reader(spark: SparkSession, path: str, table: str, layout: str = "suffix") -> Callable[[str], DataFrame]:
    """Month label to its rows: ``<path>/<table>_MM`` (suffix) or ``<path>/<table>/month=MM`` (hive).

    A ``hive`` table is listed once; each month is a filter on the partition
    column, which prunes every other month's files.
    """
    if layout == "suffix":
        return lambda mm: spark.read.parquet(os.path.join(path, f"{table}_{mm}"))
    if layout == "hive":
        whole = spark.read.parquet(os.path.join(path, table))
        label = F.lpad(F.col("month").cast("string"), 2, "0")
        return lambda mm: whole.filter(label == mm).drop("month")
    raise ValueError("layout must be 'suffix' or 'hive'")


def months_with_own_schemas(spark: SparkSession, path: str, table: str, months: Sequence[str],
                            layout: str = "suffix") -> dict[str, DataFrame]:
    """The months, each read by the schema of its own files and conformed to the one that joins them all."""
    if layout not in ("suffix", "hive"):
        raise ValueError("layout must be 'suffix' or 'hive'")
    where = (lambda mm: f"{table}_{mm}") if layout == "suffix" else (lambda mm: os.path.join(table, f"month={mm}"))
    # files of one month may differ too: their schemas are merged by the reader
    return conform_all({mm: spark.read.option("mergeSchema", "true").parquet(os.path.join(path, where(mm))) for mm in months})


def readin_monthly(
    spark: SparkSession,
    path: str,
    table: str,
    fn: MonthFn,
    start_month: int = 1,
    end_month: int = 12,
    layout: str = "suffix",
    undated: bool = False,
    widen: bool = False,
) -> DataFrame:
    """Apply ``fn`` to each month's table separately; union with a ``month`` column.

    ``undated`` also takes the rows without a date, under the label ``00``.  With
    ``widen`` the months may differ in their columns and types: ``fn`` gets every
    month with the schema that joins theirs (see ``drift``); without, a difference
    is an error.
    """
    months = month_labels(start_month, end_month, undated)
    if widen:
        tables = months_with_own_schemas(spark, path, table, months, layout)
    else:
        month_source = month_reader(spark, path, table, layout)
        tables = {mm: month_source(mm) for mm in months}
    parts = []
    for mm in months:
        parts.append(safe_names(tables[mm].transform(fn)).withColumn("month", F.lit(mm)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_monthly_tables(
    spark: SparkSession,
    path: str,
    table: str,
    fn: MonthFn,
    output_dir: str,
    table_name: str,
    start_month: int = 1,
    end_month: int = 12,
    layout: str = "suffix",
    mode: str = "overwrite",
    concurrent_jobs: int = 4,
    undated: bool = False,
) -> list[str]:
    """Per month: read, apply ``fn``, write ``<output_dir>/<table_name>_MM``.

    Output named per month like the input.  Each write is its own job and
    computes only its month (the months together are one pass over the
    input); up to ``concurrent_jobs`` month jobs are submitted at once, so
    small months do not leave the cluster idle.  The input is listed once.
    Returns the written locations in month order (``undated``: ``00`` first).
    """
    month_source = month_reader(spark, path, table, layout)

    def one(mm: str) -> str:
        loc = os.path.join(output_dir, f"{table_name}_{mm}")
        safe_names(month_source(mm).transform(fn)).write.mode(mode).parquet(loc)
        return loc

    months = month_labels(start_month, end_month, undated)
    with ThreadPoolExecutor(max_workers=max(1, concurrent_jobs)) as pool:
        return list(pool.map(one, months))


def write_monthly(df: DataFrame, output_dir: str, month_col: str = "month", mode: str = "overwrite") -> None:
    """One dataset per month under ``month=MM``; only months present are replaced.

    No shuffle by month: every task writes its own rows into the month
    directories they belong to, so a month with most of the data is still
    written by all tasks in parallel.
    """
    (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(month_col)
        .parquet(output_dir)
    )


def read_monthly_output(spark: SparkSession, output_dir: str) -> DataFrame:
    """Read a monthly output back with ``month`` as zero-padded text."""
    df = spark.read.parquet(output_dir)
    return df.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))


def split_by_month(df: DataFrame, date_col: str, output_dir: str, table: str) -> str:
    """Lay a table out as ``<output_dir>/<table>/month=MM`` in one job; rows without a date under ``00``."""
    base = os.path.join(output_dir, table)
    month = F.coalesce(F.date_format(F.col(date_col), "MM"), F.lit(UNDATED))
    write_monthly(df.withColumn("month", month), base)
    return base
