"""Monthly outputs that are computed again only where a month's input has changed.

A month's fingerprint is a number of rows, a sum and an exclusive or of row hashes:
the same for the same rows in any order and any files, repeats counted.  It is stored
beside the month's output once that is written, so a run that stops in between does
the month again.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.operators.columns import _q, safe_names
from tableflow.sources.monthly import MonthFn, month_labels, month_reader

FINGERPRINT = "n long, total decimal(38,0), folded long, columns string, version string"


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return _has_map(t.elementType) if isinstance(t, T.ArrayType) else isinstance(t, T.MapType)


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of a row's values; NULL differs from every value, and maps count by their JSON text."""
    values: list[Column] = []
    for f in df.schema.fields:
        c = F.col(_q(f.name))
        values += [c.isNull(), F.to_json(F.struct(c)) if _has_map(f.dataType) else c]
    return F.xxhash64(F.lit(1), *values), F.xxhash64(F.lit(2), *values)


def fingerprint(df: DataFrame, version: str = "") -> DataFrame:
    """One row: ``n, total, folded, columns, version``.  Sums are combined map-side, whatever the table's size."""
    first, second = row_hashes(df)
    return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(first.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("total"),
                  F.coalesce(F.bit_xor(second), F.lit(0)).alias("folded")).select(
        "*", F.lit(df.schema.simpleString()).alias("columns"), F.lit(version).alias("version"))


def _stored(spark: SparkSession, path: str) -> tuple | None:
    try:
        rows = spark.read.schema(FINGERPRINT).parquet(path).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return tuple(rows[0]) if len(rows) == 1 else None


def write_changed_months(
    spark: SparkSession,
    path: str,
    table: str,
    fn: MonthFn,
    output_dir: str,
    table_name: str,
    start_month: int = 1,
    end_month: int = 12,
    layout: str = "suffix",
    version: str = "",
    undated: bool = False,
    concurrent_jobs: int = 4,
) -> Mapping[str, bool]:
    """Write ``<output_dir>/<table_name>_MM`` for the months whose input has changed since it was last written.

    Every month's rows are read and hashed, which is one narrow pass; ``fn`` runs
    only for a month whose fingerprint, columns or ``version`` (the caller's name for
    ``fn`` as it is now) differs from the stored one.  Fingerprints are kept in
    ``<output_dir>/<table_name>_fingerprints/MM``, written after the month's output.  Up
    to ``concurrent_jobs`` months are worked on at once.  Returns for every month whether it was written.
    """
    month_source = month_reader(spark, path, table, layout)

    def one(mm: str) -> bool:
        rows = month_source(mm)
        mark = os.path.join(output_dir, f"{table_name}_fingerprints", mm)
        now = fingerprint(rows, version).collect()
        if _stored(spark, mark) == tuple(now[0]):
            return False
        safe_names(rows.transform(fn)).write.mode("overwrite").parquet(os.path.join(output_dir, f"{table_name}_{mm}"))
        spark.createDataFrame(now, FINGERPRINT).coalesce(1).write.mode("overwrite").parquet(mark)
        return True

    months = month_labels(start_month, end_month, undated)
    with ThreadPoolExecutor(max_workers=max(1, concurrent_jobs)) as pool:
        return dict(zip(months, pool.map(one, months)))
