"""Batch sources: CSV, parquet, inline rows, JDBC."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession


# How CSV files written by this package mark quotes and NULL.
CSV_FORMAT = {"escape": '"', "nullValue": "\\N"}


def _join_path(path: str, fname: str) -> str:
    # location is path + file name by plain concatenation
    return f"{path}{fname}"


def read_csv(
    spark: SparkSession,
    path: str,
    fname: str = "",
    sep: str = ",",
    infer_schema: bool = False,
    schema: str | None = None,
    **options: Any,
) -> DataFrame:
    """CSV with a header row; all columns text unless a schema is given or
    inferred (inference costs a full extra pass; declare a schema at scale).

    Quotes are doubled, NULL is ``\\N`` and an empty field an empty text, as
    ``to_csv`` writes them; pass ``nullValue=""`` for files that leave NULLs
    empty.  ``multiLine=True`` reads quoted line breaks; such files are not split.
    """
    reader = spark.read.options(header=True, sep=sep, **{**CSV_FORMAT, **options})
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.csv(_join_path(path, fname))


def read_parquet(spark: SparkSession, path: str, fname: str = "") -> DataFrame:
    return spark.read.parquet(_join_path(path, fname))


def inline_table(spark: SparkSession, rows: Iterable[Sequence[Any]], schema: str) -> DataFrame:
    """Small literal table (lookup maps, labels); not for data that grows.

    Values are checked against the schema, whatever their number.  The checked
    rows are handed over as an Arrow table, which Spark plans as a local relation
    of known size, so it can broadcast it in joins by itself.
    """
    checked = spark.createDataFrame([tuple(r) for r in rows], schema=schema)
    return spark.createDataFrame(checked.toArrow(), schema=checked.schema)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """JDBC table; with a partition column the read is split into ranges."""
    props = dict(properties or {})
    if partition_column is not None:
        return spark.read.jdbc(
            url, table, column=partition_column, lowerBound=lower_bound,
            upperBound=upper_bound, numPartitions=num_partitions, properties=props,
        )
    return spark.read.jdbc(url, table, properties=props)
