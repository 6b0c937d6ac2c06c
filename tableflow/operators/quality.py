"""Data-quality jobs: single-pass profile, null checks, schema conformance,
per-file line length and encoding profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.defaults import DEFAULT_TIME_FORMAT
from tableflow.functions.casting import safe_try_cast
from tableflow.functions.text import split_lines
from tableflow.operators.columns import TIMESTAMP_TYPES, _q

PROFILE_SCHEMA = (
    "column string, datatype string, distinct_count bigint, count bigint, "
    "mean double, stddev double, min double, max double, null_count bigint"
)


# nested times to the microsecond
_EXACT_TIMES = ("map('timestampFormat', \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\", "
                "'timestampNTZFormat', \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")")


def _key_slots(ref: str, dtype: T.DataType) -> tuple[str, str, str, str]:
    """SQL for the typed slots (l, d, s, b) of a grouping key that is equal
    exactly when two values of one column are equal under Spark's grouping
    rules, without formatting numbers as text: integral/boolean/date/instant
    values in a bigint slot, floating values in a double slot (grouping
    treats -0.0 as 0.0 and all NaNs as one value), binary in a binary slot,
    everything else as canonical text (wall-clock timestamps included, which
    an instant would merge inside daylight-saving gaps)."""
    l = d = s = b = None
    if isinstance(dtype, T.StringType):
        s = ref
    elif isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        l = f"CAST({ref} AS BIGINT)"
    elif isinstance(dtype, T.DateType):
        l = f"CAST(unix_date({ref}) AS BIGINT)"
    elif isinstance(dtype, T.TimestampType):
        l = f"unix_micros({ref})"
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        d = f"CAST({ref} AS DOUBLE)"
    elif isinstance(dtype, T.BinaryType):
        b = ref
    elif isinstance(dtype, (T.StructType, T.ArrayType)):
        s = f"to_json({ref}, {_EXACT_TIMES})"
    elif not isinstance(dtype, T.MapType):
        s = f"CAST({ref} AS STRING)"
    return (l or "CAST(NULL AS BIGINT)", d or "CAST(NULL AS DOUBLE)",
            s or "CAST(NULL AS STRING)", b or "CAST(NULL AS BINARY)")


def _profile_entry(i: int, f: T.StructField) -> Column:
    """One (column, not-null, key, numeric value) entry, as one SQL expression
    (a single call per column keeps plan building fast for wide tables)."""
    ref = _q(f.name)
    l, d, s, b = _key_slots(ref, f.dataType)
    x = f"CAST({ref} AS DOUBLE)" if isinstance(f.dataType, T.NumericType) else "CAST(NULL AS DOUBLE)"
    return F.expr(
        f"named_struct('_i', {i}, '_nn', {ref} IS NOT NULL, "
        f"'_v', named_struct('l', {l}, 'd', {d}, 's', {s}, 'b', {b}), '_x', {x})"
    )


def data_profile(df: DataFrame, approx: bool = False, rsd: float = 0.05, digits: int | None = None) -> DataFrame:
    """One row per column: type, distinct values, count, moments, NULLs.

    ``distinct_count`` counts NULL as a value.  Numeric columns get the
    non-null ``count`` and ``mean``/sample ``stddev``/``min``/``max`` as
    double; other columns get the row count and NULL statistics.

    Plan (the same for 5 or 500 columns): every row is turned into one
    ``(column, value key, numeric value)`` entry per column by a single
    ``inline``.  Counts and moments are one ``groupBy(column)`` that combines
    map-side, so no value is shuffled for them.  Exact distinct counts shuffle
    each task's distinct (column, value key) pairs, from a second scan;
    ``approx=True`` folds a HyperLogLog sketch into the first aggregate instead
    and is the choice for wide or large tables.  No column, however hot or wide,
    meets in one task.
    """
    spark = df.sparkSession
    fields = list(df.schema.fields)
    long = df.select(F.inline(F.array(*[_profile_entry(i, f) for i, f in enumerate(fields)])))

    nulls = F.col("_rows") - F.col("_n")
    sketch = [F.approx_count_distinct(F.when(F.col("_nn"), F.col("_v")), rsd).alias("_a")] if approx else []
    stats = long.groupBy("_i").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if("_nn").alias("_n"),
        F.avg("_x").alias("_avg"),
        F.stddev_samp("_x").alias("_sd"),
        F.min("_x").alias("_min"),
        F.max("_x").alias("_max"),
        *sketch,
    )
    if approx:
        stats = stats.withColumn("_d", F.col("_a") + F.when(nulls > 0, 1).otherwise(0))
    else:
        # a NULL is one value
        distinct = long.select("_i", "_v", "_nn").distinct().groupBy("_i").agg(F.count(F.lit(1)).alias("_d"))
        stats = stats.join(F.broadcast(distinct), "_i")

    # per-column constants, one row per column; every column gets a row, also
    # for an empty table (which has no groups)
    meta = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), isinstance(f.dataType, T.NumericType),
          not isinstance(f.dataType, T.MapType)) for i, f in enumerate(fields)],
        "_i int, column string, datatype string, _num boolean, _cmp boolean",
    )
    stats = meta.join(stats, "_i", "left").fillna(0, subset=["_rows", "_n", "_d"])

    is_num = F.col("_num")
    mean, sd = F.col("_avg"), F.col("_sd")
    if digits is not None:
        mean, sd = F.round(mean, digits), F.round(sd, digits)
    num = lambda v: F.when(is_num, v).otherwise(F.lit(None).cast("double"))
    return stats.orderBy("_i").select(
        "column",
        "datatype",
        F.when(F.col("_cmp"), F.col("_d")).cast("bigint").alias("distinct_count"),
        F.when(is_num, F.col("_n")).otherwise(F.col("_rows")).cast("bigint").alias("count"),
        num(mean).alias("mean"),
        num(sd).alias("stddev"),
        num(F.col("_min")).alias("min"),
        num(F.col("_max")).alias("max"),
        nulls.cast("bigint").alias("null_count"),
    )


PROFILE_PART_SCHEMA = ("part string, position int, column string, datatype string, is_numeric boolean, rows bigint, "
                       "not_null bigint, mean double, squares double, min double, max double, sketch binary")


def profile_parts(df: DataFrame, part: str | Column = "", lg_k: int = 12) -> DataFrame:
    """What a profile is made of, one row per part and column, to be stored and merged later.

    ``part`` is a label, or a column whose values are the parts: all of them take one
    pass.  Moments are a mean and the sum of squared distances from it; distinct
    values are a sketch of 2^``lg_k`` registers at most.  All are combined map-side,
    so a part with most of the rows costs a row per task.
    """
    label = F.lit(part) if isinstance(part, str) else F.coalesce(part.cast("string"), F.lit(""))
    fields = list(df.schema.fields)
    long = df.select(label.alias("part"), F.inline(F.array(*[_profile_entry(i, f) for i, f in enumerate(fields)])))
    # no data, no groups: a part without rows has none
    parts = long.groupBy("part", "_i").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("_nn").alias("not_null"), F.avg("_x").alias("mean"),
        (F.var_pop("_x") * F.count("_x")).alias("squares"), F.min("_x").alias("min"), F.max("_x").alias("max"),
        F.hll_sketch_agg(F.when(F.col("_nn"), F.xxhash64("_v")), lg_k).alias("sketch"))
    meta = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), isinstance(f.dataType, T.NumericType)) for i, f in enumerate(fields)],
        "_i int, column string, datatype string, is_numeric boolean")
    out = parts.join(F.broadcast(meta), "_i")  # a row per column
    return out.select("part", F.col("_i").alias("position"), "column", "datatype", "is_numeric", "rows", "not_null", "mean",
                      "squares", "min", "max", "sketch")


def merge_profiles(parts: DataFrame) -> DataFrame:
    """The profile (``PROFILE_SCHEMA``) of all parts together, from :func:`profile_parts` of each.

    Counts, least and greatest values are those of the whole table, and moments up to
    rounding; ``distinct_count`` is an estimate.  The same part given twice counts twice.
    """
    weight = F.col("not_null").cast("double")
    held = parts.groupBy("column").agg(
        F.min("position").alias("position"), F.max_by("datatype", "rows").alias("datatype"), F.bool_or("is_numeric").alias("is_numeric"),
        F.sum("rows").alias("rows"), F.sum("not_null").alias("n"), (F.sum(weight * F.col("mean")) / F.sum(weight)).alias("mean"),
        F.sum("squares").alias("within"), F.collect_list(F.struct(weight.alias("w"), F.col("mean").alias("m"))).alias("means"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("d"))
    # a row per part: the means' own spread around the mean of all, without cancellation
    between = F.aggregate("means", F.lit(0.0), lambda acc, p: acc + F.coalesce(p["w"] * (p["m"] - F.col("mean")) ** 2, F.lit(0.0)))
    nulls, numeric = F.col("rows") - F.col("n"), F.col("is_numeric")
    spread = F.when(F.col("n") > 1, F.sqrt((F.col("within") + between) / (F.col("n") - 1)))
    return held.orderBy("position").select(
        "column", "datatype", (F.col("d") + F.when(nulls > 0, 1).otherwise(0)).cast("bigint").alias("distinct_count"),
        F.when(numeric, F.col("n")).otherwise(F.col("rows")).alias("count"), F.when(numeric, F.col("mean")).alias("mean"),
        F.when(numeric, spread).alias("stddev"), F.when(numeric, F.col("min")).alias("min"), F.when(numeric, F.col("max")).alias("max"),
        nulls.alias("null_count"))


def null_rows(df: DataFrame, column: str, show_cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows (of ``show_cols``) where ``column`` is NULL."""
    cols = list(show_cols) if show_cols else df.columns
    return df.filter(F.col(_q(column)).isNull()).select(*[_q(c) for c in cols]).distinct()


def null_count(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """One row: number of NULLs per column, named ``null_<column>``."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    return df.agg(*[F.count_if(F.col(_q(c)).isNull()).alias(f"null_{c}") for c in cols])


def schema_conformance(
    df: DataFrame,
    declared: Mapping[str, str],
    time_format: str = DEFAULT_TIME_FORMAT,
) -> DataFrame:
    """Declared schema vs table, in one aggregation job of fixed size.

    One row per column of either side: ``in_table``, ``in_schema``,
    ``declared_type`` and ``bad_values`` - the non-NULL values that do not
    convert to the declared type (NULL when the column is on one side only).
    Each row contributes one (column, failed) entry per checked column and a
    single partial ``groupBy(column)`` counts the failures, whatever the width.
    """
    table_cols = list(df.columns)
    types = dict(df.dtypes)
    names = table_cols + [c for c in declared if c not in table_cols]
    checked = [(i, n) for i, n in enumerate(names) if n in types and declared.get(n) is not None]

    entries = []
    for i, name in checked:
        c = F.col(_q(name))
        dtype = declared[name]
        if dtype.lower() in TIMESTAMP_TYPES and types[name] == "string":
            conv = F.try_to_timestamp(c, F.lit(time_format))
        else:
            conv = safe_try_cast(c, dtype, types.get(name))
        entries.append(F.struct(F.lit(i).alias("_i"), (c.isNotNull() & conv.isNull()).alias("_bad")))

    checked_idx = {i for i, _ in checked}
    # per-column constants, one row per column of either side
    meta = df.sparkSession.createDataFrame(
        [(i, n, n in types, declared.get(n) is not None, declared.get(n), i in checked_idx)
         for i, n in enumerate(names)],
        "_i int, column string, in_table boolean, in_schema boolean, declared_type string, _chk boolean",
    )
    if entries:
        bad = df.select(F.inline(F.array(*entries))).groupBy("_i").agg(F.count_if("_bad").alias("_b"))
        out = meta.join(bad, "_i", "left")
    else:
        out = meta.withColumn("_b", F.lit(None).cast("bigint"))
    return out.orderBy("_i").select(
        "column", "in_table", "in_schema", "declared_type",
        F.when(F.col("_chk"), F.coalesce(F.col("_b"), F.lit(0))).cast("bigint").alias("bad_values"),
    )


def explode_lines(df: DataFrame, text_col: str, keep: Sequence[str] = (), with_number: bool = False) -> DataFrame:
    """One row per ``\\n``-separated line of ``text_col`` (whole texts)."""
    keep_cols = [_q(k) for k in keep]
    if with_number:
        return df.select(*keep_cols, F.posexplode(split_lines(_q(text_col))).alias("line_no", "line"))
    return df.select(*keep_cols, F.explode(split_lines(_q(text_col))).alias("line"))


def line_profile(lines: DataFrame, group_col: str, line_col: str = "line") -> DataFrame:
    """Longest line and line count per group (the check before a line limit)."""
    return lines.groupBy(_q(group_col)).agg(
        F.max(F.length(_q(line_col))).alias("max_line_length"),
        F.count(F.lit(1)).alias("n_lines"),
    )


def encoding_profile(lines: DataFrame, group_col: str, line_col: str = "value") -> DataFrame:
    """Lines per group and how many are not valid UTF-8 (wrong charset)."""
    return lines.groupBy(_q(group_col)).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(~F.is_valid_utf8(_q(line_col))).alias("bad_lines"),
    )
