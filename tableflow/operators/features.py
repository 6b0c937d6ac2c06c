"""Categorical feature encoding: frequency index, one-hot, vector assembly.

The label dictionary is built and numbered on the executors: label counts
are a distributed aggregate, a range shuffle sorts them (count desc, label
asc), and each label's position is its rank inside its range partition plus
the number of labels in earlier partitions.  Nothing proportional to the
number of labels passes through the driver or a single task; the only
driver round trip is one small per-partition count table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableflow.operators.columns import _q
from tableflow.operators.joins import split_skew_join
from tableflow.session import broadcast_limit, ensure_checkpoint_dir

_HANDLE = ("error", "skip", "keep")
# what a label row takes besides its text
_ROW_BYTES = 48
# labels with this share of the rows are split when the label table is too large to broadcast
_HOT_SHARE = 0.01
_CHECKED = "_checked_index"
_LABEL, _INDEX = "_fitted_label", "_fitted_index"


def label_index(df: DataFrame, column: str, num_partitions: int | None = None) -> DataFrame:
    """(label, label_count, index) for the non-NULL labels of ``column``.

    Index 0 is the most frequent label; ties go alphabetically (the order of
    a frequency-descending string indexer).  The result is checkpointed to
    the shared checkpoint dir, so both uses of the ranking see one sample of
    the range boundaries.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = (
        df.select(F.col(_q(column)).alias("label"))
        .filter(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("label_count"))
    )
    order = [F.col("label_count").desc(), F.col("label").asc()]
    ranked = (
        counts.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        # position inside the sorted partition: the id's low 33 bits
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .checkpoint(eager=True)
    )
    sizes = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a window over it is bounded by the partition count
    offsets = sizes.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    ).fillna(0, subset=["_off"])
    return ranked.join(F.broadcast(offsets), "_pid").select(
        "label", "label_count", (F.col("_off") + F.col("_pos")).cast("double").alias("index")
    )


def string_index(
    df: DataFrame,
    column: str,
    output_col: str | None = None,
    handle_invalid: str = "error",
) -> DataFrame:
    """Add ``output_col`` (double) = frequency rank of the ``column`` label.

    NULL labels: ``'error'`` fails the job, ``'skip'`` drops the row,
    ``'keep'`` gives them the index after the last label.  The label table is
    broadcast if its measured size is under Spark's broadcast threshold; else
    labels with a large share of the rows are split before the join.
    """
    if handle_invalid not in _HANDLE:
        raise ValueError(f"handle_invalid must be one of {_HANDLE}")
    out = output_col or f"{column}_idx"
    found = label_index(df, column)
    text_bytes = F.octet_length(F.col("label").cast("string"))
    # one row from the (checkpointed, label-sized) table: category count and size
    measured = found.agg(F.count("*").alias("n"), F.sum(text_bytes + _ROW_BYTES).alias("size"),
                         F.sum("label_count").alias("rows")).first()
    n_labels = measured["n"]
    c = F.col(_q(column))
    src = df.filter(c.isNotNull()) if handle_invalid == "skip" else df
    if (measured["size"] or 0) <= broadcast_limit(df.sparkSession):
        labels = found.select(F.col("label").alias("_lbl"), F.col("index").alias("_idx"))
        joined = src.join(F.broadcast(labels), c == F.col("_lbl"), "left").drop("_lbl")
    else:
        # at most 1 / _HOT_SHARE labels can have so many rows
        least = math.ceil(measured["rows"] * _HOT_SHARE)
        hot = [(r["label"],) for r in found.filter(F.col("label_count") >= least).select("label").collect()]
        labels = found.select(F.col("label").alias(column), F.col("index").alias("_idx"))
        joined = split_skew_join(src, labels, column, "left", hot).select(*[_q(x) for x in src.columns], "_idx")
    if handle_invalid == "keep":
        idx = F.when(c.isNull(), F.lit(float(n_labels))).otherwise(F.col("_idx"))
    elif handle_invalid == "error":
        idx = F.when(c.isNull(), F.raise_error(F.lit(f"NULL label in {column}")).cast("double")).otherwise(
            F.col("_idx")
        )
    else:
        idx = F.col("_idx")
    # nominal-attribute metadata (as an ML indexer writes it) lets encoders size
    # their output without another pass over the data
    n_values = n_labels + (1 if handle_invalid == "keep" else 0)
    return joined.withColumn(out, idx.alias(out, metadata=_nominal(out, n_values))).drop("_idx")


def fit_labels(df: DataFrame, column: str, path: str) -> DataFrame:
    """Write the label dictionary of ``column`` to ``path`` (parquet, replaced if there) and read it back.

    ``label, label_count, index`` as in :func:`label_index`: a fitted dictionary that
    :func:`index_labels` applies to any other table or stream.
    """
    label_index(df, column).write.mode("overwrite").parquet(path)
    return read_labels(df.sparkSession, path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary written by :func:`fit_labels`."""
    return spark.read.parquet(path)


def index_labels(
    df: DataFrame,
    labels: DataFrame,
    column: str,
    output_col: str | None = None,
    handle_unseen: str = "error",
) -> DataFrame:
    """Add ``output_col`` (double): the index that the fitted ``labels`` give to ``column``.

    The column is compared as the dictionary's type.  NULL, and a label that the
    dictionary does not have: ``'error'`` fails the job, ``'skip'`` drops the row,
    ``'keep'`` gives the index after the last label.  A dictionary whose measured size
    is under Spark's broadcast threshold is broadcast; a larger one is joined with the
    hot labels of ``df`` split, or, where ``df`` is a stream, shuffled with each batch.
    """
    if handle_unseen not in _HANDLE:
        raise ValueError(f"handle_unseen must be one of {_HANDLE}")
    out = output_col or f"{column}_idx"
    size = F.octet_length(F.col("label").cast("string")) + _ROW_BYTES
    measured = labels.agg(F.count("*").alias("n"), F.sum(size).alias("size")).first()
    n = measured["n"]
    label_type = labels.schema["label"].dataType
    c = F.col(_q(column))
    known = labels.select(F.col("label").alias(_LABEL), F.col("index").alias(_INDEX))
    keyed = df.withColumn(_LABEL, c.try_cast(label_type))
    if (measured["size"] or 0) <= broadcast_limit(df.sparkSession):
        joined = keyed.join(F.broadcast(known), _LABEL, "left")
    elif df.isStreaming:
        joined = keyed.join(known, _LABEL, "left")
    else:
        joined = split_skew_join(keyed, known, _LABEL, "left", min_share=_HOT_SHARE)
    found = F.col(_INDEX)
    if handle_unseen == "skip":
        joined, idx = joined.where(found.isNotNull()), found
    elif handle_unseen == "keep":
        idx = F.coalesce(found, F.lit(float(n)))
    else:
        what = F.concat(F.lit(f"label of {column} not in the dictionary: "), F.coalesce(c.cast("string"), F.lit("NULL")))
        idx = F.coalesce(found, F.raise_error(what).cast("double"))
    n_values = n + (handle_unseen == "keep")
    return joined.select(*[_q(x) for x in df.columns], idx.alias(out, metadata=_nominal(out, n_values)))


def _nominal(name: str, n: int) -> dict:
    return {"ml_attr": {"type": "nominal", "name": name, "num_vals": n}}


def category_count(df: DataFrame, index_col: str) -> int:
    """Categories of an index column: from its metadata, else its largest value + 1 (one job)."""
    n = df.schema[index_col].metadata.get("ml_attr", {}).get("num_vals")
    if n is None:
        n = int(df.agg(F.coalesce(F.max(_q(index_col)), F.lit(-1)).alias("m")).first()["m"]) + 1
    return n


def one_hot(
    df: DataFrame,
    index_col: str,
    output_col: str | None = None,
    drop_last: bool = True,
    as_columns: bool = False,
    handle_invalid: str = "error",
) -> DataFrame:
    """One-hot encode an index column (the last category is all zeros when ``drop_last``).

    ``as_columns`` gives ``<out>_<i>`` double columns for relational sinks, else a
    vector.  An index that is NULL or no category fails the job; ``'keep'`` makes
    these one more category.  Both forms and both ways to know the number of
    categories follow this rule.
    """
    if handle_invalid not in ("error", "keep"):
        raise ValueError("handle_invalid must be 'error' or 'keep'")
    out = output_col or f"{index_col}_vec"
    n, c = category_count(df, index_col), F.col(_q(index_col))
    known = F.coalesce(c.between(0, n - 1) & (c == F.floor(c)), F.lit(False))
    extra = F.lit(float(n)) if handle_invalid == "keep" else \
        F.raise_error(F.concat(F.lit(f"no category in {index_col}: "), F.coalesce(c.cast("string"), F.lit("NULL")))).cast("double")
    idx = F.when(known, c.cast("double")).otherwise(extra)
    n += handle_invalid == "keep"
    if as_columns:
        width = n - (1 if drop_last else 0)
        checked = df.withColumn(_CHECKED, idx)
        return checked.select(*[_q(x) for x in df.columns],
                              *[(F.col(_CHECKED) == float(k)).cast("double").alias(f"{out}_{k}") for k in range(width)])
    checked = df.withColumn(_CHECKED, idx.alias(_CHECKED, metadata=_nominal(_CHECKED, n)))
    return OneHotEncoder(inputCols=[_CHECKED], outputCols=[out], dropLast=drop_last).fit(checked).transform(checked).drop(_CHECKED)


def assemble(df: DataFrame, input_cols: Sequence[str], output_col: str = "features", as_array: bool = False,
             handle_invalid: str = "error") -> DataFrame:
    """Concatenate numeric / vector columns into one feature vector.

    A NULL or NaN input fails the job; ``'skip'`` drops its row, ``'keep'`` gives NaN.
    """
    res = VectorAssembler(inputCols=list(input_cols), outputCol=output_col, handleInvalid=handle_invalid).transform(df)
    if as_array:
        res = res.withColumn(output_col, vector_to_array(F.col(output_col)))
    return res
