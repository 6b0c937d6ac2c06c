"""Which charset the lines of a file are in, by the likelihood of their byte pairs.

A model holds, for every charset that it was fitted on, the log frequency of each
pair of neighbouring bytes.  A file's pairs are counted where its lines are read
and summed by Spark; its score in a charset is the sum over its pairs.  Scores
are whole numbers (thousandths of a natural log), so sums do not depend on order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.operators.columns import _q

PLAIN = "US-ASCII"
UTF8 = "UTF-8"
_SMOOTHING = 0.5
_PAIRS = 1 << 16
# pseudo pairs: the score of pairs that a charset was never seen with; a batch that is no UTF-8
_UNSEEN, _BROKEN = -1, -2
_COUNTS = "name string, pair int, n long"


def byte_pairs(lines: DataFrame, name_col: str, value_col: str = "value") -> DataFrame:
    """``name, pair, n``: how often each pair of bytes (first * 256 + second) stands in the lines of a name.

    A line is counted with the line feeds around it, so an empty one is a pair of
    them.  NULL lines are empty, a NULL name is ''.  ``pair`` -2 counts groups of
    lines that are no UTF-8.  Tasks send a row per name and pair at most a batch.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            values, index = batch.column(1).to_pylist(), names.indices.to_numpy()
            order = np.argsort(index, kind="stable")
            ends = np.searchsorted(index[order], np.arange(len(names.dictionary)), side="right")
            start = 0
            for name, end in zip(names.dictionary.to_pylist(), ends.tolist()):
                data = b"\n%b\n" % b"\n".join(values[k] or b"" for k in order[start:end].tolist())
                start = end
                byte = np.frombuffer(data, np.uint8).astype(np.int32)
                n = np.bincount(byte[:-1] * 256 + byte[1:], minlength=_PAIRS)
                pair = np.flatnonzero(n)
                try:
                    data.decode("utf-8")
                    broken = 0
                except UnicodeDecodeError:
                    broken = 1
                yield pa.RecordBatch.from_pydict({
                    "name": pa.array([name] * (len(pair) + broken), pa.string()),
                    "pair": pa.array(np.append(pair, [_BROKEN] * broken).astype(np.int32)),
                    "n": pa.array(np.append(n[pair], [1] * broken).astype(np.int64))})

    named = lines.select(F.coalesce(F.col(_q(name_col)).cast("string"), F.lit("")).alias("name"),
                         F.col(_q(value_col)).cast("binary").alias("value"))
    return named.mapInArrow(count, _COUNTS).groupBy("name", "pair").agg(F.sum("n").alias("n"))


def fit_charsets(lines: DataFrame, charset_col: str, value_col: str = "value") -> DataFrame:
    """The model of labelled lines (bytes): ``charset, pair, score``, one row more per charset for unseen pairs.

    At most 65,537 rows per charset, whatever was read; store it to use it again.
    """
    counts = byte_pairs(lines, charset_col, value_col).where("pair >= 0")
    totals = counts.groupBy("name").agg(F.sum("n").alias("total"))

    def score(n):
        return F.round(F.log((n + _SMOOTHING) / (F.col("total") + _SMOOTHING * _PAIRS)) * 1000).cast("long").alias("score")

    seen = counts.join(totals, "name").select(F.col("name").alias("charset"), "pair", score(F.col("n")))
    return seen.unionByName(totals.select(F.col("name").alias("charset"), F.lit(_UNSEEN).alias("pair"), score(F.lit(0))))


def charset_scores(lines: DataFrame, model: DataFrame, name_col: str, value_col: str = "value") -> DataFrame:
    """``name, charset, n_bytes, score, possible, plain``: one row per name and charset of the model.

    ``n_bytes`` counts the bytes of the lines and their line feeds.  ``possible``
    is false for UTF-8 where some line is none; ``plain`` lines hold nothing but
    7-bit bytes above 0.  A hot name is a row per byte
    pair and task before the shuffle.
    """
    counts = byte_pairs(lines, name_col, value_col)
    # a row per charset
    unseen = {r["charset"]: r["score"] for r in model.where(F.col("pair") == _UNSEEN).collect()}
    if not unseen:
        raise ValueError("the model has no charset")
    default = F.create_map(*[x for c, s in sorted(unseen.items()) for x in (F.lit(c), F.lit(s).cast("long"))])
    gains = model.where("pair >= 0").select("charset", "pair", (F.col("score") - default[F.col("charset")]).alias("gain"))
    # every byte is the first of a pair: the line feed after a line ends the last one
    odd = (F.col("pair") >= 128 * 256) | F.col("pair").between(0, 255)
    gained = counts.join(gains, "pair").groupBy("name", "charset").agg(F.sum(F.col("n") * F.col("gain")).alias("gained"))
    totals = counts.groupBy("name").agg(F.sum(F.when(F.col("pair") >= 0, F.col("n")).otherwise(0)).alias("n_bytes"),
                                        F.max((F.col("pair") == _BROKEN).cast("int")).alias("broken"),
                                        F.max(odd.cast("int")).alias("odd"))
    each = totals.withColumn("charset", F.explode(F.array(*[F.lit(c) for c in sorted(unseen)])))
    possible = (F.col("broken") == 0) | (F.upper("charset") != UTF8)
    return each.join(gained, ["name", "charset"], "left").select(
        "name", "charset", "n_bytes", (F.col("n_bytes") * default[F.col("charset")] + F.coalesce("gained", F.lit(0))).alias("score"),
        possible.alias("possible"), (F.col("odd") == 0).alias("plain"))


def charset_advice(lines: DataFrame, model: DataFrame, name_col: str, value_col: str = "value") -> DataFrame:
    """``name, charset, n_bytes, score, margin``: the charset of the model that fits the lines of a name best.

    ``margin`` is the lead over the second, NULL without one; ties go to the first
    charset by name.  Lines of nothing but 7-bit bytes above 0 read alike in all
    charsets of one byte: they are US-ASCII, with the score of the best.  Between
    line feeds the two byte orders of UTF-16 differ only in characters beyond
    U+00FF and in a byte order mark.
    """
    scores = charset_scores(lines, model, name_col, value_col)
    ranked = F.array_sort(F.collect_list(F.when(F.col("possible"), F.struct((-F.col("score")).alias("cost"), "charset"))))
    best = scores.groupBy("name").agg(F.first("n_bytes").alias("n_bytes"), F.first("plain").alias("plain"), ranked.alias("ranked"))
    charset = F.when(F.col("plain"), F.lit(PLAIN)).otherwise(F.get("ranked", F.lit(0)).getField("charset"))
    first, second = (F.get("ranked", F.lit(k)).getField("cost") for k in (0, 1))
    return best.select("name", charset.alias("charset"), "n_bytes", (-first).alias("score"), (second - first).alias("margin"))
