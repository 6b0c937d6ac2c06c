"""Audit of five corpus filters and of how they interact.

Each document gets a mask of the filters that it fails.  Four of them are rules
on its own text; the fifth, being a copy of a document with a smaller id, needs
the whole table and is decided in two steps.  A counting Bloom filter, built in
every task and merged slot by slot, clears the texts that are certainly unique:
one of their counters stands at one.  Only the others are shuffled, by the
SHA-256 of the whole text, to find the smallest id of every text.  All figures
of all orders of the filters are sums over the counts of the masks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import col, prepared, stored

#: Filters in the order of the mask's bits: few words, few distinct words, many capitals, symbols, copies.
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT, SYMBOLS = 50, 65, 5, b"#$%&*|"
_CAPITALS = bytes(range(65, 91))

#: Counters per document, and counters that a text adds one to: about 1 % of unique texts are not cleared.
COUNTERS_PER_ROW, PROBES = 8, 4
#: The merged sketch is sent to the tasks, a bit a counter; from 2^28 rows on it stays at
#: 256 MB and clears fewer texts: what is shuffled is still a narrow row per document at most.
MAX_COUNTERS = 1 << 31
#: Counters merged as one row.
SLICE = 1 << 16


def failed_mask(text: str | None) -> int:
    """Bits A to D of one text; a null text is an empty one."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    return (int(len(words) < MIN_WORDS)
            | int(100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
            | int(100 * capitals > MAX_CAPITALS_PERCENT * len(text)) << 2
            | int(len(data.translate(None, SYMBOLS)) < len(data)) << 3)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_py() or "" for t in batch.column(2)]
        mask = pa.array([failed_mask(t) for t in texts], pa.int32())
        digest = pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), mask, digest], ["doc_id", "part", "mask", "digest"])


def _counters(digests: pa.Array, counters: int) -> np.ndarray:
    """The ``PROBES`` counters of every digest, distinct ones read from its own bytes."""
    data = b"".join(d.as_py() for d in digests)
    return (np.frombuffer(data, "<u8").reshape(-1, 4)[:, :PROBES] & np.uint64(counters - 1)).astype(np.int64)


def _partial_sketch(counters: int):
    """Per task and slice: the counters that stand at one, and those at two or more."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = twice = np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            # a text counts once at each of its counters, also where two of its probes meet
            each = np.sort(_counters(batch.column(0), counters), axis=1)
            first = np.ones(each.shape, bool)
            first[:, 1:] = each[:, 1:] != each[:, :-1]
            slot, n = np.unique(each[first], return_counts=True)
            once, twice = _merged(once, twice, slot[n == 1], slot[n > 1])
        for s in np.unique(np.concatenate([once, twice]) // SLICE).tolist():
            rows = [(a[np.searchsorted(a, s * SLICE):np.searchsorted(a, (s + 1) * SLICE)] % SLICE).astype("<u2").tobytes()
                    for a in (once, twice)]
            yield pa.RecordBatch.from_pydict({"slice": pa.array([s], pa.int64()), "once": pa.array(rows[:1], pa.binary()),
                                              "twice": pa.array(rows[1:], pa.binary())})

    return build


def _merged(once: np.ndarray, twice: np.ndarray, more_once: np.ndarray, more_twice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sketches as one: sorted counters at one, and at two or more."""
    both = np.intersect1d(once, more_once, assume_unique=True)
    twice = np.unique(np.concatenate([twice, more_twice, both]))
    return np.setdiff1d(np.union1d(once, more_once), twice, assume_unique=True), twice


def _merge_slice(rows: pd.DataFrame) -> pd.DataFrame:
    count = np.zeros(SLICE, np.uint8)
    for once, twice in zip(rows["once"], rows["twice"]):
        count[np.frombuffer(once, "<u2")] = np.minimum(count[np.frombuffer(once, "<u2")] + 1, 2)
        count[np.frombuffer(twice, "<u2")] = 2
    return pd.DataFrame({"slice": rows["slice"].iloc[:1], "repeated": [np.packbits(count > 1, bitorder="little").tobytes()]})


def possible_repeats(digests: DataFrame, digest_col: str, rows: int) -> Column:
    """Whether a text may stand twice in ``digests`` (false: it certainly does not), as a column.

    ``rows`` is the number of rows, from which the sketch takes its size.  Its
    slices are merged by Spark and reach the driver as one bit a counter,
    ``MAX_COUNTERS`` bits at most, which are broadcast.
    """
    counters = 1 << max(SLICE.bit_length() - 1, min(MAX_COUNTERS.bit_length() - 1, (COUNTERS_PER_ROW * max(rows, 1) - 1).bit_length()))
    partial = digests.select(digest_col).mapInArrow(_partial_sketch(counters), "slice long, once binary, twice binary")
    bits = np.zeros(counters // 8, np.uint8)
    for r in partial.groupBy("slice").applyInPandas(_merge_slice, "slice long, repeated binary").toLocalIterator():
        bits[r["slice"] * SLICE // 8:(r["slice"] + 1) * SLICE // 8] = np.frombuffer(r["repeated"], np.uint8)
    sent = digests.sparkSession.sparkContext.broadcast(bits)

    def test(held: pa.Array) -> pa.Array:
        slot = _counters(held, counters)
        return pa.array((sent.value[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).all(axis=1))

    return F.arrow_udf(test, "boolean")(F.col(digest_col))


def document_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``doc_id, part, mask, n``: documents alike in id, part and the filters they fail, counted.

    Bits 0 to 4 of ``mask`` are the filters A to E.  A null part is ''.  E holds
    where the same text, null being '', has a smaller id anywhere in the table;
    a null id is neither smaller nor larger than another, and rows alike in id
    are not smaller than each other.
    """
    prepared(docs.sparkSession)
    source = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(part_col).cast("string"), F.lit("")).alias("part"),
                         col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    slim = stored(source.mapInArrow(_read_batches, f"doc_id {id_type}, part string, mask int, digest binary"))
    maybe = possible_repeats(slim, "digest", slim.count())
    tested = slim.withColumn("maybe", maybe)
    # rows cleared by the sketch keep no text key: they are not shuffled by text again
    grouped = stored(tested.groupBy("doc_id", "part", "mask", F.when(F.col("maybe"), F.col("digest")).alias("text_key"))
                     .agg(F.count("*").alias("n")))
    least = (grouped.where("text_key IS NOT NULL").groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("first", F.lit(True)))
    copy = F.col("text_key").isNotNull() & F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (grouped.join(least, ["doc_id", "text_key"], "left")
            .select("doc_id", "part", (F.col("mask") + F.when(copy, COPY).otherwise(0)).alias("mask"), "n")
            .groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each mask, and those labelled so.

    ``labels`` has ``doc_id, quality, toxic``; an id that it lists twice counts as
    good (toxic) if any of its rows says so.
    """
    known = labels.groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                                         F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    return (masks.join(known, "doc_id", "left").groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
                 F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")))


def _steps() -> list[tuple[str, int, int, int]]:
    """``order, step, bit, before`` for every place of every order: the filter's bit and those applied earlier."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            out.append(("".join(order), step, bit := 1 << FILTERS.index(name), before))
            before |= bit
    return out


def _literals(rows: list[tuple], names: list[str]) -> Column:
    return F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(names, row)]) for row in rows]))


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counts of the masks.

    What a step does depends on its filter and the set of filters before it: the
    80 such states are summed first, then dealt to the 600 places of the 120
    orders.  ``shapley`` is what the filter removes, summed over all orders: a
    mask of f failed filters is removed by each in 120 / f of them.
    """
    steps = _steps()
    states = sorted({(bit, before) for _, _, bit, before in steps})
    orders = math.factorial(len(FILTERS))
    each = counts.select("part", "mask", "n", "good", "toxic", _literals(states, ["bit", "before"]).alias("s")).select(
        "part", "mask", "n", "good", "toxic", "s.bit", "s.before")
    mask, bit, before = F.col("mask"), F.col("bit"), F.col("before")
    fails, earlier = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0

    def total(condition: Column, what: str | Column) -> Column:
        return F.sum(F.when(condition, what if isinstance(what, Column) else F.col(what)).otherwise(F.lit(0))).cast("long")

    share = F.floor(F.lit(orders) / F.greatest(F.bit_count(mask), F.lit(1)))
    sums = each.groupBy("part", "bit", "before").agg(
        total(~fails & ~earlier, "n").alias("kept"), total(fails & ~earlier, "n").alias("removed"),
        total(fails & earlier, "n").alias("redundant"), total(mask == bit, "n").alias("unique_fails"),
        total(fails & ~earlier, "good").alias("good_lost"), total(fails & ~earlier, "toxic").alias("toxic_lost"),
        total(fails, F.col("n") * share).alias("shapley"))
    places: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order, step, b, done in steps:
        places.setdefault((b, done), []).append((order, step))
    dealt = F.create_map(*[x for (b, done), held in sorted(places.items()) for x in (
        F.lit(b * 64 + done), F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step")) for o, s in held]))])
    return sums.withColumn("p", F.explode(dealt[bit * 64 + before])).select(
        "part", "p.filter_order", "p.step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """``part, filter_order, step`` and the counts of every step of every order of the five filters.

    Null and empty texts are alike; null and empty parts are one part; repeated
    rows count each; an empty table gives no rows; other columns are not read.
    """
    return interactions(mask_counts(document_masks(docs, id_col, text_col, part_col), labels))
