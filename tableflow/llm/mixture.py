"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is dealt in blocks of equal word counts.  Blocks go to sources, and a
source's blocks to its shards, by highest quotients ``votes / (2 * seats + 1)``.
A shard lays its documents end to end in a seeded order and the mix takes the
first ``quota`` blocks of that sequence, going round again when it is used up:
so exactly ``quota`` whole blocks are taken and a document is repeated as evenly
as its shard allows.

Rows alike in id, source and size are counted first and laid as pieces of at most
``PIECE_ROWS`` copies, so they spread over the shards and no key holds them all.
One row per source reaches the driver; shards are apportioned in one task per
source over at most ``MAX_SHARDS`` rows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableflow.llm.common import WORD, col, fresh, stored

BLOCK_WORDS = 64
#: A shard aims at this many words; a source has ``MAX_SHARDS`` shards at most.
SHARD_WORDS = 1 << 17
MAX_SHARDS = 1 << 16
#: Up to so many sources the plan is broadcast, a row each; beyond, it is joined like any table.
BROADCAST_SOURCES = 10_000
#: Rows alike in id, source and size that are dealt together.
PIECE_ROWS = 1024
MAX_REPEATS = 3
SEED = "mix-1"


def capped_shares(sizes: Sequence[float], weights: Sequence[float], total: float,
                  max_repeats: float = MAX_REPEATS) -> list[float]:
    """Targets in proportion to the weights, none above ``max_repeats`` times its size.

    What a full source leaves over is shared by weight among the others.  In order
    of ``cap / weight`` a source is full as long as its share of what is left
    reaches its cap.  With no weight or no size, the target is 0.
    """
    caps = [max_repeats * s for s in sizes]
    order = sorted((i for i in range(len(sizes)) if weights[i] > 0 and sizes[i] > 0),
                   key=lambda i: (caps[i] / weights[i], i))
    out = [0.0] * len(sizes)
    left, weight = float(total), float(sum(weights[i] for i in order))
    for place, i in enumerate(order):
        if left * weights[i] < caps[i] * weight:
            for j in order[place:]:
                out[j] = left * weights[j] / weight
            break
        out[i] = float(caps[i])
        left -= caps[i]
        weight -= weights[i]
    return out


def sainte_lague(votes: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Seats by highest quotients ``v / (2 s + 1)``, at most ``most[i]`` each; ties to the lower index.

    A divisor found by bisection gives nearly all seats at once, a heap the rest,
    so the cost does not depend on the number of seats.
    """
    v, cap = np.asarray(votes, float), np.asarray(most, np.int64)
    cap = np.where(v > 0, cap, 0)
    seats = min(int(seats), int(cap.sum()))
    if seats <= 0:
        return [0] * len(v)

    def at(divisor: float) -> np.ndarray:
        return np.minimum(np.floor(v / divisor + 0.5), cap).astype(np.int64)

    low, high = float(v.max()) / (seats + 1) / 4, float(v.sum()) * 2 + 1
    while at(low).sum() <= seats and low > 1e-300 and at(low).sum() < cap.sum():
        low /= 2
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if at(mid).sum() > seats:
            low = mid
        else:
            high = mid
    given = at(high)
    heap = [(-v[i] / (2 * given[i] + 1), i) for i in range(len(v)) if given[i] < cap[i]]
    heapq.heapify(heap)
    for _ in range(seats - int(given.sum())):
        _, i = heapq.heappop(heap)
        given[i] += 1
        if given[i] < cap[i]:
            heapq.heappush(heap, (-v[i] / (2 * given[i] + 1), i))
    return given.tolist()


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    target: float
    quota: int
    shards: int
    full: bool


def plan_sources(sizes: Sequence[tuple[str | None, int]], weight_of: Callable[[int, str | None], float],
                 block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
                 max_repeats: int = MAX_REPEATS) -> list[Source]:
    """Target, block quota and shard count of every source.

    Sources are ordered by code point, null last; ``weight_of(place, name)``
    gives their weights.  Targets share 100 % of all sizes.
    """
    ranked = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    size = [s for _, s in ranked]
    weight = [float(weight_of(k, name)) for k, (name, _) in enumerate(ranked)]
    target = capped_shares(size, weight, sum(size), max_repeats)
    # a source at its cap is taken whole; the others share the blocks
    full = [s > 0 and t >= max_repeats * s for s, t in zip(size, target)]
    votes = [0.0 if f else t for f, t in zip(full, target)]
    most = [-(-max_repeats * s // block_words) for s in size]
    quota = sainte_lague(votes, round(sum(votes) / block_words), most)
    return [Source(name, s, t, q, max(1, min(MAX_SHARDS, -(-s // shard_words))), f)
            for (name, s), t, q, f in zip(ranked, target, quota, full)]


def _sliced(begin: Column, size: Column, taken: Column, total: Column) -> Column:
    """Words of ``[begin, begin + size)`` among ``taken`` words of a ring of ``total`` words."""
    laps = F.floor(taken / F.greatest(total, F.lit(1)))
    rest = taken - laps * total
    return (laps * size + F.greatest(F.lit(0), F.least(rest - begin, size))).cast("long")


def _slim(id_col: str, text_col: str, source_col: str) -> list[Column]:
    size = F.coalesce(F.regexp_count(col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return [col(id_col).alias("doc_id"), col(source_col).cast("string").alias("source"), size.alias("size")]


def _laid_pieces(slim: DataFrame, weight_of: Callable[[int, str | None], float], block_words: int, shard_words: int,
                 max_repeats: int, seed: str) -> DataFrame:
    """``doc_id, source, size, piece, rows`` of every piece with its place in its shard.

    Copy j of a piece begins at ``begin + j * size``; ``shard_taken`` words of the
    ring of ``shard_size`` are taken.
    """
    spark = slim.sparkSession
    alike = stored(slim.groupBy("doc_id", "source", "size").agg(F.count("*").alias("all")))
    found = alike.groupBy("source").agg(F.sum(F.col("size") * F.col("all")).alias("n")).collect()
    planned = plan_sources([(r["source"], int(r["n"])) for r in found], weight_of, block_words, shard_words, max_repeats)
    plan = spark.createDataFrame(
        [(k, s.name, s.size, s.target, s.quota, s.shards, s.full) for k, s in enumerate(planned)],
        "sid int, name string, source_size long, target double, quota long, shards int, is_full boolean")
    plan = F.broadcast(plan) if len(planned) <= BROADCAST_SOURCES else plan
    pieces = alike.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("all") - 1) / PIECE_ROWS))))
    pieces = pieces.withColumn("rows", F.least(F.lit(PIECE_ROWS), F.col("all") - F.col("piece") * PIECE_ROWS)).drop("all")
    number = F.when(F.col("piece") > 0, F.col("piece").cast("string"))  # left out of the hashed text where null
    key = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), F.col("size").cast("string"), number))
    dealt = (pieces.join(plan, F.col("source").eqNullSafe(F.col("name"))).drop("name").withColumn("key", key)
             .withColumn("shard", (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % F.col("shards")).cast("int"))
             .withColumn("words", F.col("size") * F.col("rows")))
    shards = dealt.groupBy("sid", "shard", "quota", "is_full").agg(F.sum("words").alias("shard_size"))

    def share(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard")
        size = [int(x) for x in rows["shard_size"]]
        if rows["is_full"].iloc[0]:  # a source at its cap is taken whole, as often as may be
            taken = [max_repeats * x for x in size]
        else:
            got = sainte_lague(size, int(rows["quota"].iloc[0]), [-(-max_repeats * x // block_words) for x in size])
            taken = [min(g * block_words, max_repeats * x) for g, x in zip(got, size)]
        return pd.DataFrame({"sid": rows["sid"], "shard": rows["shard"], "shard_size": size, "shard_taken": taken})

    quotas = shards.groupBy("sid").applyInPandas(share, "sid int, shard int, shard_size long, shard_taken long")
    laid = Window.partitionBy("sid", "shard").orderBy("key", "doc_id", "size", "piece").rowsBetween(Window.unboundedPreceding, -1)
    return (dealt.drop("quota", "shards", "is_full").withColumn("begin", F.coalesce(F.sum("words").over(laid), F.lit(0)))
            .join(quotas, ["sid", "shard"]))


def _taken(place: Column) -> Column:
    """Words taken of copy ``place`` of a piece."""
    return _sliced(F.col("begin") + place * F.col("size"), F.col("size"), F.col("shard_taken"), F.col("shard_size"))


def mix(docs: DataFrame, weight_of: Callable[[int, str | None], float], id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", block_words: int = BLOCK_WORDS,
        shard_words: int = SHARD_WORDS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """``doc_id, size, source, source_size, target, taken``: one row per input row.

    ``taken`` counts the words the mix takes of a document, repeats included,
    never more than ``max_repeats`` times its size.  A null text has size 0 and
    is never taken; null is a source of its own, ordered last; a null id is kept.
    Each of the rows alike in id, source and size has its own share; which of
    them has which does not matter here.  An empty table gives no rows.  Equal
    input and seed give equal output whatever the partitioning.
    """
    pieces = _laid_pieces(docs.select(*_slim(id_col, text_col, source_col)), weight_of, block_words, shard_words, max_repeats, seed)
    copies = pieces.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
    return copies.select("doc_id", "size", "source", "source_size", "target", _taken(F.col("copy")).alias("taken"))


_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _cut_batch(texts: pd.Series, counts: pd.Series) -> pd.Series:
    def cut(text: str | None, n: int) -> str | None:
        last = next(islice(_WORDS.finditer(text), n - 1, None), None) if text and n > 0 else None
        return text[:last.end()] if last else ""
    return pd.Series([cut(t, int(n)) for t, n in zip(texts, counts)], dtype=object)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word; '' for a null text or n of 0."""
    return F.pandas_udf(_cut_batch, "string")(text, n)


def _numbered(slim: DataFrame, row: str) -> DataFrame:
    """``slim`` with ``nth``: the number of a row among those alike in id, source and size.

    Rows are numbered within their partition, and partitions of a key by the sums
    of their counts, so a key that holds most rows is numbered by many tasks.
    ``row`` is partition and place, as Spark numbers stored rows.
    """
    alike = ["doc_id", "source", "size"]
    held = slim.withColumn("lot", F.shiftright(row, 33))
    within = Window.partitionBy("lot", *alike).orderBy(row)
    numbered = held.withColumn("within", F.row_number().over(within) - 1)
    counts = held.groupBy("lot", *alike).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*alike).orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select(
        F.col("lot").alias("lot_"), *[F.col(c).alias(f"{c}_") for c in alike], "offset")
    same = F.col("lot") == F.col("lot_")
    for c in alike:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    return numbered.join(offsets, same).select(row, *alike, (F.col("offset") + F.col("within")).alias("nth"))


def mixed_rows(docs: DataFrame, weight_of: Callable[[int, str | None], float], id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source", chars_col: str | None = None,
               block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, max_repeats: int = MAX_REPEATS,
               seed: str = SEED) -> DataFrame:
    """The mix itself: ``docs`` with a row for each time a document is taken, all columns kept.

    A document taken 2.4 times its size gives two whole rows and one that is cut
    after its last word taken; one of which nothing is taken, as of a null or
    empty text, gives none.  Every row has its own share, also among rows alike:
    the rows are written to the checkpoint folder with a number each, and shares
    are given by it.  ``chars_col``, if given, gets the length of each row's text.
    An empty table gives no rows.
    """
    names = {x: fresh(docs.columns, f"_{x}") for x in ("row", "taken", "copy", "size", "number")}
    row = names["row"]
    held = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    slim = stored(held.select(F.col(row).alias("number"), *_slim(id_col, text_col, source_col)))
    pieces = _laid_pieces(slim.drop("number"), weight_of, block_words, shard_words, max_repeats, seed)
    asked = _numbered(slim, "number").select(
        "number", *[F.col(c).alias(f"{c}_") for c in ("doc_id", "source", "size")],
        F.floor(F.col("nth") / PIECE_ROWS).alias("piece_"), (F.col("nth") % PIECE_ROWS).alias("place"))
    same = F.col("piece") == F.col("piece_")
    for c in ("doc_id", "source", "size"):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    shares = (asked.where("size_ > 0").join(pieces, same)
              .select(F.col("number").alias(names["number"]), F.col("size").alias(names["size"]),
                      _taken(F.col("place")).alias(names["taken"])).where(F.col(names["taken"]) > 0))
    joined = held.join(shares, F.col(row) == F.col(names["number"]))
    size, taken = F.col(names["size"]), F.col(names["taken"])
    rows = joined.withColumn(names["copy"], F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(taken / size) - 1)))
    left = taken - F.col(names["copy"]) * size
    text = F.when(left >= size, col(text_col)).otherwise(first_words(F.when(left < size, col(text_col)), left))
    rows = rows.withColumn(text_col, text)
    if chars_col:
        rows = rows.withColumn(chars_col, F.length(col(text_col)).cast("long"))
    return rows.select(*[col(c) for c in docs.columns])
