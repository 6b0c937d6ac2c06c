"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import stored

#: Far above what the alternation needs (logarithmic); reaching it is an error.
MAX_ROUNDS = 60


#: Copies of the one row per key in :func:`spread_join`.
SALTS = 4


def spread_join(rows: DataFrame, single: DataFrame, key: str, by: str) -> DataFrame:
    """``rows`` joined by ``key`` with ``single``, which has one row for each key.

    Both sides are dealt anew by key and a salt from ``by``: rows of a very frequent
    key are spread, and what is left of a skew is split by adaptive execution.
    """
    copies = single.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    return salted.join(copies, [key, "_salt"]).drop("_salt")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return spread_join(both.where("b > a"), least, "a", "b").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = spread_join(down, least, "a", "b").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node of an edge ``a, b`` (long).

    Loops and repeated edges change nothing; nulls are left out.  Each round is
    written to the checkpoint folder, so lineage stays short.
    """
    now = stored(edges.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
                 .where("a <> b").distinct())
    for _ in range(MAX_ROUNDS):
        if _settled(now):
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
        now = stored(_small_star(_large_star(now)))
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _settled(edges: DataFrame) -> bool:
    """Every node is tied to one smaller node at most, which is tied to none: all are stars."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")),
                                          F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("e"))
    ties = ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.count("*").alias("all"))
    return ties.where("up > 1 OR (up = 1 AND all > 1)").isEmpty()
