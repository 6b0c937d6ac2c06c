"""URL filter rules by hashed host-suffix / path-prefix expressions (DataFrame functions only).

A rule is a host and a path prefix.  A URL is expanded into the expressions
``host suffix + path prefix`` that some rule could equal, and into the words of its
host; the first four bytes of their SHA-256 are equi-joined with those of the rules
and of the words that block, and full digests confirm a match.  The longest matching
rule decides, then the action that sorts last; a word decides where no rule does.

The lengths that rules have are data, not expressions: the plan is the same for ten
rules and for a hundred thousand.  An expression that very many URLs share (``org/``)
is spread over salts, as there is one rule to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm.common import ascii_lower, col, fresh, stored
from tableflow.llm.graph import spread_join

#: Hex digits of the digest that are joined on: four bytes.
PREFIX_HEX = 8
#: Words that block a URL without a rule when they are a whole token of its host.
BLOCKED_HOST_TOKENS = ("adult", "betting", "bets", "casino", "escort", "gambling", "jackpot", "poker", "porn",
                       "slots", "viagra", "xxx")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/ ? #``, A-Z lower-cased; '' without ``://``."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From the host's end up to ``? #``; '' without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``(action, rule)`` pairs such as ``("block", "example.org/es/")`` as a rule frame."""
    return spark.createDataFrame(list(rules), "action string, rule string")


#: What the expressions of words begin with; no host has it.
_WORD = "word:"


def _hashed(rules: DataFrame, words: Sequence[str]) -> DataFrame:
    """Rules and blocking words by the short prefix of their digest; ``_n`` is a rule's length, 0 for a word."""
    spark = rules.sparkSession
    known = rules.where(F.col("rule").isNotNull()).select(
        F.col("action").alias("_action"), F.col("rule").alias("_rule"), F.sha2("rule", 256).alias("_rule_digest"),
        F.length("rule").alias("_n"))
    blocking = spark.createDataFrame([(w,) for w in words], "word string").select(
        F.lit("block").alias("_action"), F.lit(None).cast("string").alias("_rule"),
        F.sha2(F.concat(F.lit(_WORD), "word"), 256).alias("_rule_digest"), F.lit(0).alias("_n"))
    return known.union(blocking).withColumn("_short", F.substring("_rule_digest", 1, PREFIX_HEX))


def _lengths(rules: DataFrame) -> dict[int, list[int]]:
    """Path lengths of the rules by the number of labels of their host; a row per different pair."""
    host = F.substring_index("rule", "/", 1)
    pairs = rules.where(F.col("rule").isNotNull()).select(
        F.size(F.split(host, r"\.")).alias("labels"), (F.length("rule") - F.length(host)).alias("chars")).distinct()
    found: dict[int, list[int]] = {}
    for r in pairs.collect():
        found.setdefault(r["labels"], []).append(r["chars"])
    return {n: sorted(found[n]) for n in sorted(found)}


def _expressions(lengths: dict[int, list[int]]) -> Column:
    """Digests of all expressions of a row's ``host`` and ``path`` that a rule could have, and of its host's words."""
    words = F.transform(F.array_distinct(F.split("host", r"[.\-]")), lambda w: F.sha2(F.concat(F.lit(_WORD), w), 256))
    if not lengths:
        return words
    chars = F.create_map(*[x for n, c in lengths.items() for x in (F.lit(n), F.lit(c))])
    labels, long = F.size(F.split("host", r"\.")), F.length("path")

    def of_suffix(n: Column) -> Column:
        suffix = F.call_function("substring_index", F.col("host"), F.lit("."), -n)
        return F.transform(F.filter(F.element_at(chars, n), lambda c: c <= long),
                           lambda c: F.sha2(F.concat(suffix, F.substr("path", F.lit(1), c)), 256))

    fitting = F.when(F.col("host") != "", F.filter(F.lit(list(lengths)), lambda n: n <= labels)).otherwise(
        F.array().cast("array<int>"))
    return F.concat(F.flatten(F.transform(fitting, of_suffix)), words)


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          blocked_words: Sequence[str] = BLOCKED_HOST_TOKENS) -> DataFrame:
    """``id_col, host, path, rule, verdict``: one row per input row.

    A rule fits its host and all subdomains when the path starts with the rule's
    path.  Without a rule the verdict is ``block`` if a word of the host (split
    at ``.`` and ``-``) is in ``blocked_words``, else ``allow``.  A null URL or
    one without ``://`` has empty host and path and is allowed.  Repeated rows
    and null ids stay; rules that differ only in action resolve to ``block``; a
    null rule is none; an empty table gives no rows; other columns are not carried.
    Only as many suffixes and prefixes are expanded as the rules have lengths, so
    long URLs cost no more than short ones.  Host and path are written to the
    checkpoint folder, with a number for each row.
    """
    known = _hashed(rules, blocked_words)
    out_id = fresh(["host", "path", "rule", "verdict"], id_col)
    parts = stored(pages.select(F.monotonically_increasing_id().alias("_row"), col(id_col).alias("_id"),
                                host_of(col(url_col)).alias("host"), path_of(col(url_col)).alias("path")))
    asked = parts.select("_row", F.explode(_expressions(_lengths(rules))).alias("_digest")).withColumn(
        "_short", F.substring("_digest", 1, PREFIX_HEX))
    fits = spread_join(asked, known, "_short", "_row").where(F.col("_digest") == F.col("_rule_digest"))
    best = fits.groupBy(F.col("_row").alias("_judged")).agg(F.max(F.struct(
        F.col("_n").alias("n"), F.col("_action").alias("action"), F.col("_rule").alias("rule"))).alias("_best"))
    return parts.join(best, F.col("_row") == F.col("_judged"), "left").select(
        F.col("_id").alias(out_id), "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.action"), F.lit("allow")).alias("verdict"))
