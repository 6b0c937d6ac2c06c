"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one ``failed_bits`` long, bit k set when rule k fails.  A policy is a named
set of rules, that is a mask: applying it is ``failed_bits & mask``, so a new
policy version, or the question what one rule costs, never reads a text again.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import col, fresh

#: The measurements of one text, in the order of the ledger's columns.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
            "n_repeat_words", "n_adjacent", "n_letters", "n_capitals")
WINDOW = 8
_SPACE, _SYMBOLS = b" \t\n\r\x0b\x0c", b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123))


@dataclass(frozen=True)
class Rule:
    """Fails where the SQL condition over the measurements holds."""

    name: str
    fails: str


#: Bit k belongs to rule k; append new rules, never reorder them.
RULES = (
    Rule("too_few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbol_share", "100 * n_symbols > 30 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("word_repeats_previous", "100 * n_adjacent > 20 * n_words"),
    Rule("shouting", "100 * n_capitals > 50 * n_letters"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
)

#: Versioned policies: the rules that reject.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "base-1": ("too_few_words", "repeated_windows"),
    "full-1": tuple(r.name for r in RULES),
}


def repeated_window_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more in the list.

    Windows are compared exactly: ranks of windows of 1, 2, 4, ... words are
    combined pairwise, so equal ranks mean equal windows.
    """
    n = len(words)
    if n <= width:
        return 0
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    if len(seen) == n:
        return 0
    span = 1
    while span < width:
        step = min(span, width - span)
        key = rank[:-step] * n + rank[step:]
        distinct, rank = np.unique(key, return_inverse=True)
        if len(distinct) == len(key):
            return 0
        span += step
    starts = np.flatnonzero(np.bincount(rank)[rank] > 1)
    edges = np.zeros(n + 1, np.int64)
    edges[starts] += 1
    edges[starts + width] -= 1
    return int((np.cumsum(edges[:n]) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text; a null text is an empty one."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]

    def count(chars: bytes) -> int:
        return len(data) - len(data.translate(None, chars))

    return (len(words), len(text) - count(_SPACE), count(_SYMBOLS), len(lines), len(lines) - len(set(lines)),
            repeated_window_words(words), sum(map(bytes.__eq__, words, words[1:])),
            count(_LETTERS), count(_CAPITALS))


def _measure_batch(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=list(MEASURES))


def _measured(text: Column) -> Column:
    return F.pandas_udf(_measure_batch, ", ".join(f"{m} long" for m in MEASURES))(text)


def _bits(rules: Iterable[Rule], held: str | None = None) -> Column:
    """The failure bits of the measurements, which stand in the struct ``held`` if given."""
    total = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        fails = rule.fails if held is None else re.sub(rf"\b({'|'.join(MEASURES)})\b", rf"{held}.\1", rule.fails)
        total = total.bitwiseOR(F.when(F.expr(fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return total


def policy_mask(names: Iterable[str], rules: tuple[Rule, ...] = RULES) -> int:
    places = {r.name: k for k, r in enumerate(rules)}
    return sum(1 << places[n] for n in set(names))


def evaluate_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger: ``id_col``, the measurements and ``failed_bits``, one row per input row.

    A null or empty text has all measurements 0 (and fails ``too_few_words``);
    repeated rows stay repeated; a null id stays null; an empty table gives an
    empty ledger; other columns of ``docs`` are not carried.  An id column named
    like one of the ledger's gets another name.
    """
    out_id = fresh([*MEASURES, "failed_bits"], id_col)
    measured = docs.select(col(id_col).alias("_id"), _measured(col(text_col)).alias("_m"))
    return measured.select("_id", "_m.*").withColumn("failed_bits", _bits(rules)).withColumnRenamed("_id", out_id)


def apply_policy(ledger: DataFrame, mask: int, kept_col: str = "kept") -> DataFrame:
    """``kept_col``: no rule of the mask failed."""
    return ledger.withColumn(kept_col, F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long")) == 0)


def ablations(ledger: DataFrame, mask: int, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: documents it rejects, and those that only it rejects.

    The ledger is first summed by its distinct bit patterns (2 ** rules at most),
    so the per-rule step reads a handful of rows whatever the corpus holds.
    """
    patterns = (ledger.select(F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits"))
                .groupBy("bits").agg(F.count("*").alias("n")))
    chosen = [(k, r.name) for k, r in enumerate(rules) if mask >> k & 1]
    table = F.explode(F.array(*[F.struct(F.lit(1 << k).cast("long").alias("bit"), F.lit(n).alias("rule"))
                                for k, n in chosen])).alias("r")
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (patterns.select("bits", "n", table).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("rejected"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only_this_rule"),
                 F.sum(F.when((F.col("bits") == 0) | (F.col("bits") == F.col("r.bit")), F.col("n")).otherwise(0))
                 .alias("kept_without")))


def keep_good(docs: DataFrame, mask: int, text_col: str = "text",
              rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs``, all columns, that the policy keeps.

    A null or empty text fails ``too_few_words``; null ids and repeated rows are
    judged like any others; an empty table stays empty.
    """
    held = fresh(docs.columns, "_ledger")
    marked = docs.withColumn(held, _measured(col(text_col)))
    return marked.where(_bits(rules, held).bitwiseAND(F.lit(mask).cast("long")) == 0).drop(held)
