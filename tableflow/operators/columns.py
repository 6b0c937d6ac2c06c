"""Projection / column operators, each compiled to a single ``select``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.defaults import (
    DEFAULT_AMOUNT_GROUP,
    DEFAULT_AMOUNT_PATTERN,
    DEFAULT_AMOUNT_STRIP,
    DEFAULT_NA,
    DEFAULT_TIME_FORMAT,
)
from tableflow.functions.casting import safe_try_cast, try_text_to_timestamp
from tableflow.functions.conditions import Predicate, case_chain
from tableflow.functions.text import safe_name

TIMESTAMP_TYPES = ("timestamp", "timestamp_ltz", "timestamp_ntz")


def _q(name: str) -> str:
    """Backtick-quote a column name (names may hold blanks or dots)."""
    return "`" + name.replace("`", "``") + "`"


def rename_cols(df: DataFrame, rename_map: Mapping[str, str]) -> DataFrame:
    """Rename by map; names not in ``df`` are ignored.

    Applied one after another like repeated ``withColumnRenamed`` (so a chain
    ``{'a': 'b', 'b': 'c'}`` moves ``a`` to ``c``), but planned as one
    ``select``.  Matching is case-insensitive like Spark's resolver.
    """
    names = list(df.columns)
    for old, new in rename_map.items():
        names = [new if n.lower() == old.lower() else n for n in names]
    if names == list(df.columns):
        return df
    return df.select(*[F.col(_q(o)).alias(n) for o, n in zip(df.columns, names)])


def drop_cols(df: DataFrame, drop: Iterable[str]) -> DataFrame:
    """Drop a list of columns; names not in ``df`` are ignored."""
    return df.drop(*list(drop))


def cast_schema(
    df: DataFrame,
    schema: Mapping[str, str],
    time_format: str = DEFAULT_TIME_FORMAT,
    specify_format: Mapping[str, str] | None = None,
) -> DataFrame:
    """Cast columns by a declared ``{column: type}`` map.

    Timestamp columns are parsed with ``time_format`` (or their own entry in
    ``specify_format``) to whole seconds; one-digit days and months and text
    after the fields are accepted.  Text to an integral type keeps the part
    before the point.  Bad values and overflow become NULL under ANSI mode too.
    Columns not in the map are kept; map entries not in ``df`` are ignored.
    """
    specify_format = specify_format or {}
    types = dict(df.dtypes)
    out = []
    for name in df.columns:
        target = schema.get(name)
        c = F.col(_q(name))
        if target is None:
            out.append(c)
            continue
        if target.lower() in TIMESTAMP_TYPES:
            source = types.get(name, "")
            if source == "string":
                fmt = specify_format.get(name, time_format)
                parsed = try_text_to_timestamp(c, fmt)
            elif source.startswith(("timestamp", "date")):
                parsed = c.cast("timestamp")  # already a point in time: no pattern
            else:
                parsed = c.try_cast("timestamp")
            # whole seconds, like a unix_timestamp round trip
            out.append(F.date_trunc("second", parsed).cast(target).alias(name))
        else:
            out.append(safe_try_cast(c, target, types.get(name)).alias(name))
    return df.select(*out)


def select_rename(sel: Sequence[str] | str = "*", rename: Mapping[str, str] | None = None) -> list[Any]:
    """Projection of a join's right side: what to select, each under its new name.

    The names are those renamed, in the map's order, then what else ``sel`` asks
    for.  A single name may be given as text; ``'*'`` adds nothing to a rename
    map and means every column without one.
    """
    asked = [sel] if isinstance(sel, str) else list(sel)
    if not rename:
        return asked
    new_names = {**rename, **{name: None for name in asked if name != "*" and name not in rename}}
    return [name if new is None else F.col(_q(name)).alias(new) for name, new in new_names.items()]


def with_case(
    df: DataFrame,
    name: str,
    conditions: Sequence[tuple[Predicate, Any]],
    default: Any = DEFAULT_NA,
) -> DataFrame:
    """Add/replace ``name`` with a first-match-wins case chain."""
    return df.withColumn(name, case_chain(df, conditions, default))


def round_cols(df: DataFrame, scales: Mapping[str, int]) -> DataFrame:
    """Round columns HALF_UP; text columns are read as double first."""
    types = dict(df.dtypes)
    repl = {}
    for name, scale in scales.items():
        if name not in types:
            continue
        c = F.col(_q(name))
        if types[name] == "string":
            c = safe_try_cast(c, "double", "string")
        repl[name] = F.round(c, scale)
    return df.withColumns(repl) if repl else df


def parse_amount(
    df: DataFrame,
    src: str,
    dst: str,
    pattern: str = DEFAULT_AMOUNT_PATTERN,
    group: int = DEFAULT_AMOUNT_GROUP,
    strip: str = DEFAULT_AMOUNT_STRIP,
    to_type: str = "bigint",
) -> DataFrame:
    """Pull a number out of text like ``RM 265,000``: extract, strip, cast.

    No match gives ``''`` from ``regexp_extract`` and so NULL after the cast.
    """
    c = F.regexp_extract(F.col(_q(src)), pattern, group)
    if strip:
        c = F.regexp_replace(c, strip, "")
    return df.withColumn(dst, safe_try_cast(c, to_type, "string"))


def safe_names(df: DataFrame) -> DataFrame:
    """Rename columns so that file formats and catalogs accept them."""
    new = [safe_name(c) for c in df.columns]
    dup = sorted({n for n in new if new.count(n) > 1})
    if dup:
        raise ValueError(f"safe names clash: {dup}")
    return df.toDF(*new)


def duplicate_names(columns: Iterable[str]) -> list[str]:
    """Names that occur more than once (case-insensitive), in first-seen order."""
    seen: set[str] = set()
    dups: list[str] = []
    for c in columns:
        k = c.lower()
        if k in seen and c not in dups:
            dups.append(c)
        seen.add(k)
    return dups

