"""Named aggregations from option dicts, distinct, top-n."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.operators.columns import _q

# The aggregation names accepted in option dicts.
AGG_FUNCS = {
    "sum": F.sum,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "avg": F.avg,
    "countDistinct": F.count_distinct,
    "approxCountDistinct": F.approx_count_distinct,
}


def agg_expr(column: str, fn: str) -> Column:
    try:
        f = AGG_FUNCS[fn]
    except KeyError:
        raise ValueError(f"unknown aggregation {fn!r}; allowed: {sorted(AGG_FUNCS)}") from None
    return f(F.col(_q(column)))


def agg_columns(agg_opts: Mapping[str, str | Mapping[str, str]]) -> list[Column]:
    """``{col: fn}`` keeps the column name; ``{col: {alias: fn}}`` names each."""
    out: list[Column] = []
    for column, opt in agg_opts.items():
        if isinstance(opt, str):
            out.append(agg_expr(column, opt).alias(column))
        elif isinstance(opt, Mapping):
            out.extend(agg_expr(column, fn).alias(alias) for alias, fn in opt.items())
        else:
            raise TypeError(f"aggregation option for {column!r} must be str or dict")
    return out


def aggregate(
    df: DataFrame,
    group_cols: str | Sequence[str],
    agg_opts: Mapping[str, str | Mapping[str, str]],
) -> DataFrame:
    """Group by a name or a list (empty list = one global group) and aggregate.

    Spark plans a partial (map-side) aggregate before the shuffle, so a hot
    group costs one row per input partition in the exchange.
    """
    keys = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    return df.groupBy(*[F.col(_q(k)) for k in keys]).agg(*agg_columns(agg_opts))


def distinct_values(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*[_q(c) for c in cols]) if cols else df).distinct()


def top_n(
    df: DataFrame,
    n: int,
    by: str | Sequence[str],
    ascending: bool | Sequence[bool] = False,
    tie_breaker: Sequence[str] = (),
) -> DataFrame:
    """First ``n`` rows by a sort key (plus unique tie-breakers, ascending).

    Planned as ``TakeOrderedAndProject``: each partition keeps its own top
    ``n``, so only ``n x partitions`` rows meet in the final task.
    """
    keys = [by] if isinstance(by, str) else list(by)
    asc = [ascending] * len(keys) if isinstance(ascending, bool) else list(ascending)
    order = [F.col(_q(k)).asc() if a else F.col(_q(k)).desc() for k, a in zip(keys, asc)]
    order += [F.col(_q(t)).asc() for t in tie_breaker]
    return df.orderBy(*order).limit(n)
