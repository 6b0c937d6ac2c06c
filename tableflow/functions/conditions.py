"""Multi-branch if/else from an ordered list of (predicate, value)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.defaults import DEFAULT_NA

Predicate = Column | Callable[[DataFrame], Column]


def case_chain(
    df: DataFrame | None,
    conditions: Sequence[tuple[Predicate, Any]],
    default: Any = DEFAULT_NA,
) -> Column:
    """First matching predicate wins; a NULL predicate falls through.

    Builds one flat ``CASE WHEN`` (not nested ``otherwise`` calls) and never
    mutates ``conditions``.  Predicates may be Columns or ``lambda df: ...``.
    """
    def resolve(p: Predicate) -> Column:
        if isinstance(p, Column):
            return p
        if df is None:
            raise ValueError("callable predicates need the DataFrame")
        return p(df)

    def as_col(v: Any) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    if not conditions:
        return as_col(default)
    expr = None
    for pred, value in conditions:
        expr = F.when(resolve(pred), as_col(value)) if expr is None else expr.when(resolve(pred), as_col(value))
    return expr.otherwise(as_col(default))
