"""Equi-joins driven by a key spec: one name, a list of names, or a map.

The physical strategy is left to Catalyst/AQE: a side whose estimated size is
under ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, anything larger
is a sort-merge join, and AQE splits skewed partitions at run time.  No hint
is forced, so a side that grows with the data is never broadcast blindly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.operators.columns import _q, duplicate_names, select_rename
from tableflow.session import ensure_checkpoint_dir

JOIN_TYPES = ("inner", "left", "right", "full", "left_semi", "left_anti")
_ALIASES = {
    "outer": "full", "fullouter": "full", "full_outer": "full",
    "leftouter": "left", "left_outer": "left", "rightouter": "right",
    "right_outer": "right", "semi": "left_semi", "leftsemi": "left_semi",
    "anti": "left_anti", "leftanti": "left_anti",
}

JoinKeys = str | Sequence[str] | Mapping[str, str]


def _how(how: str) -> str:
    h = _ALIASES.get(how.lower(), how.lower())
    if h not in JOIN_TYPES:
        raise ValueError(f"join type {how!r} not in {JOIN_TYPES}")
    return h


def join_alias(on: JoinKeys, rename: Mapping[str, str] | None = None) -> JoinKeys:
    """Re-point right keys of a ``{left: right}`` map at their renamed names.

    Returns a new map (the input is never changed); names and lists pass
    through unchanged.
    """
    if not rename or not isinstance(on, Mapping):
        return on
    return {left: rename.get(right, right) for left, right in on.items()}


def join_on(
    left: DataFrame,
    right: DataFrame,
    on: JoinKeys,
    how: str = "left",
    drop: bool = True,
    suffix: str | None = None,
) -> DataFrame:
    """Join on shared name(s) (``USING``) or on a ``{left: right}`` key map.

    Map form: a right key that also names a left column is renamed with a
    trailing ``_`` first; right keys are dropped after the join unless
    ``drop=False``.  For ``right``/``full`` joins the kept left key is
    ``coalesce(left, right)`` so right-only rows keep their key.  Non-key
    columns present on both sides raise, unless ``suffix`` renames the right
    one.  NULL keys never match.
    """
    how = _how(how)
    if isinstance(on, str) or (isinstance(on, Sequence) and not isinstance(on, Mapping)):
        keys = [on] if isinstance(on, str) else list(on)
        if how not in ("left_semi", "left_anti"):
            right = _guard_clash(left, right, set(keys), suffix)
        return left.join(right, on=keys, how=how)
    if not isinstance(on, Mapping) or not on:
        raise TypeError("on must be a column name, a list of names or a non-empty {left: right} map")

    left_cols = set(left.columns)
    mapping: dict[str, str] = {}
    renames: dict[str, str] = {}
    for lk, rk in on.items():
        new_rk = rk + "_" if (lk == rk or rk in left_cols) else rk
        if new_rk != rk:
            renames[rk] = new_rk
        mapping[lk] = new_rk
    if renames:
        right = right.select(
            *[F.col(_q(c)).alias(renames.get(c, c)) for c in right.columns]
        )
    if how not in ("left_semi", "left_anti"):
        right = _guard_clash(left, right, set(mapping.values()), suffix)
    # aliases keep the condition unambiguous when both sides come from one frame
    l_alias, r_alias = left.alias("_l"), right.alias("_r")
    cond = [F.col("_l." + _q(lk)) == F.col("_r." + _q(rk)) for lk, rk in mapping.items()]
    joined = l_alias.join(r_alias, on=cond, how=how)
    if how in ("left_semi", "left_anti"):
        return joined.select(*[F.col("_l." + _q(c)).alias(c) for c in left.columns])
    out = []
    for c in left.columns:
        lc = F.col("_l." + _q(c))
        if how in ("right", "full") and c in mapping:
            lc = F.coalesce(lc, F.col("_r." + _q(mapping[c])))
        out.append(lc.alias(c))
    right_keys = set(mapping.values())
    for c in right.columns:
        if drop and c in right_keys:
            continue
        out.append(F.col("_r." + _q(c)).alias(c))
    return joined.select(*out)


def _guard_clash(left: DataFrame, right: DataFrame, keys: set[str], suffix: str | None) -> DataFrame:
    lower_left = {c.lower() for c in left.columns}
    clash = [c for c in right.columns if c.lower() in lower_left and c not in keys]
    if not clash:
        return right
    if suffix is None:
        raise ValueError(
            f"columns on both join sides: {clash}; select them away or pass suffix="
        )
    return right.select(
        *[F.col(_q(c)).alias(c + suffix if c in clash else c) for c in right.columns]
    )


def join_mapped(
    left: DataFrame,
    right: DataFrame,
    on: JoinKeys,
    how: str = "left",
    sel: Sequence[str] | str = "*",
    rename: Mapping[str, str] | None = None,
    drop: bool = True,
    suffix: str | None = None,
) -> DataFrame:
    """Select/rename the right side, re-point the key map, then join.

    ``join_mapped(l, r, on={'a': 'b'}, sel=[...], rename={'b': 'B'})`` is the
    one-call form of ``join_on(l, r.select(*select_rename(sel, rename)),
    join_alias(on, rename))``.
    """
    r = right.select(*select_rename(sel, rename))
    dups = duplicate_names(r.columns)
    if dups:
        raise ValueError(f"duplicate right-side columns after rename: {dups}")
    return join_on(left, r, join_alias(on, rename), how=how, drop=drop, suffix=suffix)


def hot_keys(df: DataFrame, keys: Sequence[str], min_share: float = 0.01) -> list[tuple]:
    """Key values holding at least ``min_share`` of the rows of ``df``.

    One job: a distributed count per key, compared with its own total.  As each
    value has ``ceil(total * min_share)`` rows or more, at most ``1 / min_share``
    of them can pass, so the list brought to the driver has a proven bound.
    """
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be in (0, 1]")
    counts = df.groupBy(*[F.col(_q(k)) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    least = counts.agg(F.ceil(F.sum("_n") * F.lit(min_share)).alias("_least")).scalar()
    return [tuple(r[k] for k in keys) for r in counts.filter(F.col("_n") >= least).collect()]


def _one_of(df: DataFrame, keys: Sequence[str], values: Sequence[tuple]) -> Column:
    """Whether a row's key is one of a (bounded) list of values; never NULL."""
    if not values:
        return F.lit(False)
    types = dict(df.dtypes)
    known = F.array(*[F.struct(*[F.lit(v).cast(types[k]).alias(k) for k, v in zip(keys, h)]) for h in values])
    return F.coalesce(F.array_contains(known, F.struct(*[F.col(_q(k)) for k in keys])), F.lit(False))


def _present(df: DataFrame, keys: Sequence[str], values: Sequence[tuple]) -> set[tuple]:
    """Which of a bounded list of key values have a row: one flag per key, combined map-side."""
    found = df.where(_one_of(df, keys, values)).select(*[_q(k) for k in keys]).distinct()
    return {tuple(r) for r in found.collect()}


def _dealt(df: DataFrame, keys: Sequence[str], own: str, other: str, split_here: Sequence[tuple],
           split_there: Sequence[tuple], buckets: int) -> DataFrame:
    """Rows of hot keys with their own bucket, copied to all buckets that the other side has for their key."""
    here = F.when(_one_of(df, keys, split_here), F.pmod(F.col(_PLACE), F.lit(buckets)).cast("int")).otherwise(F.lit(0))
    last = F.when(_one_of(df, keys, split_there), F.lit(buckets - 1)).otherwise(F.lit(0))
    return df.withColumn(own, here).withColumn(other, F.explode(F.sequence(F.lit(0), last))).drop(_PLACE)


_PLACE, _LEFT_BUCKET, _RIGHT_BUCKET = "_skew_place", "_skew_left", "_skew_right"


def split_skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    hot: Sequence[tuple] | None = None,
    buckets: int = 32,
    min_share: float = 0.01,
) -> DataFrame:
    """Equi-join of any type that spreads hot key values of either side over ``buckets``.

    A key is hot where it holds ``min_share`` of the rows of a side; ``hot`` names
    hot keys of the left side instead, and then only those are split.  Both sides
    are written to the checkpoint folder once, each row with its place there, and
    all parts are read from that: a repeated task cannot deal rows differently.
    Rows of a hot key are dealt to buckets by their place on the side where it is
    hot and copied to all buckets on the other, so one key is joined by many
    tasks.  In an equi-join a row has a partner exactly if its key has a row on
    the other side; one flag per hot key tells which hot rows stay without one,
    so ``left``, ``right``, ``full``, semi and anti joins need no look at the
    copies.  Rows with a NULL in their key match nothing and are not shuffled.
    Cold keys take the ordinary join.  The result equals ``left.join(right, on, how)``.
    """
    how = _how(how)
    keys = [on] if isinstance(on, str) else list(on)
    one_sided = how in ("left_semi", "left_anti")
    if one_sided:
        right = right.select(*[_q(k) for k in keys])
    else:
        right = _guard_clash(left, right, set(keys), None)
    ensure_checkpoint_dir(left.sparkSession)
    # partition and row number: what the place was when the row was written
    left = left.withColumn(_PLACE, F.monotonically_increasing_id()).checkpoint()
    right = right.withColumn(_PLACE, F.monotonically_increasing_id()).checkpoint()
    split_left = list(hot) if hot is not None else hot_keys(left, keys, min_share)
    split_right = [] if hot is not None or one_sided else hot_keys(right, keys, min_share)
    split_left, split_right = ([h for h in split if all(v is not None for v in h)] for split in (split_left, split_right))
    values = list(dict.fromkeys([*split_left, *split_right]))

    no_null = F.lit(True)
    for k in keys:
        no_null = no_null & F.col(_q(k)).isNotNull()

    def cold(df: DataFrame) -> DataFrame:
        return df.where(no_null & ~_one_of(df, keys, values)).drop(_PLACE)

    def hot_rows(df: DataFrame, of: Sequence[tuple] | None = None) -> DataFrame:
        return df.where(_one_of(df, keys, values if of is None else of))

    parts = [cold(left).join(cold(right), on=keys, how=how)]
    names = parts[0].columns
    in_left, in_right = (_present(df, keys, values) for df in (left, right)) if values else (set(), set())
    if values and not one_sided:
        grid = [*keys, _LEFT_BUCKET, _RIGHT_BUCKET]
        left_hot = _dealt(hot_rows(left), keys, _LEFT_BUCKET, _RIGHT_BUCKET, split_left, split_right, buckets)
        right_hot = _dealt(hot_rows(right), keys, _RIGHT_BUCKET, _LEFT_BUCKET, split_right, split_left, buckets)
        parts.append(left_hot.join(right_hot, on=grid, how="inner").drop(_LEFT_BUCKET, _RIGHT_BUCKET))
    if how == "left_semi":
        parts.append(hot_rows(left, [v for v in values if v in in_right]))
    if how in ("left", "full", "left_anti"):
        parts += [left.where(~no_null), hot_rows(left, [v for v in values if v not in in_right])]
    if how in ("right", "full"):
        parts += [right.where(~no_null), hot_rows(right, [v for v in values if v not in in_left])]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part.drop(_PLACE), allowMissingColumns=True)
    return out.select(*[_q(c) for c in names])
