"""Joins: dimension joins, first-match lookups, fan-out joins, referential checks.

No side is hinted for broadcast here: which side is broadcast is decided by the planner from
measured sizes (static ``autoBroadcastJoinThreshold`` on scan statistics, and AQE on the
actual shuffle output at run time). A catalogue that outgrows the threshold therefore falls
back to a sort-merge join, and AQE's skew-join handling splits hot log keys on the large side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.dedupe import keep_first
from lakemart.sources.sinks import KEY_HASH, hashed_key


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def join_on_keys(left: DataFrame, right: DataFrame, left_keys, right_keys, how: str = "inner") -> DataFrame:
    """Equi-join on differently named key lists; every match is kept (fan-out)."""
    left_keys, right_keys = _names(left_keys), _names(right_keys)
    cond: Column | None = None
    for lk, rk in zip(left_keys, right_keys, strict=True):
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return left.join(right, cond, how)


def first_match_dim(dim: DataFrame, keys, order_by: Sequence, take) -> DataFrame:
    """Reduce a lookup dimension to exactly one row per lookup key: the first in ``order_by``."""
    return keep_first(dim, keys, order_by, cols=_names(take))


def lookup_first(left: DataFrame, dim: DataFrame, left_keys, dim_keys, order_by: Sequence, take,
                 how: str = "left") -> DataFrame:
    """Resolve text fields of ``left`` to ids in ``dim``: first match only, NULL ids on a miss.

    The dimension is reduced to one row per key before the join, so the log side never fans
    out and every log row is kept (``how='left'``). A NULL key never matches.
    """
    left_keys, dim_keys, take = _names(left_keys), _names(dim_keys), _names(take)
    renamed = {k: f"_lk{i}" for i, k in enumerate(dim_keys)}
    reduced = first_match_dim(dim, dim_keys, order_by, take)
    reduced = reduced.select(*[F.col(k).alias(renamed[k]) for k in dim_keys], *take)
    cond: Column | None = None
    for lk, dk in zip(left_keys, dim_keys, strict=True):
        c = left[lk] == reduced[renamed[dk]]
        cond = c if cond is None else cond & c
    out = left.join(reduced, cond, how)
    return out.drop(*renamed.values())


def _same(a: Column, b: Column) -> Column:
    """Equality that the planner does not take for one more join key, which would need another distribution."""
    return (a >= b) & (a <= b)


def join_bucketed(left: DataFrame, right: DataFrame, left_keys, right_keys, how: str = "inner") -> DataFrame:
    """Equi-join of two tables stored in the same number of buckets of these keys: bucket by bucket, without a
    shuffle. Composite keys are joined on their stored hash, and the columns are compared on its matches only."""
    left_keys, right_keys = _names(left_keys), _names(right_keys)
    if len(left_keys) == 1:
        return join_on_keys(left, right, left_keys, right_keys, how)
    if hashed_key(left) != left_keys or hashed_key(right) != right_keys:
        raise ValueError("both tables must be bucketed by the hash of the join's columns")
    cond = left[KEY_HASH] == right[KEY_HASH]
    for lk, rk in zip(left_keys, right_keys, strict=True):
        cond = cond & _same(left[lk], right[rk])
    return left.join(right, cond, how)


def lookup_first_bucketed(left: DataFrame, dim: DataFrame, left_keys, dim_keys, order_by: Sequence, take) -> DataFrame:
    """``lookup_first`` of two tables stored in the same buckets of their keys: the first match per key and the
    left join both use the stored layout."""
    left_keys, dim_keys, take = _names(left_keys), _names(dim_keys), _names(take)
    by = [KEY_HASH, *dim_keys] if len(dim_keys) > 1 else dim_keys
    reduced = keep_first(dim, by, order_by, cols=take)
    reduced = reduced.select(*[F.col(c).alias(f"_dim{i}") for i, c in enumerate(by)], *take)
    on = left[KEY_HASH if len(dim_keys) > 1 else left_keys[0]] == reduced["_dim0"]
    if len(dim_keys) > 1:
        for i, lk in enumerate(left_keys):
            on = on & _same(left[lk], reduced[f"_dim{i + 1}"])
    return left.join(reduced, on, "left").drop(*[f"_dim{i}" for i in range(len(by))], KEY_HASH)


def fk_violations(fact: DataFrame, dim: DataFrame, fact_key, dim_key=None) -> DataFrame:
    """Fact rows whose non-NULL foreign key has no row in the dimension (left anti join)."""
    fact_key = _names(fact_key)
    dim_key = _names(dim_key) if dim_key is not None else fact_key
    keys = dim.select(*[F.col(d).alias(f) for f, d in zip(fact_key, dim_key, strict=True)])
    present = fact
    for k in fact_key:
        present = present.where(F.col(k).isNotNull())
    return present.join(keys, fact_key, "left_anti")


def param_lookup(spark, sql: str, **args) -> DataFrame:
    """One parameterised lookup, bound as named SQL parameters (never by string formatting)."""
    return spark.sql(sql, args=args)
