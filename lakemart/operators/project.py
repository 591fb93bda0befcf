"""Projections, renames, filters, ordered limits and unions (thin, declarative wrappers).

They exist so a pipeline reads as the list of its steps; Catalyst collapses the chains, pushes
the filters into the Parquet scan and prunes the columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.sources.sinks import KEY_HASH, hashed_key


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def with_computed(df: DataFrame, **exprs: Column | str) -> DataFrame:
    """All columns plus computed ones (a SQL string is parsed as an expression)."""
    return df.withColumns({k: (F.expr(v) if isinstance(v, str) else v) for k, v in exprs.items()})


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def filter_nonempty(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose field is NULL or empty text (a quoted empty CSV field reads back as NULL)."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != F.lit("")))


def filter_notnull(df: DataFrame, cols) -> DataFrame:
    return df.dropna(how="any", subset=[cols] if isinstance(cols, str) else list(cols))


def key_lookup(df: DataFrame, order_by: Sequence[str] = (), **equals) -> DataFrame:
    """Rows matching every ``column = value``; ordered by the clustering columns if given.

    On a table that is bucketed by the hash of a composite key (``sinks.write_bucketed_table``) a lookup by the
    whole key also states the hash, so that it reads one bucket."""
    cond = None
    for k, v in equals.items():
        t = F.col(k) == F.lit(v)
        cond = t if cond is None else cond & t
    key = hashed_key(df)
    if key and all(equals.get(c) is not None for c in key):
        cond = cond & (F.col(KEY_HASH) == F.xxhash64(*[F.lit(equals[c]).cast(df.schema[c].dataType) for c in key]))
    out = df.where(cond) if cond is not None else df
    if key:
        out = out.drop(KEY_HASH)
    return out.orderBy(*order_by) if order_by else out


def limit_ordered(df: DataFrame, order_by: Sequence, n: int = 5) -> DataFrame:
    """First ``n`` rows of a total order (a distributed top-n, stable across runs)."""
    return df.orderBy(*order_by).limit(n)


def union_all(frames: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union by column name; columns missing in a frame become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out
