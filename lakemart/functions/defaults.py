"""Null defaults and casts between numbers and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed_default(df: DataFrame, column: str, value) -> Column:
    """``coalesce(column, value)`` with the default cast to the column's own type.

    A text default on a numeric column (or the reverse) fails loudly under ANSI mode instead of
    silently changing the column's type.
    """
    dtype = df.schema[column].dataType
    return F.coalesce(F.col(column), F.lit(value).cast(dtype)).alias(column)


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Replace NULLs per column, keeping column order and types."""
    return df.select(*[typed_default(df, c, defaults[c]) if c in defaults else F.col(c) for c in df.columns])


def number_as_text(col) -> Column:
    """Integer -> decimal text. Doubles are kept numeric: their text form differs between engines."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(T.StringType())
