"""Table checks that return the violating rows (or counts) as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators.lookup import fk_violations  # noqa: F401  (re-exported: J6)


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def pk_violations(df: DataFrame, pk) -> DataFrame:
    """Keys that occur more than once, with their row count (partial aggregation before the shuffle)."""
    pk = _names(pk)
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def null_violations(df: DataFrame, cols) -> DataFrame:
    """Rows with a NULL in any of the NOT NULL columns."""
    cond = None
    for c in _names(cols):
        t = F.col(c).isNull()
        cond = t if cond is None else cond | t
    return df.where(cond)


def null_counts(df: DataFrame, cols) -> DataFrame:
    """One row: per column, the number of NULLs (one pass, no shuffle beyond the final merge)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in _names(cols)])


def length_violations(df: DataFrame, col: str, max_len: int) -> DataFrame:
    """Rows whose text is longer than a fixed-width CHAR(n) column allows."""
    return df.where(F.length(F.col(col)) > F.lit(max_len))


def row_count(df: DataFrame, name: str | None = None) -> DataFrame:
    """Number of data rows (headers are not rows)."""
    out = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return out.select(F.lit(name).alias("table_name"), "n_rows") if name else out
