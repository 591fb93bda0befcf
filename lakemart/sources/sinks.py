"""Sinks: quoted CSV, Parquet (append / overwrite / partitioned), insert by name, layouts, stats.

Partitioned writes use the ``rebalance`` hint on the partition columns: AQE then coalesces
small partitions and splits a hot partition value across several tasks (and files), so a
value that holds a third of all rows does not end up in one writer task.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("append", "overwrite")


def write_csv_quoted(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row and every field quoted; quotes inside fields are doubled."""
    (df.write.mode(mode)
     .option("header", True).option("quoteAll", True)
     .option("quote", '"').option("escape", '"')
     .option("encoding", "UTF-8")
     .csv(path))


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                     compression: str | None = None, rows_per_file: int = 0) -> None:
    w = df.write.mode(mode).option("ignoreNullFields", False)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    if rows_per_file:   # a compressed file is read by one task
        w = w.option("maxRecordsPerFile", rows_per_file)
    w.json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = (),
                  cluster_by: Sequence[str] = ()) -> None:
    """Parquet append or overwrite; ``cluster_by`` sorts the rows inside each partition. With partition columns, ``overwrite`` replaces only the
    partitions present in ``df`` (dynamic partition overwrite), which makes reloads idempotent."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    out = df.hint("rebalance", *partition_by) if partition_by else df
    if cluster_by:
        out = out.sortWithinPartitions(*partition_by, *cluster_by)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def conform(df: DataFrame, contract: T.StructType | Sequence[str]) -> DataFrame:
    """Select the target's columns **by name**, in the target's order, cast to its types.

    Binding by name means a source that lists latitude and longitude in the other order still
    lands in the right columns. Missing columns fail loudly.
    """
    if isinstance(contract, T.StructType):
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])
    return df.select(*contract)


def insert_by_name(df: DataFrame, contract: T.StructType, path: str, mode: str = "append",
                   partition_by: Sequence[str] = ()) -> None:
    write_parquet(conform(df, contract), path, mode, partition_by)


def full_refresh(df: DataFrame, contract: T.StructType, path: str, partition_by: Sequence[str] = ()) -> None:
    """Drop-and-create semantics: the target is replaced by exactly ``df`` in the contract's shape."""
    out = conform(df, contract)
    w = (out.hint("rebalance", *partition_by) if partition_by else out).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    w.parquet(path)


def layout_hash_sorted(df: DataFrame, key: Sequence[str], sort: Sequence[str] | None = None) -> DataFrame:
    """Distribution + sort key: rows of a key are co-located (a hot key may span several
    tasks, split by AQE) and sorted inside each partition."""
    return df.hint("rebalance", *key).sortWithinPartitions(*(sort or key))


def layout_clustered(df: DataFrame, partition_key: Sequence[str], clustering_key: Sequence[str]) -> DataFrame:
    """Partition key + clustering key: co-located by the partition key, ordered by both."""
    return df.hint("rebalance", *partition_key).sortWithinPartitions(*partition_key, *clustering_key)


#: Hash of all columns of a composite key, in tables bucketed by it.
KEY_HASH = "_key"


def write_bucketed_table(df: DataFrame, table: str, key: Sequence[str], buckets: int, path: str | None = None,
                         sort: Sequence[str] | None = None) -> None:
    """A bucketed, sorted catalog table: later joins and aggregates on ``key`` need no shuffle.

    Rows are dealt by the key first, so a bucket is written by one task into one file, unless a hot key makes it
    large: AQE then splits it over several tasks and files. Spark prunes buckets for a
    single bucket column only, so a key of several columns is stored with their hash as one more column, which
    the table is bucketed by; it notes the columns, for ``project.key_lookup`` and ``lookup.join_bucketed``."""
    by = list(key)
    if len(by) > 1:
        df = df.withColumn(KEY_HASH, F.xxhash64(*by)).withMetadata(KEY_HASH, {"key": by})
        by = [KEY_HASH]
    w = df.hint("rebalance", buckets, *by).write.mode("overwrite").format("parquet").bucketBy(buckets, *by).sortBy(*by, *[c for c in sort or key if c not in by])
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def hashed_key(df: DataFrame) -> list[str]:
    """The columns whose hash a table is bucketed by; none if it has no such column."""
    return list(df.schema[KEY_HASH].metadata.get("key", [])) if KEY_HASH in df.columns else []


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def load_with_stats(spark: SparkSession, loads: Mapping[str, tuple[DataFrame, str]], mode: str = "overwrite") -> DataFrame:
    """Write each (DataFrame, path) and return a (table_name, n_rows, seconds) frame.

    Rows are counted by an ``Observation`` during the write itself, not by a second pass.
    """
    rows = []
    for name, (df, path) in loads.items():
        obs = Observation(f"load_{name}")
        t0 = time.monotonic()
        df.observe(obs, F.count(F.lit(1)).alias("n_rows")).write.mode(mode).parquet(path)
        rows.append((name, int(obs.get["n_rows"]), round(time.monotonic() - t0, 3)))
    return spark.createDataFrame(rows, "table_name string, n_rows long, seconds double")
