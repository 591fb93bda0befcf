"""Scans: CSV and JSON trees with explicit schemas, Parquet with partition discovery, file metadata.

Every reader takes a schema; nothing is inferred. Files are split and read in parallel by
Spark, so a directory tree of any size is one distributed scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.dedupe import keep_first

FILE_PATH = "_file_path"


def read_csv_tree(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
                  glob: str | None = None, multi_line: bool = True) -> DataFrame:
    """All CSV files under ``path`` at any depth; header skipped per file; quoted fields with
    embedded quotes (doubled) are read whole.

    With ``multi_line`` quoted line breaks are read whole too, but a file is one task; pass False
    where no field holds a line break, so that large files are split."""
    reader = (spark.read.schema(schema)
              .option("recursiveFileLookup", True)
              .option("header", header)
              .option("quote", '"').option("escape", '"')
              .option("multiLine", multi_line)
              .option("encoding", "UTF-8")
              .option("mode", "FAILFAST"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(path)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to a typed contract by name; bad input raises (ANSI cast)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_csv_typed(spark: SparkSession, path: str, text_schema: T.StructType, typed_schema: T.StructType,
                   header: bool = True, multi_line: bool = True) -> DataFrame:
    """Re-read a text CSV and convert it to typed columns."""
    return cast_to(read_csv_tree(spark, path, text_schema, header, multi_line=multi_line), typed_schema)


#: JSON files, plain or compressed.
JSON_FILES = "*.{json,json.gz}"


def read_json_tree(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, glob: str = "*.json") -> DataFrame:
    """All JSON-lines files matching ``glob`` under ``path`` (or several paths) at any depth."""
    return (spark.read.schema(schema)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob)
            .option("mode", "FAILFAST")
            .json(path))


def read_json_glob(spark: SparkSession, pattern: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """JSON-lines files matched by a fixed-depth glob such as ``root/*/*/*.json``."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(pattern)


def load_staging(spark: SparkSession, path: str, staging_schema: T.StructType, glob: str = "*.json") -> DataFrame:
    """Bulk load to a typed staging table: keys mapped by name in the source's own case,
    undeclared keys dropped, missing keys NULL. Values are read as text and converted to the
    declared types; empty text is NULL, any other unconvertible value fails (ANSI cast)."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in staging_schema.fields])
    raw = read_json_tree(spark, path, as_text, glob)
    return raw.select(*[
        (F.col(f.name) if isinstance(f.dataType, T.StringType)
         else F.when(F.trim(F.col(f.name)) == F.lit(""), F.lit(None)).otherwise(F.col(f.name)).cast(f.dataType)
         ).alias(f.name)
        for f in staging_schema.fields])


def read_parquet(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet with partition discovery (partition values become typed columns)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else list(path)))


def read_many(spark: SparkSession, fmt: str, paths: Sequence[str], schema: T.StructType | None = None,
              **options) -> DataFrame:
    """Many files or folders as one frame: one multi-path scan, not a loop of reads."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(list(paths))


def with_file_path(df: DataFrame) -> DataFrame:
    """Add the source file of each row (file-based scans only)."""
    return df.withColumn(FILE_PATH, F.col("_metadata.file_path"))


def with_row_index(df: DataFrame, name: str = "_row_index") -> DataFrame:
    """Add the row's position inside its file (Parquet scans)."""
    return df.withColumn(name, F.col("_metadata.row_index"))


def first_record_per_file(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first record of every file: by physical row position (Parquet; a filter, no shuffle), or
    by ``order_by`` within the file (one partial+final aggregate keyed by file path)."""
    if order_by is None:
        return df.where(F.col("_metadata.row_index") == 0).withColumn(FILE_PATH, F.col("_metadata.file_path"))
    return keep_first(with_file_path(df), [FILE_PATH], order_by, cols=list(df.columns))


def file_inventory(df: DataFrame) -> DataFrame:
    """Files under a scan and the data rows in each (file_path, n_rows)."""
    return (with_file_path(df).groupBy(FILE_PATH).agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumnRenamed(FILE_PATH, "file_path"))


def list_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Files under ``path`` at any depth, without reading them (path, size, modified)."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path))
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
