"""Runnable jobs: raw log + song catalogue folders in, tables out.

Five loaders share the builders in ``lakemart.plans.star`` and differ in their semantics:

* ``lookup_tables``  CSV log tree -> reduced all-quoted CSV -> three query-shaped tables
                     (last write wins on each table's key), laid out by partition key and
                     clustering key;
* ``star_merge``     one batch of songs and logs merged into the stored star schema (ids go on);
* ``star_upsert``    keyed upserts (first attributes + last level for users, keep-first for
                     songs, artists and time), first-match songplay lookup, dense ids from 1,
                     plus key checks;
* ``warehouse``      typed staging load, then insert-select into five tables with NULL defaults,
                     two-key songplay join, ids from 0, per-table load statistics;
* ``data_lake``      full-row distinct tables written as partitioned Parquet, the title-only
                     songplay join, append or idempotent overwrite.

Raw input is read once and staged as Parquet. Every job writes each table once and reports (table, rows) from the write itself.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.plans import incremental, star
from lakemart.session import build_session, ensure_checkpoint_dir, scratch_path, step_scratch
from lakemart.operators.project import filter_nonempty
from lakemart.sources import readers, sinks

# Row order inside a CSV log file is its arrival order; the tree is read with the file path
# and the line position so "last write" is well defined (file path, then line).
_FILE_ORDER = ["_file", "_line"]


def _with_arrival_order(df: DataFrame) -> DataFrame:
    """Arrival order of a text scan: file path, then position in the file.

    ``monotonically_increasing_id`` grows with the row position inside a task, and a text
    file is read by one task per split in order, so (file, split start, id) is the order the
    rows appear in the files.
    """
    return (df.withColumn("_file", F.col("_metadata.file_path"))
            .withColumn("_line", F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())))


def _staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and read back."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup_tables(spark: SparkSession, log_csv_dir: str, out_dir: str, buckets: int | None = None
                  ) -> dict[str, DataFrame]:
    """CSV event files -> reduced CSV -> three lookup tables (Parquet, clustered).

    With ``buckets`` the tables are catalog tables bucketed by their partition key and sorted by
    partition + clustering key: a lookup with equality on the partition key then reads one
    bucket (bucket pruning), the analogue of a partition-key read.

    The last write is the last in the source files (path, then line): rows carry that place from the
    raw scan on. The reduced CSV is an output; the tables are not built from it."""
    raw = _with_arrival_order(readers.read_csv_tree(spark, log_csv_dir, schemas.LOG_CSV))
    text = _staged(spark, filter_nonempty(raw, "artist").select(*schemas.REDUCED_LOG_COLUMNS, *_FILE_ORDER), "reduced-log")
    sinks.write_csv_quoted(star.reduced_log(text), os.path.join(out_dir, "event_datafile_new"))
    reduced = text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.REDUCED_LOG_TYPED.fields],
                          *_FILE_ORDER)
    tables = {
        "song_playlist_artists": (star.item_lookup_table(reduced, _FILE_ORDER), ["sessionId"], ["itemInSession"]),
        "song_playlist_sessions": (star.session_lookup_table(reduced, _FILE_ORDER), ["userId", "sessionId"],
                                   ["itemInSession"]),
        "song_playlist_users": (star.song_listeners_table(reduced, _FILE_ORDER), ["song"], ["userId"]),
    }
    out = {}
    for name, (df, pkey, ckey) in tables.items():
        path = os.path.join(out_dir, name)
        if buckets:
            sinks.write_bucketed_table(df, name, pkey, buckets, path, [*pkey, *ckey])
            out[name] = spark.table(name)
        else:
            sinks.write_parquet(sinks.layout_clustered(df, pkey, ckey), path, "overwrite")
            out[name] = spark.read.parquet(path)
    return out


def star_upsert(spark: SparkSession, song_dir: str, log_dir: str, out_dir: str) -> dict[str, DataFrame]:
    """Keyed-upsert star schema from JSON trees; returns the written tables and ``checks``."""
    docs = _with_arrival_order(readers.read_json_tree(spark, song_dir, schemas.SONG_JSON))
    # one song per file: the file's first record; "first" across files is arrival order
    songs = _staged(spark, readers.first_record_per_file(docs, ["_line"]), "song-documents")
    log = _staged(spark, readers.read_json_tree(spark, log_dir, schemas.LOG_JSON), "raw-log")
    contracts = {"users": schemas.USERS, "songs": schemas.SONGS, "artists": schemas.ARTISTS,
                 "time": schemas.TIME, "songplays": schemas.SONGPLAYS}

    stats = []

    def store(name, df):
        path, seen, t0 = os.path.join(out_dir, name), Observation(), time.monotonic()
        sinks.full_refresh(sinks.conform(df, contracts[name]).observe(seen, F.count(F.lit(1)).alias("n")), contracts[name], path)
        stats.append((name, int(seen.get["n"]), round(time.monotonic() - t0, 3)))
        return spark.read.parquet(path)

    written = star.write_star(log, songs, store, song_order=_FILE_ORDER)
    written["checks"] = star.star_checks({k: written[k] for k in contracts})
    written["load_stats"] = spark.createDataFrame(stats, "table_name string, n_rows long, seconds double")
    return written


def warehouse(spark: SparkSession, song_dir: str, log_dir: str, out_dir: str) -> dict[str, DataFrame]:
    """Staging load + insert-select; returns the tables and ``load_stats``."""
    staging_events = readers.load_staging(spark, log_dir, schemas.STAGING_EVENTS)
    staging_songs = readers.load_staging(spark, song_dir, schemas.STAGING_SONGS)
    staged = sinks.load_with_stats(spark, {
        "staging_events": (staging_events, os.path.join(out_dir, "staging_events")),
        "staging_songs": (staging_songs, os.path.join(out_dir, "staging_songs"))})
    se = spark.read.parquet(os.path.join(out_dir, "staging_events"))
    ss = spark.read.parquet(os.path.join(out_dir, "staging_songs"))
    builders = {
        "users": star.users_raw(se, 0),
        "songs": star.songs_default(ss),
        "artists": star.artists_default(ss),
        "time": star.time_all_events(se),
        "songplays": star.songplays_two_key(se, ss),
    }
    loads = {name: (df, os.path.join(out_dir, name)) for name, df in builders.items()}
    stats = sinks.load_with_stats(spark, loads)
    out = {name: spark.read.parquet(path) for name, (_, path) in loads.items()}
    out["load_stats"] = staged.unionByName(stats)
    return out


def data_lake(spark: SparkSession, song_root: str, log_root: str, out_dir: str,
              mode: str = "overwrite") -> dict[str, DataFrame]:
    """Distinct, partitioned Parquet tables from the song and log globs.

    Songs are partitioned by year and sorted by artist inside (a folder for each artist would be
    unbounded). The log is joined to the songs and artists as stored, so that with ``append`` it also
    meets those of earlier runs."""
    songs = _staged(spark, readers.read_json_glob(spark, os.path.join(song_root, "*", "*", "*", "*.json"),
                                                  schemas.SONG_JSON), "song-documents")
    log = _staged(spark, readers.read_json_glob(spark, os.path.join(log_root, "*", "*", "*.json"), schemas.LOG_JSON),
                  "raw-log")
    artists = star.artists_distinct(songs).select("artist_id", "artist_name", "artist_location", "artist_latitude",
                                                  "artist_longitude")
    out = {}

    def store(name, df, parts=(), cluster=()):
        path = os.path.join(out_dir, name)
        sinks.write_parquet(df, path, mode, parts, cluster)
        out[name] = readers.read_parquet(spark, path, df.schema)   # a partitioned table without rows has no file to tell

    store("songs", star.songs_distinct(songs), ["year"], ["artist_id"])
    store("artists", artists)
    store("users", star.users_distinct(log))
    store("time", star.time_sun1(log), ["year", "month"])
    store("songplays", star.songplays_title(log, out["songs"], out["artists"]), ["year", "month"])
    return out


def star_merge(spark: SparkSession, song_dir: str, log_dir: str, out_dir: str, batch: int | None = None,
               resolve_late: bool = False, one_song_per_file: bool = True) -> dict[str, DataFrame]:
    """Load the files of two growing folders into the star schema stored in ``out_dir``, each file once.

    Files are JSON lines, plain or compressed by gzip, and known by path, size and time. New ones are the next batch. If a loaded file has changed, its
    batch is loaded again from the files as they are now; a loaded file that is gone is an error, as its rows
    could not be told from others. With ``batch`` both folders, whole, are that batch. Without new or changed
    files nothing is loaded. ``resolve_late`` looks up earlier listens without a match in what a batch adds.
    What a load writes besides the store is deleted when it ends."""
    with step_scratch(spark):
        return _star_merge(spark, song_dir, log_dir, out_dir, batch, resolve_late, one_song_per_file)


def _star_merge(spark: SparkSession, song_dir: str, log_dir: str, out_dir: str, batch: int | None,
                resolve_late: bool, one_song_per_file: bool) -> dict[str, DataFrame]:
    listed = (readers.list_files(spark, song_dir, readers.JSON_FILES).withColumn("kind", F.lit("song"))
              .unionByName(readers.list_files(spark, log_dir, readers.JSON_FILES).withColumn("kind", F.lit("log"))))
    listed = _staged(spark, listed.select("kind", "path", "size", "modified"), "listed-files")

    def load(files: DataFrame, number: int | None) -> dict[str, DataFrame]:
        paths = {"song": [], "log": []}
        for r in files.select("kind", "path").collect():   # the reader takes a list of paths
            paths[r["kind"]].append(r["path"])

        def tree(kind, schema):
            return readers.read_json_tree(spark, paths[kind], schema, readers.JSON_FILES) if paths[kind] else spark.createDataFrame([], schema)

        docs = _with_arrival_order(tree("song", schemas.SONG_JSON)) if paths["song"] else (
            tree("song", schemas.SONG_JSON).withColumns({"_file": F.lit(""), "_line": F.struct(F.lit(0).cast("long"), F.lit(0).cast("long"))}))
        if one_song_per_file and paths["song"]:
            docs = readers.first_record_per_file(docs, ["_line"])
        with step_scratch(spark):   # the tables returned read the store
            return incremental.load_batch(spark, out_dir, _staged(spark, tree("log", schemas.LOG_JSON), "raw-log"),
                                          _staged(spark, docs, "song-documents"), number, star.LOG_ORDER, _FILE_ORDER,
                                          resolve_late=resolve_late, files=files)

    if batch is not None:
        return load(listed, batch)
    noted = incremental.stored(spark, os.path.join(out_dir, "files"))
    if noted is not None:   # a batch that is loaded again replaces its list
        noted = _staged(spark, noted, "noted-files")
    new, changed = incremental.changed_files(listed, noted)
    new = _staged(spark, new.select(*listed.columns), "new-files")
    again = sorted({r[0] for r in changed.select(incremental.BATCH).distinct().collect()})
    out = None
    for number in again:
        old = noted.where(F.col(incremental.BATCH) == number).select("kind", "path")
        files = _staged(spark, listed.join(old, ["kind", "path"], "left_semi").select(*listed.columns), "batch-files")
        if files.count() != old.count():
            raise ValueError(f"files of batch {number} are gone")
        out = load(files, number)
    if not new.isEmpty():
        number = None if noted is None else noted.agg(F.max(incremental.BATCH)).first()[0] + 1
        out = load(new, 0 if number is None else number)
    return out if out is not None else incremental.read_star(spark, out_dir)


JOBS = {"lookup_tables": lookup_tables, "star_upsert": star_upsert, "star_merge": star_merge, "warehouse": warehouse,
        "data_lake": data_lake}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m lakemart.plans.jobs", description=__doc__.split("\n\n")[0])
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--logs", required=True, help="log folder (CSV tree for lookup_tables, JSON otherwise)")
    ap.add_argument("--songs", help="song catalogue folder (JSON documents)")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--mode", default="overwrite", choices=("append", "overwrite"), help="data_lake write mode")
    ap.add_argument("--buckets", type=int, default=None, help="lookup_tables: bucket count (bucketed tables)")
    ap.add_argument("--batch", type=int, default=None, help="star_merge: load both folders, whole, as this batch (default: new and changed files only)")
    ap.add_argument("--resolve-late", action="store_true", help="star_merge: look up earlier misses in new songs")
    ap.add_argument("--master", default=None, help="Spark master (default: as given by spark-submit)")
    a = ap.parse_args(argv)
    if a.job != "lookup_tables" and not a.songs:
        ap.error(f"{a.job} needs --songs")
    spark = build_session(a.master, f"lakemart-{a.job}")
    ensure_checkpoint_dir(spark)
    if a.job == "lookup_tables":
        res = lookup_tables(spark, a.logs, a.out, a.buckets)
    elif a.job == "data_lake":
        res = data_lake(spark, a.songs, a.logs, a.out, a.mode)
    elif a.job == "star_merge":
        res = star_merge(spark, a.songs, a.logs, a.out, a.batch, a.resolve_late)
    else:
        res = JOBS[a.job](spark, a.songs, a.logs, a.out)
    reports = [df for name, df in res.items() if name in ("checks", "load_stats")]
    if not reports:   # rows per written table, counted on the written files
        for name, df in res.items():
            print(f"{name}: {df.count()} rows")
    for df in reports:
        df.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
