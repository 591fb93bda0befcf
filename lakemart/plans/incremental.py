"""Batches loaded into a stored star schema. No stored file is rewritten, but where a late song resolves listens.

Every table has a folder for each batch:

* ``songs``, ``artists``, ``time`` are insert-if-absent: a batch adds the rows whose key is not stored. Which
  keys are, is asked by streaming the stored key column past the batch's keys (of times, only files within the
  batch's least and greatest time); a stored table that is larger than the batch is not shuffled;
* ``users`` hold a row per user and batch with the order of its first and last log row; the users themselves
  (first attributes, last level) are an aggregate over them, so a batch only writes its own folder;
* ``songplays`` are numbered inside their batch; ``batches`` holds how many each has, and an id is that number
  after those of the batches before. A batch may be loaded again at any time: its songplays and users are
  replaced, ids stay dense and unique (those of later batches move if the count changed), and rows once
  inserted into songs, artists and time stay.
* ``files`` lists the files of a batch as they were when they were loaded; it is written last, so a load that
  broke off is done again under the same number.

Listens without a match keep their title, artist and length. With ``resolve_late`` songs and artists that a batch
adds are looked up for those listens only, and only batches with a hit are written anew.
"""

from __future__ import annotations

import os
import time
from collections.abc import Sequence
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators import dedupe
from lakemart.operators.lookup import lookup_first
from lakemart.operators.project import filter_eq
from lakemart.plans import star
from lakemart.session import scratch_path, together

BATCH = "batch"
TABLES = ("users", "songs", "artists", "time", "songplays")
_NO = "_n"
_MISSED = {"song": "_song", "artist": "_artist", "length": "_length"}


def stored(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None if there is none yet; any other failure is raised. With the schema of its
    rows (without the batch) no file is opened to find it."""
    try:
        if schema is None:
            return spark.read.parquet(path)
        return spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType())])).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _write(df: DataFrame, path: str, batch: int, mode: str, stats: list | None = None) -> None:
    """``df`` as (part of) one batch's folder; a batch without rows leaves a file that holds the schema."""
    seen, t0 = Observation(), time.monotonic()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(os.path.join(path, f"{BATCH}={batch}"))
    if stats is not None:
        stats.append((os.path.basename(path), int(seen.get["n"]), round(time.monotonic() - t0, 3)))


def absent_rows(rows: DataFrame, held: DataFrame | None, key: str, between: tuple | None = None) -> DataFrame:
    """Rows of ``rows`` whose key is not in ``held``.

    The stored keys that the batch has are found first, as a semi join that streams the stored key column, so
    only keys of the batch's size are joined against the rows. ``between`` are the batch's least and greatest key
    where stored keys lie together (times): Parquet statistics then prune the stored files."""
    if held is None:
        return rows
    held = held.select(key)
    if between is not None:
        held = held.where(F.col(key).between(F.lit(between[0]), F.lit(between[1])))
    return rows.join(held.join(rows.select(key), key, "left_semi"), key, "left_anti")


def insert_absent(spark: SparkSession, path: str, rows: DataFrame, key: str, batch: int, stats: list | None = None,
                  between: tuple | None = None) -> None:
    """Append the rows (one per key) whose key is not stored to the batch's folder; rows without a key are left out."""
    rows = rows.where(F.col(key).isNotNull())
    held = stored(spark, path, rows.schema)
    _write(absent_rows(rows, held, key, between), path, batch, "append", stats)


def users(deltas: DataFrame) -> DataFrame:
    """The users of all batches: attributes of the first row, level of the last."""
    out = dedupe.first_attrs_last_status(deltas.drop(BATCH), "userId", ["firstName", "lastName", "gender"], ["level"])
    return out.select(F.col("userId").alias("user_id"), F.col("firstName").alias("first_name"),
                      F.col("lastName").alias("last_name"), "gender", "level")


def songplays(plays: DataFrame, batches: DataFrame) -> DataFrame:
    """Stored songplays with their ids: the number in the batch after the songplays of the batches before.

    ``batches`` has one row per batch."""
    before = Window.orderBy(BATCH).rowsBetween(Window.unboundedPreceding, -1)
    start = batches.select(F.col(BATCH), F.coalesce(F.sum("n_plays").over(before), F.lit(0)).alias("_start"))
    out = plays.join(start, BATCH)
    return out.select((F.col("_start") + F.col(_NO)).alias("songplay_id"), "start_time", "user_id", "level", "song_id",
                      "artist_id", "session_id", "location", "user_agent")


def read_star(spark: SparkSession, store: str, schemas: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """The five stored tables; with the ``schemas`` of their rows no file is opened."""
    names = (*TABLES, "batches")
    schemas = schemas or {}
    t = dict(zip(names, together(*[partial(stored, spark, os.path.join(store, n), schemas.get(n)) for n in names]), strict=True))
    return {"users": users(t["users"]), **{n: t[n].drop(BATCH) for n in ("songs", "artists", "time")},
            "songplays": songplays(t["songplays"], t["batches"])}


def _catalogue(songs: DataFrame, artists: DataFrame) -> DataFrame:
    return star.song_catalogue(songs, artists).dropDuplicates()


def resolve_late_songs(spark: SparkSession, store: str, batch: int) -> list[int]:
    """Look up earlier misses in the songs and artists that ``batch`` added; the numbers of the batches written anew."""
    path = os.path.join(store, "songplays")
    t = {n: spark.read.parquet(os.path.join(store, n)) for n in ("songs", "artists", "songplays")}
    added = {n: t[n].where(F.col(BATCH) == batch) for n in ("songs", "artists")}
    new = _catalogue(added["songs"], t["artists"]).unionByName(_catalogue(t["songs"], added["artists"])).dropDuplicates()
    missed = t["songplays"].where(F.col("song_id").isNull() & (F.col(BATCH) != batch)).select(BATCH, _NO, *_MISSED.values())
    hits = lookup_first(missed, new, list(_MISSED.values()), ["title", "artist_name", "duration"], ["song_id", "artist_id"],
                        ["song_id", "artist_id"], how="inner").select(BATCH, _NO, F.col("song_id").alias("_s"), F.col("artist_id").alias("_a"))
    stage = scratch_path(spark, "late-hits")
    hits.write.parquet(stage)
    hits = spark.read.schema(hits.schema).parquet(stage)
    met = sorted(r[0] for r in hits.select(BATCH).distinct().collect())   # batch numbers
    if not met:
        return met
    old = t["songplays"].where(F.col(BATCH).isin(met)).join(hits, [BATCH, _NO], "left")
    found = F.col("_s").isNotNull()
    ids = {"song_id": F.coalesce("song_id", "_s"), "artist_id": F.coalesce("artist_id", "_a")}
    new_rows = old.select(*[ids[c].alias(c) if c in ids else F.when(~found, F.col(c)).alias(c) if c in _MISSED.values() else F.col(c)
                            for c in t["songplays"].columns])
    stage = scratch_path(spark, "late-stage")   # not overwritten while it is read
    new_rows.write.parquet(stage)
    (spark.read.schema(new_rows.schema).parquet(stage).hint("rebalance", BATCH).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path))
    return met


def load_batch(spark: SparkSession, store: str, log: DataFrame, songs: DataFrame, batch: int | None = None,
               order_by: Sequence[str] = star.LOG_ORDER, song_order: Sequence[str] = ("song_id",),
               page: str = star.LISTEN_PAGE, resolve_late: bool = False, earlier: str = "move",
               files: DataFrame | None = None) -> dict[str, DataFrame]:
    """Load one batch of log rows and song documents into the star schema in ``store``; the stored tables and
    ``load_stats`` (rows that the batch wrote to each table, seconds).

    ``batch`` is its number (default: after the last). Across batches "first" and "last" go by batch, then by the
    given orders. A stored batch that is not the last may be loaded again if ``earlier`` is ``move`` (ids of later
    batches follow its new count), not if it is ``refuse``. ``files`` is what to note as the batch's files.
    """
    if earlier not in ("move", "refuse"):
        raise ValueError("earlier must be 'move' or 'refuse'")
    sizes = T.StructType([T.StructField("n_plays", T.LongType())])
    done = stored(spark, os.path.join(store, "batches"), sizes)
    last = None if done is None else done.agg(F.max(BATCH)).first()[0]
    if batch is None:
        batch = 0 if last is None else last + 1
    if earlier == "refuse" and last is not None and batch < last:
        raise ValueError(f"batch {batch} is older than the last stored batch {last}")
    at = lambda n: os.path.join(store, n)
    stats: list = []
    people = log.where(F.col("firstName").isNotNull() & F.col("userId").isNotNull())
    people = dedupe.merge_into(None, [people], "userId", "first_attrs_last_status", order_by, first_batch_no=batch,
                               first_cols=["firstName", "lastName", "gender"], last_cols=["level"])
    listens = filter_eq(log, "page", page)
    times = star.time_table(log, "mon0", page, whole_seconds=False, dedupe=True)

    def add_times():
        span = tuple(listens.agg(F.min(F.col("ts").cast("long")), F.max(F.col("ts").cast("long"))).first())
        insert_absent(spark, at("time"), times, "start_time", batch, stats, span)

    first = {"songs": (star.songs_first(songs, song_order), "song_id"), "artists": (star.artists_first(songs, song_order), "artist_id")}
    *_, numbered = together(
        lambda: _write(people, at("users"), batch, "overwrite", stats),
        *[partial(insert_absent, spark, at(n), rows, key, batch, stats) for n, (rows, key) in first.items()],
        add_times,
        lambda: star.numbered_listens(log, page, order_by))
    t = {n: stored(spark, at(n), rows.schema) for n, (rows, _) in first.items()}
    plays = star.resolve(numbered, star.song_catalogue(t["songs"], t["artists"]))
    miss = F.col("song_id").isNull()
    plays = plays.select(F.col("songplay_id").alias(_NO), *star.SONGPLAY_COLUMNS[1:],
                         *[F.when(miss, F.col(c)).alias(a) for c, a in _MISSED.items()])
    _write(plays, at("songplays"), batch, "overwrite", stats)
    count = spark.range(1).select(F.lit(stats[-1][1]).cast("long").alias("n_plays"))
    _write(count, at("batches"), batch, "overwrite")
    if resolve_late:
        resolve_late_songs(spark, store, batch)
    if files is not None:
        _write(files, at("files"), batch, "overwrite")
    schemas = {"users": people.schema, "time": times.schema, "songplays": plays.schema, "batches": sizes,
               **{n: rows.schema for n, (rows, _) in first.items()}}
    return read_star(spark, store, schemas) | {"load_stats": spark.createDataFrame(stats, "table_name string, n_rows long, seconds double")}


def changed_files(listed: DataFrame, noted: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Of the files listed now (kind, path, size, modified): those never loaded, and the noted ones (with their
    batch) that have another size or time now or are gone."""
    if noted is None:
        return listed, listed.withColumn(BATCH, F.lit(None).cast("int")).where(F.lit(False))
    new = listed.join(noted, ["kind", "path"], "left_anti")
    changed = noted.join(listed, ["kind", "path", "size", "modified"], "left_anti")
    return new, changed
