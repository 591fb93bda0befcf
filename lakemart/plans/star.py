"""Table builders for the activity-log star schema and the query-shaped lookup tables.

Inputs use the log's own column names (``artist, firstName, ..., ts, userId``) and the
catalogue's (``song_id, title, artist_id, artist_name, duration, year, ...``). Each builder is a
lazy DataFrame plan; writers live in ``lakemart.sources.sinks``.

Three families mirror the three ways the star schema is built:

* ``*_first`` / ``*_merge`` / ``songplays_lookup``: keyed upserts and a first-match lookup;
* ``*_default`` / ``*_raw`` / ``time_all_events`` / ``songplays_two_key``: set-based
  insert-select with NULL defaults, no dedupe;
* ``*_distinct`` / ``songplays_title``: full-row distinct tables partitioned for a lake.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.defaults import typed_default
from lakemart.functions.timeparts import epoch_ms_to_ntz, epoch_ms_whole_seconds, time_parts
from lakemart.operators.dedupe import distinct_rows, first_attrs_last_status, keep_first, last_write_wins
from lakemart.operators.keys import dense_ids, dense_ids_join
from lakemart.operators.lookup import lookup_first
from lakemart.operators.project import filter_eq, filter_nonempty
from lakemart.schemas import REDUCED_LOG_COLUMNS
from lakemart.session import together

# Fixed values of the log format.
LISTEN_PAGE = "NextSong"
# Total order of log rows: event time, then session, then item.
LOG_ORDER = ["ts", "sessionId", "itemInSession"]


# ---------------------------------------------------------------- lookup tables (CSV pipeline)

def reduced_log(log: DataFrame) -> DataFrame:
    """Listen rows only (non-empty artist), 11 columns in the reduced-file order."""
    return filter_nonempty(log, "artist").select(*REDUCED_LOG_COLUMNS)


def item_lookup_table(reduced: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """(sessionId, itemInSession) -> artist, song, length, userId; last write wins on the key."""
    return last_write_wins(reduced, ["sessionId", "itemInSession"], order_by,
                           cols=["artist", "song", "length", "userId"])


def session_lookup_table(reduced: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """(userId, sessionId, itemInSession) -> artist, song, firstName, lastName."""
    return last_write_wins(reduced, ["userId", "sessionId", "itemInSession"], order_by,
                           cols=["artist", "song", "firstName", "lastName"])


def song_listeners_table(reduced: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """(song, userId) -> firstName, lastName."""
    return last_write_wins(reduced, ["song", "userId"], order_by, cols=["firstName", "lastName"])


# ---------------------------------------------------------------- users

def users_merge(log: DataFrame, order_by: Sequence[str] = LOG_ORDER) -> DataFrame:
    """One row per user: names and gender of the user's first row, level of the last row.
    Rows without a first name are not user rows."""
    rows = log.where(F.col("firstName").isNotNull())
    out = first_attrs_last_status(rows, "userId", ["firstName", "lastName", "gender"], ["level"], order_by)
    return out.select(F.col("userId").alias("user_id"), F.col("firstName").alias("first_name"),
                      F.col("lastName").alias("last_name"), "gender", "level")


def users_raw(staging_events: DataFrame, user_default=0) -> DataFrame:
    """One row per event; a NULL user id gets the column's typed default."""
    return staging_events.select(typed_default(staging_events, "userId", user_default).alias("user_id"),
                                 F.col("firstName").alias("first_name"), F.col("lastName").alias("last_name"),
                                 "gender", "level")


def users_distinct(log: DataFrame, page: str = LISTEN_PAGE) -> DataFrame:
    """Full-row distinct users of listen rows: one user at two levels keeps two rows."""
    return distinct_rows(filter_eq(log, "page", page), ["userId", "firstName", "lastName", "gender", "level"])


# ---------------------------------------------------------------- songs and artists

def songs_first(songs: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """One row per song_id, the first by ``order_by``; year as text."""
    out = keep_first(songs, "song_id", order_by, cols=["title", "artist_id", "year", "duration"])
    return out.select("song_id", "title", "artist_id", F.col("year").cast("string").alias("year"), "duration")


def songs_default(staging_songs: DataFrame) -> DataFrame:
    return staging_songs.select(typed_default(staging_songs, "song_id", "0"), "title", "artist_id", "year",
                                "duration")


def songs_distinct(songs: DataFrame) -> DataFrame:
    return distinct_rows(songs, ["song_id", "title", "artist_id", "year", "duration"])


def artists_first(songs: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """One row per artist_id, the first by ``order_by``; rows without a name are skipped
    (the name is NOT NULL in the target)."""
    named = songs.where(F.col("artist_name").isNotNull())
    out = keep_first(named, "artist_id", order_by,
                     cols=["artist_name", "artist_location", "artist_latitude", "artist_longitude"])
    return out.select("artist_id", "artist_name", F.col("artist_location").alias("location"),
                      F.col("artist_latitude").alias("latitude"), F.col("artist_longitude").alias("longitude"))


def artists_default(staging_songs: DataFrame) -> DataFrame:
    """One row per catalogue row; NULL id -> '0', NULL name -> 'N/A'; bound by name."""
    return staging_songs.select(typed_default(staging_songs, "artist_id", "0"),
                                typed_default(staging_songs, "artist_name", "N/A"),
                                F.col("artist_location").alias("location"),
                                F.col("artist_latitude").alias("latitude"),
                                F.col("artist_longitude").alias("longitude"))


def artists_distinct(songs: DataFrame) -> DataFrame:
    """NULL-defaulted (id '0', text '', coordinates 0) and full-row distinct."""
    s = songs
    return distinct_rows(s.select(
        typed_default(s, "artist_id", "0"), typed_default(s, "artist_name", ""),
        typed_default(s, "artist_location", ""), typed_default(s, "artist_latitude", 0.0),
        typed_default(s, "artist_longitude", 0.0)))


# ---------------------------------------------------------------- time

def time_table(log: DataFrame, weekday_base: str = "mon0", page: str | None = LISTEN_PAGE,
               whole_seconds: bool = False, dedupe: bool = True) -> DataFrame:
    """start_time (epoch ms) and its UTC parts.

    ``weekday_base`` picks the weekday convention (mon0 / sun0 / sun1); ``page`` restricts to
    listen rows (None keeps all events); ``whole_seconds`` cuts the instant to seconds before
    taking parts; ``dedupe`` keeps one row per start_time.
    """
    rows = filter_eq(log, "page", page) if page is not None else log
    start = F.col("ts").cast("long")
    inst = epoch_ms_whole_seconds(start) if whole_seconds else epoch_ms_to_ntz(start)
    out = rows.select(start.alias("start_time"), *time_parts(inst, weekday_base))
    return out.dropDuplicates(["start_time"]) if dedupe else out


def time_all_events(staging_events: DataFrame) -> DataFrame:
    return time_table(staging_events, "sun0", None, whole_seconds=True, dedupe=False)


def time_sun1(log: DataFrame) -> DataFrame:
    return time_table(log, "sun1", LISTEN_PAGE, whole_seconds=True, dedupe=True)


# ---------------------------------------------------------------- songplays

def song_catalogue(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """songs joined to artists on artist_id: title, artist_name, duration -> song_id, artist_id."""
    return (songs.select("song_id", "title", "artist_id", "duration")
            .join(artists.select("artist_id", "artist_name"), "artist_id"))


SONGPLAY_COLUMNS = ["songplay_id", "start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location",
                    "user_agent"]


def numbered_listens(log: DataFrame, page: str = LISTEN_PAGE, order_by: Sequence[str] = LOG_ORDER, id_start: int = 1) -> DataFrame:
    """Listen rows with dense ids in ``order_by``; the lookup neither drops nor adds rows, so they are numbered before it."""
    need = ["ts", "userId", "level", "sessionId", "location", "userAgent", "song", "artist", "length"]
    listens = filter_eq(log, "page", page).select(*dict.fromkeys([*need, *order_by]))
    return dense_ids(listens, list(order_by), "songplay_id", id_start)


def resolve(numbered: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Numbered listens as songplays, and the text that was looked up: ``song``, ``artist`` and ``length``."""
    found = lookup_first(numbered, catalogue, ["song", "artist", "length"], ["title", "artist_name", "duration"],
                         ["song_id", "artist_id"], ["song_id", "artist_id"])
    return found.select("songplay_id", F.col("ts").alias("start_time"), F.col("userId").alias("user_id"), "level",
                        "song_id", "artist_id", F.col("sessionId").alias("session_id"), "location",
                        F.col("userAgent").alias("user_agent"), "song", "artist", "length")


def songplays_lookup(log: DataFrame, catalogue: DataFrame, page: str = LISTEN_PAGE,
                     order_by: Sequence[str] = LOG_ORDER, id_start: int = 1) -> DataFrame:
    """Every listen row, its (song_id, artist_id) resolved by (title, artist name, duration) to
    the first catalogue match (smallest song_id), NULL on a miss; dense ids from 1."""
    return resolve(numbered_listens(log, page, order_by, id_start), catalogue).select(*SONGPLAY_COLUMNS)


def songplays_two_key(staging_events: DataFrame, staging_songs: DataFrame,
                      left_order: Sequence[str] = ("ts", "sessionId", "itemInSession"),
                      right_order: Sequence[str] = ("song_id",)) -> DataFrame:
    """Events joined to the catalogue on (artist name, title), every match kept; NULL ids
    default to '0'; dense ids from 0 in (event order, catalogue order).

    The ids are assigned without sorting the fan-out (``dense_ids_join``)."""
    # only what the result or the order needs is moved
    events = staging_events.select(*dict.fromkeys(["ts", "userId", "level", "sessionId", "location", "userAgent", "artist", "song", *left_order]))
    songs = staging_songs.select(*dict.fromkeys(["song_id", "artist_id", "artist_name", "title", *right_order]))
    j = dense_ids_join(events, songs, ["artist", "song"], ["artist_name", "title"], left_order, right_order, "songplay_id", 0)
    j = j.withColumn("_user_text", F.col("userId").cast("string"))
    return j.select(F.col("ts").alias("start_time"), typed_default(j, "_user_text", "0").alias("user_id"), "level",
                    typed_default(j, "song_id", "0"), typed_default(j, "artist_id", "0"),
                    F.col("sessionId").alias("session_id"), "location", F.col("userAgent").alias("user_agent"),
                    "songplay_id")


def songplays_title(log: DataFrame, songs: DataFrame, artists: DataFrame, page: str = LISTEN_PAGE) -> DataFrame:
    """Listen rows joined to songs on title only (fan-out kept) and on to artists; full-row
    distinct; year and month of the start time for partitioning.

    Same result as ``distinct(listens ⋈ songs ⋈ artists)``, planned so the fan-out is never
    shuffled: listens and songs are deduplicated *before* the join (the join of two distinct
    inputs is distinct), the artists join becomes a semi-join (multiplicity is removed by the
    distinct anyway), and only songs whose (song_id, artist_id) carries several titles, the one
    case where two join rows can collide, go through a final distinct.
    """
    listens = filter_eq(log, "page", page)
    inst = epoch_ms_whole_seconds(F.col("ts").cast("long"))
    lcols = [F.col("ts").alias("start_time"), F.col("userId").alias("user_id"), "level",
             F.col("sessionId").alias("session_id"), "location", F.col("userAgent").alias("user_agent"),
             F.year(inst).alias("year"), F.month(inst).alias("month"), F.col("song").alias("_title")]
    l_distinct = listens.select(*lcols).dropDuplicates()
    s = (songs.select("song_id", F.col("title").alias("_title"), "artist_id").dropDuplicates()
         .join(artists.select("artist_id"), "artist_id", "left_semi"))
    titles = s.groupBy(F.col("song_id").alias("_s"), F.col("artist_id").alias("_a")).agg(F.count(F.lit(1)).alias("_n_titles"))
    # null-safe: a song without id keeps its rows
    s = s.join(titles, F.col("song_id").eqNullSafe(F.col("_s")) & F.col("artist_id").eqNullSafe(F.col("_a"))).drop("_s", "_a")
    out_cols = ["start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent",
                "year", "month"]
    single = l_distinct.join(s.where(F.col("_n_titles") == 1), "_title").select(*out_cols)
    multi = l_distinct.join(s.where(F.col("_n_titles") > 1), "_title").select(*out_cols).dropDuplicates()
    return single.unionByName(multi)


# ---------------------------------------------------------------- whole star schema

def star_dims(log: DataFrame, songs: DataFrame, order_by: Sequence[str] = LOG_ORDER,
              song_order: Sequence[str] = ("song_id",), page: str = LISTEN_PAGE) -> dict[str, DataFrame]:
    """users, songs, artists and time from a raw log and a song catalogue.

    ``order_by`` orders log rows and ``song_order`` catalogue rows (both total orders; for
    files, the arrival order: file, then line)."""
    return {
        "users": users_merge(log, order_by),
        "songs": songs_first(songs, song_order),
        "artists": artists_first(songs, song_order),
        "time": time_table(log, "mon0", page, whole_seconds=False, dedupe=True),
    }


def star_schema(log: DataFrame, songs: DataFrame, order_by: Sequence[str] = LOG_ORDER,
                song_order: Sequence[str] = ("song_id",), page: str = LISTEN_PAGE) -> dict[str, DataFrame]:
    """The four dimensions and songplays, as plans; see ``write_star`` for written tables."""
    dims = star_dims(log, songs, order_by, song_order, page)
    return dims | {"songplays": songplays_lookup(log, song_catalogue(dims["songs"], dims["artists"]), page, order_by)}


def write_star(log: DataFrame, songs: DataFrame, store, order_by: Sequence[str] = LOG_ORDER,
               song_order: Sequence[str] = ("song_id",), page: str = LISTEN_PAGE) -> dict[str, DataFrame]:
    """``star_schema`` with each table written by ``store(name, df)``, which returns the written table;
    songplays are resolved against the written songs and artists. The dimensions are written, and the listens
    numbered, at the same time."""
    dims = star_dims(log, songs, order_by, song_order, page)
    *written, numbered = together(*[partial(store, name, df) for name, df in dims.items()], lambda: numbered_listens(log, page, order_by))
    out = dict(zip(dims, written, strict=True))
    plays = resolve(numbered, song_catalogue(out["songs"], out["artists"])).select(*SONGPLAY_COLUMNS)
    return out | {"songplays": store("songplays", plays)}


def star_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, pk_violations, null_violations, fk_violations, length_violations) for the five tables.

    Every table is read once: its rows become tagged keys (its own key, and each key it refers to), and one
    aggregate by (table that the key belongs to, key) tells repeated own keys and references without one. Hot
    keys are reduced before the shuffle."""
    keys = {"users": "user_id", "songs": "song_id", "artists": "artist_id", "time": "start_time", "songplays": "songplay_id"}
    not_null = {"users": ["user_id"], "songs": ["song_id"], "artists": ["artist_id", "artist_name"],
                "time": ["start_time", "hour", "day", "week", "month", "year", "weekday"],
                "songplays": ["start_time", "user_id"]}
    fks = {"songplays": {"user_id": "users", "song_id": "songs", "artist_id": "artists"}, "songs": {"artist_id": "artists"}}
    char1 = {"users": "gender"}   # CHAR(1)
    referring = [t for t in fks if t in tables]

    def tagged(name: str, df: DataFrame) -> DataFrame:
        any_null = F.greatest(*[F.col(c).isNull().cast("int") for c in not_null[name]], F.lit(0))
        long = (F.length(char1[name]) > 1).cast("int") if name in char1 else F.lit(0)
        zero = F.lit(0)

        def entry(of, key, own, null, too_long):
            return F.struct(F.lit(of).alias("of"), F.col(key).cast("string").alias("key"), own.alias("own"),
                            F.coalesce(null, zero).alias("null"), F.coalesce(too_long, zero).alias("long"),
                            *[F.lit(int(t == name and of != name)).alias(f"by_{t}") for t in referring])

        own = entry(name, keys[name], F.lit(1), any_null, long)
        refs = [F.when(F.col(c).isNotNull(), entry(dim, c, zero, zero, zero)) for c, dim in fks.get(name, {}).items()]
        return df.select(F.explode(F.array(own, *refs)).alias("e")).where("e is not null").select("e.*")

    rows = None
    for name, df in tables.items():
        rows = tagged(name, df) if rows is None else rows.unionByName(tagged(name, df))
    by_key = rows.groupBy("of", "key").agg(*[F.sum(c).alias(c) for c in ("own", "null", "long", *[f"by_{t}" for t in referring])])
    of = by_key.groupBy("of").agg(
        F.sum("own").alias("n_rows"), F.count_if(F.col("own") > 1).alias("pk"), F.sum("null").alias("null"), F.sum("long").alias("long"),
        *[F.sum(F.when(F.col("own") == 0, F.col(f"by_{t}")).otherwise(0)).alias(f"by_{t}") for t in referring])
    zero = F.lit(0).cast("long")
    found = [F.struct(F.col("of").alias("table_name"), F.col("n_rows"), F.col("pk"), F.col("null"), zero.alias("fk"), F.col("long"))]
    found += [F.struct(F.lit(t).alias("table_name"), zero.alias("n_rows"), zero.alias("pk"), zero.alias("null"),
                       F.col(f"by_{t}").alias("fk"), zero.alias("long")) for t in referring]
    total = of.select(F.explode(F.array(*found)).alias("r")).select("r.*").groupBy("table_name")
    return total.agg(*[F.sum(c).cast("long").alias(m) for c, m in (
        ("n_rows", "n_rows"), ("pk", "pk_violations"), ("null", "null_violations"), ("fk", "fk_violations"),
        ("long", "length_violations"))]).where(F.col("table_name").isin(list(tables)))
