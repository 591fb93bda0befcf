"""Explicit source schemas, in each source's own key case.

Schemas are never inferred: a column that is NULL in every row would otherwise change type
between reads, and a JSON key read under the wrong case is silently NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw activity log, one JSON object per line (18 keys, camelCase as in the files).
LOG_JSON = T.StructType([
    T.StructField("artist", T.StringType()),
    T.StructField("auth", T.StringType()),
    T.StructField("firstName", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("itemInSession", T.LongType()),
    T.StructField("lastName", T.StringType()),
    T.StructField("length", T.DoubleType()),
    T.StructField("level", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("page", T.StringType()),
    T.StructField("registration", T.DoubleType()),
    T.StructField("sessionId", T.LongType()),
    T.StructField("song", T.StringType()),
    T.StructField("status", T.LongType()),
    T.StructField("ts", T.LongType()),
    T.StructField("userAgent", T.StringType()),
    T.StructField("userId", T.StringType()),
])

# The CSV variant of the log has the same 18 columns, by position, all read as text.
LOG_CSV = T.StructType([T.StructField(f.name, T.StringType()) for f in LOG_JSON.fields])

# Reduced log written by the CSV pipeline: 11 columns, all quoted.
REDUCED_LOG_COLUMNS = ["artist", "firstName", "gender", "itemInSession", "lastName", "length",
                       "level", "location", "sessionId", "song", "userId"]
REDUCED_LOG_CSV = T.StructType([T.StructField(c, T.StringType()) for c in REDUCED_LOG_COLUMNS])
REDUCED_LOG_TYPED = T.StructType([
    T.StructField("artist", T.StringType()),
    T.StructField("firstName", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("itemInSession", T.LongType()),
    T.StructField("lastName", T.StringType()),
    T.StructField("length", T.FloatType()),
    T.StructField("level", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("sessionId", T.LongType()),
    T.StructField("song", T.StringType()),
    T.StructField("userId", T.LongType()),
])

# Song catalogue document (10 keys).
SONG_JSON = T.StructType([
    T.StructField("num_songs", T.IntegerType()),
    T.StructField("artist_id", T.StringType()),
    T.StructField("artist_latitude", T.DoubleType()),
    T.StructField("artist_longitude", T.DoubleType()),
    T.StructField("artist_location", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("song_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("year", T.IntegerType()),
])

# Typed staging tables of the bulk-load pipeline: only the declared columns survive the load.
STAGING_EVENTS = T.StructType([
    T.StructField("artist", T.StringType()),
    T.StructField("firstName", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("itemInSession", T.LongType()),
    T.StructField("lastName", T.StringType()),
    T.StructField("length", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("sessionId", T.LongType()),
    T.StructField("song", T.StringType()),
    T.StructField("status", T.LongType()),
    T.StructField("ts", T.StringType()),
    T.StructField("userAgent", T.StringType()),
    T.StructField("userId", T.IntegerType()),
])

STAGING_SONGS = T.StructType([
    T.StructField("num_songs", T.IntegerType()),
    T.StructField("artist_id", T.StringType()),
    T.StructField("artist_latitude", T.StringType()),
    T.StructField("artist_longitude", T.StringType()),
    T.StructField("artist_location", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("song_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("duration", T.StringType()),
    T.StructField("year", T.IntegerType()),
])

# Star-schema output contracts (column name -> Spark type).
USERS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("level", T.StringType()),
])
SONGS = T.StructType([
    T.StructField("song_id", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("artist_id", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("duration", T.DoubleType()),
])
ARTISTS = T.StructType([
    T.StructField("artist_id", T.StringType(), False),
    T.StructField("artist_name", T.StringType(), False),
    T.StructField("location", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])
TIME = T.StructType([
    T.StructField("start_time", T.LongType(), False),
    T.StructField("hour", T.IntegerType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("week", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("weekday", T.IntegerType(), False),
])
SONGPLAYS = T.StructType([
    T.StructField("songplay_id", T.LongType(), False),
    T.StructField("start_time", T.LongType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("level", T.StringType()),
    T.StructField("song_id", T.StringType()),
    T.StructField("artist_id", T.StringType()),
    T.StructField("session_id", T.LongType()),
    T.StructField("location", T.StringType()),
    T.StructField("user_agent", T.StringType()),
])
