"""Role adapters: the driver's tables seen as an activity log and a song catalogue.

* events           -> a raw log: ``ts`` epoch ms, ``userId``, ``page`` = event_type, ...
* lineitem ⋈ part ⋈ orders -> LOG: listen rows with text fields to resolve
  (song = a title that four parts share, artist = p_brand, length = p_size, session = l_orderkey,
  item = l_linenumber, user = o_custkey, page = l_returnflag)
* part             -> the catalogue (CAT: all parts; the artist name of one part type is blank, so
  some lookups miss)

Four parts to a title at every scale: joins on the title fan out, but linearly.

Each adapter has a SQL twin (``*_SQL``) used by the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.timeparts import ntz_to_epoch_ms
from lakemart.session import read_table

# Fixed values of the role mapping.
LISTEN_PAGE_EVENTS = "view"      # the listen page of the events log
LISTEN_PAGE_LOG = "A"            # the listen page of LOG (l_returnflag)
CAT_BLANK_TYPE = "ECONOMY"       # parts of this type have no artist name in the catalogue
TITLE = "concat('song ', p_partkey div 4)"
TITLE_SQL = "'song ' || (p_partkey // 4)"
LOG_ORDER = ["sessionId", "itemInSession", "ts", "_partkey", "_suppkey", "_price", "_qty"]
LOG_ORDER_SQL = "sessionId, itemInSession, ts, _partkey, _suppkey, _price, _qty"


def events_as_log(events: DataFrame) -> DataFrame:
    """events in the raw log's shape; error events carry no first name and an empty artist."""
    is_error = F.col("event_type") == F.lit("error")
    return events.select(
        ntz_to_epoch_ms("ts").alias("ts"),
        F.col("user_id").alias("userId"),
        F.col("event_type").alias("page"),
        F.col("event_type").alias("level"),
        F.when(~is_error, F.col("props")).alias("firstName"),
        F.col("props").alias("lastName"),
        F.substring("event_type", 1, 1).alias("gender"),
        F.when(is_error, F.lit("")).otherwise(F.col("event_type")).alias("artist"),
        F.col("props").alias("song"),
        F.col("value").alias("length"),
        F.col("event_id").alias("itemInSession"),
        F.col("user_id").alias("sessionId"),
        F.col("props").alias("location"),
    )


EVENTS_AS_LOG_SQL = """
SELECT epoch_us(ts) // 1000 AS ts, user_id AS userId, event_type AS page, event_type AS level,
       CASE WHEN event_type <> 'error' THEN props END AS firstName, props AS lastName,
       substr(event_type, 1, 1) AS gender,
       CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS artist,
       props AS song, value AS length, event_id AS itemInSession, user_id AS sessionId, props AS location
FROM events"""


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOG: lineitem joined to its part and its order, in the raw log's shape."""
    li = read_table(spark, sf_dir, "lineitem")
    p = read_table(spark, sf_dir, "part")
    o = read_table(spark, sf_dir, "orders")
    j = li.join(p, li["l_partkey"] == p["p_partkey"]).join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select(
        F.expr(TITLE).alias("song"), F.col("p_brand").alias("artist"),
        F.col("p_size").cast("double").alias("length"), ntz_to_epoch_ms("l_shipdate").alias("ts"),
        F.col("l_orderkey").alias("sessionId"), F.col("l_linenumber").cast("long").alias("itemInSession"),
        F.col("o_custkey").alias("userId"), F.col("l_returnflag").alias("page"),
        F.col("o_orderstatus").alias("level"), F.col("o_orderpriority").alias("location"),
        F.col("l_linestatus").alias("userAgent"), F.col("o_orderpriority").alias("firstName"),
        F.col("o_orderstatus").alias("lastName"), F.col("l_linestatus").alias("gender"),
        F.col("l_partkey").alias("_partkey"), F.col("l_suppkey").alias("_suppkey"),
        F.col("l_extendedprice").alias("_price"), F.col("l_quantity").alias("_qty"))


LOG_SQL = f"""
SELECT {TITLE_SQL} AS song, p.p_brand AS artist, CAST(p.p_size AS DOUBLE) AS length,
       epoch_us(l.l_shipdate) // 1000 AS ts, l.l_orderkey AS sessionId,
       CAST(l.l_linenumber AS BIGINT) AS itemInSession, o.o_custkey AS userId, l.l_returnflag AS page,
       o.o_orderstatus AS level, o.o_orderpriority AS location, l.l_linestatus AS userAgent,
       o.o_orderpriority AS firstName, o.o_orderstatus AS lastName, l.l_linestatus AS gender,
       l.l_partkey AS _partkey, l.l_suppkey AS _suppkey, l.l_extendedprice AS _price, l.l_quantity AS _qty
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey"""


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CAT as a songs ⋈ artists catalogue: title, artist_name, duration -> song_id, artist_id."""
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("song_id"), F.col("p_brand").alias("artist_id"),
                    F.expr(TITLE).alias("title"),
                    F.when(F.col("p_type") != F.lit(CAT_BLANK_TYPE), F.col("p_brand")).alias("artist_name"),
                    F.col("p_size").cast("double").alias("duration"))


CAT_SQL = f"""
SELECT p_partkey AS song_id, p_brand AS artist_id, {TITLE_SQL} AS title,
       CASE WHEN p_type <> '{CAT_BLANK_TYPE}' THEN p_brand END AS artist_name, CAST(p_size AS DOUBLE) AS duration
FROM part"""


def part_as_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as song documents (song_id = part key as text, artist = brand)."""
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("string").alias("song_id"), F.expr(TITLE).alias("title"),
                    F.col("p_brand").alias("artist_id"), F.col("p_brand").alias("artist_name"),
                    F.col("p_type").alias("artist_location"), F.col("p_retailprice").alias("artist_latitude"),
                    F.col("p_size").cast("double").alias("artist_longitude"),
                    F.col("p_size").cast("double").alias("duration"), F.col("p_size").alias("year"),
                    F.col("p_partkey").alias("_order"))
