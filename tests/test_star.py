"""End-to-end: raw log + song documents -> star schema, on the published sample rows."""

import os

from lakemart import schemas
from lakemart.plans import star
from lakemart.sources import readers
from tests.fixtures import LOG_ROWS, SONG_DOCS, write_json_lines


def _inputs(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "log"), exist_ok=True)
    os.makedirs(os.path.join(tmp_dir, "song"), exist_ok=True)
    write_json_lines(os.path.join(tmp_dir, "log", "e.json"), LOG_ROWS)
    for i, d in enumerate(SONG_DOCS):
        write_json_lines(os.path.join(tmp_dir, "song", f"s{i}.json"), [d])
    log = readers.read_json_tree(spark, os.path.join(tmp_dir, "log"), schemas.LOG_JSON)
    songs = readers.read_json_tree(spark, os.path.join(tmp_dir, "song"), schemas.SONG_JSON)
    return log, songs


def test_star_schema(spark, tmp_dir):
    log, songs = _inputs(spark, tmp_dir)
    t = star.star_schema(log, songs)
    users = {r.user_id: r for r in t["users"].collect()}
    assert set(users) == {"73", "24"}
    assert users["24"].level == "free" and users["24"].first_name == "Ines"   # last level, first attributes
    time = {r.start_time: r for r in t["time"].collect()}
    g = time[1543449657796]
    assert (g.hour, g.day, g.week, g.month, g.year, g.weekday) == (0, 29, 48, 11, 2018, 3)
    plays = sorted(t["songplays"].collect(), key=lambda r: r.songplay_id)
    assert [p.songplay_id for p in plays] == list(range(1, 7))            # dense from 1, listens only
    hits = {p.start_time: p.song_id for p in plays}
    assert hits[1543449690796] == "SOPAPER"
    assert hits[1543450033796] == "SOTWODOORS1"                               # first match: smallest id
    assert hits[1543449657796] is None                                      # miss keeps the row
    checks = {r.table_name: r for r in star.star_checks(t).collect()}
    assert checks["songplays"].n_rows == 6
    assert all(c.pk_violations == 0 and c.fk_violations == 0 for c in checks.values())


def test_three_time_tables(spark, tmp_dir):
    log, _ = _inputs(spark, tmp_dir)
    st = log.select(*[c for c in schemas.STAGING_EVENTS.fieldNames()]).withColumn("ts", log["ts"].cast("string"))
    a = star.time_table(log, "mon0").where("start_time = 1543449657796").first()
    b = star.time_all_events(st).where("start_time = 1543449657796").first()
    c = star.time_sun1(log).where("start_time = 1543449657796").first()
    assert (a.weekday, b.weekday, c.weekday) == (3, 4, 5)
    assert star.time_all_events(st).count() == len(LOG_ROWS)   # all events, no dedupe


def test_user_tables_differ(spark, tmp_dir):
    log, _ = _inputs(spark, tmp_dir)
    assert star.users_merge(log).count() == 2
    assert star.users_distinct(log).count() == 3      # Ines at two levels keeps two rows


def test_song_and_artist_tables(spark, tmp_dir):
    _, songs = _inputs(spark, tmp_dir)
    assert star.songs_first(songs, ["song_id"]).count() == 4
    arts = {r.artist_id: r for r in star.artists_first(songs, ["song_id"]).collect()}
    assert arts["ARVELVET"].latitude == 51.5 and arts["ARVELVET"].longitude == -0.1
    d = {r.artist_id: r for r in star.artists_distinct(songs).collect()}
    assert d["ARXYZ3K2298C005BC8"].artist_latitude == 0.0                  # NULL -> 0
    assert star.artists_distinct(songs).count() == 3


def test_two_key_and_title_joins(spark, tmp_dir):
    log, songs = _inputs(spark, tmp_dir)
    st = log.select(*schemas.STAGING_EVENTS.fieldNames())
    two = star.songplays_two_key(st, songs).collect()
    assert sorted(r.songplay_id for r in two) == list(range(len(two)))      # dense from 0
    assert len(two) == 5   # Copper Finch once, Velvet Quarry twice x two catalogue copies
    title = star.songplays_title(log, songs, songs.select("artist_id"))
    assert title.count() == 5


def test_title_join_keeps_songs_without_id(spark, tmp_dir):
    log, songs = _inputs(spark, tmp_dir)
    doors = songs.where("title = 'Two Doors'")
    blank = doors.limit(1).selectExpr("* except (song_id)", "cast(null as string) as song_id").select(songs.columns)
    both = doors.where("song_id = 'SOTWODOORS1'").unionByName(blank)
    got = star.songplays_title(log, both, both.select("artist_id")).select("song_id").distinct().collect()
    assert sorted((r.song_id or "") for r in got) == ["", "SOTWODOORS1"]


def test_null_defaults_of_insert_select_builders(spark):
    # num_songs, artist_id, artist_latitude, artist_longitude, artist_location, artist_name,
    # song_id, title, duration, year
    ss = spark.createDataFrame([(1, None, "1.5", "2.5", "loc", None, None, "T", "100.0", 2000),
                                (1, "AR1", None, None, "", "Name", "S1", "T2", "1.0", 0)],
                               schemas.STAGING_SONGS)
    a = {r.artist_id: r for r in star.artists_default(ss).collect()}
    assert a["0"].artist_name == "N/A" and a["0"].latitude == "1.5" and a["0"].longitude == "2.5"
    assert a["AR1"].artist_name == "Name"
    assert sorted(r.song_id for r in star.songs_default(ss).collect()) == ["0", "S1"]
