"""The four loaders end to end on the published sample rows."""

import csv
import os

from lakemart import schemas
from lakemart.operators.project import key_lookup
from lakemart.plans import jobs
from tests.fixtures import LOG_ROWS, SONG_DOCS, write_json_lines


def _csv_tree(root):
    d = os.path.join(root, "event_data")
    os.makedirs(d)
    for i, rows in enumerate((LOG_ROWS[:4], LOG_ROWS[4:])):
        with open(os.path.join(d, f"2018-11-{i + 1:02d}-events.csv"), "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f)
            w.writerow(schemas.LOG_CSV.fieldNames())
            for r in rows:
                w.writerow(["" if r[c] is None else r[c] for c in schemas.LOG_CSV.fieldNames()])
    return d


def _json_trees(root):
    for i, doc in enumerate(SONG_DOCS):
        d = os.path.join(root, "song_data", "A", "B", chr(ord("A") + i))
        os.makedirs(d, exist_ok=True)
        write_json_lines(os.path.join(d, f"TR{i}.json"), [doc])
    d = os.path.join(root, "log_data", "2018", "11")
    os.makedirs(d)
    write_json_lines(os.path.join(d, "2018-11-28-events.json"), LOG_ROWS[:3])
    write_json_lines(os.path.join(d, "2018-11-29-events.json"), LOG_ROWS[3:])
    return os.path.join(root, "song_data"), os.path.join(root, "log_data")


def test_lookup_tables(spark, tmp_dir):
    src = _csv_tree(tmp_dir)
    t = jobs.lookup_tables(spark, src, os.path.join(tmp_dir, "out"))
    item = key_lookup(t["song_playlist_artists"], sessionId=954, itemInSession=53).collect()
    assert [(r.artist, r.song, round(r.length, 3)) for r in item] == [("Harbour Lanterns", "Don't Wake the Tide",
                                                                       201.08)]
    sess = key_lookup(t["song_playlist_sessions"], ["itemInSession"], userId=24, sessionId=984).collect()
    assert [r.itemInSession for r in sess] == [88, 89, 90, 91]
    listeners = key_lookup(t["song_playlist_users"], ["userId"], song="Two Doors").collect()
    assert [(r.firstName, r.lastName) for r in listeners] == [("Ines", "Marlow")]
    # the visitor row without an artist is not a listen
    assert t["song_playlist_artists"].count() == len(LOG_ROWS) - 1


def test_star_upsert(spark, tmp_dir):
    songs, logs = _json_trees(tmp_dir)
    t = jobs.star_upsert(spark, songs, logs, os.path.join(tmp_dir, "out"))
    assert t["songplays"].schema == schemas.SONGPLAYS or t["songplays"].columns == schemas.SONGPLAYS.fieldNames()
    assert t["songplays"].count() == 6
    checks = {r.table_name: r for r in t["checks"].collect()}
    assert checks["users"].n_rows == 2 and checks["songs"].n_rows == 4 and checks["artists"].n_rows == 3
    assert sum(r.pk_violations + r.fk_violations for r in checks.values()) == 0


def test_warehouse(spark, tmp_dir):
    songs, logs = _json_trees(tmp_dir)
    t = jobs.warehouse(spark, songs, logs, os.path.join(tmp_dir, "out"))
    stats = {r.table_name: r.n_rows for r in t["load_stats"].collect()}
    assert stats["staging_events"] == len(LOG_ROWS) and stats["staging_songs"] == len(SONG_DOCS)
    assert stats["users"] == len(LOG_ROWS)                   # insert-select, no dedupe
    assert stats["songplays"] == 5
    assert sorted(r.songplay_id for r in t["songplays"].collect()) == [0, 1, 2, 3, 4]
    visitor = t["users"].where("user_id = 0").count()
    assert visitor == 1                                      # NULL user id -> typed default


def test_data_lake_modes(spark, tmp_dir):
    songs, logs = _json_trees(tmp_dir)
    out = os.path.join(tmp_dir, "lake")
    jobs.data_lake(spark, songs, logs, out, "overwrite")
    t = jobs.data_lake(spark, songs, logs, out, "overwrite")
    assert t["songs"].count() == 4 and t["songplays"].count() == 5
    assert set(t["songs"].columns) >= {"year", "artist_id"}
    t = jobs.data_lake(spark, songs, logs, out, "append")
    assert t["songs"].count() == 8                           # append doubles on rerun


def test_last_write_is_the_last_in_the_source_files(spark, tmp_dir):
    # whichever day's file is larger, day 2 comes after day 1
    for name, sizes in (("large_first", (400, 1)), ("large_last", (1, 400))):
        d = os.path.join(tmp_dir, name)
        os.makedirs(d)
        for day, n in enumerate(sizes, start=1):
            with open(os.path.join(d, f"2018-11-{day:02d}-events.csv"), "w", newline="", encoding="utf-8") as f:
                w = csv.writer(f)
                w.writerow(schemas.LOG_CSV.fieldNames())
                for i in range(n):
                    r = dict(LOG_ROWS[0], itemInSession=i, song=f"day {day}")
                    w.writerow(["" if r[c] is None else r[c] for c in schemas.LOG_CSV.fieldNames()])
        t = jobs.lookup_tables(spark, d, os.path.join(tmp_dir, name + "_out"))
        row = key_lookup(t["song_playlist_artists"], sessionId=954, itemInSession=0).first()
        assert (row.song, row.userId) == ("day 2", 73)


def test_star_merge_goes_on_after_the_stored_batches(spark, tmp_dir):
    songs, logs = _json_trees(tmp_dir)
    out = os.path.join(tmp_dir, "store")
    later = os.path.join(tmp_dir, "later")
    os.makedirs(later)
    write_json_lines(os.path.join(later, "2018-11-30-events.json"),
                     [dict(LOG_ROWS[4], ts=1543550000000, level="free", firstName="Other", itemInSession=95)])
    jobs.star_merge(spark, songs, logs, out)
    for _ in range(2):   # the last batch again changes nothing
        t = jobs.star_merge(spark, songs, later, out, batch=1)
        plays = sorted((r.songplay_id, r.song_id) for r in t["songplays"].collect())
        assert [i for i, _ in plays] == list(range(1, 8)) and plays[-1] == (7, "SOTWODOORS1")
        users = {r.user_id: (r.first_name, r.level) for r in t["users"].collect()}
        assert users["24"] == ("Ines", "free") and len(users) == 2
        assert t["songs"].count() == 4 and t["time"].count() == 7


def test_cli(tmp_dir):
    songs, logs = _json_trees(tmp_dir)
    assert jobs.main(["star_upsert", "--songs", songs, "--logs", logs, "--out", os.path.join(tmp_dir, "cli"),
                      "--master", "local[2]"]) == 0


def test_star_upsert_takes_first_record_per_song_file(spark, tmp_dir):
    songs, logs = _json_trees(tmp_dir)
    extra = dict(SONG_DOCS[0], song_id="SOSECONDLINE")
    d = os.path.join(songs, "A", "B", "A")
    write_json_lines(os.path.join(d, "TR0.json"), [SONG_DOCS[0], extra])
    t = jobs.star_upsert(spark, songs, logs, os.path.join(tmp_dir, "out2"))
    ids = {r.song_id for r in t["songs"].collect()}
    assert "SOSECONDLINE" not in ids and "SOQWERT12B7C5D9F0A" in ids


def test_lookup_tables_bucketed_prune_to_one_bucket(spark, tmp_dir):
    src = _csv_tree(tmp_dir)
    t = jobs.lookup_tables(spark, src, os.path.join(tmp_dir, "outb"), buckets=4)
    # the planner turns the bucketed scan off when no join/aggregate needs it (files are still
    # pruned by bucket id); with it on, the plan reports the pruning
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")
        q = key_lookup(t["song_playlist_artists"], sessionId=954, itemInSession=53)
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 1 out of 4" in plan
        assert [r.artist for r in q.collect()] == ["Harbour Lanterns"]
    finally:
        spark.conf.set(key, old)
