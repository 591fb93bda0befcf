"""Batches and growing folders loaded into a stored star schema."""

import glob
import gzip
import json
import os

import pytest

from lakemart import schemas
from lakemart.plans import incremental, jobs, queries
from lakemart.plans.star import LOG_ORDER
from lakemart.session import ensure_checkpoint_dir, read_table
from pyspark.sql import functions as F
from tests.conftest import SMALL_SF
from tests.fixtures import LOG_ROWS, SONG_DOCS, write_json_lines


def _log(spark, *rows):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schemas.LOG_JSON.fields) for r in rows], schemas.LOG_JSON)


def _songs(spark, *docs):
    return spark.createDataFrame([tuple(d.get(f.name) for f in schemas.SONG_JSON.fields) for d in docs], schemas.SONG_JSON)


def _files(store, *tables):
    return {os.path.relpath(f, store) for t in tables for f in glob.glob(os.path.join(store, t, "**", "part-*"), recursive=True)}


def _plays(t):
    return sorted((r.songplay_id, r.session_id, r.start_time, r.song_id) for r in t["songplays"].collect())


def test_later_batches_rewrite_no_file(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    incremental.load_batch(spark, store, _log(spark, *LOG_ROWS[:3]), _songs(spark, *SONG_DOCS[:2]))
    before = _files(store, "users", "songs", "artists", "time", "songplays")
    t = incremental.load_batch(spark, store, _log(spark, *LOG_ROWS[3:]), _songs(spark, *SONG_DOCS))
    assert before <= _files(store, "users", "songs", "artists", "time", "songplays")
    stats = {r.table_name: r.n_rows for r in t["load_stats"].collect()}
    assert stats == {"users": 2, "songs": 2, "artists": 1, "time": 3, "songplays": 3}   # only what was absent
    whole = incremental.load_batch(spark, os.path.join(tmp_dir, "whole"), _log(spark, *LOG_ROWS), _songs(spark, *SONG_DOCS))
    for n in ("users", "songs", "artists", "time"):
        assert sorted(map(tuple, t[n].select(*whole[n].columns).collect()), key=str) == sorted(map(tuple, whole[n].collect()), key=str)
    assert [p[:3] for p in _plays(t)] == [p[:3] for p in _plays(whole)]


def test_stored_rows_win_and_repeats_add_nothing(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    incremental.load_batch(spark, store, _log(spark, *LOG_ROWS), _songs(spark, *SONG_DOCS))
    for _ in range(2):
        t = incremental.load_batch(spark, store, _log(spark), _songs(spark, dict(SONG_DOCS[1], title="other"), SONG_DOCS[1]), batch=1)
        assert {r.song_id: r.title for r in t["songs"].collect()}["SOTWODOORS2"] == "Two Doors" and t["songs"].count() == 4


def test_keys_are_asked_by_a_semi_join_that_does_not_shuffle_the_store(spark, tmp_dir):
    path = os.path.join(tmp_dir, "held")
    spark.range(1000).selectExpr("id as k", "id as v").write.parquet(path)
    rows = spark.createDataFrame([(5, 1), (2000, 1)], "k long, v long")
    got = incremental.absent_rows(rows, spark.read.parquet(path), "k", (5, 2000))
    assert [r.k for r in got.collect()] == [2000]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,5)" in plan and "LessThanOrEqual(k,2000)" in plan   # reach the file's statistics


@pytest.mark.parametrize("count", [1, 4])
def test_an_earlier_batch_again_keeps_ids_dense(spark, tmp_dir, count):
    store = os.path.join(tmp_dir, "store")
    songs = _songs(spark, *SONG_DOCS)
    incremental.load_batch(spark, store, _log(spark, *LOG_ROWS[:2]), songs, 0)
    incremental.load_batch(spark, store, _log(spark, *LOG_ROWS[3:]), songs, 1)
    more = [dict(LOG_ROWS[0], ts=1543440000000 + i, itemInSession=i) for i in range(count)]
    t = incremental.load_batch(spark, store, _log(spark, *more), songs, 0)
    plays = _plays(t)
    assert [p[0] for p in plays] == list(range(1, count + 4))
    assert [p[2] for p in plays] == sorted(p[2] for p in plays)
    with pytest.raises(ValueError, match="older than the last"):
        incremental.load_batch(spark, store, _log(spark, *more), songs, 0, earlier="refuse")


@pytest.mark.parametrize("logs,songs", [([], SONG_DOCS), (LOG_ROWS, []), ([], []), ([LOG_ROWS[5]], SONG_DOCS)])
def test_a_first_batch_without_rows(spark, tmp_dir, logs, songs):
    store = os.path.join(tmp_dir, "store")
    t = incremental.load_batch(spark, store, _log(spark, *logs), _songs(spark, *songs))
    listens = sum(r["page"] == "NextSong" for r in logs)
    assert t["songplays"].count() == listens and t["songs"].count() == len(songs)
    t = incremental.load_batch(spark, store, _log(spark, *LOG_ROWS), _songs(spark, *SONG_DOCS))
    assert [p[0] for p in _plays(t)] == list(range(1, listens + 7))
    assert t["songs"].count() == 4 and t["users"].count() == 2


def test_late_songs_are_found_and_other_batches_left_alone(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    incremental.load_batch(spark, store, _log(spark, *LOG_ROWS[:2]), _songs(spark))
    incremental.load_batch(spark, store, _log(spark, LOG_ROWS[4]), _songs(spark, SONG_DOCS[0]))
    incremental.load_batch(spark, store, _log(spark, LOG_ROWS[3]), _songs(spark))
    before = _files(store, "songplays")
    t = incremental.load_batch(spark, store, _log(spark, LOG_ROWS[6]), _songs(spark, *SONG_DOCS[1:3]), resolve_late=True)
    found = {r.start_time: (r.song_id, r.artist_id) for r in t["songplays"].collect()}
    assert found[LOG_ROWS[4]["ts"]] == ("SOTWODOORS1", "ARVELVET") == found[LOG_ROWS[6]["ts"]]
    assert sum(s is not None for s, _ in found.values()) == 2 and len(found) == 5
    gone = before - _files(store, "songplays")
    assert gone and all("batch=1" in f for f in gone)
    # an artist may be late, too
    docs = [dict(SONG_DOCS[3], artist_name=None)]
    incremental.load_batch(spark, store, _log(spark), _songs(spark, *docs), resolve_late=True)
    t = incremental.load_batch(spark, store, _log(spark), _songs(spark, dict(SONG_DOCS[3], song_id="SOOTHER", title="x")), resolve_late=True)
    assert {r.start_time: r.song_id for r in t["songplays"].collect()}[LOG_ROWS[1]["ts"]] == "SOPAPER"


def _put(root, name, rows):
    os.makedirs(root, exist_ok=True)
    write_json_lines(os.path.join(root, name), rows)


def test_a_growing_folder_is_loaded_once(spark, tmp_dir):
    songs, logs, store = (os.path.join(tmp_dir, n) for n in ("songs", "logs", "store"))
    for i, d in enumerate(SONG_DOCS):
        _put(songs, f"TR{i}.json", [d])
    _put(logs, "2018-11-28.json", LOG_ROWS[:3])
    jobs.star_merge(spark, songs, logs, store)
    _put(os.path.join(logs, "deep"), "2018-11-29.json", LOG_ROWS[3:])
    for _ in range(2):   # the second time there is nothing new
        t = jobs.star_merge(spark, songs, logs, store)
        assert [p[0] for p in _plays(t)] == list(range(1, 7))
    assert len(glob.glob(os.path.join(store, "songplays", "batch=*"))) == 2
    whole = jobs.star_merge(spark, songs, logs, os.path.join(tmp_dir, "whole"))
    assert _plays(t) == _plays(whole)
    # a file that changed: its batch is loaded again, as it is now
    _put(logs, "2018-11-28.json", LOG_ROWS[:2])
    t = jobs.star_merge(spark, songs, logs, store)
    assert [p[0] for p in _plays(t)] == list(range(1, 6))
    os.remove(os.path.join(logs, "2018-11-28.json"))
    with pytest.raises(ValueError, match="gone"):
        jobs.star_merge(spark, songs, logs, store)


def test_a_load_leaves_no_scratch_and_reads_compressed_files(spark, tmp_dir):
    songs, logs, store = (os.path.join(tmp_dir, n) for n in ("songs", "logs", "store"))
    for i, d in enumerate(SONG_DOCS):
        _put(songs, f"TR{i}.json", [d])
    _put(logs, "2018-11-28.json", LOG_ROWS[:3])
    scratch = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "lakemart-scratch")
    held = set(glob.glob(f"{scratch}/*"))
    jobs.star_merge(spark, songs, logs, store)
    with gzip.open(os.path.join(logs, "2018-11-29.json.gz"), "wt") as f:
        f.writelines(json.dumps(r) + "\n" for r in LOG_ROWS[3:])
    t = jobs.star_merge(spark, songs, logs, store)
    assert set(glob.glob(f"{scratch}/*")) == held
    assert [p[0] for p in _plays(t)] == list(range(1, 7)) and t["load_stats"].count() > 0
    whole = jobs.star_merge(spark, songs, logs, os.path.join(tmp_dir, "whole"))
    assert _plays(t) == _plays(whole)


def test_a_growing_folder_holds_each_log_once(spark):
    """Beside the store only the folder's files stay, in the size of the rows, not of their JSON text."""
    scratch = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "lakemart-scratch")
    held = set(glob.glob(f"{scratch}/*"))
    assert queries.QUERIES["star_growing_folder"](spark, SMALL_SF).count() > 0
    new = set(glob.glob(f"{scratch}/*")) - held
    assert [os.path.basename(x).split("-")[0] for x in new] == ["growing"]
    files = [f for f in glob.glob(f"{new.pop()}/logs/**/part-*", recursive=True) if not f.endswith(".crc")]
    lines = spark.read.text(files)
    size, text = sum(os.path.getsize(f) for f in files), lines.agg(F.sum(F.length("value") + 1)).first()[0]
    assert lines.count() == read_table(spark, SMALL_SF, "lineitem").count() and size < text / 4


def test_orders_of_batches_decide_users(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    later = dict(LOG_ROWS[4], ts=1, level="free", firstName="Other")
    incremental.load_batch(spark, store, _log(spark, *LOG_ROWS[:2]), _songs(spark))
    t = incremental.load_batch(spark, store, _log(spark, later), _songs(spark), order_by=LOG_ORDER)
    assert {r.user_id: (r.first_name, r.level) for r in t["users"].collect()}["24"] == ("Ines", "free")
    assert t["time"].where(F.col("start_time") == 1).count() == 1


def test_lake_without_listens(spark, tmp_dir):
    d = os.path.join(tmp_dir, "songs", "A", "B", "C")
    _put(d, "T.json", SONG_DOCS[:1])
    _put(os.path.join(tmp_dir, "logs", "2018", "11"), "a.json", [LOG_ROWS[5]])
    for mode in ("overwrite", "append"):
        t = jobs.data_lake(spark, os.path.join(tmp_dir, "songs"), os.path.join(tmp_dir, "logs"), os.path.join(tmp_dir, "lake"), mode)
        assert t["songplays"].count() == 0 and t["time"].count() == 0 and t["users"].count() == 0
