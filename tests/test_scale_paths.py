"""Plans that small inputs never take on their own: no broadcast (sort-merge join with AQE skew
splitting), a hot key holding a third of the rows, and brute-force property checks."""

import os

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.operators import dedupe, keys, lookup, project
from lakemart.sources import sinks


def _no_broadcast(spark):
    saved = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                   "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    return saved


def _restore(spark, saved):
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_lookup_without_broadcast_and_hot_key(spark):
    saved = _no_broadcast(spark)
    try:
        # a third of the log rows carry the same title
        logs = spark.range(0, 3000).select(
            F.col("id").alias("row"),
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("id") % 50).cast("string")))
            .alias("song"))
        dim = spark.range(0, 120).select(F.col("id").alias("song_id"),
                                         F.when(F.col("id") < 10, F.lit("hot"))
                                         .otherwise(F.concat(F.lit("t"), (F.col("id") % 40).cast("string"))).alias("title"))
        out = lookup.lookup_first(logs, dim, "song", "title", ["song_id"], ["song_id"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        got = {r.row: r.song_id for r in out.collect()}
        assert len(got) == 3000                                  # every log row kept, no fan-out
        assert got[0] == 0                                       # hot title -> smallest id
        assert got[1] == 41 and got[49] is None                  # t1 -> 41 (of 41, 81); no t49 in the catalogue
    finally:
        _restore(spark, saved)


def test_dense_ids_join_without_broadcast(spark):
    saved = _no_broadcast(spark)
    try:
        left = spark.range(0, 200).select((F.col("id") % 5).alias("k"), F.col("id").alias("lo"))
        right = spark.range(0, 60).select((F.col("id") % 4).alias("rk"), F.col("id").alias("ro"))
        got = keys.dense_ids_join(left, right, ["k"], ["rk"], ["lo"], ["ro"], "id", 0)
        rows = sorted((r.lo, r.ro, r.id) for r in got.collect())
        assert [r[2] for r in rows] == list(range(len(rows)))
    finally:
        _restore(spark, saved)


rows_strategy = st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["a", "b", None]),
                                   st.sampled_from(["free", "paid"])), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_keyed_semantics_match_brute_force(spark, rows):
    data = [(k, a, lv, i) for i, (k, a, lv) in enumerate(rows)]
    pdf = pd.DataFrame(data, columns=["k", "attr", "level", "o"]).sort_values("o")
    df = spark.createDataFrame(data, "k long, attr string, level string, o long").repartition(3)

    def norm(x):
        return None if x is None or (isinstance(x, float) and pd.isna(x)) else x

    first = {k: (norm(g.iloc[0].attr), g.iloc[0].level) for k, g in pdf.groupby("k")}
    last = {k: (norm(g.iloc[-1].attr), g.iloc[-1].level) for k, g in pdf.groupby("k")}
    merged = {k: (norm(g.iloc[0].attr), g.iloc[-1].level) for k, g in pdf.groupby("k")}
    got_first = {r.k: (r.attr, r.level) for r in dedupe.keep_first(df, "k", ["o"], cols=["attr", "level"]).collect()}
    got_last = {r.k: (r.attr, r.level) for r in dedupe.last_write_wins(df, "k", ["o"], cols=["attr", "level"]).collect()}
    got_merged = {r.k: (r.attr, r.level)
                  for r in dedupe.first_attrs_last_status(df, "k", ["attr"], ["level"], ["o"]).collect()}
    assert got_first == first and got_last == last and got_merged == merged
    distinct = {(k, norm(a), lv) for k, a, lv in rows}
    assert {tuple(r) for r in dedupe.distinct_rows(df, ["k", "attr", "level"]).collect()} == distinct


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_selection_neither_shuffles_nor_writes(spark, monkeypatch):
    import random
    rnd = random.Random(5)
    rows = sorted([(rnd.choice([None, 1, 1, 1, 2, 3]), rnd.choice(["a", "b", None]), i) for i in range(9000)],
                  key=lambda r: tuple((v is not None, v) if v is not None else (False, 0 if k != 1 else "") for k, v in enumerate(r)))
    df = spark.createDataFrame(rnd.sample(rows, len(rows)), "a int, b string, c long").repartition(6)
    monkeypatch.setattr(keys, "_stored", None)
    for n in (0, 1, 2999, 4500, 8998, 8999):
        got = keys.row_at_position(df, ["a", "b", "c"], n, at_once=50, cuts=4)
        assert tuple(got.first()) == rows[n]
        assert "Exchange" not in _plan(got.select("c")).replace("Exchange RoundRobinPartitioning", "").replace("Exchange SinglePartition", "")
    assert keys.row_at_position(df, ["a", "b", "c"], 9000, at_once=50, cuts=4).count() == 0
    hot = spark.range(5000).selectExpr("id div 4000 as k", "timestamp_ntz '2020-01-01 00:00:00' as t")
    assert keys.row_at_position(hot, ["t", "k"], 3999, at_once=10, cuts=4).first().k == 0
    assert keys.row_at_position(hot, ["t", "k"], 4000, at_once=10, cuts=4).first().k == 1


def test_lookups_by_a_composite_key_read_one_bucket(spark, tmp_dir):
    df = spark.range(200).selectExpr("cast(id % 7 as int) as u", "cast(id % 11 as string) as s", "id as item", "id as v")
    sinks.write_bucketed_table(df, "t_composite", ["u", "s"], 4, os.path.join(tmp_dir, "t"), ["u", "s", "item"])
    sinks.write_bucketed_table(df, "t_single", ["u"], 4, os.path.join(tmp_dir, "t1"))
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")
        one = project.key_lookup(spark.table("t_composite"), ["item"], u=3, s="5")
        assert "SelectedBucketsCount: 1 out of 4" in _plan(one)
        assert [r.item for r in one.collect()] == [i for i in range(200) if i % 7 == 3 and i % 11 == 5] and "_key" not in one.columns
        assert "SelectedBucketsCount: 1 out of 4" in _plan(project.key_lookup(spark.table("t_single"), u=3))
        part = project.key_lookup(spark.table("t_composite"), u=3)   # part of the key: every bucket, same rows
        assert part.count() == sum(i % 7 == 3 for i in range(200))
    finally:
        spark.conf.set(key, old)


def test_joins_over_stored_buckets_do_not_shuffle(spark, tmp_dir):
    left = spark.range(300).selectExpr("concat('t', id % 20) as title", "if(id % 5 = 0, null, cast(id % 3 as double)) as len", "id as n")
    right = spark.range(60).selectExpr("concat('t', id % 25) as name", "cast(id % 3 as double) as dur", "id as song")
    sinks.write_bucketed_table(left, "t_left", ["title", "len"], 4, os.path.join(tmp_dir, "l"))
    sinks.write_bucketed_table(right, "t_right", ["name", "dur"], 4, os.path.join(tmp_dir, "r"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = lookup.lookup_first_bucketed(spark.table("t_left"), spark.table("t_right"), ["title", "len"], ["name", "dur"], ["song"], ["song"])
        want = lookup.lookup_first(left, right, ["title", "len"], ["name", "dur"], ["song"], ["song"])
        assert "Exchange" not in _plan(got)
        assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        pairs = lookup.join_bucketed(spark.table("t_left"), spark.table("t_right"), ["title", "len"], ["name", "dur"])
        assert "Exchange" not in _plan(pairs)
        assert pairs.count() == lookup.join_on_keys(left, right, ["title", "len"], ["name", "dur"]).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_checks_read_every_table_once(spark, tmp_dir):
    from lakemart.plans import star
    tables = {"users": "user_id long, gender string", "songs": "song_id string, artist_id string", "artists": "artist_id string, artist_name string",
              "time": "start_time long, hour int, day int, week int, month int, year int, weekday int",
              "songplays": "songplay_id long, start_time long, user_id long, song_id string, artist_id string"}
    rows = {"users": [(1, "M"), (1, "F"), (None, "MM"), (2, None)], "songs": [("s", "a"), ("t", "x"), ("u", None)], "artists": [("a", None)],
            "time": [(1, 1, 1, 1, 1, 1, 1)], "songplays": [(1, 1, 1, "s", "a"), (2, None, 9, "q", None), (2, 1, None, None, "z")]}
    for n, schema in tables.items():
        spark.createDataFrame(rows[n], schema).write.parquet(os.path.join(tmp_dir, n))
    checks = star.star_checks({n: spark.read.parquet(os.path.join(tmp_dir, n)) for n in tables})
    assert _plan(checks).count("FileScan parquet") == 5
    got = {r.table_name: tuple(r)[1:] for r in checks.collect()}
    assert got == {"users": (4, 1, 1, 0, 1), "songs": (3, 0, 0, 1, 0), "artists": (1, 0, 1, 0, 0), "time": (1, 0, 0, 0, 0),
                   "songplays": (3, 1, 2, 3, 0)}


def test_a_hot_bucket_is_written_by_several_tasks(spark, tmp_dir):
    import glob
    import re
    df = spark.range(60000, numPartitions=4).selectExpr("if(id % 3 = 0, 7, id) as k", "uuid() as v")
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
        sinks.write_bucketed_table(df, "t_hot", ["k"], 4, os.path.join(tmp_dir, "hot"))
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    buckets = [int(re.search(r"_(\d{5})\.c000", f)[1]) for f in glob.glob(os.path.join(tmp_dir, "hot", "part-*"))]
    assert set(buckets) == {0, 1, 2, 3} and len(buckets) > 4
    assert spark.table("t_hot").count() == 60000 and project.key_lookup(spark.table("t_hot"), k=7).count() == 20001
