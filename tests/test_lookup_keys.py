from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemart.operators import keys, lookup, quality


def test_lookup_first_keeps_misses_and_takes_smallest(spark):
    logs = spark.createDataFrame([(1, "Two Doors", "Velvet Quarry", 187.25546), (2, "Nope", "Nobody", 1.0),
                                  (3, None, "Velvet Quarry", 187.25546)],
                                 "row long, song string, artist string, length double")
    dim = spark.createDataFrame([("S2", "A1", "Two Doors", "Velvet Quarry", 187.25546),
                                 ("S1", "A1", "Two Doors", "Velvet Quarry", 187.25546)],
                                "song_id string, artist_id string, title string, artist_name string, duration double")
    out = lookup.lookup_first(logs, dim, ["song", "artist", "length"], ["title", "artist_name", "duration"],
                              ["song_id"], ["song_id", "artist_id"])
    got = {r.row: (r.song_id, r.artist_id) for r in out.collect()}
    assert got == {1: ("S1", "A1"), 2: (None, None), 3: (None, None)}


def test_title_only_join_fans_out(spark):
    logs = spark.createDataFrame([(1, "Two Doors")], "row long, song string")
    songs = spark.createDataFrame([("S1", "Two Doors", "A1"), ("S2", "Two Doors", "A2")],
                                  "song_id string, title string, artist_id string")
    assert lookup.join_on_keys(logs, songs, "song", "title").count() == 2


def test_fk_and_pk_checks(spark):
    fact = spark.createDataFrame([(1, "u1"), (2, "u9"), (3, None), (4, "u1")], "id long, user_id string")
    users = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    assert [r.id for r in lookup.fk_violations(fact, users, "user_id").collect()] == [2]
    pk = quality.pk_violations(fact, "user_id").collect()
    assert [(r.user_id, r.n_rows) for r in pk] == [("u1", 2)]
    nn = quality.null_violations(fact, ["user_id"]).collect()
    assert [r.id for r in nn] == [3]
    g = spark.createDataFrame([("M",), ("Fe",)], "gender string")
    assert [r.gender for r in quality.length_violations(g, "gender", 1).collect()] == ["Fe"]


def test_dense_ids_match_row_number_under_skew(spark):
    # a hot leading value (a third of the rows) must still be numbered densely and in order
    df = spark.range(0, 6000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("a"),
                                     F.col("id").alias("b"))
    expected = {r.b: r.rn for r in df.select("b", F.row_number().over(Window.orderBy("a", "b")).alias("rn")).collect()}
    for n in (1, 5, 16):
        got = {r.b: r.id for r in keys.dense_ids(df.repartition(n), ["a", "b"], "id", 1, num_partitions=n).collect()}
        assert got == expected
    zero = keys.dense_ids(df, ["a", "b"], "id", 0).agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()
    assert tuple(zero) == (0, 5999, 6000)


def test_dense_ids_plan_has_no_single_partition_exchange_on_rows(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("a"))
    out = keys.dense_ids(df, ["a"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the rows were numbered before the checkpoint; the only single-partition step left is
    # the running sum over the per-partition count table
    assert plan.count("SinglePartition") <= 1


def test_row_at_position(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("x"))
    assert keys.row_at_position(df, ["x"], 0).first().x == 0
    assert keys.row_at_position(df, ["x"], 41).first().x == 41
    assert keys.row_at_position(df, ["x"], 500).count() == 0


def test_dense_ids_join_matches_row_number_of_join(spark):
    left = spark.range(0, 400).select((F.col("id") % 13).alias("k"), F.col("id").alias("lo"),
                                      (F.col("id") * 3).alias("lv"))
    # key 0 is hot on the right; key 12 has no partners; NULL keys never join
    right = spark.range(0, 300).select(F.when(F.col("id") % 3 == 0, F.lit(0))
                                       .when(F.col("id") == 7, F.lit(None)).otherwise(F.col("id") % 12)
                                       .alias("rk"), F.col("id").alias("ro"))
    j = left.join(right, left.k == right.rk)
    expected = {(r.lo, r.ro): r.rn for r in
                j.select("lo", "ro", F.row_number().over(Window.orderBy("lo", "ro")).alias("rn")).collect()}
    for n in (1, 6):
        got = keys.dense_ids_join(left, right, ["k"], ["rk"], ["lo"], ["ro"], "id", 1, num_partitions=n)
        assert got.columns == ["k", "lo", "lv", "rk", "ro", "id"]
        assert {(r.lo, r.ro): r.id for r in got.collect()} == expected


def test_dense_ids_with_aqe_coalescing(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("a"))
        got = keys.dense_ids(df, ["a"], "id", 1).collect()
        assert sorted((r.a, r.id) for r in got) == [(i, i + 1) for i in range(5000)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_row_at_position_is_one_way_for_every_position(spark):
    df = spark.range(0, 3000).select((((F.col("id") + 1) * 7) % 3001).alias("x"))
    for n in (0, 1, 999, 1000, 2500, 2999):
        assert keys.row_at_position(df, ["x"], n).first().x == n + 1
    assert keys.row_at_position(df.where("x < 0"), ["x"], 0).count() == 0


def test_weighted_offsets_match_a_running_sum(spark):
    df = spark.range(0, 2000).select(((F.col("id") * 7919) % 2000).alias("o"), (F.col("id") % 5).alias("w"))
    got = {r.o: r.s for r in keys.weighted_offsets(df, ["o"], "w", "s", 7).collect()}
    total = 0
    for r in sorted(df.collect()):
        assert got[r.o] == total
        total += r.w
