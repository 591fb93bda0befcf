import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart import schemas
from lakemart.sources import readers, sinks
from tests.fixtures import LOG_ROWS, SONG_DOCS, write_json_lines


def _log_tree(tmp_dir):
    # log_data/<year>/<month>/<date>-events.json, split over two days
    for day, rows in (("2018-11-28", LOG_ROWS[:3]), ("2018-11-29", LOG_ROWS[3:])):
        d = os.path.join(tmp_dir, "log_data", "2018", "11")
        os.makedirs(d, exist_ok=True)
        write_json_lines(os.path.join(d, f"{day}-events.json"), rows)
    return os.path.join(tmp_dir, "log_data")


def test_json_tree_and_glob_with_explicit_schema(spark, tmp_dir):
    root = _log_tree(tmp_dir)
    tree = readers.read_json_tree(spark, root, schemas.LOG_JSON)
    glob = readers.read_json_glob(spark, f"{root}/*/*/*.json", schemas.LOG_JSON)
    assert tree.count() == glob.count() == len(LOG_ROWS)
    r = tree.where("ts = 1543449657796").first()
    assert (r.firstName, r.userId, r.sessionId) == ("Tomas", "73", 954)   # camelCase keys read
    inv = readers.file_inventory(tree).collect()
    assert sorted(x.n_rows for x in inv) == [3, len(LOG_ROWS) - 3]


def test_staging_load_drops_undeclared_and_nulls_missing(spark, tmp_dir):
    root = _log_tree(tmp_dir)
    st = readers.load_staging(spark, root, schemas.STAGING_EVENTS)
    assert st.columns == schemas.STAGING_EVENTS.fieldNames()
    assert "page" not in st.columns
    assert st.where("ts = '1543449657796'").first().length == "201.07955"


def test_first_record_per_file(spark, tmp_dir):
    d = os.path.join(tmp_dir, "song_data", "A", "B", "C")
    os.makedirs(d)
    write_json_lines(os.path.join(d, "one.json"), SONG_DOCS[:2])
    write_json_lines(os.path.join(d, "two.json"), SONG_DOCS[2:])
    songs = readers.read_json_tree(spark, os.path.join(tmp_dir, "song_data"), schemas.SONG_JSON)
    seq = songs.withColumn("_line", F.monotonically_increasing_id())
    firsts = readers.first_record_per_file(seq, ["_line"])
    assert sorted(r.song_id for r in firsts.collect()) == ["SOQWERT12B7C5D9F0A", "SOTWODOORS1"]


def test_csv_quoting_round_trip(spark, tmp_dir):
    rows = [("1", 'He said "hi"', "a,b"), ("2", "line one\nline two", ""), ("3", None, "x")]
    df = spark.createDataFrame(rows, "id string, text string, other string")
    path = os.path.join(tmp_dir, "csv")
    sinks.write_csv_quoted(df, path)
    raw = open([os.path.join(path, f) for f in os.listdir(path) if f.endswith(".csv")][0], encoding="utf-8").read()
    assert raw.startswith('"id","text","other"')
    back = readers.read_csv_tree(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in df.columns]))
    got = {r.id: (r.text, r.other) for r in back.collect()}
    assert got["1"] == ('He said "hi"', "a,b")
    assert got["2"][0] == "line one\nline two"
    assert got["2"][1] in (None, "")   # an empty field reads back as NULL
    assert got["3"][0] is None


def test_append_doubles_overwrite_is_idempotent(spark, tmp_dir):
    df = spark.range(0, 50).select(F.col("id"), (F.col("id") % 3).alias("year"))
    a, o = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "o")
    for _ in range(2):
        sinks.write_parquet(df, a, "append", ["year"])
        sinks.write_parquet(df, o, "overwrite", ["year"])
    assert spark.read.parquet(a).count() == 100
    assert spark.read.parquet(o).count() == 50
    # dynamic partition overwrite only replaces the partitions in the batch
    sinks.write_parquet(df.where("year = 1"), o, "overwrite", ["year"])
    assert spark.read.parquet(o).count() == 50


def test_insert_by_name_binds_by_name(spark, tmp_dir):
    src = spark.createDataFrame([(-0.1, 51.5, "London", "Velvet Quarry", "AR1")],
                                "longitude double, latitude double, location string, artist_name string, artist_id string")
    path = os.path.join(tmp_dir, "artists")
    sinks.insert_by_name(src, schemas.ARTISTS, path)
    r = spark.read.parquet(path).first()
    assert spark.read.parquet(path).columns == schemas.ARTISTS.fieldNames()
    assert (r.latitude, r.longitude) == (51.5, -0.1)


def test_load_with_stats(spark, tmp_dir):
    df = spark.range(0, 42)
    stats = sinks.load_with_stats(spark, {"t": (df, os.path.join(tmp_dir, "t"))}).first()
    assert (stats.table_name, stats.n_rows) == ("t", 42)


def test_bucketed_table_aggregates_without_shuffle(spark, tmp_dir):
    df = spark.range(0, 2000).select((F.col("id") % 97).alias("k"), F.col("id").alias("v"))
    sinks.write_bucketed_table(df, "lm_test_bucketed", ["k"], 8, os.path.join(tmp_dir, "b"))
    t = spark.table("lm_test_bucketed")
    agg = t.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert agg.count() == 97 and agg.agg(F.sum("n")).first()[0] == 2000


def test_bucketed_write_makes_one_file_per_bucket(spark, tmp_dir):
    path = os.path.join(tmp_dir, "one")
    df = spark.range(0, 4000).repartition(16).select((F.col("id") % 97).alias("k"), F.col("id").alias("v"))
    sinks.write_bucketed_table(df, "lm_test_one_file", ["k"], 8, path)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) <= 8


def test_layouts_hold_in_the_written_files(spark, tmp_dir):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 311).alias("k"), (F.col("id") % 13).alias("c"))
    for name, out, order in (("dist", sinks.layout_hash_sorted(df, ["k"]), ["k"]),
                             ("clust", sinks.layout_clustered(df, ["k"], ["c"]), ["k", "c"])):
        path = os.path.join(tmp_dir, name)
        sinks.write_parquet(out, path, "overwrite")
        rows = (spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("f"),
                                                F.col("_metadata.row_index").alias("i")).collect())
        files = {}
        for r in sorted(rows, key=lambda r: (r.f, r.i)):
            files.setdefault(r.f, []).append(tuple(r[c] for c in order))
        assert all(v == sorted(v) for v in files.values())          # sorted inside each file
        owner = {}
        for f, v in files.items():
            for t in v:
                assert owner.setdefault(t[0], f) == f               # a key is in one file
    years = os.path.join(tmp_dir, "years")
    sinks.write_parquet(df.withColumnRenamed("c", "year"), years, "append", ["year"], ["k"])
    assert len(os.listdir(years)) >= 13


def test_csv_without_line_breaks_can_be_split(spark, tmp_dir):
    path = os.path.join(tmp_dir, "flat")
    sinks.write_csv_quoted(spark.range(0, 100).select(F.col("id").cast("string").alias("a"), F.lit('x "y", z').alias("b")), path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b")])
    assert readers.read_csv_tree(spark, path, schema, multi_line=False).where(F.col("b") == 'x "y", z').count() == 100


def test_staging_load_rejects_bad_values_and_nulls_empty_text(spark, tmp_dir):
    import pytest
    schema = T.StructType([T.StructField("userId", T.IntegerType()), T.StructField("ts", T.StringType())])
    good = os.path.join(tmp_dir, "good")
    os.makedirs(good)
    write_json_lines(os.path.join(good, "a.json"), [{"userId": "7", "ts": "1"}, {"userId": "", "ts": "2"}])
    rows = {r.ts: r.userId for r in readers.load_staging(spark, good, schema).collect()}
    assert rows == {"1": 7, "2": None}
    bad = os.path.join(tmp_dir, "bad")
    os.makedirs(bad)
    write_json_lines(os.path.join(bad, "b.json"), [{"userId": "seven", "ts": "3"}])
    with pytest.raises(Exception):
        readers.load_staging(spark, bad, schema).collect()
