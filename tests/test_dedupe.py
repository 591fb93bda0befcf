"""The four keyed semantics must give four different answers on the same input."""

from pyspark.sql import functions as F

from lakemart.operators import dedupe

SCHEMA = "k long, attr string, level string, o long"


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_rename_and_upgrade_case(spark):
    df = spark.createDataFrame([(1, "A", "free", 1), (1, "B", "paid", 2)], SCHEMA)
    assert _rows(dedupe.distinct_rows(df, ["k", "attr", "level"]), ["k", "attr", "level"]) == [
        (1, "A", "free"), (1, "B", "paid")]
    assert _rows(dedupe.keep_first(df, "k", ["o"], cols=["attr", "level"]), ["k", "attr", "level"]) == [
        (1, "A", "free")]
    assert _rows(dedupe.last_write_wins(df, "k", ["o"], cols=["attr", "level"]), ["k", "attr", "level"]) == [
        (1, "B", "paid")]
    assert _rows(dedupe.first_attrs_last_status(df, "k", ["attr"], ["level"], ["o"]), ["k", "attr", "level"]) == [
        (1, "A", "paid")]


def test_level_change_case(spark):
    df = spark.createDataFrame([(1, "A", "free", 1), (1, "B", "paid", 2), (1, "A", "free", 3)], SCHEMA)
    assert _rows(dedupe.distinct_rows(df, ["k", "attr", "level"]), ["k", "attr", "level"]) == [
        (1, "A", "free"), (1, "B", "paid")]
    assert _rows(dedupe.keep_first(df, "k", ["o"], cols=["attr", "level"]), ["attr", "level"]) == [("A", "free")]
    assert _rows(dedupe.last_write_wins(df, "k", ["o"], cols=["attr", "level"]), ["attr", "level"]) == [
        ("A", "free")]
    assert _rows(dedupe.first_attrs_last_status(df, "k", ["attr"], ["level"], ["o"]), ["attr", "level"]) == [
        ("A", "free")]


def test_payload_comes_from_one_row(spark):
    # NULLs must not be filled from another row
    df = spark.createDataFrame([(1, None, "free", 1), (1, "B", None, 2)], SCHEMA)
    r = dedupe.keep_first(df, "k", ["o"], cols=["attr", "level"]).first()
    assert (r.attr, r.level) == (None, "free")
    r = dedupe.last_write_wins(df, "k", ["o"], cols=["attr", "level"]).first()
    assert (r.attr, r.level) == ("B", None)


def test_invariant_under_repartitioning(spark):
    base = spark.range(0, 3000).select((F.col("id") % 37).alias("k"), F.col("id").cast("string").alias("attr"),
                                       F.when(F.col("id") % 3 == 0, "paid").otherwise("free").alias("level"),
                                       F.col("id").alias("o"))
    expected = _rows(dedupe.first_attrs_last_status(base, "k", ["attr"], ["level"], ["o"]), ["k", "attr", "level"])
    for n in (1, 7, 23):
        shuffled = base.repartition(n).orderBy(F.rand(n))
        got = _rows(dedupe.first_attrs_last_status(shuffled, "k", ["attr"], ["level"], ["o"]), ["k", "attr", "level"])
        assert got == expected


def test_hot_key_collapses_map_side(spark):
    # one key holds a third of the rows; the plan aggregates before the shuffle
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                     F.col("id").alias("o"), F.col("id").cast("string").alias("attr"))
    out = dedupe.keep_first(df, "k", ["o"], cols=["attr"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(" in plan   # map-side partial aggregate before the exchange
    assert out.where("k = 0").first().attr == "0"


def test_merge_batches_equals_unsplit(spark):
    rows = [(k % 5, f"a{i}", "paid" if i % 2 else "free", i) for i, k in enumerate(range(40))]
    df = spark.createDataFrame(rows, SCHEMA)
    b1, b2, b3 = df.where("o < 13"), df.where("o >= 13 and o < 29"), df.where("o >= 29")
    kw = dict(first_cols=["attr"], last_cols=["level"])
    t = dedupe.merge_into(None, [b1], "k", "first_attrs_last_status", ["o"], **kw)
    t = dedupe.merge_into(t, [b2], "k", "first_attrs_last_status", ["o"], first_batch_no=1, **kw)
    t = dedupe.merge_into(t, [b3], "k", "first_attrs_last_status", ["o"], first_batch_no=2, **kw)
    whole = dedupe.first_attrs_last_status(df, "k", ["attr"], ["level"], ["o"])
    assert _rows(dedupe.drop_merge_columns(t), ["k", "attr", "level"]) == _rows(whole, ["k", "attr", "level"])
    for mode, fn in (("keep_first", dedupe.keep_first), ("last_write_wins", dedupe.last_write_wins)):
        t = dedupe.merge_into(None, [b1, b2], "k", mode, ["o"], cols=["attr", "level"])
        t = dedupe.merge_into(t, [b3], "k", mode, ["o"], cols=["attr", "level"], first_batch_no=2)
        assert (_rows(dedupe.drop_merge_columns(t), ["k", "attr", "level"])
                == _rows(fn(df, "k", ["o"], cols=["attr", "level"]), ["k", "attr", "level"]))


def test_second_batch_without_a_number_comes_after_the_stored_ones(spark):
    b = [spark.createDataFrame([(1, x, x, o)], SCHEMA) for x, o in (("A", 5), ("B", 1), ("C", 1))]
    for mode, last in (("last_write_wins", "C"), ("keep_first", "A")):
        t = dedupe.merge_into(None, [b[0]], "k", mode, ["o"], cols=["attr"])
        t = dedupe.merge_into(t, [b[1]], "k", mode, ["o"], cols=["attr"])
        assert dedupe.stored_batch_no(t) == (1 if mode == "last_write_wins" else 0)
        t = dedupe.merge_into(t, [b[2]], "k", mode, ["o"], cols=["attr"])
        assert [r.attr for r in t.collect()] == [last]


def test_map_payload_falls_back_to_min_by(spark):
    df = spark.createDataFrame([(1, {"a": 1}, 2), (1, {"b": 2}, 1)], "k long, m map<string,int>, o long")
    assert dedupe.keep_first(df, "k", ["o"], cols=["m"]).first().m == {"b": 2}
    assert dedupe.last_write_wins(df, "k", ["o"], cols=["m"]).first().m == {"a": 1}


def test_merged_rows_hold_their_order_once_before_the_map_side_aggregate(spark):
    # what a task sorts for its partial aggregate: the order as plain columns, no structs (and not twice)
    df = spark.createDataFrame([(i % 7, f"a{i}", "paid" if i % 2 else "free", i) for i in range(60)], SCHEMA)
    kw = dict(first_cols=["attr"], last_cols=["level"], first_batch_no=3)
    t = dedupe.merge_into(None, [df.where("o < 30"), df.where("o >= 30")], "k", "first_attrs_last_status", ["o", "k"], **kw)
    plan = t._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Aggregate":
        plan = plan.children().head()
    below = plan.children().head().output()
    kinds = [below.apply(i).dataType().typeName() for i in range(below.size())]
    assert "struct" not in kinds and len(kinds) == 6
    got = {r.k: (r.attr, r.level, r._order_first, r._order_last) for r in t.collect()}
    assert len(got) == 7
    for k, (attr, level, first, last) in got.items():
        assert (attr, first) == (f"a{k}", (3, (k, k)))
        end = max(i for i in range(60) if i % 7 == k)
        assert (level, last) == ("paid" if end % 2 else "free", (4, (end, k)))
    # and onto stored rows, whose first rows stay
    more = spark.createDataFrame([(0, "z", "new", 0), (9, "n", "new", 0)], SCHEMA)
    t = dedupe.merge_into(t, [more], "k", "first_attrs_last_status", ["o", "k"], first_cols=["attr"], last_cols=["level"])
    got = {r.k: (r.attr, r.level, r._order_last.b) for r in t.collect()}
    assert got[0] == ("a0", "new", 5) and got[9] == ("n", "new", 5) and len(got) == 8
