"""The registered queries at the smallest driver tables: SQL twins, URL lists, and the whole pipeline by plain Python."""

import collections
import datetime
import os

import duckdb
import pytest

import corpus_pipeline
from lakemart.llm import perplexity, queries, url_filter
from tests.conftest import SMALL_SF
from tests.llm import brute


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL_SF, t + '.parquet')}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SMALL_SF)
    res = duck.execute(queries.ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in df.collect()))) == sorted(map(repr, res.fetchall()))


def test_all_eleven_are_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {"pipeline", *(f"op{i}" for i in range(1, 11))}


def test_url_lists_as_of_the_capture_day(spark):
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(days=n)
    entries = [("bad", "block", "Example.com.", day(5), "add"), ("bad", "block", "example.com", day(5), "add"),
               ("bad", "block", "example.com", day(8), "add"), ("bad", "block", "example.com", day(10), "remove"),
               ("bad", "block", "example.com", day(12), "remove"), ("bad", "block", "example.com", day(20), "add"),
               ("bad", "block", "same.org", day(3), "add"), ("bad", "block", "same.org", day(3), "remove"),
               ("ok", "allow", "www.example.com", day(22), "add"), (None, "block", "x.org", day(0), "add"), ("bad", "block", None, day(0), "add")]
    e = spark.createDataFrame(entries, "list string, verdict string, domain string, day date, action string")
    caps = [(1, "http://www.EXAMPLE.com/a", 4), (2, "https://u:p@www.example.com:80/", 5), (3, "http://example.com", 9),
            (4, "http://example.com", 10), (5, "http://a.b.example.com./?q", 20), (6, "http://www.example.com", 22), (7, "http://notexample.com", 6),
            (8, "http://same.org/", 4), (9, None, 6), (10, "no url", 6), (11, "http://example.com", None), (3, "http://example.com", 9)]
    c = spark.createDataFrame([(i, u, None if n is None else day(n), "mine") for i, u, n in caps], "page_id long, url string, day date, domain string")
    got = collections.defaultdict(set)
    rows = url_filter.judge(c, e).collect()
    for r in rows:
        got[r.page_id].add((r.n_active, r.active_lists, r.blocked, r.domain))
    blocked = {2, 3, 5}
    assert len(rows) == len(caps)
    for i, _, _ in caps:
        want = (1, "bad", True) if i in blocked else (2, "bad,ok", False) if i == 6 else (0, "", False)
        assert got[i] == {(*want, "mine")}, i
    assert url_filter.judge(c.limit(0), e).count() == 0
    assert not any(r.blocked for r in url_filter.judge(c, e.limit(0)).collect())


def test_pipeline_by_plain_python(spark):
    """Each stage's decisions, from what the stage before kept."""
    docs = spark.read.parquet(os.path.join(SMALL_SF, "documents.parquet"))
    columns, benchmark = docs.columns, spark.read.parquet(os.path.join(SMALL_SF, "benchmark.parquet")).collect()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "n-gram Jaccard join", "substring dedup", "benchmark decontamination",
                            "best-fit packing"]
    path = lambda n: corpus_pipeline.C.scratch_path(spark, n)

    def step(name, before):
        out = stages[name](spark, before, SMALL_SF)
        at = path("stage")
        out.write.parquet(at)
        return spark.read.parquet(at)

    def rows(df):
        assert df.columns == columns
        return {r.doc_id: r for r in df.collect()}

    one = step("quality classifier", docs)
    kept = {r.doc_id for r in queries.QUERIES["op7_perplexity"](spark, SMALL_SF).where("kept").collect()}
    before = rows(docs)
    assert rows(one) == {i: r for i, r in before.items() if i in kept} and 0 < len(kept) < len(before)
    two = step("n-gram Jaccard join", one)
    parts = brute.components([(r.doc_id, r.text) for r in rows(one).values()])
    assert rows(two) == {i: r for i, r in rows(one).items() if parts[i][1] == i}
    three = step("substring dedup", two)
    gone = brute.removed([(r.doc_id, r.text) for r in rows(two).values()])
    assert {i: r.text for i, r in rows(three).items()} == {i: " ".join(gone[i][2]) if gone[i][1] else r.text
                                                           for i, r in rows(two).items()}
    assert all(r.n_chars == len(r.text) for r in rows(three).values())
    four = step("benchmark decontamination", three)
    bad = brute.contamination([(r.doc_id, r.text) for r in rows(three).values()], [tuple(b)[:2] for b in benchmark])
    assert set(rows(four)) == {i for i in rows(three) if not bad[i][3]} and len(rows(four)) < len(rows(three))
    five = step("best-fit packing", four).collect()
    assert {r.doc_id for r in five} == set(rows(four))
    full = collections.Counter()
    for r in five:
        full[r.sequence_id] += r.length
    assert max(full.values()) <= 4096 and len(full) <= -(-sum(full.values()) // 4096) + 1


def test_first_stage_by_plain_python(spark):
    """What the classifier keeps of the smallest table, from a plain Kneser-Ney model and quantiles."""
    docs = spark.read.parquet(os.path.join(SMALL_SF, "documents.parquet"))
    labels = spark.read.parquet(os.path.join(SMALL_SF, "labels.parquet"))
    rows = [(r.doc_id, r.lang, r.text) for r in docs.collect()]
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1 and r.toxic == 0}
    assert len({r[0] for r in rows}) == len(rows)
    want = brute.classifier(rows, trusted, perplexity.CLASSES.tolist(), perplexity.QUANTILE, perplexity.MARGIN, perplexity.PRIOR)
    got = [r.doc_id for r in dict(corpus_pipeline.STAGES)["quality classifier"](spark, docs, SMALL_SF).collect()]
    assert sorted(got) == sorted(want) and 0 < len(got) < len(rows)


def test_pipeline_runs_whole(spark):
    assert corpus_pipeline.run(spark, SMALL_SF).count() > 100
