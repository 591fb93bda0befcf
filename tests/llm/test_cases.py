"""What the operators' docstrings say of nulls, repeated rows, rows without id, empty tables and further columns, where
test_operators.py does not look; and the verdict of the quality rules against plain Python."""

import collections
import math
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lakemart.llm import decontaminate, html_text, packing, quality_rules, queries, token_store
from lakemart.session import scratch_path
from tests.llm import brute

RND = random.Random(21)
WORDS = ["".join(RND.choice("abcdefghijklmno") for _ in range(RND.randint(2, 8))) for _ in range(300)]
LONG = " ".join(RND.choice(WORDS) for _ in range(9000))


def _text(n):
    return " ".join(RND.choice(WORDS) for _ in range(n))


ODD = [(None, "no id here", "en", 1), (None, None, None, 1), (3, None, "en", 1), (4, "", "en", 1), (5, " \n\t ", "en", 1),
       (6, "twice the same row", "en", 1), (6, "twice the same row", "en", 1), (6, "another text of this id", "en", 1), (7, LONG, "en", 1)]
SCHEMA = "doc_id long, text string, lang string, piece int"   # piece: a name of the results


def _ids(path, text, end):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, end]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_store_of_odd_rows(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    folder = scratch_path(spark, "odd-store")
    manifest, freq = token_store.write_store(df, folder, path)
    got = token_store.read_store(spark, folder, manifest, freq).collect()
    want = [(i, _ids(path, t, 0)) for i, t, *_ in ODD]
    assert (collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got)
            == collections.Counter((i, len(x), _crc(x)) for i, x in want))
    at = 0
    for r in sorted(got, key=lambda r: r.start):   # gapless, in the order of the ids
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, None, 3, 4, 5, 6, 6, 6, 7]


def test_packing_of_odd_rows(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    df = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    got = packing.pack(packing.pieces(df, path)).collect()
    want = collections.Counter()
    for i, t, *_ in ODD:
        ids = _ids(path, t, 1)
        for k, s in enumerate(range(0, len(ids), 4096)):
            x = ids[s:s + 4096]
            want[i, k, s, len(x), _crc(x)] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = collections.defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for x in held.values():   # gapless from 0
        x.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(x, x[1:])) and x[0][0] == 0 and sum(n for _, n in x) <= 4096


def test_quality_rules_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    got = quality_rules.score(df, None).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(i for i, *_ in ODD)
    same = [tuple(r)[1:] for r in got if r.doc_id == 6 and r.n_words == 4]
    assert len(same) == 2 and same[0] == same[1]
    assert all(r.base_failed and not r.kept for r in got if r.doc_id != 7)


def test_decontaminate_odd_rows(spark):
    items = spark.createDataFrame([(None, "no id here", 1), (1, "twice the same row", 1), (1, "twice the same row", 1), (2, None, 1), (3, "", 1)],
                                  "item_id long, text string, doc_id int")
    df = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    got = collections.Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(df, items).collect())
    assert got == collections.Counter([(None, 3, 3, 0, True), (None, 0, 0, 0, False), (3, 0, 0, 0, False), (4, 0, 0, 0, False), (5, 0, 0, 0, False),
                                       (6, 4, 4, 1, True), (6, 4, 4, 1, True), (6, 5, 0, 0, False), (7, 9000, 0, 0, False)])
    assert decontaminate.contamination(df.limit(0), items).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(df, items.limit(0)).collect())


def test_html_of_odd_rows(spark):
    page = "<article><p>A text, of some length.</p></article>"
    rows = [(None, "u", page, 1), (1, None, page, 1), (1, None, page, 1), (2, "v", None, 1), (3, "w", "", 1), (4, "x", "<br>", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = collections.Counter(map(tuple, html_text.extract(df).collect()))
    text = "A text, of some length."
    assert got == collections.Counter([(None, "u", text, len(text)), (1, None, text, len(text)), (1, None, text, len(text)),
                                       (2, "v", "", 0), (3, "w", "", 0), (4, "x", "", 0)])
    assert html_text.extract(df.limit(0)).count() == 0


# ---------------------------------------------------------------- the verdict of the quality rules

def _grams(text, places=quality_rules.PLACES):
    """Places of a text's word, word-pair and four-byte grams, one text at a time."""
    import pyarrow as pa

    (_, buf, off), = quality_rules.C.doc_slices(pa.array([text]))
    w = quality_rules.C.Words(buf, off, quality_rules.C.ASCII_SPACE, quality_rules.C.SAME)
    one = [int(h) >> (64 - places) for h in w.hash]
    two = [(int(quality_rules.C.kgrams(w.hash[k:k + 2], 2)[0]) >> (64 - places)) + (1 << places) for k in range(len(w.hash) - 1)]
    raw = text.encode()
    four = [((int.from_bytes(raw[k:k + 4], "little") * 2654435761 & 0xFFFFFFFF) >> (32 - places)) + (2 << places) for k in range(len(raw) - 3)]
    return one, two, four


def test_verdict_is_that_of_plain_python(spark):
    good = [(i, _text(RND.randint(60, 120))) for i in range(60)]
    bad = [(100 + i, " ".join(RND.choice(["buy", "now", "$$$", "click"]) + str(RND.randint(0, 9)) for _ in range(RND.randint(55, 120)))) for i in range(60)]
    odd = [(300, "short"), (301, _text(80) + " buy now $$$"), (302, "x y z " * 40)]
    docs = spark.createDataFrame(good + bad + odd, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    model = quality_rules.fit(docs, labels, rounds=40)
    got = {r.doc_id: r for r in quality_rules.score(docs, model).collect()}
    for i, text in good + bad + odd:
        z = model.bias + sum(math.fsum(float(model.weights[p]) for p in g) / len(g) for g in _grams(text) if g)
        p = 1 / (1 + math.exp(-max(-60.0, min(60.0, model.slope * z + model.shift))))
        assert abs(got[i].p_good - p) < 1e-5
        words = text.split()
        three = collections.Counter(zip(words, words[1:], words[2:]))
        again = sum(any(three[tuple(words[s:s + 3])] > 1 for s in range(max(0, k - 2), min(k, len(words) - 3) + 1)) for k in range(len(words)))
        failed = len(words) < 50 or 100 * again > 50 * len(words)
        assert got[i].base_failed == failed and got[i].n_repeat_words == again
        assert got[i].kept == (not failed and got[i].p_good >= quality_rules.KEEP)
    assert sum(got[i].kept for i, _ in good) > 50 and sum(got[i].kept for i, _ in bad) < 10


# ---------------------------------------------------------------- the pipeline

def _folder(spark, root, docs, labels, items):
    schema = "doc_id long, text string, lang string, source string, n_chars long, rest string, kept string"
    spark.createDataFrame([(i, t, lang, "web", None if t is None else len(t), "r", "k") for i, t, lang in docs], schema).write.parquet(os.path.join(root, "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(os.path.join(root, "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(os.path.join(root, "benchmark.parquet"))
    return root


@pytest.mark.parametrize("empty", [(), ("labels",), ("benchmark",), ("documents",)])
def test_pipeline_of_odd_tables(spark, tmp_path, empty):
    """Null texts, rows without id, repeated rows, columns named like results; and each table empty."""
    docs = [(i, _text(RND.randint(30, 90)), "en") for i in range(25)]
    passage = _text(20)
    docs += [(30, docs[3][1], "en"), (31, passage + " " + _text(30), "en"), (32, _text(30) + " " + passage, "en"), (33, None, None), (34, "", "en"),
             (None, _text(40), "en"), (None, None, "en"), (35, docs[7][1] + " tail", "en"), (36, docs[9][1][:40] + " " + docs[11][1][-200:], "en")]
    items = [(1, docs[5][1]), (2, None)]
    rows = {"documents": docs, "labels": [(i, 1, 0) for i in range(25)] + [(None, 1, 0), (999, 1, 0)], "benchmark": items}
    root = _folder(spark, str(tmp_path / "sf"), *[[] if n in empty else rows[n] for n in ("documents", "labels", "benchmark")])
    got = corpus_pipeline.run(spark, root).collect()
    if "documents" in empty:
        assert not got
        return
    left = collections.Counter(r.doc_id for r in got if r.piece == 0)
    assert left[None] == 2 and left[33] == left[34] == 1          # kept by every stage
    assert 30 not in left and 35 not in left and left[3] == left[7] == 1   # copies and near copies go, the least id stays
    assert (5 in left) == ("benchmark" in empty)
    assert all(n == 1 for i, n in left.items() if i is not None)


def test_registered_queries_of_the_folder():
    assert {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in queries.QUERIES}
    assert brute.lower("ÀB") == "Àb"
