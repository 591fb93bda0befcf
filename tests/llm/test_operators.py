"""The operators on small tables that hold nulls, empty and long texts, copies, near copies, ties, repeated rows,
shared passages and further columns, against plain Python versions."""

import base64
import collections
import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lakemart.llm import (common, decontaminate, html_text, jaccard_join, packing, perplexity, quality_rules,
                          substring_dedup, token_store, tokens, warc)
from lakemart.session import scratch_path
from tests.llm import brute

RND = random.Random(7)
VOCAB = ["".join(RND.choice("abcdefghij") for _ in range(RND.randint(2, 7))) for _ in range(150)] + ["Été", "ß", "a.", "X!"]
SCHEMA = "doc_id long, text string, lang string, row int, hits string, doc int"   # further columns, some with names used inside


def _words(n):
    return [RND.choice(VOCAB) for _ in range(n)]


def _corpus():
    passage, texts = _words(40), [None, "", "  \n\t ", "one", "One", "a b c d", "A b\nc  d", "a b c d e"]
    for _ in range(30):
        w = _words(RND.randint(3, 160))
        texts.append(" ".join(w))
        for _ in range(RND.randint(0, 3)):   # near copies of every nearness
            c = list(w)
            for _ in range(RND.randint(0, max(1, len(w) // 12))):
                c[RND.randrange(len(c))] = RND.choice(VOCAB)
            texts.append((" " if RND.random() < 0.7 else "\n").join(c))
        if RND.random() < 0.5:
            k = RND.randrange(len(w))
            a = RND.randint(0, 20)
            texts.append(" ".join(w[:k] + passage[a:a + RND.randint(10, 20)] + w[k:]))
    texts += [texts[8], texts[8], texts[20], "x " * 300, "x " * 299 + "y", " ".join(_words(3000)), "日本語 テキスト é"]
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


CORPUS = _corpus()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", 0, "h", 1) for i, t in CORPUS]
    return spark.createDataFrame(RND.sample(rows, len(rows)), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _odd(spark):
    """Rows without id, and rows of one id."""
    return spark.createDataFrame([(None, "p q r s t u v w x y z a b c", None, 0, "", 0), (5, CORPUS[8][1], "en", 0, "", 0),
                                  (5, CORPUS[8][1], "en", 0, "", 0), (5, "other words here", "en", 0, "", 0), (None, None, None, 0, "", 0)],
                                 SCHEMA)


def test_jaccard_join(spark, docs, empty):
    want = brute.components(CORPUS)
    for limit in (jaccard_join.LIMIT, 3):   # 3: groups and clusters cut into blocks
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs, limit=limit, bits=16).collect()}
        assert got == want
    assert len({c for _, c in want.values()}) < len(want) - 20
    assert jaccard_join.near_duplicates(empty, bits=16).count() == 0
    odd = sorted(((r.doc_id, r.component_id) for r in jaccard_join.near_duplicates(_odd(spark), bits=16).collect()), key=str)
    assert odd == [(5, 5)] * 3 + [(None, None)] * 2


def _roots(n, links):
    parts = jaccard_join.Parts(n)
    for i, j in links:
        parts.join(i, j)
    return [parts.root(i) for i in range(n)]


def test_trie_finds_what_all_pairs_find():
    rng = np.random.default_rng(3)
    for _ in range(60):
        base = [np.unique(rng.integers(0, 2**63, rng.integers(2, 60), dtype=np.uint64)) for _ in range(4)]
        sets = []
        for _ in range(14):
            s = base[rng.integers(4)]
            extra = rng.integers(0, 2**63, rng.integers(0, 6), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([s[rng.random(len(s)) < 0.93], extra])))
        sets = [s if len(s) else base[0] for s in sets]
        pairs = [(i, j) for i in range(14) for j in range(i)]
        full = [(i, j) for i, j in pairs if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
        assert _roots(14, jaccard_join.exact_links(sets)) == _roots(14, full)


def test_copies_that_miss_the_limit_cost_a_pass_each():
    """A cluster of copies of which many are linked with none: each asks the tree about all others."""
    rng = np.random.default_rng(12)
    base = rng.permutation(np.unique(rng.integers(0, 2**63, 396, dtype=np.uint64)))
    sets = []
    for i in range(400):
        lost = (rng.choice(390, 4 if i % 5 else 11, replace=False)[:, None] + np.arange(5)).ravel()
        sets.append(np.union1d(np.delete(base, lost), rng.integers(0, 2**63, 20 if i % 5 else 55, dtype=np.uint64)))
    began = time.process_time()
    got = _roots(400, jaccard_join.exact_links(sets))
    assert time.process_time() - began < 4
    size = np.array([len(s) for s in sets])
    held = np.searchsorted(base_in_order := np.sort(base), np.concatenate(sets)).clip(max=len(base) - 1)
    m = np.zeros((400, len(base)), np.int64)
    m[np.repeat(np.arange(400), size), held] = base_in_order[held] == np.concatenate(sets)
    both = m @ m.T   # what is not of the base stands in one set
    full = np.argwhere(np.tril(100 * both >= 80 * (size[:, None] + size - both), -1))
    assert got == _roots(400, full.tolist()) and len(set(got)) > 50


def _linked(x, y):
    return 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))


def test_keys_and_candidates_lose_no_linked_pair():
    """Every linked pair shares a key; in a key's group the links found connect what all pairs that may be linked connect."""
    rng = np.random.default_rng(8)
    hashes = lambda n: np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    passage = hashes(40)
    seen = 0
    for trial in range(80):
        base = [np.union1d(hashes(rng.integers(1, 400)), passage if rng.random() < 0.5 else passage[:0]) for _ in range(4)]
        sets = []
        for _ in range(rng.integers(2, 40)):
            s = base[rng.integers(4)]
            sets.append(np.union1d(s[rng.random(len(s)) < rng.choice([0.85, 0.93, 1.0])], hashes(rng.integers(0, 20))))
        sets = [s if len(s) else base[0] for s in sets]
        order = np.argsort(passage) if trial % 2 else np.arange(0)
        known, often = passage[order], np.arange(1, len(order) + 1, dtype=np.uint32)
        keys = [jaccard_join._first(s, known, often) for s in sets]
        groups = {}
        for i, k in enumerate(keys):
            for p, g in enumerate(k.tolist()):
                groups.setdefault(g, []).append((i, p))
        rows = [(g, i, p) for g in sorted(groups) for i, p in groups[g]]
        got = jaccard_join.candidate_links(np.array([r[0] for r in rows], np.uint64), np.array([len(sets[r[1]]) for r in rows]),
                                           np.array([r[2] for r in rows]), [jaccard_join.sketch(sets[r[1]]).tobytes() for r in rows])
        roots = _roots(len(sets), [(rows[a][1], rows[b][1]) for a, b in got])
        for i in range(len(sets)):
            for j in range(i):
                if _linked(sets[i], sets[j]):
                    seen += 1
                    assert set(keys[i].tolist()) & set(keys[j].tolist()) and roots[i] == roots[j]
        assert all(rows[a][0] == rows[b][0] for a, b in got)
    assert seen > 1000


def test_sketches_fold_and_bound_the_difference():
    rng = np.random.default_rng(2)
    for n in (1, 5, 31, 33, 300, 513, 5000, 20000):
        s = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        t = np.union1d(s[rng.random(len(s)) < 0.9], rng.integers(0, 2**63, n // 10, dtype=np.uint64))
        x, y = jaccard_join.sketch(s), jaccard_join.sketch(t)
        while len(x) > len(y):
            x = jaccard_join.fold(x)
        while len(y) > len(x):
            y = jaccard_join.fold(y)
        assert int(np.bitwise_count(x ^ y).sum()) <= len(np.setxor1d(s, t))


def test_many_documents_sharing_a_passage(spark):
    """A passage in thousands of documents makes no hot group: its shingles come last in every set."""
    rnd = random.Random(12)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(rnd.randint(60, 200))) + " " + passage) for i in range(2000)]
    rows += [(5000 + i, rows[i][1] + " tail") for i in range(50)]
    began = time.monotonic()
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert time.monotonic() - began < 60
    assert got == {i: i - 5000 if i >= 5000 else i for i, _ in rows}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    ids = rng.sample(range(1000), 400)
    links = [(ids[i], ids[i + 1]) for i in range(200)] + [(ids[300], x) for x in ids[301:360]] + [(7777, 7777), (ids[390], ids[391])] * 2
    up = {x: x for x in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for u, v in links:
        if u != v:
            a, b = sorted((root(u), root(v)))
            up[b] = a
    got = {r.node: r.part for r in jaccard_join.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: root(x) for u, v in links for x in (u, v) if u != v}


def test_substring_dedup_reads_the_texts_six_times(spark):
    """Equal texts, seeds, places, windows, and the texts that stay and those that lose words; nothing is hashed anew."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(i, t) for i, t in CORPUS if i is not None and t]
    read = spark.createDataFrame(rows, "doc_id long, text string").mapInArrow(count, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup.dedup(read, bits=16).collect()}
    times = seen.value / len(rows)
    assert got == {r.doc_id: r.n_removed for r in substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), bits=16).collect()}
    assert any(got.values()) and times <= 6


def test_substring_dedup(spark, docs, empty):
    want = {i: (n, k, brute.sha(w), " ".join(w)) for i, (n, k, w) in brute.removed(CORPUS).items()}
    for bits in (substring_dedup.BITS, 15):   # 15: the bit tables let nearly all pass
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in substring_dedup.dedup(docs, bits=bits).collect()}
        assert got == want
    assert sum(k > 0 for _, k, *_ in want.values()) > 20
    rest = substring_dedup.dedup(docs, bits=16, keep_rest=True).select("doc_id", "text", "rest.*").collect()
    assert {(r[0], r[1], r.row) for r in rest} == {(i, t, 0) for i, t in CORPUS} or {
        (r[0], r[1] or "", r.row) for r in rest} == {(i, t or "", 0) for i, t in CORPUS}
    assert substring_dedup.dedup(empty, bits=16).count() == 0
    assert sorted(r.n_removed for r in substring_dedup.dedup(_odd(spark), bits=16).collect()) == [0] * 5


def test_decontamination(spark, docs, empty):
    texts = dict(CORPUS)
    long_ = [t for t in texts.values() if t and len(t.split()) > 60]
    items = [(1, " ".join(long_[0].split()[5:40])), (2, long_[1].upper()), (3, "one"), (4, None), (5, "..."), (6, "no such words, none"),
             (10, " ".join(long_[0].split()[5:40])), (7, "a b c d e"), (7, "a b c d e")]
    table = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, words int")
    want = {i: (n, h, len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), c)
            for i, (n, h, x, c) in brute.contamination(CORPUS, items).items()}
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in decontaminate.contamination(docs, table).collect()}
    assert got == want and sum(v[4] for v in want.values()) >= 3
    assert decontaminate.contamination(empty, table).count() == 0
    clean = decontaminate.contamination(docs, spark.createDataFrame([], "item_id long, text string")).collect()
    assert len(clean) == len(CORPUS) and not any(r.contaminated for r in clean)
    unnamed = spark.createDataFrame([(None, "one")], "item_id long, text string")
    marked = {r.doc_id: r for r in decontaminate.contamination(docs, unnamed).collect()}[CORPUS[3][0]]
    assert (marked.n_hit, marked.n_items, marked.contaminated) == (1, 0, True)


def test_quality_counts(spark, docs, empty):
    want = {i: brute.base_counts(t) for i, t in CORPUS}
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in quality_rules.score(docs, None).collect()}
    assert got == want
    assert quality_rules.score(empty, None).count() == 0
    assert quality_rules.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int")) is None


def _labelled(spark, n=240):
    """Good texts of the vocabulary, bad ones with signs or in capitals; even ids are labelled."""
    rows = []
    for i in range(n):
        w = _words(RND.randint(60, 120))
        rows.append((i, " ".join(w) if i % 4 < 2 else " ".join(x + "***" for x in w) if i % 8 < 4 else "!! ".join(w).upper(),
                     ("en", None)[i % 7 == 0]))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = [(i, int(i % 4 < 2), 0) for i in range(0, n, 2)] + [(10_000, 1, 0), (None, 1, 0), (0, 1, 0)]
    return table, spark.createDataFrame(lab, "doc_id long, quality int, toxic int"), {i: i % 4 < 2 for i in range(n)}


def test_quality_model_on_held_out_texts(spark):
    table, lab, good = _labelled(spark)
    model = quality_rules.fit(table, lab, rounds=60)
    got = {r.doc_id: r.kept for r in quality_rules.score(table, model).collect()}
    held = [i for i in good if i % 2]
    assert np.mean([got[i] == good[i] for i in held]) >= 0.97
    assert all(got[i] for i in held if good[i])


def test_perplexity_on_held_out_texts(spark, empty):
    table, lab, good = _labelled(spark)
    got = {r.doc_id: r for r in perplexity.classify(table, lab, least_trusted=10).collect()}
    held = [i for i in good if i % 2]
    assert np.mean([got[i].kept == good[i] for i in held]) >= 0.97
    assert all(got[i].kept for i in held if good[i])
    assert perplexity.classify(empty, lab).count() == 0
    blank = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (None, "x", None)], "doc_id long, text string, lang string")
    assert all(r.kept for r in perplexity.classify(blank, lab).collect())


def test_kneser_ney_probabilities_sum_to_one_and_match_plain_python(spark):
    texts = ["abracadabra, abra", "abba. Cab!", "dab ab"]
    bits = perplexity.model(spark.createDataFrame([(t,) for t in texts], "text string")).table()
    p = np.exp2(-bits.astype(float)).reshape(-1, 64)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    counts = [collections.Counter() for _ in range(5)]
    for t in texts:
        c = [0, 0, 0, *(int(perplexity.CLASSES[b]) for b in t.encode())]
        counts[4].update(tuple(c[i:i + 4]) for i in range(len(c) - 3))
    for k in (3, 2, 1):
        counts[k].update(g[1:] for g in counts[k + 1])
    d = {}
    for k in range(1, 5):
        n = [max(1, sum(v == j for v in counts[k].values())) for j in (1, 2, 3, 4)]
        q = n[0] / (n[0] + 2 * n[1])
        d[k] = [0] + [min(max(j - (j + 1) * q * n[j] / n[j - 1], 0.05), j) for j in (1, 2, 3)]

    def prob(g):
        if not g:
            return 1 / 64
        k, own = len(g), [(x, v) for x, v in counts[len(g)].items() if x[:-1] == g[:-1]]
        total = sum(v for _, v in own)
        if not total:
            return prob(g[1:])
        v = counts[k].get(g, 0)
        return max(v - d[k][min(v, 3)], 0) / total + sum(d[k][min(x, 3)] for _, x in own) / total * prob(g[1:])

    for t in ("abrac", "zzzz", "cab! dab"):
        c = [0, 0, 0, *(int(perplexity.CLASSES[b]) for b in t.encode())]
        for i in range(len(c) - 3):
            g = tuple(c[i:i + 4])
            assert np.isclose(np.exp2(-float(bits[g[0] << 18 | g[1] << 12 | g[2] << 6 | g[3]])), prob(g), rtol=1e-4)


def test_word_model_matches_plain_python(spark):
    texts = {1: "a b a b c a b", 2: "b  c a b\nd", 3: "a b zz", 4: "d d d d d d d d a", 5: "b c a b a b c q", 6: "a a"}
    table = spark.createDataFrame([(i, t, "en") for i, t in texts.items()] + [(6, "a a", "en")], "doc_id long, text string, lang string")
    trusted = [1, 2, 3, 6, 6]
    lab = spark.createDataFrame([(i, 1, 0) for i in (1, 2, 3, 6)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: (r.perplexity, r.n_bytes) for r in perplexity.classify(table, lab).collect()}
    assert len(texts) == len(got)
    bits = perplexity.model(spark.createDataFrame([(texts[i],) for i in trusted], "text string")).table()
    cls = [int(x) for x in perplexity.CLASSES]
    members = collections.Counter(cls)

    def spell(word):
        c = [0, 0, 1, *(cls[b] for b in word.encode()), 1]
        return (sum(float(bits[c[i - 3] << 18 | c[i - 2] << 12 | c[i - 1] << 6 | c[i]]) for i in range(3, len(c)))
                + sum(np.log2(members[cls[b]]) for b in word.encode()))

    padded = lambda t: ["<s>", "<s>", *t.split(), ""]
    counts, owners = [None, *(collections.Counter() for _ in range(3))], collections.defaultdict(set)
    for i in trusted:
        w = padded(texts[i])
        for at in range(2, len(w)):
            counts[3][tuple(w[at - 2:at + 1])] += 1
            for k in (1, 2, 3):
                owners[tuple(w[at - k + 1:at + 1])].add(i)
    for k in (2, 1):
        counts[k].update(g[1:] for g in counts[k + 1])
    d = {}
    for k in (1, 2, 3):
        n = [max(1, sum(v == j for v in counts[k].values())) for j in (1, 2, 3, 4)]
        q = n[0] / (n[0] + 2 * n[1])
        d[k] = [0] + [min(max(j - (j + 1) * q * n[j] / n[j - 1], 0.05), j) for j in (1, 2, 3)]

    def prob(g, seen=lambda g: True):
        """Interpolated, with n-grams that are not ``seen`` (as ends or as contexts) left to the order below."""
        if not g:
            return None
        k, own = len(g), [(x, v) for x, v in counts[len(g)].items() if x[:-1] == g[:-1]]
        low = prob(g[1:], seen) if k > 1 else 2.0 ** -spell(g[0])
        if not own or k > 1 and not seen(g[:-1]):
            return low
        total = sum(v for _, v in own)
        rest = sum(d[k][min(x, 3)] for _, x in own) / total
        v = counts[k].get(g, 0)
        if not v or not seen(g):
            return rest * low
        whole = prob(g[1:]) if k > 1 else low  # the gain is that of the whole model
        return rest * low * (((v - d[k][min(v, 3)]) / total + rest * whole) / (rest * whole))

    for i, t in texts.items():
        seen = lambda g: owners[g] != {i} if set(g) != {"<s>"} else True  # noqa: B023, E731
        w = padded(t)
        want = -sum(np.log2(prob(tuple(w[at - 2:at + 1]), seen)) for at in range(2, len(w)))
        c = [0, 0, 0, *(cls[b] for b in t.encode())]
        for at in range(3, len(c)):  # white space but for single spaces after words
            if t[at - 3].isspace() and not (t[at - 3] == " " and at > 3 and not t[at - 4].isspace()):
                want += float(bits[c[at - 3] << 18 | c[at - 2] << 12 | c[at - 1] << 6 | c[at]])
        assert np.isclose(got[i][0], 2 ** (want / got[i][1]), rtol=1e-4), (i, t)


def test_each_language_has_its_own_limit(spark):
    rows = [(i, " ".join(_words(40)), "en") for i in range(60)] + [(100 + i, "Qxz! " * (10 + i), "fr") for i in range(3)]
    rows += [(200, " ".join(_words(40)), "de"), (201, "some text", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = spark.createDataFrame([(r[0], 1, 0) for r in rows[:63]], "doc_id long, quality int, toxic int")
    got = perplexity.classify(table, lab).collect()
    score = {x: [r.score for r in got if r.lang == x] for x in ("en", "fr")}
    limit = {r.lang: r.score_limit for r in got}
    for x in ("en", "fr"):
        assert np.isclose(limit[x], max(score[x]) + perplexity.MARGIN)
    assert limit["en"] != limit["fr"] and np.isclose(limit["de"], max(score["en"] + score["fr"]) + perplexity.MARGIN) and limit[None] == limit["de"]


def test_word_order_counts(spark):
    """Words and spelling of the trusted texts in another order: only the counts of word n-grams tell them apart."""
    sentence = ["one two three four five six seven eight nine ten", "red green blue black white grey brown pink gold teal"]
    rows = [(i, " ".join(sentence[(i + j) % 2] for j in range(6)), "en") for i in range(20)]
    mixed = (sentence[0] + " " + sentence[1]).split() * 3
    random.Random(3).shuffle(mixed)
    rows += [(100, " ".join(mixed), "en"), (101, " ".join([sentence[0], sentence[1]] * 3), "en")]
    lab = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in perplexity.classify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), lab).collect()}
    assert not got[100] and all(k for i, k in got.items() if i != 100)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens_are_those_of_the_whole_text(name):
    enc, tok = tokens.Encoder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    bits = ["a", " ", "  ", "\n", "\t", "Bc", "'s", "'", "1", "é", "é", " ", ".", "***", "\x1c", "İ", "<|endoftext|>", "日本"]
    texts = [None, "", " x", "y ", *("".join(RND.choice(bits) for _ in range(RND.randint(1, 25))) for _ in range(2000))]
    got = enc.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tok.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_token_store_round_trip(spark, docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, at, want = Tokenizer.from_file(path), 0, []
    for i, t in sorted(CORPUS, key=lambda r: r[0]):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
        at += len(ids)
    folder = scratch_path(spark, "tokens-test")
    manifest, freq = token_store.write_store(docs, folder, path, segment=5000)
    assert manifest.count() > 2 and freq.sum() == 1 << 20
    got = token_store.read_store(spark, folder, manifest, freq, keep_ids=True).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got) == want
    wrong = freq.copy()
    wrong[[0, int(np.flatnonzero(freq)[-1])]] = wrong[[int(np.flatnonzero(freq)[-1]), 0]]
    if (wrong != freq).any():
        with pytest.raises(Exception, match="not a file of this table"):
            token_store.read_store(spark, folder, manifest, wrong).collect()
    folder = scratch_path(spark, "tokens-none")
    manifest, freq = token_store.write_store(empty, folder, path)
    assert token_store.read_store(spark, folder, manifest, freq).count() == 0


def test_rans_blocks_find_damage():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.geometric(0.01, 30_000), 900)
    counts = dict(zip(*(x.tolist() for x in np.unique(ids, return_counts=True)), strict=True))
    coder = token_store.Coder(token_store.frequencies(counts))
    raw = token_store._segment(coder, [(1, ids[:10]), (None, ids[10:10]), (2, ids[10:])])
    doc, lens, back = token_store._read_segment(coder, raw)
    assert doc == [1, None, 2] and lens.tolist() == [10, 0, 29_990] and (back == ids).all()
    assert 8 * len(raw) < 1.08 * sum(-n * np.log2(n / len(ids)) for n in counts.values()) + 8 * 2000 + 64 * 32 * 8
    with pytest.raises(ValueError, match="checksum"):
        token_store._read_segment(coder, raw[:-9] + bytes([raw[-9] ^ 1]) + raw[-8:])


def test_packing(spark, docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = packing.pack(packing.pieces(docs, path, size=256, keep_ids=True), 256)
    got = rows.collect()
    want = {}
    for i, t in CORPUS:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), 256):
            want[i, k // 256] = (k, len(ids[k:k + 256]), zlib.crc32(ids[k:k + 256].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    held = collections.defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for v in held.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 256
    counts = collections.Counter(n for _, n, _ in want.values())
    assert len(held) <= 1.02 * packing.fewest(counts, 256) + 1
    assert sum(len(r.ids) for r in packing.sequences(rows).collect()) == 4 * sum(n for _, n, _ in want.values())
    assert packing.pack(packing.pieces(empty, path)).count() == 0


@pytest.mark.parametrize("counts", [{}, {4096: 3}, {2048: 5}, {1: 4096, 4095: 2}, {1365: 7, 1366: 2}, {1500: 9, 2596: 3, 1000: 4, 96: 1}])
def test_plan_places_every_piece(counts):
    made = packing.plan(counts)
    used = collections.Counter()
    for combo, n in made:
        assert sum(combo) <= 4096 and n > 0
        for x in combo:
            used[x] += n
    assert used == counts
    assert sum(n for _, n in made) <= packing.fewest(counts) + 2


def test_warc_round_trip(spark):
    big = "<p>" + "é" * 700_000
    rows = [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (9, None, "<p>x</p>"), (3, "http://c/\r\nX: y", None),
            (4, "http://d/", ""), (5, "http://e/", big), (6, "http://f/", "one\r\n\r\ntwo"), (None, "http://g/", "alone"), (7, "u", "<p>x</p>")]
    pages = spark.createDataFrame([(*r, 0, "z") for r in rows], "page_id long, url string, html string, bytes int, sha string")
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(warc.plan_records(pages), folder, chunk=1 << 16)
    chunks = warc.read_archives(spark, folder, manifest, chunk=1 << 16, keep_data=True)
    data = collections.defaultdict(dict)
    for r in chunks.collect():
        assert len(r.data) <= 1 << 16
        data[r.page_id][r.chunk] = bytes(r.data)
    assert b"".join(v for _, v in sorted(data[5].items())) == big.encode() and len(data[5]) > 15
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.summed(chunks).collect()}
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    keep = {"<p>x</p>": 9, "": 4, None: 4}
    want = {i: (len((t or "").encode()), digest(t), "revisit" if keep.get(t, i) != i else "response",
                keep[t] if keep.get(t, i) != i else None) for i, _, t in rows}
    assert got == want
    plain = warc.plan_records(pages, least=9)
    assert plain.where("record_type = 'revisit'").count() == 0
    none = warc.write_archives(warc.plan_records(pages.where("page_id > 99")), scratch_path(spark, "warc-none"))
    assert warc.summed(warc.read_archives(spark, folder, none)).count() == 0


PAGES = [
    (None, ""), ("", ""), ("no tags, but text.", "no tags, but text."), ("<script>var a = '<p>x</p>';</script>", ""),
    ("<body><nav><a href=/>Home</a><a href=/b>More</a></nav><article><h1>Title &amp; more</h1><p>First,\n  <b>bold</b>, and more text for it."
     "<br>Line.<p>Second&nbsp;one</article><footer>&copy; x</footer>", "Title & more\n\nFirst, bold, and more text for it. Line.\n\nSecond one"),
    ("<div class=page><div id=sidebar><p>Many, many, many, words, here, and, there, again.</p></div><div class=content><p>Some long text, with commas,"
     " that goes on for a while.</p><p>And another one, with more, of the same kind.</p><ul><li>point</ul></div>"
     "<div class='comments'><p>I think, that, this, is, a comment, a long one at that.</p></div></div>",
     "Some long text, with commas, that goes on for a while.\n\nAnd another one, with more, of the same kind.\n\npoint"),
    ("<main><form><p>Your name, please, and your mail, and more, and more.</p></form><p>Kept text, long enough to count.</p>"
     "<aside>not this</aside><div><a href=1>one link</a> <a href=2>two link</a></div></main>", "Kept text, long enough to count."),
    ("<p>unclosed <i>tags <a href='x>y'>link</a> and &lt;b&gt; text", "unclosed tags link and <b> text"),
    ("<article><p>cut in a tag <img src='", "cut in a tag"),
    ("<article><!-- a <p> comment --><p>a</p><style>p{}</style><p>b<table><tr><td>c<td>d</table></article>", "a\n\nb\n\nc\n\nd"),
]


def test_html_text(spark):
    for page, want in PAGES:
        assert html_text.main_text(page) == want
    rows = [(i, f"u{i}", h, "x") for i, (h, _) in enumerate(PAGES)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert {(r.page_id, r.url, r.text, r.n_chars) for r in got} == {(i, f"u{i}", t, len(t)) for i, (_, t) in enumerate(PAGES)}
    assert html_text.main_text("<div>" * 3000 + "deep text, far down") == "deep text, far down"


PROSE = "<p>Some long text, with commas, that goes on for a while.</p><p>And another one, with more, of the same kind.</p>"
TEXT = "Some long text, with commas, that goes on for a while.\n\nAnd another one, with more, of the same kind."


@pytest.mark.parametrize("page", [
    "<div class='content has-sidebar'>%s</div>", "<div class='post ad-free'>%s</div>", "<div class='post ad-free'><article>%s</article></div>",
    "<div id='comments-page'>%s</div>", "<div id='comments-page'><article>%s<div class='share'>Share, this, with, your, friends, and, so, on.</div></article></div>",
    "<div class='has-sidebar'><div>%s</div><div class='sidebar'><p>Many, many, many, words, here, and, there, again.</p></div></div><div>Rights</div>",
    "<div class='layout sidebar-left'><main>%s</main><div id=sidebar>Links</div></div><p>Rights, all, reserved, by us, forever and ever.</p>",
    "<span class='has-sidebar'><div>%s</div></span>", "<p class='ad'>Buy, buy, buy, and buy some more, dear reader.</p><div>%s</div>",
    "<div class=page><div>%s</div><div class=comments>" + "<div><p>A comment, long, with commas, and more, and more.</p></div>" * 20 + "</div></div>",
])
def test_html_names_lower_the_score(page):
    assert html_text.main_text("<body><nav>Home</nav>" + page.replace("%s", PROSE) + "</body>") == TEXT


def test_words_and_bit_table(spark):
    import pyarrow as pa

    texts = ["a b", None, "c", "c", "dé  f\n", "x" * 5000 + " b"]
    (first, buf, off), = common.doc_slices(pa.array(texts))
    w = common.Words(buf, off, common.ASCII_SPACE, common.SAME)
    assert first == 0 and np.diff(w.first).tolist() == [2, 0, 1, 1, 2, 2]
    assert w.hash[2] == w.hash[3] and w.hash[1] == w.hash[7] and len(set(w.hash.tolist())) == 6
    keys = np.array([0, -1, 5, 2**62], np.int64)
    table = common.set_bits(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k", 16)
    assert table.has(keys.view(np.uint64)).all()
    assert not table.has(np.array([2**50 * 3], np.uint64)).any()


@pytest.mark.parametrize("attrs", ["style='overflow: hidden'", 'style="visibility: hidden; color: red"', "title='Hidden costs'", "data-x='a class=\"ad\" id=menu'",
                                   "style = 'overflow: hidden'class=content", "class=content class=ad", "data-a=x/hidden", "data-a='role=\"navigation\"'"])
def test_html_attribute_names_only_in_name_position(attrs):
    assert html_text.main_text(f"<body><div {attrs}>{PROSE}</div></body>") == TEXT
    for hides in ("hidden", "HIDDEN=''", "hidden/", "role=navigation", "a='b'hidden"):
        assert html_text.main_text(f"<body><div {hides}>{PROSE}</div><p>Short.</p></body>") == "Short."


def test_html_long_attribute_values():
    page = "<article><div data-x=\"%s\" data-y='%s'>Some text.</div><p>More.</p></article>"
    long = "<p>markup > text</p>" * 5000
    assert html_text.main_text(page % (long, long)) == "Some text.\n\nMore."
    assert html_text.main_text("<article><p>One.</p><p title=\"" + "x" * 5000 + ">Two.</p></article>") == "One.\n\nTwo."  # no closing quote


SOURCES = "<ul><li><a href=1>First source</a></li><li><a href=2>Second source</a></li></ul>"


@pytest.mark.parametrize("page, want", [
    (f"<article>{PROSE}<h2>Sources</h2>{SOURCES}</article>", f"{TEXT}\n\nSources\n\nFirst source\n\nSecond source"),
    (f"<article>{PROSE}{SOURCES}</article>", f"{TEXT}\n\nFirst source\n\nSecond source"),
    (f"<article>{PROSE}{SOURCES}<p>The end, then.</p></article>", f"{TEXT}\n\nFirst source\n\nSecond source\n\nThe end, then."),
    (f"<article>{PROSE}<section><h2>References</h2><a href=1>First source</a></section></article>", f"{TEXT}\n\nReferences\n\nFirst source"),
    (f"<article>{SOURCES}{PROSE}</article>", TEXT),
    (f"<article>{PROSE}<ul class='related'><li><a href=1>Another article</a></ul><div><a href=1>next</a></div></article>", TEXT),
    (f"<body><h1>Title</h1><div>{PROSE}</div><h2>Elsewhere</h2></body>", f"Title\n\n{TEXT}"),
    (f"<body><h1><a href=/>Site</a></h1><div>{PROSE}</div></body>", TEXT),
    (f"<body><div>{PROSE}</div><pre>some code</pre><ul><li>point</ul><p>The end, then.</p><ul><li>x</ul></body>", f"{TEXT}\n\nsome code\n\npoint\n\nThe end, then."),
])
def test_html_lists_and_headings(page, want):
    assert html_text.main_text(page) == want


def test_word_model_in_ranges_leaves_no_tables(spark, monkeypatch, tmp_path):
    """Counts of one range of words at a time: scores as in one range, and no counts on disk afterwards."""
    rows = [(i if i % 9 else None, " ".join(_words(30 + i)) if i % 7 else "", "en") for i in range(40)]
    rows += [(500 + i, rows[i][1], "en") for i in range(0, 40, 3)] + [rows[5], rows[5]]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)] + [(500, 1, 0), (503, 1, 0)], "doc_id long, quality int, toxic int")
    folders = []
    monkeypatch.setattr(common, "scratch_path", lambda spark, name: folders.append(tmp_path / f"{name}-{len(folders)}") or str(folders[-1]))
    scores = lambda: sorted(((r.doc_id or -1, r.n_bytes, r.kept), r.perplexity or 0.0) for r in perplexity.classify(table, lab).collect())
    one = scores()
    monkeypatch.setattr(perplexity, "RANGES", 3)
    monkeypatch.setattr(perplexity, "RANGE_BYTES", 1, raising=False)
    several = scores()
    assert [x[0] for x in one] == [x[0] for x in several] and np.allclose([x[1] for x in one], [x[1] for x in several], rtol=1e-9)
    assert not [f for f in folders if f.exists() and f.name.startswith(("words", "word-values", "perplexity"))]


def test_full_cache_of_parts_keeps_what_the_run_has(monkeypatch):
    """A cache that gets too large is not emptied: parts of the current run are not encoded again."""
    import public_tokenizers

    from lakemart.llm import tokens

    class Counting:
        def __init__(self, tok):
            self.tok, self.words = tok, 0

        def encode_batch_fast(self, texts, **kw):
            self.words += sum(len(t.split()) for t in texts)
            return self.tok.encode_batch_fast(texts, **kw)

    enc = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    words = [f"{a}{b}" for a in "abcdefghij" for b in "uvwxyz"]
    monkeypatch.setattr(tokens, "CACHE_PARTS", 50)
    enc.tok = Counting(enc.tok)
    enc.encode(["x " + " ".join(words[:40])])
    before, texts = enc.tok.words, ["x " + " ".join(words), "x \t y", None, "x a,\nb. "]
    got = enc.encode(texts)
    assert enc.tok.words - before < 40
    assert got == [np.array(e.ids, "<u4").tobytes() for e in enc.tok.tok.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]


def test_words_too_frequent_for_a_shard(spark, monkeypatch):
    """A word with more places than a shard takes is dealt to several: scores stay, and no shard has all of its places."""
    rows = [(i, " ".join(f"the {x}" if k % 3 else x for k, x in enumerate(_words(20 + i))), "en") for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)], "doc_id long, quality int, toxic int")
    scores = lambda: sorted((r.doc_id, r.n_bytes, r.kept, r.perplexity) for r in perplexity.classify(table, lab).collect())
    one, deals, gains = scores(), [], perplexity.Words.gains
    monkeypatch.setattr(perplexity, "SHARD_WORDS", 64)
    monkeypatch.setattr(perplexity, "RANGE_BYTES", 1)
    monkeypatch.setattr(perplexity.Words, "gains", lambda self, *a: deals.append(self.deal) or gains(self, *a))
    several = scores()
    assert len(deals[0].hot) and deals[0].parts.max() > 1 and deals[0].ranges > 1
    assert [x[:3] for x in one] == [x[:3] for x in several] and np.allclose([x[3] for x in one], [x[3] for x in several], rtol=1e-9)


def test_trusted_words_are_dealt_packed():
    """Every 3-gram of the texts reaches one shard of one range, in under 24 bytes, what three hashes take."""
    texts = [" ".join(_words(4000 + i)) for i in range(8)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8), pa.int64()), pa.array(texts)], names=["key", "text"])
    deal, places, size = perplexity.Deal(6, 2, {}), 0, 0
    for r in range(2):
        for b in perplexity._trusted_words([batch], deal, r):
            for shard, trusted, n, payload in zip(*(b.column(c).to_pylist() for c in b.schema.names), strict=True):
                v, p, w, keys, counts = perplexity._unpack(n, payload)
                assert trusted and shard % 2 == r and (deal.shard(v, p) == shard).all() and len(v) == len(p) == len(w) == counts.sum() and set(keys) <= set(range(8))
                places, size = places + len(w), size + len(payload)
    assert places == sum(len(t.split()) + 1 for t in texts) and size < 24 * places
