"""Spelling variants: words of a vocabulary within one edit of each other, and the common form of a rare one.

Two words one edit apart differ at one place, so they agree before and after any stretch (a *hole*) that
holds the place of their first difference. Words are dealt by what they have outside a hole: with two holes,
the left and the right half, every pair meets exactly once. A deal of more than ``limit`` words cuts its hole
in two and is dealt again, down to holes of one letter, whose deals the alphabet bounds; so no hot prefix or
ending makes a large group, and no pair is left out.

A deal is a sorted list. It is read as such: adjacent words share a prefix (their LCP), and the edit matrix's
rows of a shared prefix are computed once. Rows are banded, as only cells beside the diagonal can be one or
less. A range of the list whose shared prefix costs more than one edit is skipped whole. All words of a deal
ask at once, level by level, in NumPy.

Defined results: words are compared by code points, exactly; hashes only deal them. No text or no words: no
rows. Repeated rows count again. A row without id counts like one whose id is empty text. Ties of a form go to
the word that is least in code-point order. Texts and words of any length are read whole, texts in pieces.
Further columns are ignored.
"""

from __future__ import annotations

import collections
import math
import zlib

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import common as C

#: Words in a deal at most, before its hole is cut in two.
LIMIT = 16384
#: Rows that are read at once, whole deals.
RUN = 1 << 15
_PIECE, _HELD = 1 << 20, 1 << 18
#: Latin letters to themselves, A-Z to a-z, all else to a blank; one byte for a code point.
_FOLD = bytes(c if 97 <= c <= 122 or c >= 0xC0 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def _runs(text: str):
    """Lower-cased runs of Latin letters, in pieces of the text."""
    raw = text.encode("latin-1", "replace").translate(_FOLD)
    lo = 0
    while lo < len(raw):
        hi = raw.find(b" ", lo + _PIECE) if len(raw) - lo > _PIECE else -1
        hi = len(raw) if hi < 0 else hi
        yield raw[lo:hi].split()
        lo = hi


def vocabulary(docs: DataFrame, least_length: int = 7, least_n: int = 2, slip: int = 0) -> DataFrame:
    """(word, n) of the runs ``[A-Za-z\\u00C0-\\u00FF]+`` in the texts, A-Z lower-cased.

    With ``slip``, a run whose CRC-32 of ``<doc_id>:<run>`` it divides loses the letter at CRC-32 % length:
    typing errors that depend on the row alone."""
    def count(batches):
        held = {}

        def out():
            words = list(held)
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in words], pa.string()),
                                               pa.array([held[w] for w in words], pa.int64())], names=["word", "n"])

        for batch in batches:
            for b in C.row_slices(batch):
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    if not text:
                        continue
                    start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for runs in _runs(text):
                        for w, k in collections.Counter([w for w in runs if len(w) >= least_length]).items():
                            if slip:
                                h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                                if h % slip == 0:
                                    at = h % len(w)
                                    w = w[:at] + w[at + 1:]
                                    if len(w) < least_length:
                                        continue
                            held[w] = held.get(w, 0) + k
                    if len(held) > _HELD:
                        yield out()
                        held.clear()
        if held:
            yield out()

    rows = docs.select(C.column(docs, "doc_id").alias("doc"), C.column(docs, "text", "string").alias("text"))
    parts = rows.mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def _prefixes(cp, off, length, first):
    """LCP of each row with the row before it; -1 at the first row of a deal."""
    lcp = np.full(len(off), -1, np.int64)
    at = np.flatnonzero(~first)
    lcp[at] = 0
    d = 0
    while len(at):
        at = at[np.minimum(length[at], length[at - 1]) > d]
        at = at[cp[off[at] + d] == cp[off[at - 1] + d]]
        d += 1
        lcp[at] = d
    return lcp


def near_pairs(words: list[str], deal: np.ndarray, shorter: np.ndarray, hole_from: np.ndarray, hole_to: np.ndarray):
    """Row pairs (i, j) of words one edit apart whose first difference lies in their deal's hole.

    Rows are sorted by deal, then word. ``shorter`` is the deal's word length, others have one letter more;
    i has the shorter length. A pair of equal lengths comes in both directions, others once."""
    none = np.zeros(0, np.int64)
    length = np.fromiter(map(len, words), np.int64, len(words))
    cp = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    off = np.cumsum(length) - length
    n = len(words)
    if not n:
        return none, none
    first = np.ones(n, bool)
    first[1:] = deal[1:] != deal[:-1]
    lcp = _prefixes(cp, off, length, first)
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], n)
    of = np.cumsum(first) - 1
    base = np.minimum.reduceat(np.where(first, np.iinfo(np.int64).max, lcp), starts)   # what all words of a deal share
    base[ends - starts < 2] = 0
    base = base[of]

    def letter(rows, place, miss):
        """Code point at ``place`` of the words ``rows``; ``miss`` outside the word."""
        ok = (place >= 0) & (place < length[rows])
        out = np.full(len(rows), miss, np.int64)
        out[ok] = cp[off[rows[ok]] + place[ok]]
        return out

    asks = np.flatnonzero((length == shorter) & (ends - starts > 1)[of])
    q, lo, hi = asks, starts[of[asks]], ends[of[asks]]
    d = base[asks]
    same = np.full(len(q), -1, np.int64)   # length of the common prefix, once the words differ
    x0, x1, x2 = np.where(d > 0, 1, 2), np.zeros(len(q), np.int64), np.where(d < length[q], 1, 2)
    left, right, step = [none], [none], 0
    rows = np.arange(n)
    while len(q):
        live = np.zeros(n + 1, np.int64)   # rows of ranges that somebody still reads
        np.add.at(live, lo, 1)
        np.add.at(live, hi, -1)
        rows = rows[np.cumsum(live)[rows] > 0]
        cut = rows[lcp[rows] <= base[rows] + step]   # first rows of the ranges one letter on
        cut = np.union1d(cut, lo)
        a, z = np.searchsorted(cut, lo), np.searchsorted(cut, hi)
        k = z - a
        item = np.repeat(np.arange(len(q)), k)
        child = np.arange(len(item)) - np.repeat(np.cumsum(k) - k, k) + a[item]
        w, q, d = cut[child], q[item], d[item]
        hi = np.where(child + 1 < z[item], cut[np.minimum(child + 1, len(cut) - 1)], hi[item])
        x0, x1, x2, same = x0[item], x1[item], x2[item], same[item]
        done = length[w] == d
        if done.any():   # a word that ends here: its distance is in the matrix's last row
            over = length[q] - d
            cost = np.where(over == 0, x1, np.where(over == -1, x0, np.where(over == 1, x2, 2)))
            hit = done & (cost == 1)
            p = np.where(x1[hit] == 0, d[hit], same[hit])
            ok = (p >= hole_from[q[hit]]) & (p < hole_to[q[hit]])
            left.append(q[hit][ok])
            right.append(w[hit][ok])
        c = letter(w, d, -1)
        y0 = np.minimum(x0 + (letter(q, d - 1, -2) != c), x1 + 1)
        y1 = np.minimum(np.minimum(x1 + (letter(q, d, -2) != c), x2 + 1), y0 + 1)
        y1[d + 1 > length[q]] = 2
        y2 = np.minimum(x2 + (letter(q, d + 1, -2) != c), y1 + 1)
        y2[d + 2 > length[q]] = 2
        same = np.where((same < 0) & (y1 > 0), d, same)
        # of words equal up to the hole's end, the difference lies in another hole
        keep = ~done & (np.minimum(np.minimum(y0, y1), y2) <= 1) & ((y1 > 0) | (d + 1 < hole_to[q]))
        keep &= (same < 0) | ((same >= hole_from[q]) & (same < hole_to[q]))
        q, lo, hi, d, same = q[keep], w[keep], hi[keep], d[keep] + 1, same[keep]
        x0, x1, x2 = y0[keep], y1[keep], y2[keep]
        step += 1
    return np.concatenate(left), np.concatenate(right)


def _deals(vocab: DataFrame, limit: int) -> DataFrame:
    """(deal, m, s, e, word, n): each word by its letters outside the holes, for its own length and one less."""
    size = F.char_length("word")
    rows = vocab.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).where("m > 0")
    half = F.expr("m div 2")
    holes = F.array(F.struct(F.lit(0).alias("s"), half.cast("int").alias("e")), F.struct(half.cast("int").alias("s"), (F.col("m") + 1).alias("e")))
    rows = rows.select("word", "n", "m", F.explode(holes).alias("h")).select("word", "n", "m", "h.s", "h.e").where("s < e")

    def dealt(r):
        return r.withColumn("deal", F.xxhash64("m", "s", "e", F.expr("left(word, s)"), F.expr("right(word, greatest(0, m - e))")))

    rows, out = dealt(rows), None
    while True:
        large = C.stored(rows.groupBy("deal").agg(F.count(F.lit(1)).alias("c"), F.max(F.expr("e - s")).alias("wide"))
                         .where((F.col("c") > limit) & (F.col("wide") > 1)).select("deal"), "large-deals")
        if large.isEmpty():
            return rows if out is None else out.unionByName(rows)
        small = rows.join(large, "deal", "left_anti")
        out = small if out is None else out.unionByName(small)
        mid = F.expr("s + (e - s) div 2").cast("int")
        cut = F.array(F.struct(F.col("s"), mid.alias("e")), F.struct(mid.alias("s"), F.col("e")))
        rows = C.stored(dealt(rows.join(large, "deal", "left_semi").withColumn("h", F.explode(cut))
                              .select("word", "n", "m", "h.s", "h.e")), "cut-deals")


def _near(batches):
    """Of each word and deal: how many are near, and the most frequent of them (ties: the least word)."""
    held, rows = [], 0

    def out(t):
        words, n, deal = t.column("word").to_pylist(), t.column("n").to_numpy(), t.column("deal").to_numpy()
        at = lambda c: t.column(c).to_numpy().astype(np.int64)
        a, b = near_pairs(words, deal, at("m"), at("s"), at("e"))
        if not len(a):
            return None
        size = np.fromiter(map(len, words), np.int64, len(words))
        back = size[a] != size[b]
        a, b = np.concatenate([a, b[back]]), np.concatenate([b, a[back]])
        order = np.lexsort((b, -n[b], a))   # rows of a deal are in the order of their words
        a, b = a[order], b[order]
        one = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        count = np.diff(np.append(one, len(a)))
        pick = lambda rows: pa.array([words[i] for i in rows], pa.string())
        return pa.RecordBatch.from_arrays([pick(a[one]), pa.array(count), pa.array(n[b[one]]), pick(b[one])],
                                          names=["word", "n_near", "form_n", "form"])

    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < RUN:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        deal = t.column("deal").to_numpy()
        cut = int(np.searchsorted(deal, deal[-1]))   # the last deal may go on
        if cut:
            got = out(t.slice(0, cut))
            if got is not None:
                yield got
        held, rows = t.slice(cut).to_batches(), t.num_rows - cut
    if held:
        got = out(pa.Table.from_batches(held).combine_chunks())
        if got is not None:
            yield got


def near_words(vocab: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(word, n_near, form_n, form): words of ``vocab`` (word, n; distinct words) that have words one edit
    apart, how many, and the one of largest n."""
    rows = _deals(vocab, limit).select("deal", "m", "s", "e", "word", "n")
    found = (rows.repartition("deal").sortWithinPartitions("deal", "word")
             .mapInArrow(_near, "word string, n_near long, form_n long, form string"))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.less")).alias("form_n"), F.col("b.form").alias("form")))


def group_variants(vocab: DataFrame, ratio: int = 10, limit: int = LIMIT) -> DataFrame:
    """(word, n, form, form_n, n_near, root): a word's form is its most frequent near word if that has
    ``ratio`` (2 at least) times its n; the root follows forms to the last.

    A chain of forms multiplies n by ``ratio`` at each step, so the largest n bounds its length: pointers are
    doubled as often as that needs."""
    vocab = C.stored(vocab.select("word", "n"), "vocabulary")
    near = C.stored(near_words(vocab, limit), "near-words")
    ok = F.col("form_n") >= ratio * F.col("n")
    rows = vocab.join(near, "word", "left").select(
        "word", "n", F.when(ok, F.col("form")).alias("form"), F.when(ok, F.col("form_n")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
    up = C.stored(rows.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "forms")
    largest = vocab.agg(F.max("n")).first()[0] or 1
    chain = max(1, math.ceil(math.log(max(largest, 2), ratio)) + 1)
    for _ in range(math.ceil(math.log2(chain))):
        on = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = C.stored(up.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "forms")
    return rows.join(up, "word", "left").withColumn("root", F.coalesce("root", "word"))
