"""Quality classifier: interpolated modified Kneser-Ney model of trusted text, judged by perplexity.

The model is over words (between white space, as written) and, below them, over byte classes: the
probability of a word without history falls back on its spelling, so no word is unknown.

1. Spelling: trusted texts (labelled good and not toxic) are counted whole as 4-grams of 64 byte classes;
   modified Kneser-Ney from order 4 down to 1. A word is spelled from a space to a space; line ends and
   further white space cost what this model says in their place.
2. Words: all n-grams of ``WORDS`` words of the trusted texts (start and end of a text are words) are dealt, packed,
   into shards by the hash of their middle word, or for a very frequent word by that and the word before; so a 3-gram's
   context and end are counted in its shard by 64-bit hash, and three discounts an order follow from all shards' counts of
   counts. Counts of the words as ends of pairs, and of the frequent words' pairs, are summed over the shards and
   joined back. Shards hold about ``SHARD_WORDS`` words, however many there are; the tables grow with the
   trusted text and stay in the tasks. One range of shards is counted after the other, then each is valued: its
   shuffle files go before the next begins, and the texts are read again.
3. For a seen n-gram, log P is that of its end plus the weight left to it plus a gain; for others there is no gain.
   So a text's bits are those of its spelling less, over its n-grams, their gains and their weights as
   contexts: the documents' distinct n-grams with their counts are sent to the shards and come back as sums by
   document; those of trusted texts are there already. A bit table of a range's hashes leaves out beforehand what is
   certainly not in it.
4. A trusted document is judged as if it had not been counted: n-grams that only it has give it nothing.
5. A document's score is its bits a byte, drawn towards the trusted mean as by ``PRIOR`` more bytes, so a
   few odd words do not reject a short text; a second score is that of its byte classes in their places
   (white space and punctuation between words). Both must be within their limits. Its language's limit is the ``QUANTILE`` of the trusted
   documents' scores and ``MARGIN`` bits, however few they are; a language without any takes that of all.

Cases: null and empty texts have no perplexity and are kept; a label without document is ignored, and
so is one without id; repeated labels count once; rows without id are scored, never trusted; without
trusted text all is kept; an empty table gives no rows; only the named columns are read; rows of equal id and
text are scored alike.
"""

from __future__ import annotations

import functools
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import common as C

ORDER, BITS, WORDS = 4, 6, 3
RANGES = 6  # of shards, for at most so many parts of the counts on disk at a time
RANGE_BYTES = 1 << 21  # of trusted text, at least, for each range
SHARD_WORDS = 1 << 19  # trusted words of a shard, about
SLOT_BITS, FILTER_BITS = 23, 28  # of the tables, of a shard and of a range, that spare n-grams which are not in the model
START, END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # the words before and after a text
MANY = -(1 << 63)  # in place of a document's key: more than one has the n-gram
QUANTILE, MARGIN, PRIOR = 0.999, 0.25, 200


FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k of eight bytes


def _classes() -> np.ndarray:
    """Class of each byte; 0 stands before a text's start."""
    t = np.full(256, 63, np.uint8)  # other control bytes
    t[[0x20, 0x09]], t[[0x0A, 0x0B, 0x0C, 0x0D]] = 1, 2
    t[0x61:0x7B], t[0x41:0x5B] = np.arange(3, 29), np.arange(29, 55)
    t[0x30:0x3A] = 55
    for k, signs in enumerate((b".,", b"'\"-:;?()", b"!", b"#*$%&|<>@~^=+_[]{}\\/`")):
        t[list(signs)] = 56 + k
    t[0x80:0xC0], t[0xC0:0xC4], t[0xC4:] = 60, 61, 62
    return t


CLASSES = _classes()
#: Bits for a byte within its class, all alike.
WITHIN = np.log2(np.maximum(np.bincount(CLASSES, minlength=64), 1))[CLASSES]


def grams(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The 4-gram that ends at each byte, over the texts of a run; no gram reaches into the text before."""
    c = CLASSES[buf].astype(np.int32)
    place = np.arange(len(buf)) - np.repeat(off[:-1], np.diff(off))
    out = c.copy()
    for j in range(1, ORDER):
        out[j:] |= np.where(place[j:] >= j, c[:-j], 0) << (BITS * j)
    return out


def _count(batches):
    gram, n = np.zeros(0, np.int32), np.zeros(0, np.int64)
    for b in batches:
        for _, buf, off in C.doc_slices(b.column("text")):
            u, c = np.unique(grams(buf, off), return_counts=True)
            both, where = np.unique(np.concatenate([gram, u]), return_inverse=True)
            n = np.bincount(where, np.concatenate([n, c]), len(both)).astype(np.int64)
            gram = both
    yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int64)), pa.array(n)], names=["gram", "n"])


def _with_bit(batches, held):
    """The rows whose id's bit is set: all trusted ones and a few more."""
    for b in batches:
        yield b.filter(pa.array(held.value.has(b.column("hid").to_numpy().view(np.uint64)))).drop_columns(["hid"])


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Distinct ids that are labelled good and not toxic."""
    return (labels.where((C.column(labels, "quality") == 1) & (C.column(labels, "toxic") == 0))
            .select(C.column(labels, "doc_id", "long").alias("doc_id")).dropna().distinct())


def _three(*y: int) -> list[float]:
    """The three discounts of an order with ``y`` n-grams of count 1, 2, 3 and 4: of counts of 1, of 2, and of more."""
    n1, n2, n3, n4 = (max(1, x or 0) for x in y)
    q = n1 / (n1 + 2 * n2)
    return [min(max(x, 0.05), k) for k, x in ((1, 1 - 2 * q * n2 / n1), (2, 2 - 3 * q * n3 / n2), (3, 3 - 4 * q * n4 / n3))]


def _discounts(counts: DataFrame) -> list[float]:
    """The three discounts of one order."""
    return _three(*counts.agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first())


def _discount(d: list[float]):
    """The discount of a row's count."""
    return F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])


def _only():
    """The only document's key of a group, or MANY."""
    return F.when(F.min("only") == F.max("only"), F.min("only")).otherwise(F.lit(MANY)).alias("only")


def _level(counts: DataFrame):
    """(gram, share) of the seen grams of one order and (context, rest) of their contexts: the discounted share
    and the weight left to the order below. Joined by context."""
    d = _discounts(counts)
    rows = counts.withColumn("context", F.shiftright("gram", BITS)).withColumn("d", _discount(d))
    sums = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum("d").alias("taken"))
    seen = rows.join(sums, "context").select("gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("share"))
    return seen, sums.select("context", (F.col("taken") / F.col("total")).alias("rest"))


class Model(C.Shipped):
    """Trigram probabilities, weights left to them by context, and shares of the seen 4-grams."""

    def __init__(self, low, rest, gram, share):
        self.low, self.rest, self.gram, self.share, self.name = low, rest, gram, share, uuid.uuid4().hex

    def table(self) -> np.ndarray:
        """-log2 P of the last class of each 4-gram given those before; put together once in each worker."""
        held = C.worker_state("perplexity")
        if self.name not in held:
            held.clear()
            held[self.name] = _negative_log2(_raise(self.low, self.rest, self.gram, self.share))
        return held[self.name]


def _raise(low, rest, gram, share) -> np.ndarray:
    """Probabilities of one order from those of the order below."""
    p = np.tile(low, 1 << BITS)
    p.reshape(-1, 1 << BITS)[:] *= rest[:, None]
    p[gram] += share
    return p


def _negative_log2(p):
    np.log2(p, out=p)
    return np.negative(p, out=p)


def model(texts: DataFrame) -> Model | None:
    """The model of ``texts`` (column text); None without text."""
    counts = C.stored(texts.mapInArrow(_count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "gram-counts")
    orders = [counts]
    for k in range(ORDER - 1, 0, -1):  # below the top: in how many distinct places a gram's end occurs
        orders.append(orders[-1].groupBy(F.col("gram").bitwiseAND((1 << (BITS * k)) - 1).alias("gram"))
                      .agg(F.count(F.lit(1)).alias("n")))
    if counts.isEmpty():
        return None
    p = np.full(1, 1 / (1 << BITS), np.float32)
    for k, c in enumerate(reversed(orders), start=1):
        seen, rest = _level(c)
        r, s = rest.toPandas(), seen.toPandas()  # at most 2**18 contexts and 2**24 grams, the size of the table
        weight = np.ones(1 << (BITS * (k - 1)), np.float32)
        weight[r["context"].to_numpy()] = r["rest"].to_numpy()
        gram, share = s["gram"].to_numpy(np.int32), s["share"].to_numpy(np.float32)
        if k == ORDER:
            return Model(p, weight, gram, share)
        p = _raise(p, weight, gram, share)


class TextWords(C.Words):
    """Words between white space of a run of texts, as written; the hash takes eight bytes at a time."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        super().__init__(buf, off, C.ASCII_SPACE, C.SAME)

    def _block(self, b, cuts, sep, fold):
        gap = (b == 0x20) | (b - np.uint8(9) < 5)
        edge = np.empty(len(b) + 1, bool)
        edge[0], edge[-1] = not gap[0], not gap[-1]
        np.not_equal(gap[1:], gap[:-1], out=edge[1:-1])
        at = np.flatnonzero(edge)
        s, e = at[::2], at[1::2]
        cuts = cuts[(cuts > 0) & (cuts < len(b))]
        cuts = np.unique(cuts[~gap[cuts] & ~gap[cuts - 1]])
        if len(cuts):  # a text may end without a separator before the next one begins
            s, e = np.sort(np.concatenate([s, cuts])), np.sort(np.concatenate([e, cuts]))
        return self._of(b, s, e - s), s, e

    @staticmethod
    def _of(b, start, lens):
        eight = np.ndarray(len(b) + 1, "<u8", np.append(b, np.zeros(8, np.uint8)), strides=(1,))  # from each byte on
        h = C.mix((eight[start] & FIRST[np.minimum(lens, 8)]) * np.uint64(0x9E3779B97F4A7C15) + lens.astype(np.uint64))
        more, done = np.flatnonzero(lens > 8), 8
        while len(more):
            x = eight[start[more] + done] & FIRST[np.minimum(lens[more] - done, 8)]
            h[more] = C.mix(h[more] * np.uint64(0xD6E8FEB86659FD93) + C.mix(x + np.uint64(done)))
            done += 8
            more = more[lens[more] > done]
        return h


def _padded(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts (word range ``first``) with two starts before and an end after each, the text of each place, and
    the places of words and ends."""
    n, pad = np.diff(first), WORDS - 1
    size = n + pad + 1
    at = np.cumsum(size) - size
    doc = np.repeat(np.arange(len(n)), size)
    w = np.full(len(doc), START)
    w[np.arange(len(h)) + np.repeat(at + pad - first[:-1], n)] = h
    w[at + size - 1] = END
    return w, doc, np.flatnonzero(np.arange(len(doc)) - np.repeat(at, size) >= pad)


def _extended(below: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hashes of the n-grams ``below``, each with one more word ``w``."""
    g = C.mix(w * np.uint64(0x9FB21C651E98DF25) + np.uint64(1))
    g += below * np.uint64(0xD6E8FEB86659FD93)
    return C.mix(g)


BEGIN = _extended(np.array([START]), np.array([START]))[0]  # the context of a text's first word


def spelled(buf: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Bits of each word's spelling, from the space before it to the space after it."""
    size = end - start + 1
    at = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(at, size)
    b = np.full(len(place), 0x20, np.uint8)
    inside = place < np.repeat(size - 1, size)
    b[inside] = buf[(place + np.repeat(start, size))[inside]]
    c = CLASSES[b].astype(np.int32)
    gram = c.copy()
    for j in range(1, ORDER):
        before = np.where(place >= j, np.concatenate([c[:0], np.zeros(min(j, len(c)), np.int32), c[:-j]])[:len(c)], place == j - 1)
        gram |= before.astype(np.int32) << (BITS * j)
    cost = table[gram].astype(np.float64) + np.where(inside, WITHIN[b], 0)
    return np.add.reduceat(cost, at) if len(at) else np.zeros(0)


def _white(buf: np.ndarray, off: np.ndarray, in_place: np.ndarray) -> np.ndarray:
    """Bits of each text's white space but for single spaces after words."""
    gap = C.ASCII_SPACE[buf]
    after = np.zeros(len(buf), bool)
    after[1:] = ~gap[:-1]
    after[off[:-1][off[:-1] < len(buf)]] = False
    at = np.flatnonzero(gap & ~(after & (buf == 0x20)))
    return np.bincount(np.searchsorted(off, at, side="right") - 1, in_place[at], len(off) - 1)


def _pack(wide: list[np.ndarray], small: list[np.ndarray]) -> tuple[int, bytes]:
    """Columns of 64-bit hashes, and of small numbers by their bytes' places, compressed; and their size before."""
    head = np.array([len(wide), len(small), *map(len, wide), *map(len, small)], np.int64)
    planes = [x.astype("<u4").view(np.uint8).reshape(-1, 4).T for x in small]
    raw = b"".join(x.tobytes() for x in (head, *wide, *planes))
    return len(raw), pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpack(size: int, payload: bytes) -> list[np.ndarray]:
    """The columns of ``_pack``; hashes as unsigned numbers."""
    raw = pa.Codec("zstd").decompress(payload, size, asbytes=True)
    n_wide, n_small = np.frombuffer(raw, np.int64, 2)
    lens, at, out = np.frombuffer(raw, np.int64, n_wide + n_small, 16), 16 + 8 * int(n_wide + n_small), []
    for k, n in enumerate(lens.tolist()):
        if k < n_wide:
            out.append(np.frombuffer(raw, np.uint64, n, at))
        else:
            out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T).view("<u4")[:, 0].astype(np.int64))
        at += (8 if k < n_wide else 4) * n
    return out


def _find(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each of ``x`` in the sorted ``table``, and whether it is there."""
    if not len(table):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.searchsorted(table, x)
    at[at == len(table)] = 0
    return at, table[at] == x


class Deal(C.Shipped):
    """The shard of each context: that of its last word, and for words that are too frequent for one shard one of several,
    by the word before. Ranges take every ``ranges``-th shard."""

    def __init__(self, shards: int, ranges: int, hot: dict[int, int]):
        self.shards, self.ranges = shards, ranges
        self.hot = np.sort(np.array(list(hot), np.int64).view(np.uint64))
        self.parts = np.array([min(shards, hot[int(w)] // SHARD_WORDS + 1) for w in self.hot.view(np.int64)], np.uint64)
        self.slot_bits = (shards // ranges - 1).bit_length()

    def shard(self, v: np.ndarray, by: np.ndarray | None = None) -> np.ndarray:
        """Shards of contexts that end with ``v``; without ``by``, of the words ``v`` alone."""
        out = (v >> np.uint64(16)) % np.uint64(self.shards)
        if by is not None and len(self.hot):
            at, hot = _find(self.hot, v)
            out[hot] = (out[hot] + (by[hot] >> np.uint64(20)) % self.parts[at[hot]]) % np.uint64(self.shards)
        return out.astype(np.int64)

    def slot(self, gram: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Key of n-grams of a shard in its range's bit table: the shard's place in the range, then the hash's top bits."""
        if not self.slot_bits:
            return gram
        return ((shard // self.ranges).astype(np.uint64) << np.uint64(64 - self.slot_bits)) | (gram >> np.uint64(self.slot_bits))


def _runs(batches, skip=None):
    """Of each run of texts: keys, words with starts and ends, the text of each place, and the places of words and ends;
    without rows whose id's bit (of ``hid``) is in ``skip``."""
    for b in batches:
        if skip is not None:
            b = b.filter(pa.array(~skip.value.has(b.column("hid").to_numpy().view(np.uint64))))
        for i, buf, off in C.doc_slices(b.column("text"), 8 << 20, 4096):
            key = b.column("key").slice(i, len(off) - 1).to_numpy(zero_copy_only=False)
            words = TextWords(buf, off)
            yield key, *_padded(words.hash, words.first)


def _firsts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])[:len(x)])


def _by_shard(shard: np.ndarray):
    """Each shard with the places of its rows, in their order."""
    order = np.argsort(shard.astype(np.uint16 if len(shard) and shard.max() < 1 << 16 else np.int64), kind="stable")
    start = _firsts(shard[order])
    for lo, hi in zip(start, np.append(start[1:], len(order)), strict=True):
        yield int(shard[order[lo]]), order[lo:hi]


_BLOBS = "shard int, trusted boolean, size long, payload binary"


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    shard, trusted, size, payload = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(trusted, pa.bool_()), pa.array(size, pa.int64()), pa.array(payload, pa.binary())],
                                      names=["shard", "trusted", "size", "payload"])


def _trusted_words(batches, deal, r):
    """The words and ends of range ``r`` of each run of texts with the two words before, by shard."""
    for key, w, doc, at in _runs(batches):
        shard = deal.shard(w[at - 1], w[at - 2])
        mine = np.flatnonzero(shard % deal.ranges == r)
        rows = []
        for s, x in _by_shard(shard[mine]):
            x = at[mine[x]]
            start = _firsts(doc[x])
            rows.append((s, True, *_pack([w[x - 1], w[x - 2], w[x], key[doc[x[start]]]], [np.diff(np.append(start, len(x)))])))
        yield _blobs(rows)


def _asked(batches, deal, r, held, hot_pairs, skip=None):
    """The distinct word n-grams of range ``r`` of each text that may be in the model, with their counts, by shard."""
    for key, w, doc, at in _runs(batches, skip):
        v, p, d = w[at - 1], w[at - 2], doc[at]
        own, alone = deal.shard(v, p), deal.shard(v)
        hot = _find(deal.hot, v)[1]
        asked = []

        def ask(x, where, shard, may):
            may = np.flatnonzero(may)
            asked.append((x[may], d[where[may]], shard[may]))

        def has(x, shard):
            return held.value.has(deal.slot(x, shard))

        x = np.flatnonzero(alone % deal.ranges == r)
        ask(v[x], x, alone[x], hot[x] | has(v[x], alone[x]))
        if hot.any():  # their pairs are in a shard of their own, by the second word
            x = np.flatnonzero(hot)
            pair_at = deal.shard(v[x], w[at[x]])
            mine = pair_at % deal.ranges == r
            x, pair_at = x[mine], pair_at[mine]
            pair = _extended(v[x], w[at[x]])
            ask(pair, x, pair_at, hot_pairs.value.has(pair))
        x = np.flatnonzero(own % deal.ranges == r)
        x = x[hot[x] | has(v[x], own[x])]  # without its middle word, or its context or end, no n-gram is in the model
        pair, context = _extended(v[x], w[at[x]]), _extended(p[x], v[x])
        cold, known = ~hot[x] & has(pair, own[x]), has(~context, own[x])
        ask(pair, x, own[x], cold)
        ask(~context, x, own[x], known)
        known &= hot[x] | cold
        x, gram = x[known], _extended(context[known], w[at[x[known]]])
        ask(gram, x, own[x], has(gram, own[x]))
        grams, docs, shards = (np.concatenate(x) for x in zip(*asked, strict=True))
        order = np.argsort(grams, kind="stable")  # texts stay in order
        grams, docs, shards = grams[order], docs[order], shards[order]
        rows = []
        for s, x in _by_shard(shards):
            g, t = grams[x], docs[x]
            new = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (t[1:] != t[:-1])))
            n, g, t = np.diff(np.append(new, len(g))), g[new], t[new]
            start, (one, t) = _firsts(g), np.unique(t, return_inverse=True)
            rows.append((s, False, *_pack([g[start], key[one]], [np.diff(np.append(start, len(g))), t, n])))
        yield _blobs(rows)


def _groups(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by value, where each value begins in it, the values, and how often each occurs."""
    order = np.argsort(x, kind="stable")
    start = _firsts(x[order])
    return order, start, x[order[start]], np.diff(np.append(start, len(x)))


def _group_of(order: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Number of each row's group."""
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(np.arange(len(n)), n)
    return out


def _sole(only: np.ndarray, order: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The only document's key of each group, or MANY."""
    if not len(start):
        return np.zeros(0, np.int64)
    lo = np.minimum.reduceat(only[order], start)
    return np.where(lo == np.maximum.reduceat(only[order], start), lo, MANY)


class Counted:
    """The trusted n-grams of one shard: 3-grams, their contexts and their ends, with counts and only documents."""

    def __init__(self, blobs: pa.Table, deal: Deal):
        parts = [_unpack(n, x) for n, x in zip(blobs.column("size").to_pylist(), blobs.column("payload").to_pylist(), strict=True)]
        v, p, w, self.keys, self.words = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (
            *(np.zeros(0, np.uint64) for _ in range(4)), np.zeros(0, np.int64))
        self.keys = self.keys.view(np.int64)
        self.key = np.repeat(self.keys, self.words)
        context = _extended(p, v)
        order, start, self.gram, self.n = _groups(_extended(context, w))
        self.gram_of, self.only = _group_of(order, self.n), _sole(self.key, order, start)
        one = order[start]
        context, v, w = context[one], v[one], w[one]
        order, start, self.context, n = _groups(context)
        # contexts that begin a text are never ends: only their own document may have them, but all texts begin alike
        self.context_of, self.context_only = _group_of(order, n), np.where(self.context == BEGIN, MANY, _sole(self.only, order, start))
        order, start, self.pair, self.pair_n = _groups(_extended(v, w))
        self.pair_of, self.pair_only = _group_of(order, self.pair_n), _sole(self.only, order, start)
        one = order[start]
        self.v, self.w = v[one], w[one]
        self.hot_at, self.hot = _find(deal.hot, self.v)


_COUNTS = "kind int, shard int, v long, w long, n long, only long, bits binary"
WORD, HOT, COUNTS, TABLE = range(4)


def _shard_counts(blobs: pa.Table, deal: Deal, bits: int) -> pa.Table:
    """Of one shard: its words as ends of pairs with counts (WORD), the pairs of hot words, which other shards have
    too (HOT), how many 3-grams and other pairs occur once to four times (COUNTS), and its n-grams' bits (TABLE)."""
    m, shard = Counted(blobs, deal), blobs.column("shard")[0].as_py()
    cold, hot = np.flatnonzero(~m.hot), np.flatnonzero(m.hot)
    order, start, w, n = _groups(m.w[cold])
    table = np.zeros(1 << bits, bool)
    for x in (m.v[cold], m.pair[cold], ~m.context, m.gram):
        table[(x >> np.uint64(64 - bits)).astype(np.int64)] = True
    counts = [np.bincount(np.minimum(x, 5), minlength=6)[1:5] for x in (m.n, m.pair_n[cold])]
    sizes = {WORD: len(w), HOT: len(hot), COUNTS: 8, TABLE: 1}
    kind = np.repeat(np.fromiter(sizes, np.int64), list(sizes.values()))
    none = lambda n, t=pa.int64(): pa.nulls(n, t)
    column = lambda *x: pa.chunked_array([y if isinstance(y, pa.Array) else pa.array(y) for y in x]).combine_chunks()
    signed = lambda x: x.view(np.int64)
    return pa.table({
        "kind": pa.array(kind, pa.int32()), "shard": pa.array(np.full(len(kind), shard), pa.int32()),
        "v": column(none(len(w)), signed(m.v[hot]), none(9)),
        "w": column(signed(w), signed(m.w[hot]), np.arange(8), none(1)),
        "n": column(n, m.pair_n[hot], np.concatenate(counts), none(1)),
        "only": column(_sole(m.pair_only[cold], order, start), m.pair_only[hot], none(9)),
        "bits": column(none(len(kind) - 1, pa.binary()), pa.array([np.packbits(table, bitorder="little").tobytes()], pa.binary()))})


class Facts(C.Shipped):
    """What every shard needs of all: discounts, and of the hot words the pairs that begin with them, the weight left to
    the order below, and value and only document."""

    def __init__(self, d2, d3, deal: Deal, rows):
        self.d2, self.d3 = (np.array([0, *d]) for d in (d2, d3))
        self.total, self.rest, self.value = np.ones(len(deal.hot)), np.zeros(len(deal.hot)), np.zeros(len(deal.hot))
        self.only = np.full(len(deal.hot), MANY)
        for x in rows:
            at = int(np.searchsorted(deal.hot, np.array([x["v"]], np.int64).view(np.uint64))[0])
            self.total[at], self.rest[at], self.value[at], self.only[at] = x["total"], x["rest"], x["value"], x["only"]


_TABLES = "shard int, kind int, v long, w long, n long, only long, x double"
LOG_P, VALUE, PAIR, HOME = range(4)


def _shard_gains(blobs: pa.Table, tables: pa.Table, deal: Deal, facts: Facts) -> pa.Table:
    """key and gain from the n-grams of one shard of its trusted texts and of those that ask."""
    m = Counted(blobs.filter(blobs.column("trusted")), deal)
    kind = tables.column("kind").to_numpy()

    def table(k, *columns):
        t = tables.filter(pa.array(kind == k))
        return [t.column(c).to_numpy() if c in ("n", "only", "x") else t.column(c).to_numpy().view(np.uint64) for c in columns]

    w, log_p = table(LOG_P, "w", "x")
    order = np.argsort(w)
    at, _ = _find(w[order], m.w)
    log_1 = log_p[order][at] if len(w) else np.zeros(len(m.w))
    n, only = m.pair_n.copy(), m.pair_only.copy()
    hot, cold = np.flatnonzero(m.hot), np.flatnonzero(~m.hot)

    def hot_pairs(k):
        v, w, n, only, x = table(k, "v", "w", "n", "only", "x")
        g = _extended(v, w)
        order = np.argsort(g)
        return g[order], _find(deal.hot, v[order])[0], n[order], only[order], x[order]

    if len(hot):  # their counts are those of all shards
        g, _, hot_n, hot_only, x = hot_pairs(PAIR)
        at, _ = _find(g, m.pair[hot])
        n[hot], only[hot], log_1[hot] = hot_n[at], hot_only[at], x[at]

    def of_pairs(n, total, rest, log_1):
        below = log_1 + rest
        log_p = np.log2((n - facts.d2[np.minimum(n, 3)]) / total + np.exp2(below))
        return log_p, log_p - below

    order, start, v, size = _groups(m.v[cold])
    v_of = _group_of(order, size)
    total_v, taken = np.bincount(v_of, n[cold], len(v)), np.bincount(v_of, facts.d2[np.minimum(n[cold], 3)], len(v))
    rest_v = np.log2(taken / total_v)
    total, rest, one = (np.zeros(len(m.v)) for _ in range(3))
    one_only = np.full(len(m.v), MANY)
    w, value, word_only = table(VALUE, "w", "x", "only")
    order = np.argsort(w)
    at, has = _find(w[order], v)  # the start is no word
    word = np.where(has, value[order][at] if len(w) else 0.0, 0.0) + rest_v
    word_only = np.where(has, word_only[order][at] if len(w) else MANY, MANY)
    for where, x in ((cold, (total_v[v_of], rest_v[v_of], word[v_of], word_only[v_of])),
                     (hot, (facts.total[m.hot_at[hot]], facts.rest[m.hot_at[hot]], facts.value[m.hot_at[hot]], facts.only[m.hot_at[hot]]) if len(hot) else ((),) * 4)):
        total[where], rest[where], one[where], one_only[where] = x
    log_2, two = of_pairs(n, total, rest, log_1)
    d = facts.d3[np.minimum(m.n, 3)]
    in_context = np.bincount(m.context_of, m.n, len(m.context))
    before = np.log2(np.bincount(m.context_of, d, len(m.context)) / in_context)
    below = log_2[m.pair_of] + before[m.context_of]
    three = np.log2((m.n - d) / in_context[m.context_of] + np.exp2(below)) - below

    gain = np.zeros(len(m.key))  # of the trusted texts' own words
    for value, alone, of in ((three, m.only, None), (before, m.context_only, m.context_of), (two, only, m.pair_of), (one, one_only, m.pair_of)):
        at = m.gram_of if of is None else of[m.gram_of]
        gain += np.where(alone[at] != m.key, value[at], 0.0)
    start = np.cumsum(m.words) - m.words
    keys, gains = [m.keys], [np.add.reduceat(gain, start) if len(start) else np.zeros(0)]

    g, at, hot_n, _, x = hot_pairs(HOME)
    _, home = of_pairs(hot_n.astype(np.int64), facts.total[at], facts.rest[at], x) if len(g) else (None, np.zeros(0))
    grams = np.concatenate([v, deal.hot, m.pair[cold], g, ~m.context, m.gram])
    values = np.concatenate([word, facts.value, two[cold], home, before, three])
    order = np.argsort(grams)
    grams, values = grams[order], values[order]
    asked = blobs.filter(pc.invert(blobs.column("trusted")))
    for size, payload in zip(asked.column("size").to_pylist(), asked.column("payload"), strict=True):
        g, key, n_docs, doc, n = _unpack(size, payload.as_py())
        at, has = _find(grams, g)
        value = np.where(has, values[at] if len(grams) else 0.0, 0.0)
        keys.append(key.view(np.int64))
        gains.append(np.bincount(doc, np.repeat(value, n_docs) * n, len(key)))
    key, gain = np.concatenate(keys), np.concatenate(gains)
    some = np.flatnonzero(gain)
    return pa.table({"key": key[some], "gain": gain[some]})


def _at_home(batches, deal):
    """Pairs of hot words with their hash and the shard that is asked for them."""
    for b in batches:
        v, w = (b.column(c).to_numpy().view(np.uint64) for c in "vw")
        b = b.append_column("gram", pa.array(_extended(v, w).view(np.int64)))
        yield b.append_column("home", pa.array(deal.shard(v, w), pa.int32()))


def _word_spelling(batches, spelling):
    """Distinct words of each run of texts, the end among them, how often each occurs and the bits of its spelling."""
    for batch in batches:
        for _, buf, off in C.doc_slices(batch.column("text"), 4 << 20):
            table = spelling.value.table()
            words = TextWords(buf, off)
            h, one, n = np.unique(words.hash, return_index=True, return_counts=True)
            cost = spelled(buf, words.start[one], words.end[one], table)  # the end is an empty word
            yield pa.RecordBatch.from_arrays([pa.array(np.append(h, END).view(np.int64)), pa.array(np.append(n, len(off) - 1)),
                                              pa.array(np.append(cost, np.float64(table[1 << BITS | 1])))], names=["w", "n", "spell"])


class Words:
    """The word model in shards of contexts, built while its ``scratch`` is open: the 3-grams with one middle word share a
    shard (those of a very frequent one several), so their contexts and ends are counted and valued in it."""

    def __init__(self, texts: DataFrame, all_bytes: int, spelling, scratch: C.Scratch):
        self.texts, self.scratch = texts, scratch
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = max(1, min(RANGES, size // RANGE_BYTES))
        with scratch.part("spelled") as own:
            spell = texts.mapInArrow(lambda b: _word_spelling(b, spelling), "w long, n long, spell double")
            spell = own.stored(spell.groupBy("w").agg(F.min("spell").alias("spell"), F.sum("n").alias("n")), "words")
            total = spell.agg(F.sum("n")).first()[0]
            shards = -(-int(max(total, total * all_bytes / size / 8)) // SHARD_WORDS)
            shards = -(-shards // ranges) * ranges
            end = int(END.view(np.int64))
            hot = {x["w"]: x["n"] for x in spell.where((F.col("n") > SHARD_WORDS) & (F.col("w") != end)).select("w", "n").collect()}  # fewer than shards
            deal = self.deal = Deal(shards, ranges, hot)
            bits = self.bits = max(3, min(SLOT_BITS, FILTER_BITS - deal.slot_bits))
            counts = []
            for r in range(ranges):
                blobs = texts.mapInArrow(lambda b, r=r: _trusted_words(b, deal, r), _BLOBS)
                counts.append(scratch.stored(blobs.groupBy("shard").applyInArrow(lambda t: _shard_counts(t, deal, bits), _COUNTS), f"counts-{r}"))
            self.counts = functools.reduce(DataFrame.unionByName, counts)
            pairs = self.counts.where(F.col("kind") == HOT)
            self.hot = scratch.stored(pairs.groupBy("v", "w").agg(F.sum("n").alias("n"), _only()), "hot-pairs")
            found = self.counts.where(F.col("kind") == COUNTS).groupBy("w").agg(F.sum("n").alias("n")).collect()
            found = {x["w"]: x["n"] for x in found}
            more = self.hot.agg(*[F.count_if(F.col("n") == k).alias(f"y{k}") for k in (1, 2, 3, 4)]).first()
            self.d3, self.d2 = _three(*[found[k] for k in range(4)]), _three(*[found[4 + k] + more[k] for k in range(4)])
            ends = self.counts.where(F.col("kind") == WORD).select("w", "n", "only")
            ends = ends.unionByName(self.hot.select("w", F.lit(1).cast("long").alias("n"), "only"))
            words = ends.groupBy("w").agg(F.sum("n").alias("n"), _only()).join(spell.select("w", "spell").hint("merge"), "w")
            words = scratch.stored(words, "words")
        d1 = _discounts(words)
        words = words.withColumn("d", _discount(d1))
        y = words.agg(F.sum("n").alias("total"), F.sum("d").alias("taken")).first()
        self.first = -float(np.log2(y["taken"] / y["total"]))
        below = -F.col("spell") - F.lit(self.first)
        log_p = F.log2((F.col("n") - F.col("d")) / F.lit(y["total"]) + F.pow(F.lit(2.0), below))
        self.words = words.select("w", "only", log_p.alias("log_p"), (log_p - below).alias("value"))
        self.end = self.words.where(F.col("w") == end).first()
        d2 = F.element_at(F.array(*map(F.lit, self.d2)), F.least("n", F.lit(3)).cast("int"))
        totals = self.hot.groupBy("v").agg(F.sum("n").alias("total"), F.log2(F.sum(d2) / F.sum("n")).alias("rest"))  # as many as hot words
        totals = totals.join(self.words.hint("merge"), F.col("v") == F.col("w")).select("v", "total", "rest", "only", (F.col("value") + F.col("rest")).alias("value"))
        self.facts = Facts(self.d2, self.d3, deal, totals.collect())

    def _home(self, r: int) -> DataFrame:
        """The hot words' pairs that a shard of range ``r`` is asked for."""
        deal = self.deal
        pairs = self.hot.mapInArrow(lambda b: _at_home(b, deal), "v long, w long, n long, only long, gram long, home int")
        return pairs.where(F.pmod(F.col("home"), F.lit(deal.ranges)) == r)

    def _tables(self, r: int) -> DataFrame:
        """What the shards of range ``r`` need of the words: log P of the ends, values of the shard's own words, and counts of
        the hot words' pairs, for those shards that have them and for the one that is asked for them."""
        mine = lambda c: F.pmod(F.col(c), F.lit(self.deal.ranges)) == r
        none = F.lit(None).cast("long")
        words = self.words.hint("merge")
        row = lambda kind, shard, v, n, only, x: [F.col(shard).alias("shard"), F.lit(kind).alias("kind"), v.alias("v"), F.col("w"), n.alias("n"), only.alias("only"), F.col(x).alias("x")]  # noqa: E731, E501
        ends = self.counts.where((F.col("kind") == WORD) & mine("shard")).select("shard", "w").join(words.select("w", "log_p"), "w")
        out = ends.select(*row(LOG_P, "shard", none, none, none, "log_p"))
        own = self.words.withColumn("shard", F.pmod(F.shiftrightunsigned("w", 16), F.lit(self.deal.shards)).cast("int"))
        out = out.unionByName(own.where(mine("shard")).select(*row(VALUE, "shard", none, none, F.col("only"), "value")))
        if len(self.deal.hot):
            log_p = words.select("w", "log_p")
            pairs = self.hot.join(log_p, "w")
            has = self.counts.where((F.col("kind") == HOT) & mine("shard")).select("shard", "v", "w")
            has = has.join(pairs.select("v", "w", "n", "only", "log_p").hint("merge"), ["v", "w"])
            for kind, x, shard in ((PAIR, has, "shard"), (HOME, self._home(r).join(log_p, "w"), "home")):
                out = out.unionByName(x.select(*row(kind, shard, F.col("v"), F.col("n"), F.col("only"), "log_p")))
        return out

    def gains(self, others: DataFrame, missed: DataFrame, skip) -> DataFrame:
        """key and gain of the trusted texts, of ``others`` (key, hid, text) without those whose id's bit is in ``skip``, and
        of ``missed`` (key, text), range by range. What only one trusted text has concerns the others alone."""
        sc, deal, facts, out = others.sparkSession.sparkContext, self.deal, self.facts, []
        for r in range(deal.ranges):
            held = np.zeros((1 << deal.slot_bits, (1 << self.bits) >> 3), np.uint8)
            found = self.counts.where((F.col("kind") == TABLE) & (F.pmod(F.col("shard"), F.lit(deal.ranges)) == r))
            for x in found.select("shard", "bits").collect():  # 2**FILTER_BITS bits at most
                held[x["shard"] // deal.ranges] = np.frombuffer(bytes(x["bits"]), np.uint8)
            held = sc.broadcast(C.BitSet(held.reshape(-1), deal.slot_bits + self.bits))
            pairs = sc.broadcast(C.set_bits(self._home(r), "gram", FILTER_BITS) if len(deal.hot) else None)
            blobs = self.texts.mapInArrow(lambda b, r=r: _trusted_words(b, deal, r), _BLOBS)
            blobs = blobs.unionByName(others.mapInArrow(lambda b, r=r, h=held, p=pairs: _asked(b, deal, r, h, p, skip), _BLOBS))
            blobs = blobs.unionByName(missed.mapInArrow(lambda b, r=r, h=held, p=pairs: _asked(b, deal, r, h, p), _BLOBS))
            with self.scratch.part(f"tables-{r}") as own:
                tables = own.stored(self._tables(r), "tables")
                found = blobs.groupBy("shard").cogroup(tables.groupBy("shard")).applyInArrow(lambda b, t: _shard_gains(b, t, deal, facts), "key long, gain double")
                out.append(self.scratch.stored(found.groupBy("key").agg(F.sum("gain").alias("gain")), f"gains-{r}"))
            for x in (held, pairs):
                x.destroy()
        return functools.reduce(DataFrame.unionByName, out).groupBy("key").agg(F.sum("gain").alias("gain"))


def _local(batches, spelling, first):
    """Per text: n_bytes, its bits without what the word n-grams give, and its bits as byte classes in their places."""
    for b in batches:
        for i, buf, off in C.doc_slices(b.column("text")):
            n, total, classes = np.diff(off), np.zeros(len(off) - 1), np.zeros(len(off) - 1)
            if spelling.value:
                table = spelling.value.table()
                in_place, at = table[grams(buf, off)].astype(np.float64), np.flatnonzero(n)
                if len(at):
                    classes[at] = np.add.reduceat(in_place, off[:-1][at])
                words = TextWords(buf, off)
                doc = np.repeat(np.arange(len(n)), np.diff(words.first))
                _, one, word = np.unique(words.hash, return_index=True, return_inverse=True)
                total += np.bincount(doc, (spelled(buf, words.start[one], words.end[one], table) + first)[word], len(n))
                total += np.where(n > 0, _white(buf, off, in_place) + table[1 << BITS | 1] + first, 0)
            keep = [b.column(c).slice(i, len(n)) for c in ("key", "doc_id", "lang")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(n), pa.array(total), pa.array(classes)],
                                             names=["key", "doc_id", "lang", "n_bytes", "bits", "class_bits"])


def _scored(rows: DataFrame, others: DataFrame, missed: DataFrame, held, spelling, words: Words | None) -> DataFrame:
    """key, doc_id, lang, n_bytes, bits and class_bits of the text of each of ``rows`` (key, doc_id, lang, text);
    ``others`` but for those whose id's bit is in ``held``, and ``missed``, are not trusted."""
    first = words.first if words else 0.0
    local = rows.mapInArrow(lambda b: _local(b, spelling, first), "key long, doc_id long, lang string, n_bytes long, bits double, class_bits double")
    if words is None:
        return local
    gains = words.gains(others, missed, held)
    local = words.scratch.stored(local, "spelling-bits")
    copies = local.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))  # equal rows share a key
    gains = gains.join(copies.hint("merge"), "key").select("key", (F.col("gain") / F.col("copies")).alias("gain"))
    end = F.when((F.col("n_bytes") > 0) & (F.col("key") != words.end["only"]), F.lit(words.end["value"])).otherwise(F.lit(0.0))
    return local.join(gains.hint("merge"), "key", "left").withColumn("bits", F.col("bits") - F.coalesce("gain", F.lit(0.0)) - end).drop("gain")


def _limits(scored: DataFrame, ids: DataFrame, quantile: float, margin: float, prior: float, least: int):
    """Of the words and of the byte classes: score columns, limits by language (lang, own, own_class) and limits of
    all; ``scored`` has doc_id, lang, n_bytes, bits, class_bits."""
    trusted = scored.where("n_bytes > 0").join(ids, "doc_id", "left_semi")
    kinds = {"own": "bits", "own_class": "class_bits"}
    means = trusted.agg(*[(F.sum(c) / F.sum("n_bytes")).alias(k) for k, c in kinds.items()]).first()
    score = {k: (F.col(c) + F.lit((means[k] or 0.0) * prior)) / (F.col("n_bytes") + F.lit(prior)) for k, c in kinds.items()}
    limits = [(F.percentile_approx(score[k], F.lit(quantile), F.lit(1000000)) + F.lit(margin)).alias(k) for k in kinds]
    own = (trusted.groupBy("lang").agg(*limits, F.count(F.lit(1)).alias("k"))
           .where((F.col("k") >= least) & F.col("lang").isNotNull()).drop("k"))
    every = trusted.agg(*limits).first()
    return score, C.stored(own, "language-limits"), {k: float("inf") if every[k] is None else every[k] for k in kinds}


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             quantile: float = QUANTILE, margin: float = MARGIN, prior: float = PRIOR,
             least_trusted: int = 1, keep_rest: bool = False) -> DataFrame:
    """Per document: doc_id, lang, n_bytes, perplexity (a byte), score and class_score with
    their limits and kept; with ``keep_rest`` also
    rest (a struct of all columns)."""
    ids = trusted_ids(labels)
    key = F.xxhash64(C.column(docs, doc_id, "long"), C.column(docs, text))
    rows = docs.select(key.alias("key"), C.column(docs, doc_id, "long").alias("doc_id"),
                       C.column(docs, lang, "string").alias("lang"), C.column(docs, text).alias("text"))
    sc = docs.sparkSession.sparkContext
    with C.Scratch(docs.sparkSession, "perplexity") as scratch:
        held = sc.broadcast(C.set_bits(ids.select(F.xxhash64("doc_id").alias("hid")), "hid", FILTER_BITS))
        filled = rows.where(F.octet_length("text") > 0).select("key", "doc_id", "text", F.xxhash64("doc_id").alias("hid"))
        maybe = filled.mapInArrow(lambda b: _with_bit(b, held), "key long, doc_id long, text string")
        trusted, missed = (scratch.stored(maybe.join(ids, "doc_id", how).select("key", "text"), how) for how in ("left_semi", "left_anti"))
        fitted = model(trusted.select("text"))
        spelling = sc.broadcast(fitted)
        size = filled.agg(F.sum(F.octet_length("text"))).first()[0]
        words = Words(trusted, size, spelling, scratch) if fitted else None
        scored = C.stored(_scored(rows, filled.select("key", "hid", "text"), missed, held, spelling, words), "text-bits")
    score, own, every = _limits(scored, ids, quantile, margin, prior, least_trusted)
    if keep_rest:
        whole = docs.select(key.alias("key"), F.struct(*[C.column(docs, c) for c in docs.columns]).alias("rest"))
        scored = whole.join(scored.dropDuplicates(["key"]).hint("merge"), "key")
    out = scored.join(own, "lang", "left")
    for k, name in (("own", "score"), ("own_class", "class_score")):
        out = out.withColumn(name, score[k]).withColumn(f"{name}_limit", F.coalesce(k, F.lit(every[k])))
    perplexity = F.when(F.col("n_bytes") > 0, F.pow(F.lit(2.0), F.col("bits") / F.col("n_bytes")))
    within = (F.col("score") <= F.col("score_limit")) & (F.col("class_score") <= F.col("class_score_limit"))
    return out.select("doc_id", "lang", "n_bytes", perplexity.alias("perplexity"), "score", "score_limit", "class_score",
                      "class_score_limit", ((F.col("n_bytes") == 0) | within).alias("kept"), *["rest"] * keep_rest)
