"""Quality rules: counts that fixed limits judge, and a hashed n-gram logistic regression.

Features are the words, the word pairs and the 4-byte grams of the whole text, each hashed into its
own 2**18 places; a document's value of a place is its share of the document's grams of that kind.
The model is fitted on labelled rows: at most ``PER_CLASS`` of each class, the first in the order of
their id's hash, three quarters for the weights, one for the calibration (Platt's two parameters,
classes weighted as in all labels). Texts are scored in Arrow batches; P(good) under ``KEEP`` rejects.

Cases: null and empty texts have no words and fail the limits; a label without a document, or without
id or class, is ignored; of repeated labels of one id each counts; without labels of both classes
there is no model and only the limits judge; empty tables give no rows; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import common as C

PLACES, PER_CLASS, KEEP, ROUNDS = 18, 2000, 0.5, 200
LEAST_WORDS, REPEAT_SHARE = 50, 50
SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])


def _inside(first: np.ndarray, n: int, k: int):
    """Grams of k neighbours that stay in their text: (places, text of each)."""
    p = np.arange(max(0, n - k + 1))
    d = np.searchsorted(first, p, side="right") - 1
    ok = p + k <= first[d + 1]
    return p[ok], d[ok]


def base_counts(buf: np.ndarray, off: np.ndarray, w: C.Words) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    n = len(off) - 1
    chars = _per_text(~C.ASCII_SPACE[buf] & _STARTS_CHAR[buf], off)
    raw, dup = buf.tobytes(), np.zeros(n, np.int64)
    for i, (a, z) in enumerate(zip(off.tolist(), off[1:].tolist(), strict=False)):
        lines = [x for x in raw[a:z].split(b"\n") if x and not x.isspace()]
        dup[i] = len(lines) - len(set(lines))
    p, d = _inside(w.first, len(w), 3)
    key = C.mix(C.kgrams(w.hash, 3)[p] ^ (d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    _, which, times = np.unique(key, return_inverse=True, return_counts=True)
    again = p[times[which] > 1] if len(p) else p
    cover = np.zeros(len(w), bool)
    for j in range(3):
        cover[again + j] = True
    return [np.diff(w.first), chars, _per_text(_IS_SYMBOL[buf], off), dup, _per_text(cover, w.first)]


def grams(buf: np.ndarray, off: np.ndarray, w: C.Words, places: int = PLACES):
    """(place, text) of each gram, for the three kinds of grams."""
    shift = np.uint64(64 - places)
    d1 = np.repeat(np.arange(len(off) - 1), np.diff(w.first))
    yield (w.hash >> shift).astype(np.int64), d1
    p, d = _inside(w.first, len(w), 2)
    yield (C.kgrams(w.hash, 2)[p] >> shift).astype(np.int64) + (1 << places), d
    p, d = _inside(off, len(buf), 4)
    code = sum(buf[j:len(buf) - 3 + j].astype(np.uint32) << np.uint32(8 * j) for j in range(4)) if len(buf) > 3 else buf
    code = (code[p].astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(32 - places)
    yield code.astype(np.int64) + (2 << places), d


def _mean(values: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """Mean of the values of each text (in text order), 0 where there are none; sums text by text."""
    out = np.zeros(n)
    if len(d):
        at = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        out[d[at]] = np.add.reduceat(values, at) / np.diff(np.concatenate([at, [len(d)]]))
    return out


class Model(C.Shipped):
    """Weights by place, bias, and the calibration (slope, shift)."""

    def __init__(self, weights, bias=0.0, slope=1.0, shift=0.0):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def logits(self, buf, off, w) -> np.ndarray:
        n = len(off) - 1
        return self.bias + sum(_mean(self.weights[i], d, n) for i, d in grams(buf, off, w))

    def good(self, buf, off, w) -> np.ndarray:
        """Calibrated P(good) of each text."""
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(buf, off, w) + self.shift, -60, 60)))


def _features(batches):
    for b in batches:
        for i, buf, off in C.doc_slices(b.column("text")):
            w, n = C.Words(buf, off, C.ASCII_SPACE, C.SAME), len(off) - 1
            idx, val = [[] for _ in range(n)], [[] for _ in range(n)]
            for place, d in grams(buf, off, w):
                cut = np.searchsorted(d, np.arange(n + 1))
                for k in range(n):
                    u, c = np.unique(place[cut[k]:cut[k + 1]], return_counts=True)
                    idx[k].append(u.astype("<i4"))
                    val[k].append((c / max(1, c.sum())).astype("<f4"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(i, n), b.column("y").slice(i, n),
                 pa.array([np.concatenate(x).tobytes() for x in idx], pa.binary()),
                 pa.array([np.concatenate(x).tobytes() for x in val], pa.binary())], names=["doc_id", "y", "idx", "val"])


def _descend(idx, val, row, y, weight, size, rounds, l2=1e-5, step=0.5):
    """Weighted logistic regression by Adam on all rows at once; deterministic."""
    w, b = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    for t in range(1, rounds + 1):
        z = b + np.add.reduceat(w[idx] * val, starts)
        g = weight * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y)
        gw = np.bincount(idx, val * g[row], size) + l2 * w
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        k = step * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w -= k * m / (np.sqrt(v) + 1e-8)
        b -= k * mb / (np.sqrt(vb) + 1e-8)
    return w, b


def _platt(z, y, weight):
    """Slope and shift of the calibrated log-odds, by Newton steps on smoothed targets."""
    a, c = 1.0, 0.0
    pos, neg = max(1.0, float((y == 1).sum())), max(1.0, float((y == 0).sum()))
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + c, -60, 60)))
        r, s = weight * (p - target), weight * p * (1 - p) + 1e-9
        h = np.array([[np.sum(s * z * z) + 1e-6, np.sum(s * z)], [np.sum(s * z), np.sum(s) + 1e-6]])
        da, dc = np.linalg.solve(h, [np.sum(r * z), np.sum(r)])
        a, c = a - np.clip(da, -2, 2), c - np.clip(dc, -2, 2)
    return max(a, 1e-3), c


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        per_class: int = PER_CLASS, rounds: int = ROUNDS) -> Model | None:
    """The model of a bounded sample of labelled rows; None without labels of both classes."""
    lab = labels.select(C.column(labels, "doc_id", "long").alias("doc_id"), C.column(labels, label, "int").alias("y"))
    lab = lab.where("doc_id is not null and y in (0, 1)")
    share = {r["y"]: r["count"] for r in lab.groupBy("y").count().collect()}
    if len(share) < 2:
        return None
    pick = [lab.where(F.col("y") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    texts = docs.select(C.column(docs, doc_id, "long").alias("doc_id"), C.column(docs, text).alias("text"))
    # at most 2 * per_class ids and labels
    rows = (texts.join(F.broadcast(pick[0].unionAll(pick[1])), "doc_id").select("doc_id", "y", "text")
            .mapInArrow(_features, "doc_id long, y int, idx binary, val binary")
            .withColumn("at", F.xxhash64("doc_id", F.lit(7))).collect())
    rows = sorted(rows, key=lambda r: (r["at"], r["doc_id"], r["y"], bytes(r["val"])))
    rows = [r for r in rows if len(r["idx"])]
    train = [r for i, r in enumerate(rows) if i % 4]
    held = rows[::4]
    if len({r["y"] for r in train}) < 2:
        return None
    y = np.array([r["y"] for r in train], float)
    idx = np.concatenate([np.frombuffer(r["idx"], "<i4") for r in train])
    val = np.concatenate([np.frombuffer(r["val"], "<f4") for r in train]).astype(float)
    row = np.repeat(np.arange(len(train)), [len(r["idx"]) // 4 for r in train])
    balance = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w, b = _descend(idx, val, row, y, balance, 3 << PLACES, rounds)
    z = np.array([b + float(np.frombuffer(r["val"], "<f4") @ w[np.frombuffer(r["idx"], "<i4")]) for r in held])
    yh = np.array([r["y"] for r in held])
    n = {k: max(1, int((yh == k).sum())) for k in (0, 1)}
    slope, shift = _platt(z, yh, np.where(yh == 1, share[1] / n[1], share[0] / n[0]) / sum(share.values()) * len(yh))
    return Model(w.astype(np.float32), b, slope, shift)


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text", keep: float = KEEP) -> DataFrame:
    """Per document: doc_id, the base counts, base_failed, p_good and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            for i, buf, off in C.doc_slices(b.column(1)):
                w, n = C.Words(buf, off, C.ASCII_SPACE, C.SAME), len(off) - 1
                words, chars, symbols, dup, again = base_counts(buf, off, w)
                failed = (words < LEAST_WORDS) | (100 * again > REPEAT_SHARE * words)
                p = shared.value.good(buf, off, w) if shared.value else np.ones(n)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, n), *(pa.array(x.astype(np.int64)) for x in (words, chars, symbols, dup, again)),
                     pa.array(failed), pa.array(p), pa.array(~failed & (p >= keep))],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                           "p_good", "kept"])

    return docs.select(C.column(docs, doc_id, "long").alias("d"), C.column(docs, text).alias("t")).mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, p_good double, kept boolean")
