"""Substring dedup: seed and extend over winnowed anchors.

Of each 13-word window the word 5-gram with the least hash is an anchor (winnowing), so two texts
that share a window share an anchor at the same place in it. Work follows the repeats, not the pairs:

1. Seeds: anchors that stand in two documents at least (one aggregate of the anchors; a bit table of
   fixed size then picks their places in a second pass, false passes only cost time).
   Texts equal to a smaller document's are set aside first: all their windows are repeats.
2. Extension both ways, whole: an anchor with its reach (8 words on either side, all windows through
   it) is compared by its hash. If a smaller document has the same reach, every window in it is a repeat.
3. Extension, part by part: where the reaches of one anchor differ (ends of a repeat, chance seeds),
   the first document of each reach gives its windows one by one; a window is a repeat if a smaller
   document gives it too.
4. The repeats of a document are united to maximal spans; their words are removed.

No step holds a group of equal anchors together: groups are reduced to their least document by
aggregates and joined back, so a passage in a third of all documents is one row per task.
Whether texts, reaches or windows are equal is judged on a 64-bit hash and 32 bits of another one (of a text its
CRC-32); anchors, which only find places, on a 64-bit hash.

Cases: null and wordless texts keep nothing and lose nothing; texts under 13 words have no window;
equal ids are not smaller than each other, so rows of one id do not thin each other; rows without id
come after all others; equal rows (id and text) get equal results; empty tables give no rows; only
the named columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import common as C

WINDOW, ANCHOR, BITS = 13, 5, 27
NO_ID = (1 << 63) - 1


def _anchors(w: C.Words, window: int, k: int):
    """(places of anchors, hash of each, document of each) over the words of a run of texts."""
    g = C.kgrams(w.hash, k)
    n = len(w) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = C.window_min(g, window - k + 1)[:n]
    doc = np.searchsorted(w.first, np.arange(n), side="right") - 1
    inside = np.arange(n) + window <= w.first[doc + 1]
    keep = np.zeros(len(g), bool)
    keep[at[inside]] = True
    at = np.flatnonzero(keep)
    return at, g[at], np.searchsorted(w.first, at, side="right") - 1


def _second(h: np.ndarray) -> np.ndarray:
    """Other hashes of the same words, to judge equality by."""
    return C.mix(h ^ np.uint64(0xC3A5C85C97CB3127))


def _more(h: np.ndarray) -> np.ndarray:
    """32 bits of a hash."""
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _reach(w: C.Words, at, doc, window: int, k: int):
    """Hash of each anchor's reach, which takes in how many words it has on either side."""
    side = window - k
    lo, hi = w.first[doc], w.first[doc + 1]
    out = np.minimum(at - lo, side).astype(np.uint64) * np.uint64(64) + np.minimum(hi - at, window).astype(np.uint64)
    for j in range(-side, window):
        p = at + j
        ok = (p >= lo) & (p < hi)
        out += np.where(ok, w.hash[np.minimum(np.maximum(p, 0), len(w) - 1)], np.uint64(0)) * C._GRAM[j + side]
        out ^= out >> np.uint64(31)
    return C.mix(out)


class _Other:
    """Words under their second hashes."""

    def __init__(self, w: C.Words):
        self.hash, self.first = _second(w.hash), w.first

    def __len__(self):
        return len(self.hash)


def _key(reach, doc):
    """One 64-bit key of a reach in a document."""
    return C.mix((reach * np.uint64(0x9E3779B97F4A7C15)) ^ (doc.astype(np.uint64) << np.uint64(1)))


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc, text, doc_id and rest (all columns but the text), with t32 (32 bits of the text's hash), row (of id and
    t32) and copy (of id and text), and the text's two hashes th and tc."""
    t = C.column(docs, text)
    out = docs.select(F.coalesce(C.column(docs, doc_id, "long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(t).alias("th"),
                      F.crc32(F.encode(F.coalesce(t, F.lit("")), "UTF-8")).alias("tc"),
                      t.alias("text"), C.column(docs, doc_id, "long").alias("doc_id"),
                      F.struct(*[C.column(docs, c) for c in docs.columns if c != text]).alias("rest"))
    return out.select("*", F.shiftright("th", 32).cast("int").alias("t32"), F.xxhash64("th", "tc", "doc").alias("copy")) \
        .withColumn("row", F.xxhash64("doc", "t32"))


def _slices(b, firsts):
    """Words, doc and t32 of runs of texts; texts that are surely not the first of equal ones have no words."""
    for p in C.row_slices(b, 1024):
        first = firsts.has(p.column("copy").to_numpy().view(np.uint64))
        text = p.column("text").take(pa.array(np.arange(p.num_rows), mask=~first))
        for i, buf, off in C.doc_slices(text):
            w = C.Words(buf, off, C.ASCII_SPACE, C.SAME)
            n = len(off) - 1
            yield w, p.column("doc").slice(i, n).to_numpy(), p.column("t32").slice(i, n).to_numpy().astype(np.int64)


def _batch(names, *arrays):
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=names)


def _spot(t32, start, size):
    """t32, start and length (under 32) of a span in one number."""
    return (t32 << 32) | (start.astype(np.int64) * 32 + size)


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR,
            bits: int = BITS) -> tuple[DataFrame, Broadcast]:
    """(doc, t32, spans) of the words in windows that also start in a smaller document, and the bit table of first copies.

    A span is start * 32 + length; spans are neither united nor in order, see ``unite``. Texts that are
    equal to a smaller document's are left out: their bit is not set, and all their windows are repeats.
    """
    with C.Scratch(docs.sparkSession, "repeats") as scratch:
        spans, firsts = _repeats(docs, doc_id, text, window, anchor, bits, scratch)
        return C.stored(spans, "repeat-spans"), firsts


def _repeats(docs, doc_id, text, window, anchor, bits, scratch: C.Scratch):
    """Spans that read tables of ``scratch``. Words are hashed in three passes over the texts: for seeds, for the seeds'
    places (kept for both aggregate and join) and for windows (also kept)."""
    sc = docs.sparkSession.sparkContext
    src = _texts(docs, doc_id, text)
    side = window - anchor
    equal = src.groupBy("th", "tc").agg(F.min("doc").alias("doc")).select(F.xxhash64("th", "tc", "doc").alias("copy"))
    firsts = sc.broadcast(C.set_bits(equal, "copy", bits))
    src = src.select("doc", "t32", "copy", "text")

    def seeds(batches):
        for b in batches:
            for w, ids, _ in _slices(b, firsts.value):
                _, h, d = _anchors(w, window, anchor)
                yield _batch(["doc", "h"], ids[d], h.view(np.int64))

    found = (src.mapInArrow(seeds, "doc long, h long")
             .groupBy("h").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi"))
    table = sc.broadcast(C.set_bits(found, "h", bits))

    def anchors(w):
        """Anchors of texts that stand in the table of seeds."""
        at, h, d = _anchors(w, window, anchor)
        ok = table.value.has(h)
        return at[ok], h[ok], d[ok]

    def places(batches):
        for b in batches:
            for w, ids, t32 in _slices(b, firsts.value):
                at, h, d = anchors(w)
                r, more = _reach(w, at, d, window, anchor), _more(_reach(_Other(w), at, d, window, anchor))
                s, e = np.maximum(at - side, w.first[d]), np.minimum(at + window, w.first[d + 1])
                yield _batch(["doc", "reach", "more", "h", "spot"], ids[d], r.view(np.int64), more, h.view(np.int64),
                             _spot(t32[d], s - w.first[d], e - s))

    placed = scratch.stored(src.mapInArrow(places, "doc long, reach long, more int, h long, spot long"), "places")
    least = scratch.stored(placed.groupBy("reach", "more").agg(F.min("doc").alias("lo"), F.min("h").alias("h")), "least-of-reach")
    whole = (placed.select("doc", "reach", "more", "spot").join(least.select("reach", "more", "lo"), ["reach", "more"])
             .where("lo < doc").select("doc", "spot"))

    mixed = least.groupBy("h").agg(F.min("lo").alias("a"), F.max("lo").alias("b")).where("a < b").select("h")
    mixed_table = sc.broadcast(C.set_bits(mixed, "h", bits))

    def part_keys(batches):
        for b in batches:
            h, r, lo = (b.column(c).to_numpy().view(np.uint64) for c in ("h", "reach", "lo"))
            ok = mixed_table.value.has(h)
            yield _batch(["k"], _key(r[ok], lo[ok]).view(np.int64))

    parts = sc.broadcast(C.set_bits(least.mapInArrow(part_keys, "k long"), "k", bits))

    def windows(batches):
        for b in batches:
            for w, ids, t32 in _slices(b, firsts.value):
                at, _, d = anchors(w)
                ids, t32 = ids[d], t32[d]
                ok = parts.value.has(_key(_reach(w, at, d, window, anchor), ids))
                at, d, ids, t32 = at[ok], d[ok], ids[ok], t32[ok]
                s = (at[:, None] - np.arange(side + 1)[None, :]).ravel()
                k = np.repeat(np.arange(len(at)), side + 1)
                ok = (s >= w.first[d[k]]) & (s + window <= w.first[d[k] + 1])
                s, first = np.unique(s[ok], return_index=True)
                k = k[ok][first]
                x, y = (C.kgrams(h, window)[s] if len(s) else np.zeros(0, np.uint64) for h in (w.hash, _second(w.hash)))
                size = np.full(len(s), window)
                yield _batch(["doc", "x", "y", "spot"], ids[k], x.view(np.int64), _more(y), _spot(t32[k], s - w.first[d[k]], size))

    cut = scratch.stored(src.mapInArrow(windows, "doc long, x long, y int, spot long"), "windows")
    shared = (cut.select("doc", "x", "y").groupBy("x", "y").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
              .where("lo < hi").select("x", "y", "lo"))
    partly = cut.join(shared, ["x", "y"]).where("lo < doc").select("doc", "spot")
    spans = (whole.unionAll(partly).groupBy("doc", F.shiftright("spot", 32).cast("int").alias("t32"))
             .agg(F.collect_list(F.col("spot").bitwiseAND(F.lit(0xFFFFFFFF))).alias("spans")))  # one document's own
    return spans, firsts


def unite(spans) -> np.ndarray:
    """Maximal spans, in order, of spans (start * 32 + length) that overlap or touch; rows [start, end)."""
    x = np.array(spans if spans is not None else (), dtype=np.int64)
    if not len(x):
        return np.zeros((0, 2), np.int64)
    a = np.stack([x >> 5, (x >> 5) + (x & 31)], axis=1)
    a = a[np.argsort(a[:, 0], kind="stable")]
    reach = np.maximum.accumulate(a[:, 1])
    new = np.flatnonzero(np.concatenate([[True], a[1:, 0] > reach[:-1]]))
    return np.stack([a[new, 0], reach[np.concatenate([new[1:] - 1, [len(a) - 1]])]], axis=1)


_OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _kept_rows(rows):
    """Result rows from (doc_id, text bytes, maximal spans)."""
    out = []
    for i, text, u in rows:
        w = text.split()
        kept = [w] if not len(u) else [w[a:z] for a, z in zip([0, *u[:, 1]], [*u[:, 0], len(w)], strict=True)]
        body = b" ".join(x for run in kept for x in run)
        out.append((i, len(w), int((u[:, 1] - u[:, 0]).sum()), hashlib.sha256(body).hexdigest(), body.decode()))
    cols = list(zip(*out, strict=True)) or [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                      names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR,
          bits: int = BITS, keep_rest: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and kept (the words left, one space between them); with
    ``keep_rest`` also text (as it was) and rest (a struct of the other columns).

    Copies, and documents that surely have no span, are finished where they are read; only the
    others' texts, compressed, meet their spans in a join.
    """
    spans, firsts = repeats(docs, doc_id, text, window, anchor, bits)
    touched = docs.sparkSession.sparkContext.broadcast(C.set_bits(spans.select(F.xxhash64("doc", "t32").alias("row")), "row", bits))
    src = _texts(docs, doc_id, text)
    extra = ["text", "rest"] if keep_rest else []
    rest = f", text string, rest {src.schema['rest'].dataType.simpleString()}" if keep_rest else ""
    src = src.select("doc", "t32", "doc_id", "copy", "row", "text", *extra[1:])

    def add(made, b):
        return pa.RecordBatch.from_arrays([*made.columns, *(b.column(c) for c in extra)], names=[*made.schema.names, *extra])

    def split(b):
        first = firsts.value.has(b.column("copy").to_numpy().view(np.uint64))
        return first, first & touched.value.has(b.column("row").to_numpy().view(np.uint64))

    def here(batches):
        none = np.zeros((0, 2), np.int64)
        for b in (x for b in batches for x in C.row_slices(b)):
            first, later = split(b)
            p = b.take(pa.array(np.flatnonzero(~later)))
            rows = []
            for i, text, f in zip(p.column("doc_id").to_pylist(), p.column("text").to_pylist(), first[~later], strict=True):
                text = (text or "").encode()
                n = 0 if f else len(text.split())
                rows.append((i, text, none if n < window else np.array([[0, n]])))
            yield add(_kept_rows(rows), p)

    def packed(batches):
        for b in (x for b in batches for x in C.row_slices(b)):
            p = b.take(pa.array(np.flatnonzero(split(b)[1])))
            raw = [(t or "").encode() for t in p.column("text").to_pylist()]
            z, size = [pa.compress(t, "zstd", asbytes=True) for t in raw], [len(t) for t in raw]
            yield pa.RecordBatch.from_arrays(
                [p.column("doc"), p.column("t32"), p.column("doc_id"), pa.array(z, pa.binary()), pa.array(size, pa.int64()),
                 *(p.column(c) for c in extra[1:])], names=["doc", "t32", "doc_id", "z", "size", *extra[1:]])

    def joined(batches):
        for b in (x for b in batches for x in C.row_slices(b)):
            cols = (b.column(c).to_pylist() for c in ("doc_id", "z", "size", "spans"))
            rows = [(i, pa.decompress(z, n, "zstd", asbytes=True) if n else b"", unite(s))
                    for i, z, n, s in zip(*cols, strict=True)]
            made = _kept_rows(rows)
            if extra:
                made = pa.RecordBatch.from_arrays(
                    [*made.columns, pa.array([x.decode() for _, x, _ in rows], pa.string()), b.column("rest")],
                    names=[*made.schema.names, *extra])
            yield made

    sent = "doc long, t32 int, doc_id long, z binary, size long" + rest.removeprefix(", text string")
    moved = src.mapInArrow(packed, sent).join(spans, ["doc", "t32"], "left")
    return src.mapInArrow(here, _OUT + rest).unionAll(
        moved.select("doc_id", "z", "size", "spans", *extra[1:]).mapInArrow(joined, _OUT + rest))
