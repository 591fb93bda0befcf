"""Benchmark decontamination: prefix-filtered set join of item windows with documents.

A window of an item is a set of word shingles. All of them must occur in a document that holds the
window, so one token of each window, the rarest over the documents, is prefix enough. The windows'
rarest shingles join the documents' shingles; candidates that would run over a document's start or
end are dropped, the rest is compared word by word.

1. One pass over the texts keeps, for each document, its length and the places of shingles that the
   benchmark has (a bit table of fixed size filters; false passes only cost time).
2. Shingle counts over all documents order each window's shingles; a window with a shingle that
   never occurs is dropped.
3. Join on the rarest shingle, positional and length bounds, exact comparison in the document.

Cases: null or wordless texts have no words and are never contaminated; an item without words has
no windows; an item without id marks words but is not listed; a repeated item is one item; repeated
documents are judged one by one; empty tables give empty or clean results; only the named columns
are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import common as C

WINDOW, SHINGLE, BITS = 13, 5, 24

_KEEP = bytes(b | 0x20 if 0x41 <= b <= 0x5A else 0x20 if C.NOT_WORD_10[b] else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of letters, digits and non-ASCII characters."""
    return (text or "").encode().translate(_KEEP).split()


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
                 shingle: int = SHINGLE) -> DataFrame:
    """(item_id, words, n, tokens) for each window: its words with spaces, their number, its shingles' hashes."""

    def run(batches):
        for b in batches:
            ids, ws, ns, ts = [], [], [], []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = words_of(text)
                if not w:
                    continue
                n = min(window, len(w))
                k = min(shingle, n)
                buf = np.frombuffer(b" ".join(w), np.uint8)
                h = C.Words(buf, np.array([0, len(buf)]), C.NOT_WORD_10, C.LOWER).hash
                g = C.kgrams(h, k).view(np.int64)
                for s in range(len(w) - n + 1):
                    ids.append(item)
                    ws.append(b" ".join(w[s:s + n]).decode())
                    ns.append(n)
                    ts.append(g[s:s + n - k + 1].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(ws, pa.string()),
                                              pa.array(ns, pa.int32()), pa.array(ts, pa.list_(pa.int64()))],
                                             names=["item_id", "words", "n", "tokens"])

    return (items.select(C.column(items, id_col, "string").alias("i"), C.column(items, text_col).alias("t"))
            .mapInArrow(run, "item_id string, words string, n int, tokens array<long>"))


def _shingle_hits(docs: DataFrame, table: C.BitSet, ks: list[int]) -> DataFrame:
    def run(batches):
        base, seen = TaskContext.get().partitionId() << 33, 0
        for b in batches:
            ids = b.column(0)
            text = pa.array([], pa.string()) if not len(ids) else b.column(1)
            for i, buf, off in C.doc_slices(text):
                w = C.Words(buf, off, C.NOT_WORD_10, C.LOWER)
                n = len(off) - 1
                at, key = [], []
                for k in ks:
                    g = C.kgrams(w.hash, k)
                    p = np.flatnonzero(table.has(g))
                    d = np.searchsorted(w.first, p, side="right") - 1
                    ok = p + k <= w.first[d + 1]
                    at.append(p[ok])
                    key.append(g[p[ok]].view(np.int64))
                at, key = np.concatenate(at), np.concatenate(key)
                order = np.argsort(at, kind="stable")
                at, key = at[order], key[order]
                doc = np.searchsorted(w.first, at, side="right") - 1
                cut = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
                hits = pa.ListArray.from_arrays(
                    pa.array(cut), pa.StructArray.from_arrays([pa.array((at - w.first[doc]).astype(np.int32)),
                                                               pa.array(key)], names=["pos", "h"]))
                at_text = pa.array(i + np.arange(n), mask=np.diff(cut) == 0)  # null where there is no hit
                yield pa.RecordBatch.from_arrays(
                    [pa.array(base + seen + np.arange(n)), ids.slice(i, n), pa.array(np.diff(w.first).astype(np.int64)),
                     hits, text.take(at_text).cast(pa.string())],
                    names=["row", "doc_id", "n_words", "hits", "text"])
                seen += n

    return docs.mapInArrow(run, "row long, doc_id long, n_words long, hits array<struct<pos:int,h:long>>, text string")


def _verify(batches):
    """Marks each candidate window whose words stand in the document at its place."""
    for b in (x for b in batches for x in C.row_slices(b)):
        rows, marks, found = [], [], []
        for row, text, cand in zip(b.column("row").to_pylist(), b.column("text").to_pylist(),
                                   b.column("cand").to_pylist(), strict=True):
            w = words_of(text)
            hit, got = np.zeros(len(w) + 1, np.int64), set()
            for c in cand:
                s, e = c["start"], c["start"] + c["n"]
                if b" ".join(w[s:e]).decode() == c["words"]:
                    hit[s] += 1
                    hit[e] -= 1
                    got.add(c["words"])
            if got:
                rows.append(row)
                marks.append(int((np.cumsum(hit) > 0).sum()))
                found.append(list(got))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(marks, pa.int64()),
                                          pa.array(found, pa.list_(pa.string()))], names=["row", "n_hit", "found"])


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
                  bits: int = BITS, share: int = 20) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (see the module's text).

    A document is contaminated when at least one word in ``share`` is part of an item's window.
    """
    win = C.stored(item_windows(items, item_id, item_text, window, shingle), "item-windows")
    tokens = win.select(F.explode("tokens").alias("h"))
    ks = sorted({min(shingle, r["n"]) for r in win.select("n").distinct().collect()})  # at most 13 lengths
    table = C.set_bits(tokens, "h", bits)
    flat = docs.select(C.column(docs, doc_id, "long").alias("d"), C.column(docs, text).alias("t"))
    sig = C.stored(_shingle_hits(flat, table, ks or [shingle]), "shingle-hits")

    hits = sig.select("row", "n_words", F.explode("hits").alias("x")).select("row", "n_words", "x.pos", "x.h")
    counts = hits.groupBy("h").agg(F.count(F.lit(1)).alias("freq"))
    rare = (win.select("words", "n", F.posexplode("tokens").alias("j", "h")).distinct().join(counts, "h", "left")
            .groupBy("words", "n").agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "j", "h")).alias("r"))
            .where("r.freq > 0").select("words", "n", F.col("r.j").alias("j"), F.col("r.h").alias("h")))
    cand = (hits.join(rare, "h").withColumn("start", F.col("pos") - F.col("j"))
            .where("start >= 0 and start + n <= n_words")
            .groupBy("row").agg(F.collect_list(F.struct("start", "n", "words")).alias("cand")))  # one document's own
    found = C.stored(sig.where("text is not null").select("row", "text").join(cand, "row").select("row", "text", "cand")
                     .mapInArrow(_verify, "row long, n_hit long, found array<string>"), "windows-found")
    listed = (found.select("row", F.explode("found").alias("words"))
              .join(win.where("item_id is not null").select("words", "item_id").distinct(), "words")
              .groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    out = sig.select("row", "doc_id", "n_words").join(found.select("row", "n_hit"), "row", "left").join(listed, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_).cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", items_), 256).alias("items_sha256"),
                      ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))
