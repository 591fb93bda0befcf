"""Best-fit packing by exact complements.

Only lengths decide where a piece goes, and there are at most ``size`` of them. So the pieces are
counted by length (one aggregate), the counts are packed, and the plan is dealt back to the pieces:

1. Exact complements: a length's gap is looked up among single lengths, sums of pairs and sums of
   triples that are still available; a combination that fills the gap is used as often as the counts
   allow, longest lengths first.
2. Best fit: what is left goes, in decreasing length, to the fullest open sequence that takes it.
3. Pieces are numbered in one order of (length, id, piece); a plan entry owns a range of numbers, so
   each piece finds its sequence and offset by a lookup of its number.

The plan's size follows the number of lengths, not of pieces: each step uses up a length's count or
a group of alike open sequences. No length is held in one task, however many pieces have it.

Cases: null and empty texts are one end id; equal rows are packed one by one; empty tables give no
rows; only the named columns are read; rows without id keep a null id.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import common as C
from lakemart.llm.tokens import ROWS, encoder
from lakemart.operators.keys import dense_ids

SIZE, END = 4096, 1


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
           end: int = END, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each text's ids and the end id, cut every ``size`` ids."""
    tail = np.array([end], "<u4").tobytes()

    def run(batches):
        enc = encoder(tokenizer)
        for b in batches:
            for part in C.row_slices(b, ROWS):
                out = []
                for i, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist()), strict=True):
                    ids += tail
                    for k, s in enumerate(range(0, len(ids), 4 * size)):
                        x = ids[s:s + 4 * size]
                        out.append((i, k, s // 4, len(x) // 4, zlib.crc32(x), x if keep_ids else None))
                cols = list(zip(*out, strict=True)) or [()] * 6
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)][:6 if keep_ids else 5],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:6 if keep_ids else 5])

    return docs.select(C.column(docs, doc_id, "long").alias("d"), C.column(docs, text).alias("t")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else ""))


def _take(counts: np.ndarray, combo: tuple[int, ...]) -> int:
    """Use a combination of lengths as often as the counts allow."""
    own = {x: combo.count(x) for x in combo}
    n = min(int(counts[x]) // m for x, m in own.items())
    for x, m in own.items():
        counts[x] -= n * m
    return n


def _pair(counts: np.ndarray, gap: int, most: int):
    """Pairs of available lengths, none over ``most``, that sum to ``gap``; longest first."""
    lo, hi = (gap + 1) // 2, min(most, gap - 1)
    if hi < lo:
        return
    b = np.arange(hi, lo - 1, -1)
    for x in b[(counts[b] > 0) & (counts[gap - b] > 0)].tolist():
        yield x, gap - x


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences), for all pieces counted by length.

    Few pieces may do better with more left to the best fit: complements of up to three, two, one and
    no pieces are tried until no packing could have fewer sequences, and the best is taken.
    """
    best = None
    for most in (3, 2, 1, 0):
        made = _plan(counts, size, most)
        if best is None or sum(n for _, n in made) < sum(n for _, n in best):
            best = made
        if sum(n for _, n in best) == fewest(counts, size):
            break
    return best


def _plan(counts, size, most):
    """``plan`` with exact complements of at most ``most`` pieces."""
    left = np.zeros(size + 1, np.int64)
    for n, c in counts.items():
        left[n] += c
    out = []

    def use(combo):
        n = _take(left, combo)
        if n:
            out.append((combo, n))

    use((size,))
    for a in range(size - 1, size // 2 - 1, -1) if most > 0 else ():  # one length fills the gap
        if left[a]:
            use((a, size - a))
    for a in range(size - 2, size // 3 - 1, -1) if most > 1 else ():  # two do
        if left[a]:
            for pair in _pair(left, size - a, a):
                use((a, *pair))
                if not left[a]:
                    break
    for a in range(size - 3, size // 4 - 1, -1) if most > 2 else ():  # three do; sums of available pairs are indexed as bits
        if not left[a]:
            continue
        have = [int(x) for x in np.flatnonzero(left)]
        bits = sum(1 << x for x in have)
        sums = 0
        for x in have:
            sums |= bits << x
        for b in reversed([x for x in have if x <= min(a, size - a - 2)]):
            if not left[a]:
                break
            if left[b] and sums >> (size - a - b) & 1:
                for pair in _pair(left, size - a - b, b):
                    use((a, b, *pair))
                    if not left[a] or not left[b]:
                        break
    groups: dict[int, list] = {}  # free places -> [[lengths, number of sequences]]
    spaces: list[int] = []

    def put(free, combo, n):
        if not free:
            out.append((combo, n))
            return
        if free not in groups:
            bisect.insort(spaces, free)
            groups[free] = []
        groups[free].append([combo, n])

    for a in range(size, 0, -1):
        while left[a]:
            k = bisect.bisect_left(spaces, a)
            if k == len(spaces):
                free, combo, n = size, (), 1 << 62
            else:
                free = spaces[k]
                combo, n = groups[free].pop()
                if not groups[free]:
                    del groups[free], spaces[k]
            per = free // a
            full = min(n, int(left[a]) // per)
            if full:
                left[a] -= full * per
                put(free - per * a, combo + (a,) * per, full)
            elif left[a]:
                rest = int(left[a])
                left[a], full = 0, 1
                put(free - rest * a, combo + (a,) * rest, 1)
            if combo and n > full:
                put(free, combo, n - full)
    out.extend((combo, n) for g in groups.values() for combo, n in g)
    return out


def _ranges(counts: dict[int, int], made) -> np.ndarray:
    """Rows (first number, first sequence, offset) of the plan, by first number, in the order of lengths."""
    at, next_ = {}, 0
    for n in sorted(counts):
        at[n] = next_
        next_ += counts[n]
    rows, seq = [], 0
    for combo, n in made:
        off = 0
        for x in combo:
            rows.append((at[x], seq, off))
            at[x] += n
            off += x
        seq += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """``cut`` (from ``pieces``) with sequence_id and offset; offsets of a sequence have no gaps."""
    spark = cut.sparkSession
    cut = C.stored(cut, "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``size`` rows
    ranges = spark.sparkContext.broadcast(_ranges(counts, plan(counts, size)))
    numbered = dense_ids(cut, ["length", "doc_id", "piece", "ids_crc32"], "number", 0)

    kinds = ", ".join(f"`{n}` {t}" for n, t in cut.dtypes)
    return numbered.mapInArrow(_placer(ranges, cut.columns), f"{kinds}, sequence_id long, offset long")


def _placer(ranges, names):
    def place(batches):
        r = ranges.value
        for b in batches:
            n = b.column("number").to_numpy()
            k = np.searchsorted(r[:, 0], n, side="right") - 1
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(r[k, 1] + n - r[k, 0]),
                                              pa.array(r[k, 2])], names=[*names, "sequence_id", "offset"])

    return place


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the joined ids of each sequence, for pieces cut with ``keep_ids``."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``size`` pieces
    empty = F.lit(b"").cast("binary")
    return packed.groupBy("sequence_id").agg(
        F.aggregate(ordered, empty, lambda acc, x: F.concat(acc, x["ids"])).alias("ids"))


def fewest(counts: dict[int, int], size: int = SIZE) -> int:
    """No packing has fewer sequences than this."""
    return max(-(-sum(n * c for n, c in counts.items()) // size), sum(c for n, c in counts.items() if 2 * n > size))
