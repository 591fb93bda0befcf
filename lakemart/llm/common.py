"""Helpers shared by the operators: tables, scratch, words and hashes over Arrow batches."""

from __future__ import annotations

import functools
import operator
import sys
import types
import uuid
import zlib

import numpy as np
import pyarrow as pa

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["read_table", "scratch_path", "stored", "Scratch", "worker_state", "ASCII_SPACE", "NOT_WORD_10", "Words",
           "doc_slices", "row_slices", "mix", "kgrams", "window_min", "BitSet", "set_bits", "bit_position", "column"]


# Functions of this module are shipped to tasks by value, and with them what it names; the session helpers
# are therefore looked up when they are called, on the driver.

def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    """A table of the inputs."""
    from lakemart.session import read_table as read

    return read(spark, sf_dir, name)


def scratch_path(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    from lakemart.session import scratch_path as path

    return path(spark, name)


def column(df: DataFrame, name: str, kind: str | None = None):
    """One column by its own name, resolved on ``df`` itself (extra columns cannot clash)."""
    c = df[f"`{name}`"]
    return c.cast(kind) if kind else c


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: a fixed table, short lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one step under the shared scratch folder, deleted at its end; meanwhile Spark deletes the shuffle files of
    each query when the query ends, not when the driver has collected its garbage."""

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark, name: str, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, name)

    def __enter__(self):
        self.before = self.spark.conf.get(self.CLEANUP, "false")
        self.spark.conf.set(self.CLEANUP, "true")
        return self

    def __exit__(self, *_):
        self.spark.conf.set(self.CLEANUP, self.before)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def part(self, name: str) -> Scratch:
        """Scratch of a part of the step."""
        return Scratch(self.spark, name, f"{self.path}/{name}")

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once and read back, as long as the step lasts."""
        df.write.option("compression", "zstd").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")


def worker_state(kind: str) -> dict:
    """A dict that lives on in the Python worker, for loaded models and caches of one kind of work.

    What another kind of work has left there is dropped, so stages do not add up in a worker's memory."""
    held = sys.modules.setdefault("_lakemart_worker_state", types.ModuleType("_lakemart_worker_state")).__dict__
    if held.get("kind") != kind:
        held["kind"], held["state"] = kind, {}
    return held["state"]


def _table(keep) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[[b for b in range(256) if not keep(b)]] = True
    return t


#: True for bytes that separate words. Bytes of multi-byte characters are always part of words.
ASCII_SPACE = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
NOT_WORD_10 = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A or b >= 0x80)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
SAME = np.arange(256, dtype=np.uint8)

_RNG = np.random.default_rng(20260117)
_MULT = _RNG.integers(0, 2**63, size=1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GRAM = _RNG.integers(0, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 1 << 17


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes in place (an invertible mixer)."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    return h


class Words:
    """Words of consecutive texts: 64-bit hash, byte start and end of each word, word range of each text.

    The hash is a sum of (byte + 1) times an odd multiplier of its place, mixed at the end, so it
    depends on the word alone. Texts are read in blocks, so scratch memory does not follow a text's length.
    """

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, sep: np.ndarray, fold: np.ndarray):
        hs, ss, es, lo = [], [], [], 0
        total = len(buf)
        cuts = offsets[1:-1]
        while lo < total:
            hi = min(total, lo + _BLOCK)
            while hi < total and not sep[buf[hi]]:
                hi += 1
            h, s, e = self._block(buf[lo:hi], cuts[(cuts > lo) & (cuts < hi)] - lo, sep, fold)
            hs.append(h)
            ss.append(s + lo)
            es.append(e + lo)
            lo = hi
        one = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.hash, self.start, self.end = one(hs, np.uint64), one(ss, np.int64), one(es, np.int64)
        self.first = np.searchsorted(self.start, offsets)
        self.first[-1] = len(self.start)

    @staticmethod
    def _hash(b, starts, lens, fold):
        at = np.cumsum(lens) - lens
        place = np.arange(len(b), dtype=np.int32) - np.repeat(at.astype(np.int32), lens)
        v = fold[b].astype(np.uint64)
        v += np.uint64(1)
        if len(lens) and lens.max() > 1024:
            v += (place >> 10).astype(np.uint64) * np.uint64(257)
        v *= _MULT[place & 1023]
        return mix(np.add.reduceat(v, at)) if len(at) else np.zeros(0, np.uint64)

    def _block(self, b, cuts, sep, fold):
        gap = sep[b]
        inside = np.zeros(len(b) + 2, dtype=np.int8)
        inside[1:-1] = ~gap
        edge = np.diff(inside)
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(cuts):  # a text may end without a separator before the next one begins
            cuts = cuts[(cuts > 0) & (cuts < len(b))]
            cuts = cuts[~gap[cuts] & ~gap[cuts - 1]]
            if len(cuts):
                cuts = np.unique(cuts)
                s, e = np.sort(np.concatenate([s, cuts])), np.sort(np.concatenate([e, cuts]))
        return self._hash(b[~gap], s, e - s, fold), s, e

    def __len__(self):
        return len(self.hash)


def doc_slices(col: pa.ChunkedArray | pa.Array, max_bytes: int = 1 << 20, rows: int = 1024):
    """Cut a string column into runs of at most ``rows`` rows of about ``max_bytes``: (first row, buffer, offsets), null as empty.

    Only such a run, not the column, is copied, and scratch memory follows ``max_bytes`` or the longest text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    for lo in range(0, len(col), rows):
        part = col.slice(lo, rows)
        part = (part.fill_null("") if part.null_count else part).cast(pa.large_binary())
        n = len(part)
        off = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset:part.offset + n + 1]
        data = np.frombuffer(part.buffers()[2], dtype=np.uint8) if part.buffers()[2] is not None else np.zeros(0, np.uint8)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
            yield lo + i, data[off[i]:off[j]], off[i:j + 1] - off[i]
            i = j


def row_slices(b: pa.RecordBatch, rows: int = 512):
    """A batch in runs of ``rows`` rows, for work that makes Python objects of them."""
    for lo in range(0, b.num_rows, rows):
        yield b.slice(lo, rows)


def kgrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on (those that run over the end of ``h`` are left out)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += (h[j:j + n] >> np.uint64(7 * (j % 2))) * _GRAM[j]
        out ^= out >> np.uint64(31)
    return mix(out)


def window_min(g: np.ndarray, w: int) -> np.ndarray:
    """Place of the leftmost least value in each run of ``w`` values of ``g``."""
    n = len(g) - w + 1
    best = g[w - 1:w - 1 + n].copy()
    at = np.arange(w - 1, w - 1 + n)
    for j in range(w - 2, -1, -1):
        less = g[j:j + n] <= best
        best = np.where(less, g[j:j + n], best)
        at = np.where(less, np.arange(j, j + n), at)
    return at


# A set of 64-bit keys as a bit table of fixed size: no key of the set is missed, a few others pass.

def bit_position(key, bits: int):
    """Place of a key's bit in a table of 2**bits bits: its top bits."""
    return F.shiftrightunsigned(key, 64 - bits)


class _ByValue:
    """A function that pickles by value also where Spark pickles plainly (broadcasts)."""

    def __init__(self, fn):
        self.fn = fn

    def __reduce__(self):
        return cloudpickle.loads, (cloudpickle.dumps(self.fn),)


def _made(kind, state: dict):
    out = kind.__new__(kind)
    out.__dict__.update(state)
    return out


class Shipped:
    """Base of what is broadcast: it reaches tasks that have no copy of this package."""

    def __reduce__(self):
        return operator.call, (_ByValue(functools.partial(_made, type(self))), self.__dict__)


class BitSet(Shipped):
    """The bit table, sent compressed and unpacked once in each worker."""

    def __init__(self, table: np.ndarray, bits: int):
        self.bits, self.packed, self.name = bits, zlib.compress(table.tobytes(), 1), uuid.uuid4().hex

    def table(self) -> np.ndarray:
        held = worker_state("bit tables")
        if self.name not in held:
            while len(held) >= 4:  # of earlier steps
                held.pop(next(iter(held)))
            held[self.name] = np.frombuffer(zlib.decompress(self.packed), np.uint8)
        return held[self.name]

    def has(self, h: np.ndarray) -> np.ndarray:
        """Which of the hashes ``h`` have their bit set."""
        p = h >> np.uint64(64 - self.bits)
        return (self.table()[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


def set_bits(keys: DataFrame, key: str, bits: int) -> BitSet:
    """Bit table of ``key`` over all rows; at most 2**bits / 8 bytes reach the driver, however many rows there are."""
    place = bit_position(F.col(key), bits) + 1  # Spark's bitmaps count from 1
    rows = (keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).collect())
    out = np.zeros(max(1, (1 << bits) >> 3), np.uint8)
    for r in rows:  # bucket numbers start at 1 and hold 32768 bits
        at = (r["b"] - 1) * 4096
        m = np.frombuffer(bytes(r["m"]), np.uint8)
        out[at:at + 4096] = m[:len(out) - at] if at + 4096 > len(out) else m
    return BitSet(out, bits)
