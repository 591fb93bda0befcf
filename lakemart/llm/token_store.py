"""Token-id files coded with a static range asymmetric numeral system (rANS).

One frequency table, counted over all ids, serves every file. A file holds segments of whole
documents; a segment holds blocks of ``BLOCK`` ids that are coded independently, each with ``LANES``
interleaved states. A segment's head keeps the checkpoints that parallel decoding needs: each
block's word count and the CRC-32 of its ids. All blocks of a segment are coded side by side.

File (little-endian):
  file     b"RANSIDS1", u32 CRC-32 of the frequency table, then segments one after another
  segment  u32 documents, u32 blocks, u64 ids, u32 CRC-32 of the rest of the segment;
           i64 ids of the documents, u8 1 where the id is null, u64 lengths;
           u32 words and u32 CRC-32 of each block; u64 states (blocks x LANES); u32 words
Coder: states in [2**31, 2**63), 32-bit words, frequencies that sum to 2**20. Id t of a block
belongs to lane t mod LANES.

A task writes its file under a name of its own and names it in the manifest, so a repeated or
speculative task never spoils a file that another task's manifest names. Files are opened through
``pyarrow.fs`` by the folder's URI; tables are read by Spark.

Cases: null and empty texts are one end id; equal rows are kept one by one; rows without id come
first; an empty table gives no files and no rows; only the named columns are read. A file with a
wrong checksum or table raises an error.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.llm import common as C
from lakemart.llm.tokens import ROWS, encoder

END, BLOCK, LANES, SEGMENT = 0, 4096, 32, 1 << 20
MAGIC, SCALE, LOW = b"RANSIDS1", 20, 31
_HEAD = "<IIQI"


def frequencies(counts: dict[int, int]) -> np.ndarray:
    """Table of frequencies by id, in proportion to the counts, at least 1 for each id that occurs; sum 2**SCALE."""
    size = max(counts, default=0) + 1
    c = np.zeros(size, np.int64)
    for i, n in counts.items():
        c[i] = n
    total, room = int(c.sum()), (1 << SCALE) - int((c > 0).sum())
    if room < 0:
        raise ValueError("more ids than the table has places")
    if not total:
        return np.zeros(1, np.int64)
    share = [int(n) * room for n in c]  # exact integers: the same table on every machine
    f = np.array([s // total + (n > 0) for s, n in zip(share, c, strict=True)], np.int64)
    rest = (1 << SCALE) - int(f.sum())
    order = sorted((i for i in range(size) if c[i]), key=lambda i: (-(share[i] % total), i))
    f[order[:rest]] += 1
    return f


class Coder:
    """Encodes and decodes runs of ids with one frequency table."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(freq)]).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        self.crc = zlib.crc32(freq.astype("<u4").tobytes())

    def encode(self, ids: np.ndarray):
        """(words of each block, states, words) of a run of ids."""
        nb, steps = -(-len(ids) // BLOCK), BLOCK // LANES
        grid = np.full(nb * BLOCK, -1, np.int64)
        grid[:len(ids)] = ids
        grid = grid.reshape(nb, steps, LANES)
        x = np.full((nb, LANES), 1 << LOW, np.uint64)
        words, out = np.zeros((nb, steps, LANES), np.uint32), np.zeros((nb, steps, LANES), bool)
        for s in range(steps - 1, -1, -1):
            t = grid[:, s, :]
            on = t >= 0
            f, c = self.freq[t], self.cum[t]  # places past the end read some row and are masked
            f = np.where(on, f, np.uint64(1 << SCALE))
            put = on & (x >= f << np.uint64(LOW - SCALE + 32))
            words[:, s, :] = x & np.uint64(0xFFFFFFFF)
            out[:, s, :] = put
            x = np.where(put, x >> np.uint64(32), x)
            q = x // f
            x = np.where(on, (q << np.uint64(SCALE)) + (x - q * f) + c, x)
        return out.sum(axis=(1, 2)).astype("<u4"), x.astype("<u8"), words[out].astype("<u4")

    def decode(self, n: int, sizes: np.ndarray, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        nb, steps = len(sizes), BLOCK // LANES
        out = np.zeros((nb, steps, LANES), np.uint32)
        at = (np.cumsum(sizes.astype(np.int64)) - sizes)[:, None]
        x = states.astype(np.uint64).reshape(nb, LANES)
        held = np.minimum(n - np.arange(nb) * BLOCK, BLOCK)[:, None]
        words = np.concatenate([words, np.zeros(1, np.uint32)])
        mask, low = np.uint64((1 << SCALE) - 1), np.uint64(1 << LOW)
        for s in range(steps):
            on = s * LANES + np.arange(LANES)[None, :] < held
            v = x & mask
            t = self.slot[v.astype(np.int64)]
            out[:, s, :] = t
            x = np.where(on, self.freq[t] * (x >> np.uint64(SCALE)) + v - self.cum[t], x)
            get = on & (x < low)
            k = np.cumsum(get, axis=1)
            w = words[np.minimum(at + k - 1, len(words) - 1) * get]
            x = np.where(get, (x << np.uint64(32)) | w, x)
            at = at + k[:, -1:]
        return out.reshape(-1)[:n]


def _segment(coder: Coder, docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    ids = np.concatenate([x for _, x in docs])
    sizes, states, words = coder.encode(ids)
    crcs = np.array([zlib.crc32(ids[i:i + BLOCK].astype("<u4").tobytes()) for i in range(0, len(ids), BLOCK)], "<u4")
    body = b"".join([
        np.array([i or 0 for i, _ in docs], "<i8").tobytes(), np.array([i is None for i, _ in docs], "u1").tobytes(),
        np.array([len(x) for _, x in docs], "<u8").tobytes(), sizes.tobytes(), crcs.tobytes(), states.tobytes(),
        words.tobytes()])
    return struct.pack(_HEAD, len(docs), len(sizes), len(ids), zlib.crc32(body)) + body


def _read_segment(coder: Coder, raw: bytes):
    """(doc ids, lengths, ids) of one segment; raises ValueError if a checksum differs."""
    n_docs, nb, n, crc = struct.unpack_from(_HEAD, raw)
    body = memoryview(raw)[struct.calcsize(_HEAD):]
    if zlib.crc32(body) != crc:
        raise ValueError("segment checksum differs")
    at = 0

    def take(kind, k):
        nonlocal at
        out = np.frombuffer(body, kind, k, at)
        at += out.nbytes
        return out

    doc, none, lens = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs).astype(np.int64)
    sizes, crcs, states = take("<u4", nb), take("<u4", nb), take("<u8", nb * LANES)
    ids = coder.decode(n, sizes, states, take("<u4", int(sizes.sum())))
    for k in range(nb):
        if zlib.crc32(ids[k * BLOCK:(k + 1) * BLOCK].astype("<u4").tobytes()) != crcs[k]:
            raise ValueError(f"checksum of block {k} differs")
    return [None if z else int(d) for d, z in zip(doc, none, strict=True)], lens, ids


def tokenized(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """(doc_id, ids): ids of each text and the end id, unsigned 16-bit if the vocabulary allows, else 32-bit."""
    def run(batches):
        enc = encoder(tokenizer)
        kind, tail = "<u2" if enc.size <= 1 << 16 else "<u4", np.array([end], "<u4").tobytes()
        for b in batches:
            for part in C.row_slices(b, ROWS):
                got = [np.frombuffer(x + tail, "<u4").astype(kind).tobytes() for x in enc.encode(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got, pa.binary()),
                                                  pa.array([int(kind[2])] * len(got), pa.int32())],
                                                 names=["doc_id", "ids", "width"])

    return docs.select(C.column(docs, doc_id, "long").alias("d"), C.column(docs, text).alias("t")).mapInArrow(
        run, "doc_id long, ids binary, width int")


def _counts(batches):
    total = np.zeros(0, np.int64)
    for b in batches:
        for lo in range(0, b.num_rows, 512):
            part = b.slice(lo, 512)  # one tokenizer, one width
            n = np.bincount(np.frombuffer(b"".join(part.column(0).to_pylist()), f"<u{part.column(1)[0]}"), minlength=len(total))
            n[:len(total)] += total
            total = n
    i = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(total[i])], names=["id", "n"])


def write_store(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                end: int = END, segment: int = SEGMENT) -> tuple[DataFrame, np.ndarray]:
    """Write the token-id files in ascending id order; (manifest, frequency table).

    Manifest: part, seg, file, offset, bytes, n_docs, n_tokens, start (ids in all segments before).
    """
    spark = docs.sparkSession
    ids = C.stored(tokenized(docs, tokenizer, doc_id, text, end), "token-ids")
    counts = ids.select("ids", "width").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    freq = frequencies({r["id"]: r["n"] for r in counts.collect()})  # at most a row for each id of the vocabulary
    shared = spark.sparkContext.broadcast(freq)

    def write(batches):
        coder, part = Coder(shared.value), TaskContext.get().partitionId()
        fs, root = pafs.FileSystem.from_uri(folder)
        name, out, at, rows, run, held = f"part-{part:05d}-{uuid.uuid4().hex}.ransids", None, 0, [], [], 0

        def flush():
            nonlocal out, at, run, held
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
                at = out.write(MAGIC + struct.pack("<I", coder.crc)) or len(MAGIC) + 4
            raw = _segment(coder, run)
            out.write(raw)
            rows.append((part, len(rows), name, at, len(raw), len(run), held))
            at, run, held = at + len(raw), [], 0

        for b in batches:
            for i, x, w in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                run.append((i, np.frombuffer(x, f"<u{w}").astype(np.int64)))
                held += len(run[-1][1])
                if held >= segment:
                    flush()
        if run:
            flush()
        if out is not None:
            out.close()
        cols = list(zip(*rows, strict=True)) or [()] * 7
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                         names=["part", "seg", "file", "offset", "bytes", "n_docs", "n_tokens"])

    ordered = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    segs = C.stored(ordered.mapInArrow(write, "part int, seg int, file string, offset long, bytes long, n_docs long, "
                                              "n_tokens long"), "token-manifest")
    # ids before a part over the parts' totals (a row for each file), then before a segment in its part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    parts = segs.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    start = F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return C.stored(segs.join(parts, "part").withColumn("start", start.cast("long")).drop("base"), "token-segments"), freq


def read_store(spark: SparkSession, folder: str, manifest: DataFrame, freq: np.ndarray, keep_ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32[, ids (32-bit little-endian)]."""
    shared = spark.sparkContext.broadcast(freq)
    n = manifest.count()
    if not n:
        manifest = manifest.limit(0)
    tasks = max(1, min(n, max(spark.sparkContext.defaultParallelism, -(-n // 8))))

    def read(batches):
        coder = None
        for b in batches:
            for file, offset, size, start in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "bytes", "start")),
                                                 strict=True):
                coder = coder or Coder(shared.value)
                fs, root = pafs.FileSystem.from_uri(folder)
                with fs.open_input_file(f"{root}/{file}") as f:
                    if f.read_at(len(MAGIC) + 4, 0) != MAGIC + struct.pack("<I", coder.crc):
                        raise ValueError(f"{file}: not a file of this table")
                    doc, lens, ids = _read_segment(coder, f.read_at(size, offset))
                ends = np.cumsum(lens)
                raw = memoryview(ids.astype("<u4").tobytes())
                cut = [raw[4 * (e - k):4 * e] for e, k in zip(ends.tolist(), lens.tolist(), strict=True)]
                cols = [pa.array(doc, pa.int64()), pa.array(start + ends - lens), pa.array(lens),
                        pa.array([zlib.crc32(x) for x in cut], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if keep_ids:
                    cols.append(pa.array([bytes(x) for x in cut], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return manifest.select("file", "offset", "bytes", "start").repartition(tasks).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if keep_ids else ""))
