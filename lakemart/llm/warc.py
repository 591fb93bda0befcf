"""WARC archives through a chunked record table.

A payload travels as rows (record, chunk number, bytes): pieces of ``CHUNK`` bytes with the SHA-1 of
all bytes so far, so neither the writer nor the reader holds a second copy of a long record. The
writer streams the rows of a record, in order, into one gzip member of a .warc.gz file; the reader
inflates members piece by piece and gives the same kind of rows back, from which lengths and digests
are summed up.

1. Digest and length of each payload, and for equal payloads the page that keeps it (largest id):
   an aggregate by digest joined back, so a payload that a third of the pages share is one row a task.
2. Rows are dealt by a hash of the record to the writers; each writes files under names of its own and
   names them in the manifest with each record's place, so repeated tasks do no harm.
3. The reader takes ranges of records of about equal bytes.

Cases: a null payload is written as empty; equal rows (id and all) are one record each and, if theirs is
the largest id, all of them responses; pages without id keep a null id and come last in choosing
the response; a null url leaves the target out; an empty table gives no files; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import common as C

CHUNK, FILE_BYTES = 1 << 18, 256 << 20
DATE = "1970-01-01T00:00:00Z"  # the table has no capture time


def base32_sha1(hexed):
    """Bare upper-case base32 of a hex SHA-1 column: 8 runs of 20 bits, 4 letters each."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for k in range(8):
        bits = F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 10).cast("int")
        out += [F.substring(letters, F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def chunks(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(record, chunk, last, data): payload bytes in order; ``pages`` has record and payload."""
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("payload") / chunk)).cast("int")
    return (pages.select("*", F.explode(F.sequence(F.lit(0), count - 1)).alias("chunk"))
            .select(*[c for c in pages.columns if c != "payload"], "chunk",
                    F.substring("payload", F.col("chunk") * chunk + 1, F.lit(chunk)).alias("data")))


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                 least: int = 0) -> DataFrame:
    """Records to write: record, page_id, url, payload, bytes, digest, record_type, refers_to.

    Of records with equal payloads of at least ``least`` bytes, that with the largest id is the
    response and the others revisit it.
    """
    body = F.coalesce(C.column(pages, html, "string"), F.lit("")).cast("binary")
    rows = pages.select(C.column(pages, page_id, "long").alias("page_id"), C.column(pages, url, "string").alias("url"),
                        body.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha"))
    # one record for each row: equal ids are told apart by payload and by a number that the task gives
    keeper = (rows.where(F.col("bytes") >= least).groupBy("sha")
              .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"))
    rows = rows.join(keeper, "sha", "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page_id"))
    return rows.select("page_id", "url", "payload", "bytes", base32_sha1(F.col("sha")).alias("digest"),
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("keeper")).alias("refers_to"))


def _head(record, page_id, url, digest, kind, refers_to, size, http):
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c for c in url if c not in "\r\n"))
    if page_id is not None:
        lines.append(f"WARC-X-Page: {page_id}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-X-Refers-To-Page: {refers_to}", f"WARC-X-Payload-Length: {size}"]
        size = 0
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + size}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _http(size):
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def write_archives(records: DataFrame, folder: str, chunk: int = CHUNK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write .warc.gz files; manifest rows (file, offset, bytes): the place of each record's gzip member."""
    rows = records.withColumn("payload", F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload")))
    rows = chunks(rows.withColumn("record", F.expr("uuid()")), chunk)

    def write(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        part, state = TaskContext.get().partitionId(), {"out": None, "at": 0, "n": 0}
        done = []

        def begin():
            if state["out"] is None or state["at"] >= file_bytes:
                if state["out"] is not None:
                    state["out"].close()
                fs.create_dir(root, recursive=True)
                state["name"] = f"pages-{part:05d}-{state['n']:04d}-{uuid.uuid4().hex}.warc.gz"
                state["out"], state["at"] = fs.open_output_stream(f"{root}/{state['name']}", compression=None), 0
                state["n"] += 1
            state["z"], state["from"] = zlib.compressobj(6, zlib.DEFLATED, 31), state["at"]

        def put(data, flush=False):
            got = state["z"].flush() if flush else state["z"].compress(data)
            if got:
                state["out"].write(got)
                state["at"] += len(got)

        def end():
            put(b"\r\n\r\n")
            put(b"", True)
            done.append((state["name"], state["from"], state["at"] - state["from"]))

        open_ = False
        for b in batches:
            cols = {n: b.column(n).to_pylist() for n in ("page_id", "url", "bytes", "digest", "record_type", "refers_to",
                                                         "record", "chunk")}
            for i, data in enumerate(b.column("data")):
                v = {n: c[i] for n, c in cols.items()}
                if v["chunk"] == 0:
                    if open_:
                        end()
                    begin()
                    http = _http(v["bytes"])
                    put(_head(v["record"], v["page_id"], v["url"], v["digest"], v["record_type"], v["refers_to"],
                              v["bytes"], http) + http)
                    open_ = True
                put(memoryview(data.as_buffer()) if len(data.as_buffer()) else b"")
            names, at, size = zip(*done, strict=True) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(at, pa.int64()),
                                              pa.array(size, pa.int64())], names=["file", "offset", "bytes"])
            done.clear()
        if open_:
            end()
        if state["out"] is not None:
            state["out"].close()
        names, at, size = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(at, pa.int64()),
                                          pa.array(size, pa.int64())], names=["file", "offset", "bytes"])

    # a task explodes its own rows, so the chunks of a record follow one another in order
    return C.stored(rows.mapInArrow(write, "file string, offset long, bytes long"), "warc-manifest")


class _Member:
    """Bytes of one gzip member of a file, inflated by pieces of at most ``chunk`` bytes."""

    def __init__(self, f, offset, size, chunk):
        self.f, self.at, self.end, self.chunk = f, offset, offset + size, chunk
        self.z, self.rest, self.held = zlib.decompressobj(31), b"", b""

    def more(self):
        raw = self.rest
        if not raw and self.at < self.end:
            raw = self.f.read_at(min(self.chunk, self.end - self.at), self.at)
            self.at += len(raw)
        out = self.z.decompress(raw, self.chunk) if raw else b""
        self.rest = self.z.unconsumed_tail
        if not out and not self.rest and self.at >= self.end:
            raise ValueError("record ends early")
        return out

    def line(self):
        while b"\r\n" not in self.held:
            self.held += self.more()
        got, _, self.held = self.held.partition(b"\r\n")
        return got.decode()

    def head(self):
        fields = {}
        first = self.line()
        while line := self.line():
            k, _, v = line.partition(":")
            fields[k.strip().lower()] = v.strip()
        return first, fields

    def pieces(self, n):
        while n:
            if not self.held:
                self.held = self.more()
                continue
            got, self.held = self.held[:n], self.held[n:]
            n -= len(got)
            yield got


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame, chunk: int = CHUNK,
                  keep_data: bool = False) -> DataFrame:
    """Chunk rows of the archives' records: record, page_id, url, record_type, refers_to, digest, payload_bytes (as
    stated for a revisit), chunk, n_bytes, sha1 (hex, of the payload up to here), last[, data]."""
    n = manifest.count()
    tasks = max(1, min(n, max(spark.sparkContext.defaultParallelism, -(-n // 4096))))
    kinds = [("record", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
             ("refers_to", pa.int64()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("chunk", pa.int32()),
             ("n_bytes", pa.int64()), ("sha1", pa.string()), ("last", pa.bool_()), ("data", pa.binary())]
    kinds = kinds if keep_data else kinds[:-1]

    def batch(rows):
        cols = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, kinds, strict=True)],
                                          names=[n for n, _ in kinds])

    def read(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        name, f, rows, held = None, None, [], 0
        for b in batches:
            for file, offset, size in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "bytes")), strict=True):
                if file != name:
                    name, f = file, fs.open_input_file(f"{root}/{file}")
                m = _Member(f, offset, size, chunk)
                first, w = m.head()
                if first != "WARC/1.1":
                    raise ValueError(f"{file} at {offset}: not a WARC record")
                before = int(w["content-length"])
                _, http = m.head()
                total = int(http["content-length"])
                kind, left = w["warc-type"], total if w["warc-type"] == "response" else 0
                if before < left:
                    raise ValueError(f"{file} at {offset}: block shorter than its payload")
                meta = (w["warc-record-id"].removeprefix("<urn:uuid:").rstrip(">"),
                        int(w["warc-x-page"]) if "warc-x-page" in w else None, w.get("warc-target-uri"), kind,
                        int(w["warc-x-refers-to-page"]) if kind == "revisit" else None,
                        w["warc-payload-digest"].removeprefix("sha1:"), total)
                sha, k, put = hashlib.sha1(usedforsecurity=False), 0, 0
                for data in m.pieces(left):
                    sha.update(data)
                    put += len(data)
                    rows.append((*meta, k, len(data), sha.hexdigest(), put == left, *[data] * keep_data))
                    k, held = k + 1, held + len(data) * keep_data
                    if held > chunk or len(rows) >= 4096:
                        yield batch(rows)
                        rows, held = [], 0
                if not left:
                    rows.append((*meta, 0, 0, sha.hexdigest(), True, *[b""] * keep_data))
                if kind == "response" and base64.b32encode(sha.digest()).decode() != meta[5]:
                    raise ValueError(f"{file} at {offset}: payload digest differs")
        yield batch(rows)

    place = manifest.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return place.mapInArrow(read, ", ".join(f"{n} {_SPARK[str(k)]}" for n, k in kinds))


_SPARK = {"string": "string", "int64": "long", "int32": "int", "bool": "boolean", "binary": "binary"}


def summed(rows: DataFrame) -> DataFrame:
    """Per record of ``read_archives``: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's length and digest are those of its chunk rows; a revisit's are as its record states.
    """
    own = (rows.groupBy("record", "page_id", "record_type", "refers_to", "digest", "payload_bytes")
           .agg(F.sum("n_bytes").alias("n"), F.max_by("sha1", "chunk").alias("sha")))
    response = F.col("record_type") == "response"
    return own.select("page_id", F.when(response, F.col("n")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                      F.when(response, base32_sha1(F.col("sha"))).otherwise(F.col("digest")).alias("payload_digest"),
                      "record_type", "refers_to")
