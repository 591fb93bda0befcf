"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on a ring. A row's key falls on the ring, too, and belongs to the first point
clockwise from it; if that point's shard is full, the row continues clockwise to the next point whose shard is
not. Rows come in the order (round, arc, key's place, key, text's CRC-32); the round is another byte of the
key's hash, so every arc fills evenly and a shard that fills up does so with rows of the whole ring.

What decides is only where a shard fills up, and there are as many such events as shards. Rows are counted by
(round, arc), a table whose size does not follow the data (256 x shards x vnodes at most); the events are found
by walking it on the driver. An event falls inside one cell: only the rows of those cells are ranked. A row's
shard is then a lookup in its arc's short list of (event, shard).

``slack`` is what a shard may hold above the mean. With 0 all shards are full in the end and counts differ by
one at most (law ``rows``); with more, fewer rows move when a shard is added, and the first shards may hold up to
1 + slack times the mean.

Defined results: a null text has no bytes; a null key is a key of its own; repeated rows are rows of their own,
a key that holds many rows is split where its shard is full; ties go by text and then by place in the stored
table, so equal rows only change places among themselves. An empty table gives no rows. Further columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import common as C
from lakemart.operators.keys import dense_ids

ROUNDS = 256


def ring(n_shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the points on the ring, ascending, and their shards: 32 bits of the MD5 of ``shard:number``."""
    points = sorted((int(hashlib.md5(f"{s}:{v}".encode()).hexdigest()[:8], 16), s, v)
                    for s in range(n_shards) for v in range(vnodes))
    return np.array([p[0] for p in points], np.int64), np.array([p[1] for p in points], np.int64)


def capacities(rows: int, n_shards: int, slack: float) -> np.ndarray:
    """Rows that a shard may hold; without slack they add up to all rows."""
    if slack:
        return np.full(n_shards, int(np.ceil((1 + slack) * rows / n_shards)), np.int64)
    return rows // n_shards + (np.arange(n_shards) < rows % n_shards)


def _targets(shard_of: np.ndarray, full: np.ndarray) -> np.ndarray:
    """For each arc the first shard clockwise that is not full (-1 if all are)."""
    n = len(shard_of)
    at = np.where(full[shard_of], 2 * n, np.arange(n))
    at = np.minimum.accumulate(np.concatenate([at, at + n])[::-1])[::-1][:n]
    return np.where(at < 2 * n, shard_of[at % n], -1)


def fill_events(cells: np.ndarray, counts: np.ndarray, shard_of: np.ndarray, capacity: np.ndarray):
    """Where shards fill up: ((cell, rank) of the first row that the change holds for, shard by arc) in order.

    ``cells`` are round * arcs + arc, ascending. The first entry holds from the beginning."""
    arcs, load = len(shard_of), np.zeros(len(capacity), np.int64)
    full = capacity <= 0
    to = _targets(shard_of, full)
    events = [((0, 0), to)]
    i = 0
    while i < len(cells):
        s = to[cells[i:] % arcs]
        # the first cell with which some shard overflows, by its running sum
        order = np.argsort(s, kind="stable")
        run = np.cumsum(counts[i:][order])
        first = np.append(True, s[order][1:] != s[order][:-1])
        before = np.maximum.accumulate(np.where(first, run - counts[i:][order], 0))
        filled = np.flatnonzero(run - before + load[s[order]] >= capacity[s[order]])
        stop = order[filled].min() if len(filled) else len(s)
        load += np.bincount(s[:stop], weights=counts[i:i + stop], minlength=len(load)).astype(np.int64)
        i += stop
        if i == len(cells):
            break
        rank, left = 0, int(counts[i])
        while left:   # this cell's rows, shard by shard
            t = to[cells[i] % arcs]
            take = min(left, int(capacity[t] - load[t]))
            load[t], rank, left = load[t] + take, rank + take, left - take
            if load[t] == capacity[t]:
                full[t] = True
                to = _targets(shard_of, full)
                events.append(((int(cells[i]), rank), to))
        i += 1
    return events


def _arcs(places: np.ndarray):
    """Arc of each key: the first point at or after its place, around the ring."""
    def run(batches):
        for b in batches:
            at = np.searchsorted(places, b.column("place").to_numpy(), side="left") % len(places)
            cell = b.column("round").to_numpy().astype(np.int64) * len(places) + at
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at), pa.array(cell)], names=[*b.schema.names, "arc", "cell"])
    return run


def assign(docs: DataFrame, n_shards: int = 24, vnodes: int = 64, slack: float = 0.0, key: str = "doc_id") -> DataFrame:
    """(key, size, text_crc32, shard) of each row; size is the text's UTF-8 bytes and 8."""
    text = C.column(docs, "text", "string")
    raw = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    digest = F.md5(F.encode(F.coalesce(C.column(docs, key).cast("string"), F.lit("")), "UTF-8"))
    number = lambda a, n: F.conv(F.substring(digest, a, n), 16, 10).cast("long")
    rows = docs.select(C.column(docs, key).alias("key"), (F.octet_length(raw) + 8).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"), number(1, 8).alias("place"), number(9, 2).alias("round"))
    places, shard_of = ring(n_shards, vnodes)
    keyed = rows.mapInArrow(_arcs(places), f"key {rows.schema['key'].dataType.simpleString()}, size long, text_crc32 long, "
                                           "place long, round long, arc long, cell long")
    keyed = C.stored(keyed.drop("round").withColumn("row", F.monotonically_increasing_id()), "ring-keys")
    counted = keyed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).orderBy("cell").toPandas()   # ROUNDS x arcs rows at most
    cells, counts = counted["cell"].to_numpy(np.int64), counted["n"].to_numpy(np.int64)
    events = fill_events(cells, counts, shard_of, capacities(int(counts.sum()), n_shards, slack))
    split = sorted({c for (c, _), _ in events[1:]})
    # rank of the rows of the cells in which a shard fills up
    start = np.concatenate([[0], np.cumsum(counts[np.searchsorted(cells, split)])]) if split else [0]
    order = ["cell", "place", "key", "text_crc32", "row"]
    inside = dense_ids(keyed.where(F.col("cell").isin(split)), order, "rank", 0)
    begin = F.element_at(F.array(*[F.lit(int(x)) for x in start]), F.array_position(F.array(*[F.lit(c) for c in split or [-1]]), F.col("cell")).cast("int"))
    inside = inside.withColumn("rank", F.col("rank") - begin)
    ranked = keyed.where(~F.col("cell").isin(split)).withColumn("rank", F.lit(0).cast("long")).unionByName(inside)
    # of each arc, the events that change its shard
    plan, last = [], np.full(len(shard_of), -2)
    for (cell, rank), to in events:
        plan += [(int(a), cell, rank, int(to[a])) for a in np.flatnonzero(to != last)]
        last = to
    steps = (docs.sparkSession.createDataFrame(plan, "arc long, cell long, rank long, shard int").groupBy("arc")
             .agg(F.array_sort(F.collect_list(F.struct("cell", "rank", "shard"))).alias("steps")))
    held = F.expr("element_at(filter(steps, x -> x.cell < cell or (x.cell = cell and x.rank <= rank)), -1).shard")
    return ranked.join(steps, "arc").select("key", "size", "text_crc32", "row", held.alias("shard"))


def sharded(docs: DataFrame, n_shards: int = 24, vnodes: int = 64, slack: float = 0.0) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): the rows' shards and their gapless places in them,
    in the order of their ids. The law is ``rows``: counts differ by one at most if ``slack`` is 0."""
    rows = C.stored(assign(docs, n_shards, vnodes, slack), "shards")
    sizes = {r["shard"]: r["n"] for r in rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    start = np.concatenate([[0], np.cumsum([sizes.get(s, 0) for s in range(n_shards)])])
    begin = F.element_at(F.array(*[F.lit(int(x)) for x in start]), F.col("shard") + 1)
    placed = dense_ids(rows, ["shard", "key", "text_crc32", "row"], "at", 0)
    return placed.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         (F.col("at") - begin).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
