"""Dense surrogate keys and positional access, without a single-partition step.

``row_number() over (order by ...)`` with no partition moves every row into one task. Instead:

1. range-partition the rows on the (total) order and sort inside each partition; the range
   partitioner samples the full sort key, so even a hot leading value is spread over tasks;
2. number the rows inside each partition (``monotonically_increasing_id`` minus the partition's
   base) and write that as Parquet under the shared checkpoint folder, which fixes the numbering and
   cuts the lineage so a lost executor cannot renumber anything;
3. count rows per partition (reads one column), turn the counts into running offsets (one row per partition: the
   table is bounded by the partition count, so broadcasting it is safe), and add the offset.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.session import scratch_path

_PID, _POS, _OFF, _CNT = "_pid", "_pos", "_offset", "_cnt"


def _range(df: DataFrame, order_by: Sequence[str], num_partitions: int | None) -> DataFrame:
    """Range-partition on the order. Without an explicit count the session's shuffle partition
    count is used and AQE may merge small neighbouring ranges; merged ranges stay contiguous
    and are renumbered in order, so partition ids still follow the sort order."""
    if num_partitions:
        return df.repartitionByRange(int(num_partitions), *order_by)
    return df.repartitionByRange(*order_by)


def _stored(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _numbered(df: DataFrame, order_by: Sequence[str], num_partitions: int | None) -> DataFrame:
    """``df`` with its range partition and its place in it, written once: one exchange of the rows."""
    local = (_range(df, order_by, num_partitions)
             .sortWithinPartitions(*order_by)
             .withColumn(_PID, F.spark_partition_id())
             .withColumn(_POS, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33)))
    return _stored(local, "numbered")


def dense_ids(df: DataFrame, order_by: Sequence[str], id_col: str = "id", start: int = 1,
              num_partitions: int | None = None) -> DataFrame:
    """Append ``id_col`` = start, start+1, ... following ``order_by`` (which must be a total order)."""
    cols = df.columns
    local = _numbered(df, order_by, num_partitions)
    counts = local.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT))
    running = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum(_CNT).over(running), F.lit(0)).alias(_OFF))
    out = local.join(F.broadcast(offsets), _PID)
    return out.select(*cols, (F.col(_OFF) + F.col(_POS) + F.lit(start)).cast("long").alias(id_col))


def _literal(value, kind: T.DataType):
    """A collected value as a literal of its column's type."""
    if value is not None and isinstance(kind, T.TimestampNTZType):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(kind)


def row_at_position(df: DataFrame, order_by: Sequence[str], position: int, at_once: int = 1 << 16, cuts: int = 32) -> DataFrame:
    """The row at 0-based ``position`` of ``order_by`` (a total order); empty if out of range.

    Selection, not sorting: boundaries from a sample of fixed size, exact counts of the rows below and up to each
    in one pass, then the same within the one range that holds the position, until it has at most ``at_once``
    rows; those are sorted by a top-n. The first column's bounds are pushed into the scan. Nothing is shuffled
    or written; a boundary that many rows share is settled by its count.
    """
    if position < 0:
        raise ValueError("position must be >= 0")
    order = list(order_by)
    kinds = [df.schema[c].dataType for c in order]
    key = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    bound = lambda b: F.struct(*[_literal(v, k).alias(f"o{i}") for i, (v, k) in enumerate(zip(b, kinds, strict=True))])
    part, rows, seed = df, None, 0
    while rows is None or rows > at_once:
        seed += 1
        sample = part.select(*order).orderBy(F.rand(seed)).limit(128 * cuts)
        sample = [tuple(r) for r in df.sparkSession.createDataFrame(sample.collect(), sample.schema).orderBy(*order).collect()]
        if len(sample) < 128 * cuts:   # all rows
            break
        marks = list(dict.fromkeys(sample[len(sample) * i // cuts] for i in range(1, cuts)))
        counts = part.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(key < bound(b)).alias(f"lt{i}") for i, b in enumerate(marks)],
                          *[F.count_if(key <= bound(b)).alias(f"le{i}") for i, b in enumerate(marks)]).first()
        if position >= counts["n"]:
            break
        below = [i for i in range(len(marks)) if counts[f"lt{i}"] <= position]
        if below and position < counts[f"le{below[-1]}"]:
            return part.where(key == bound(marks[below[-1]])).limit(1)
        start, rows = 0, counts["n"]
        if below:
            low = marks[below[-1]]
            start = counts[f"le{below[-1]}"]
            part = part.where(key > bound(low))
            if low[0] is not None:
                part = part.where(F.col(order[0]) >= _literal(low[0], kinds[0]))
        if len(below) < len(marks):
            high = marks[len(below)]
            rows = counts[f"lt{len(below)}"]
            part = part.where(key < bound(high))
            if high[0] is not None:
                part = part.where(F.col(order[0]).isNull() | (F.col(order[0]) <= _literal(high[0], kinds[0])))
        position, rows = position - start, rows - start
    return part.orderBy(*order).offset(position).limit(1)


def weighted_offsets(df: DataFrame, order_by: Sequence[str], weight: str, out_col: str,
                     num_partitions: int | None = None) -> DataFrame:
    """Append ``out_col`` = sum of ``weight`` over all rows before this one in ``order_by``.

    The same range-partition plan as ``dense_ids``, one exchange of the rows: a task adds up its own
    sorted partition in Arrow batches, and the partition totals are turned into offsets through the
    broadcast per-partition table.
    """
    def running(batches):
        total = 0
        for b in batches:
            w = pc.fill_null(b.column(weight).cast(pa.int64()), 0)
            upto = pc.cumulative_sum(w)
            place = pc.add(pc.subtract(upto, w), total)
            total += upto[-1].as_py() if len(upto) else 0
            yield pa.RecordBatch.from_arrays([*b.columns, place], names=[*b.schema.names, _POS])

    ranged = (_range(df, order_by, num_partitions).sortWithinPartitions(*order_by)
              .withColumn(_PID, F.spark_partition_id()))
    schema = T.StructType([*ranged.schema.fields, T.StructField(_POS, T.LongType())])
    local = _stored(ranged.mapInArrow(running, schema), "weighted")
    totals = local.groupBy(_PID).agg(F.sum(weight).alias(_CNT))
    running = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_PID, F.coalesce(F.sum(_CNT).over(running), F.lit(0)).alias(_OFF))
    out = local.join(F.broadcast(offsets), _PID)
    return out.select(*df.columns, (F.col(_OFF) + F.col(_POS)).cast("long").alias(out_col))


def dense_ids_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
                   left_order: Sequence[str], right_order: Sequence[str], id_col: str = "id", start: int = 1,
                   num_partitions: int | None = None) -> DataFrame:
    """Inner equi-join of ``left`` and ``right`` with ``id_col`` numbered densely in the order
    (left_order, right_order) of the joined rows, without sorting the joined rows.

    Each right row gets its rank inside its key group (a skew-proof numbering of ``right`` by
    key, then order, minus the group's first number); each left row gets the number of join
    partners of all left rows before it (``weighted_offsets`` over ``left``). A joined pair's id
    is start + left offset + right rank. Only ``left`` and ``right`` are sorted, never the
    fan-out, which may be many times larger.
    """
    left_keys, right_keys = list(left_keys), list(right_keys)
    rk = [f"_rk{i}" for i in range(len(right_keys))]
    r = right.select("*", *[F.col(k).alias(a) for k, a in zip(right_keys, rk, strict=True)])
    for a in rk:
        r = r.where(F.col(a).isNotNull())
    r_num = dense_ids(r, rk + list(right_order), "_rid", 0, num_partitions)
    groups = r_num.groupBy(*rk).agg(F.min("_rid").alias("_gstart"), F.count(F.lit(1)).alias("_m"))
    r_ranked = (r_num.join(groups.drop("_m"), rk)
                .withColumn("_rank", F.col("_rid") - F.col("_gstart")).drop("_rid", "_gstart"))
    lk = [f"_lk{i}" for i in range(len(left_keys))]
    l_keyed = left.select("*", *[F.col(k).alias(a) for k, a in zip(left_keys, lk, strict=True)])
    weights = groups.select(*[F.col(a).alias(b) for a, b in zip(rk, lk, strict=True)], "_m")
    l_w = l_keyed.join(weights, lk, "left").withColumn("_m", F.coalesce(F.col("_m"), F.lit(0)))
    l_off = weighted_offsets(l_w, left_order, "_m", "_loff", num_partitions)
    cond = None
    for a, b in zip(lk, rk, strict=True):
        c = l_off[a] == r_ranked[b]
        cond = c if cond is None else cond & c
    joined = l_off.join(r_ranked, cond, "inner")
    return joined.select(*[l_off[c] for c in left.columns], *[r_ranked[c] for c in right.columns],
                         (F.lit(start) + F.col("_loff") + F.col("_rank")).cast("long").alias(id_col))
