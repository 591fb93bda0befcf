"""Dedupe and upsert operators with four distinct meanings.

* ``distinct_rows``          full-row dedupe (one user at two levels keeps two rows)
* ``keep_first``             insert-if-absent: the first row per key wins
* ``last_write_wins``        upsert: the last row per key wins
* ``first_attrs_last_status`` merge upsert: attributes of the first row, status of the last row
* ``merge_into``             the same operators applied to stored rows plus a new batch

"First" and "last" are defined by an explicit ``order_by`` that must be a total order. All
keyed operators are one ``groupBy(key).agg(min/max(struct(order, payload)))``: a partial
aggregate runs before the shuffle, so a hot key is collapsed map-side to one row per task and
no group is ever materialised. The payload columns travel in one struct so that they all come
from the same row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names used to carry the order of the kept row through merges.
ORDER_FIRST = "_order_first"
ORDER_LAST = "_order_last"
BATCH = "_batch"


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _order_struct(order_by: Sequence, skip: Sequence[str] = ()) -> Column:
    """The order as one struct. Key columns are left out: they are constant within a group (an
    order made only of key columns becomes a constant, and ties go to the smallest payload)."""
    if not order_by:
        raise ValueError("order_by must name at least one column (a total order)")
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by if not (isinstance(c, str) and c in skip)]
    if not cols:
        cols = [F.lit(0)]
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(cols)])


def _orderable(df: DataFrame, cols: Sequence[str]) -> bool:
    """Whether ``cols`` can sit inside a compared struct (maps cannot be compared)."""
    def ok(t):
        if isinstance(t, T.MapType):
            return False
        if isinstance(t, T.StructType):
            return all(ok(f.dataType) for f in t.fields)
        if isinstance(t, T.ArrayType):
            return ok(t.elementType)
        return True
    return all(ok(df.schema[c].dataType) for c in cols)


def _extreme(agg: str, order: Column, payload: Sequence[str], df: DataFrame) -> Column:
    """The payload of the row with the smallest / largest order, as struct ``o`` + ``p``.

    One ``min``/``max`` over struct(order, payload) when the payload is comparable (cheaper than
    ``min_by``/``max_by`` over two structs, and deterministic even on ties); ``min_by``/``max_by``
    otherwise."""
    p = F.struct(*[F.col(c) for c in payload])
    if _orderable(df, payload):
        both = F.struct(order.alias("o"), p.alias("p"))
        return F.min(both) if agg == "min" else F.max(both)
    by = F.min_by if agg == "min" else F.max_by
    ext = F.min if agg == "min" else F.max
    return F.struct(ext(order).alias("o"), by(p, order).alias("p"))


def _payload(df: DataFrame, key: list[str], cols, reserved=()) -> list[str]:
    if cols is not None:
        return _names(cols)
    return [c for c in df.columns if c not in key and c not in reserved]


def distinct_rows(df: DataFrame, cols=None) -> DataFrame:
    """Full-row dedupe over ``cols`` (all columns by default)."""
    return (df.select(*_names(cols)) if cols is not None else df).dropDuplicates()


def _pick(df: DataFrame, key, order_by, cols, keep_order: bool, agg: str) -> DataFrame:
    key = _names(key)
    payload = _payload(df, key, cols, (ORDER_FIRST, ORDER_LAST, BATCH))
    o = F.col(ORDER_FIRST) if ORDER_FIRST in df.columns else _order_struct(order_by, key)
    out = df.groupBy(*key).agg(_extreme(agg, o, payload, df).alias("_row"))
    cols_out = [F.col(k) for k in key] + [F.col(f"_row.p.{c}").alias(c) for c in payload]
    if keep_order:
        cols_out.append(F.col("_row.o").alias(ORDER_FIRST))
    return out.select(*cols_out)


def keep_first(df: DataFrame, key, order_by: Sequence = (), cols=None, keep_order: bool = False) -> DataFrame:
    """Insert-if-absent semantics: per key, the row that is first in ``order_by``."""
    return _pick(df, key, order_by, cols, keep_order, "min")


def last_write_wins(df: DataFrame, key, order_by: Sequence = (), cols=None, keep_order: bool = False) -> DataFrame:
    """Upsert semantics: per key, the row that is last in ``order_by``."""
    return _pick(df, key, order_by, cols, keep_order, "max")


def first_attrs_last_status(df: DataFrame, key, first_cols, last_cols, order_by: Sequence = (),
                            keep_order: bool = False) -> DataFrame:
    """Merge upsert: attributes from the first row per key, status columns from the last row.

    Input rows may be raw rows (ordered by ``order_by``) or stored rows that carry
    ``_order_first`` / ``_order_last`` from an earlier run; both merge the same way, so a merge
    of batches equals the unsplit result.
    """
    if ORDER_FIRST in df.columns:
        o_first, o_last = F.col(ORDER_FIRST), F.col(ORDER_LAST)
    else:
        o_first = o_last = _order_struct(order_by, _names(key))
    return _first_last(df, _names(key), _names(first_cols), _names(last_cols), o_first, o_last, keep_order)


def _first_last(df: DataFrame, key: list[str], first_cols: list[str], last_cols: list[str], o_first: Column, o_last: Column,
                keep_order: bool) -> DataFrame:
    """Per key ``first_cols`` of the row that is first by ``o_first`` and ``last_cols`` of the one last by ``o_last``."""
    out = df.groupBy(*key).agg(_extreme("min", o_first, first_cols, df).alias("_first"),
                               _extreme("max", o_last, last_cols, df).alias("_last"))
    cols_out = ([F.col(k) for k in key] + [F.col(f"_first.p.{c}").alias(c) for c in first_cols]
                + [F.col(f"_last.p.{c}").alias(c) for c in last_cols])
    if keep_order:
        cols_out += [F.col("_first.o").alias(ORDER_FIRST), F.col("_last.o").alias(ORDER_LAST)]
    return out.select(*cols_out)


def _first_last_of_batches(batches: Sequence[DataFrame], key: list[str], first_cols: list[str], last_cols: list[str],
                           order_by: Sequence, first_batch_no: int, batch_order: bool) -> DataFrame:
    """Raw batches with ``first_attrs_last_status``, order columns kept.

    Structs are compared, so Spark sorts a task's rows by key before its map-side aggregate. The rows hold the order
    once, as plain columns; the structs are made of them in the aggregate."""
    _order_struct(order_by)   # refuses an empty order
    order = [(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}") for i, c in enumerate(order_by)]
    u = None
    for i, b in enumerate(batches):
        rows = b.select(*key, *first_cols, *last_cols, *order, F.lit(first_batch_no + i).alias(BATCH))
        u = rows if u is None else u.unionByName(rows)
    o = _order_struct([f"_o{i}" for i in range(len(order))])
    if batch_order:
        o = F.struct(F.col(BATCH).alias("b"), o.alias("o"))
    return _first_last(u, key, first_cols, last_cols, o, o, keep_order=True)


def _with_batch_order(df: DataFrame, batch_no: int, order_by: Sequence, batch_order: bool = True) -> DataFrame:
    """Raw batch rows get an order struct, prefixed by the batch number for arrival order."""
    o = (F.struct(F.lit(batch_no).alias("b"), _order_struct(order_by).alias("o")) if batch_order
         else _order_struct(order_by))
    return df.withColumn(ORDER_FIRST, o).withColumn(ORDER_LAST, o)


def stored_batch_no(target: DataFrame) -> int | None:
    """Largest batch number in a stored result of ``merge_into``; None if it has no rows."""
    last = ORDER_LAST if ORDER_LAST in target.columns else ORDER_FIRST
    return target.agg(F.max(F.greatest(F.col(f"{ORDER_FIRST}.b"), F.col(f"{last}.b"))).alias("b")).first()["b"]


def merge_into(target: DataFrame | None, batches: Sequence[DataFrame], key, mode: str, order_by: Sequence,
               first_cols=None, last_cols=None, cols=None, first_batch_no: int | None = None,
               batch_order: bool = True) -> DataFrame:
    """Merge new batches into stored rows with one of the keyed semantics.

    ``target`` is a previous result of ``merge_into`` (it carries the order columns) or None.
    With ``batch_order`` (arrival order) batches are numbered from ``first_batch_no`` (default: after
    the largest number stored in ``target``, from 0 without one) and the batch number decides first, then ``order_by``; without it only ``order_by`` (event order)
    decides, so the result does not depend on the order in which batches arrive. The result
    carries ``_order_first``/``_order_last`` so it can be merged again; drop them with
    ``drop_merge_columns`` before publishing.
    """
    if first_batch_no is None:
        first_batch_no = 0
        if target is not None and batch_order:
            held = stored_batch_no(target)
            first_batch_no = 0 if held is None else held + 1
    key = _names(key)
    if mode == "first_attrs_last_status" and batches:   # reduced before they meet the stored rows
        parts = [_first_last_of_batches(batches, key, _names(first_cols), _names(last_cols), order_by, first_batch_no, batch_order)]
        if target is None:
            return parts[0]
    else:
        parts = [_with_batch_order(b, first_batch_no + i, order_by, batch_order) for i, b in enumerate(batches)]
    if target is not None:
        if ORDER_LAST not in target.columns:
            target = target.withColumn(ORDER_LAST, F.col(ORDER_FIRST))
        parts.insert(0, target)
    if not parts:
        raise ValueError("nothing to merge")
    if mode == "first_attrs_last_status":
        base = [p.select(*key, *_names(first_cols), *_names(last_cols), ORDER_FIRST, ORDER_LAST) for p in parts]
    else:
        payload = _payload(parts[-1], key, cols, (ORDER_FIRST, ORDER_LAST, BATCH))
        base = [p.select(*key, *payload, ORDER_FIRST, ORDER_LAST) for p in parts]
    u = base[0]
    for p in base[1:]:
        u = u.unionByName(p)
    if mode == "keep_first":
        return keep_first(u.drop(ORDER_LAST), key, keep_order=True).withColumn(ORDER_LAST, F.col(ORDER_FIRST))
    if mode == "last_write_wins":
        return (last_write_wins(u.drop(ORDER_FIRST).withColumnRenamed(ORDER_LAST, ORDER_FIRST), key,
                                keep_order=True).withColumn(ORDER_LAST, F.col(ORDER_FIRST)))
    if mode == "first_attrs_last_status":
        return first_attrs_last_status(u, key, first_cols, last_cols, keep_order=True)
    raise ValueError(f"unknown merge mode {mode!r}")


def drop_merge_columns(df: DataFrame) -> DataFrame:
    return df.drop(ORDER_FIRST, ORDER_LAST, BATCH)
