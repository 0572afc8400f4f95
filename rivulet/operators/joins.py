"""Interval join of two streams and table enrichment (latest or as-of)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.time import duration_micros, interval, local_time_to_micros
from rivulet.operators.scan import DEFAULT_ROWS_PER_CHUNK, running


def _micros(df: DataFrame, c: str) -> Column:
    if isinstance(df.schema[c].dataType, T.TimestampNTZType):
        return local_time_to_micros(c)
    return F.unix_micros(F.col(c))


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_ts: str, right_ts: str, within: str = "30 minutes",
                  watermark: str | None = "24 hours") -> DataFrame:
    """Inner join of records with the same key whose times differ by at most
    ``within`` (both ends inclusive).  Null keys never match.

    Besides the key, both sides are matched on a time bucket of width
    ``2 * within``: the window ``[t - within, t + within]`` of a left record
    covers exactly two consecutive buckets, so each left record is offered
    to those two and each right record sits in one -- every pair is found
    exactly once, and a hot key is spread over its time buckets instead of
    pairing all its rows in one task.  Column names of the two sides must
    differ.

    On streaming inputs both sides get ``withWatermark(watermark)`` (the
    join state retention; 24 hours by default) on their time column, which
    must then be a TIMESTAMP.
    """
    half = duration_micros(within)
    width = max(1, 2 * half)   # a width of 0 still needs a bucket
    if left.isStreaming and watermark:
        left = left.withWatermark(left_ts, watermark)
    if right.isStreaming and watermark:
        right = right.withWatermark(right_ts, watermark)
    # bucket of the window's start; its end (start + width) is in the next one
    lb = F.floor((_micros(left, left_ts) - F.lit(half)) / F.lit(width)).cast("long")
    left_b = left.filter(F.col(left_key).isNotNull()).withColumn(
        "__lbucket", F.explode(F.array(lb, lb + 1)))
    right_b = right.filter(F.col(right_key).isNotNull()).withColumn(
        "__rbucket", F.floor(_micros(right, right_ts) / F.lit(width)).cast("long"))
    cond = ((F.col(left_key) == F.col(right_key))
            & (F.col("__lbucket") == F.col("__rbucket"))
            & F.col(right_ts).between(F.col(left_ts) - interval(within),
                                      F.col(left_ts) + interval(within)))
    return left_b.join(right_b, cond, "inner").drop("__lbucket", "__rbucket")


def combine_orders(joined: DataFrame, key: str, appliance_order_id: str, appliance_id: str,
                   electronic_order_id: str, time: Column) -> DataFrame:
    """Value joiner of the order join: one combined order per matched pair.

    ``time`` is the combined record's time; the original takes the wall
    clock, here it is a parameter so results are reproducible (e.g.
    ``greatest`` of the two event times, or ``unix_millis(current_timestamp())``).
    ``user_name`` starts at its default, the empty string.
    """
    return joined.select(
        F.col(key).alias("key"),
        F.col(electronic_order_id).alias("electronic_order_id"),
        F.col(appliance_order_id).alias("appliance_order_id"),
        F.col(appliance_id).alias("appliance_id"),
        F.lit("").alias("user_name"),
        time.alias("time"))


def enrich_latest(stream: DataFrame, table: DataFrame, stream_key: str, table_key: str,
                  name_col: str, out: str = "user_name", default: str = "") -> DataFrame:
    """Left lookup of each stream record in the table's current snapshot;
    ``out`` takes the table's ``name_col`` when matched, else keeps its
    value (or ``default``).  Stream records with a null key are skipped.

    No broadcast hint: the planner broadcasts the table only when its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE
    re-checks at run time) and shuffles both sides otherwise.
    """
    t = table.select(F.col(table_key).alias("__tkey"), F.col(name_col).alias("__tname"))
    s = stream.filter(F.col(stream_key).isNotNull())
    j = s.join(t, F.col(stream_key) == F.col("__tkey"), "left")
    current = F.col(out) if out in stream.columns else F.lit(default)
    return j.withColumn(out, F.coalesce(F.col("__tname"), current, F.lit(default))) \
        .drop("__tkey", "__tname")


def enrich_asof(stream: DataFrame, changes: DataFrame, stream_key: str, change_key: str,
                stream_ts: str, change_ts: str, value_cols: Sequence[str],
                change_order: str | None = None, deleted: Column | None = None,
                out_cols: Sequence[str] | None = None, chunk: Column | None = None,
                rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Each stream record joined with the table value *as of* its time: the
    last change of its key at or before the record's time (left join).

    ``changes`` is the table's changelog.  ``deleted`` marks tombstones: a
    tombstone clears the value for later records.  Ties on time take the
    change first.  Computed as one running "last" over the union of both
    sides (see ``operators.scan``), so no key is gathered in one task and no
    record is paired with more than one change.  ``out_cols`` renames the
    looked-up values (default: their names in ``changes``).
    """
    u = asof_union(stream, changes, stream_key, change_key, stream_ts, change_ts, value_cols,
                   change_order, deleted)
    return asof_resolve(u, value_cols, out_cols, chunk, rows_per_chunk)


def asof_union(stream: DataFrame, changes: DataFrame, stream_key: str, change_key: str,
               stream_ts: str, change_ts: str, value_cols: Sequence[str],
               change_order: str | None = None, deleted: Column | None = None) -> DataFrame:
    """Both sides of an as-of lookup in one frame (batch or stream):
    ``__k`` key, ``__t`` time, ``__side`` (0 change, 1 record), ``__tie``,
    ``__v`` the change's values (a struct of nulls for a tombstone) and
    ``__row`` the record."""
    vals = [F.col(c).alias(c) for c in value_cols]
    change_val = F.struct(*vals) if deleted is None else \
        F.when(~deleted, F.struct(*vals)).otherwise(
            F.struct(*[F.lit(None).cast(changes.schema[c].dataType).alias(c)
                       for c in value_cols]))
    tie = F.col(change_order).cast("long") if change_order else F.lit(0).cast("long")
    srow = F.struct(*[F.col(c).alias(c) for c in stream.columns])
    row_type = stream.select(srow.alias("r")).schema["r"].dataType
    a = changes.filter(F.col(change_key).isNotNull()).select(
        F.col(change_key).alias("__k"), F.col(change_ts).alias("__t"),
        F.lit(0).alias("__side"), tie.alias("__tie"),
        change_val.alias("__v"), F.lit(None).cast(row_type).alias("__row"))
    b = stream.filter(F.col(stream_key).isNotNull()).select(
        F.col(stream_key).alias("__k"), F.col(stream_ts).alias("__t"),
        F.lit(1).alias("__side"), F.lit(0).cast("long").alias("__tie"),
        F.lit(None).cast(a.schema["__v"].dataType).alias("__v"), srow.alias("__row"))
    return a.unionByName(b)


def asof_resolve(u: DataFrame, value_cols: Sequence[str], out_cols: Sequence[str] | None = None,
                 chunk: Column | None = None, rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK
                 ) -> DataFrame:
    """The records of an ``asof_union`` frame with their looked-up values."""
    r = running(u, ["__k"], ["__t", "__side", "__tie"], "__v", "last", "__asof", chunk,
                rows_per_chunk)
    r = r.filter(F.col("__side") == 1)
    outs = list(out_cols or value_cols)
    return r.select("__row.*", *[F.col(f"__asof.{c}").alias(o) for c, o in zip(value_cols, outs)])
