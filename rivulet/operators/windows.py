"""Event time, stream time, lateness and tumbling windows (batch forms).

Lateness follows the per-partition rule of a keyed log: the *stream time*
of a topic partition is the highest event time seen so far on it, in
arrival order; a record is late (dropped) when its window's end plus the
grace period is at or before the stream time.  A window's final result is
the one emitted when the stream time passes ``end + grace``.

Streaming forms live in ``rivulet.streaming``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.sums import order_free_sum
from rivulet.functions.time import interval, millis_to_timestamp
from rivulet.operators.scan import DEFAULT_ROWS_PER_CHUNK, running


def with_event_time(df: DataFrame, millis: str = "time", out: str = "event_time") -> DataFrame:
    """Event time from an epoch-millisecond payload field.

    A negative time cannot be an event time: such records are skipped.
    """
    return df.filter(F.col(millis) >= 0).withColumn(out, millis_to_timestamp(millis))


def window_start(ts: str, size: str) -> Column:
    """Start of the epoch-aligned tumbling window of ``size`` holding ``ts``."""
    return F.window(ts, size).start


def stream_time(df: DataFrame, partition: str = "partition",
                order: Sequence[str] = ("offset",), ts: str = "timestamp",
                out: str = "stream_time", chunk: Column | None = None,
                rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Running max of event time per topic partition in arrival order.

    A topic partition holds many rows, so each is cut into chunks of about
    ``rows_per_chunk`` rows along the arrival order (``operators.scan``)."""
    return running(df, [partition], list(order), ts, "max", out, chunk, rows_per_chunk)


def mark_late(df: DataFrame, ts: str = "timestamp", size: str = "10 seconds",
              grace: str = "0 seconds", partition: str = "partition",
              order: Sequence[str] = ("offset",), chunk: Column | None = None,
              rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Add ``window_start``, ``stream_time`` and ``is_late`` to each record."""
    d = stream_time(df, partition, order, ts, "stream_time", chunk, rows_per_chunk)
    d = d.withColumn("window_start", window_start(ts, size))
    closes = F.col("window_start") + interval(size) + interval(grace)
    return d.withColumn("is_late", closes <= F.col("stream_time"))


def drop_late(df: DataFrame, **kw) -> DataFrame:
    """Records accepted under the grace rule (the on-time ones)."""
    return mark_late(df, **kw).filter(~F.col("is_late"))


def late_records(df: DataFrame, **kw) -> DataFrame:
    """The records the grace rule drops -- kept as a side output for audit."""
    return mark_late(df, **kw).filter(F.col("is_late"))


def _sum(value: str, exact_scale: int | None) -> Column:
    if exact_scale is None:
        return order_free_sum(value)
    return F.sum(F.col(value).cast(f"decimal(18,{exact_scale})")).cast("double")


def tumbling_sum(df: DataFrame, key: str = "key", ts: str = "timestamp",
                 value: str = "value", size: str = "10 seconds", out: str = "total",
                 exact_scale: int | None = None) -> DataFrame:
    """Sum per key and epoch-aligned tumbling window, every record counted."""
    d = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    return (d.groupBy(key, F.window(ts, size).start.alias("window_start"))
            .agg(_sum(value, exact_scale).alias(out)))


def tumbling_sum_final(df: DataFrame, key: str = "key", ts: str = "timestamp",
                       value: str = "value", size: str = "10 seconds",
                       grace: str = "0 seconds", partition: str = "partition",
                       order: Sequence[str] = ("offset",), out: str = "total",
                       exact_scale: int | None = None, chunk: Column | None = None,
                       rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Final window sums only: late records dropped, and only windows that
    the stream has closed (``end + grace <= final stream time`` of the
    partition) are emitted -- the window holding the newest records is not.
    """
    # every record advances its partition's stream time, also those the
    # aggregate then skips (null key or value)
    on_time = drop_late(df, ts=ts, size=size, grace=grace, partition=partition,
                        order=order, chunk=chunk, rows_per_chunk=rows_per_chunk)
    on_time = on_time.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    sums = (on_time.groupBy(partition, key, "window_start")
            .agg(_sum(value, exact_scale).alias(out)))
    # One row per topic partition: the broadcast is bounded by the
    # partition count of the topic, not by the data.
    final_st = F.broadcast(df.groupBy(partition).agg(F.max(ts).alias("__final_st")))
    closed = sums.join(final_st, partition).filter(
        F.col("window_start") + interval(size) + interval(grace) <= F.col("__final_st"))
    return closed.select(key, "window_start", out)


def tumbling_sum_updates(df: DataFrame, key: str = "key", ts: str = "timestamp",
                         value: str = "value", size: str = "10 seconds",
                         grace: str = "0 seconds", partition: str = "partition",
                         order: Sequence[str] = ("offset",), out: str = "total",
                         exact_scale: int | None = None, chunk: Column | None = None,
                         rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Every update of every window (no suppression): one output per
    accepted record, the window's running sum in arrival order."""
    on_time = drop_late(df, ts=ts, size=size, grace=grace, partition=partition,
                        order=order, chunk=chunk, rows_per_chunk=rows_per_chunk)
    on_time = on_time.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    amt = F.col(value).cast(f"decimal(18,{exact_scale})") if exact_scale is not None \
        else F.col(value)
    on_time = on_time.withColumn("__amount", amt)
    # hot (key, window) groups are sized from all records, not the on-time
    # ones: same answer shape, and the stream-time plan is not run again
    every = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull()) \
        .withColumn("window_start", window_start(ts, size))
    r = running(on_time, [key, "window_start"], list(order), "__amount", "sum", out, chunk,
                rows_per_chunk, stats_from=every)
    if exact_scale is not None:
        r = r.withColumn(out, F.col(out).cast("double"))
    return r.drop("__amount")
