"""The eight order-stream applications, composed from rivulet operators.

Each takes topic tables (``topic, partition, offset, timestamp, key,
value``) and returns its output records.  The batch forms compute exactly
what the record-at-a-time application emits for the same log; the stream
forms are the Structured Streaming plans (see each function).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.time import timestamp_to_millis
from rivulet.operators import (combine_orders, enrich_asof, enrich_latest, interval_join,
                               order_number_chain, quarantine_non_numeric, running_sum,
                               table_order_changelog, table_snapshot, tumbling_sum_final,
                               tumbling_sum_updates, with_event_time)
from rivulet.operators.stateless import hello_values
from rivulet.streaming.sinks import running_sum_writer, window_writer
from rivulet.streaming.stateful import running_sum_stream, window_stream, with_state_before

# Parameters of the applications.
ORDER_MARKER = "order-"
ERROR_MARKER = "orderNumber-"
ORDER_THRESHOLD = 1000
WINDOW_SIZE = "10 seconds"
WINDOW_GRACE = "5 seconds"
JOIN_WINDOW = "30 minutes"


def hello_app(users: DataFrame) -> DataFrame:
    """Greeting for every value of a keyless topic."""
    return hello_values(users, "value", "greeting").select("greeting")


def basic_app(topic: DataFrame, marker: str = ORDER_MARKER,
              threshold: int = ORDER_THRESHOLD) -> DataFrame:
    """contains marker -> text after the dash -> number above threshold."""
    return order_number_chain(topic, marker, threshold).select("offset", "key", "value")


def table_app(topic: DataFrame, marker: str = ORDER_MARKER,
              threshold: int = ORDER_THRESHOLD) -> DataFrame:
    """The same chain over an upsert table: one update (or delete) per input."""
    return table_order_changelog(topic, marker, threshold, "key", "offset", "value")


def _orders(topic: DataFrame) -> DataFrame:
    return topic.select("partition", "offset", "timestamp", "key",
                        F.col("value.price").alias("price"), F.col("value.time").alias("time"))


def aggregate_app(orders: DataFrame) -> DataFrame:
    """Running total of price per key: one output per input record.

    Stream form: exact per-record totals with state per key (append mode);
    ``aggregate_app_before`` with ``aggregate_app_writer`` also splits hot keys
    inside a micro-batch.
    """
    o = _orders(orders)
    if o.isStreaming:
        return running_sum_stream(o, "key", "price", ["offset"], "total") \
            .select("offset", "key", "total")
    return running_sum(o, "key", ["offset"], "price", "total").select("offset", "key", "total")


def windows_app(orders: DataFrame, size: str = WINDOW_SIZE, grace: str = WINDOW_GRACE
                ) -> DataFrame:
    """Final sum per key and tumbling window (record time), late records
    dropped per partition; the window key is turned back into the plain key.

    Stream form (``append`` mode): every topic partition follows its own clock,
    record by record; there is no watermark.
    """
    o = _orders(orders)
    if o.isStreaming:
        return window_stream(o, "key", "timestamp", "price", size, grace, "partition", ["offset"], "total", "final")
    return tumbling_sum_final(o, key="key", ts="timestamp", value="price", size=size,
                              grace=grace, partition="partition", order=["offset"],
                              out="total")


def time_app(orders: DataFrame, size: str = WINDOW_SIZE) -> DataFrame:
    """Window sums on event time taken from the payload, no grace, every
    update emitted.  Stream form (``append`` mode): one update per accepted
    record, every topic partition by its own clock."""
    o = with_event_time(_orders(orders), "time", "event_time")
    if o.isStreaming:
        return window_stream(o, "key", "event_time", "price", size, "0 seconds", "partition", ["offset"], "total",
                             "updates").select("offset", "key", "window_start", "total")
    return tumbling_sum_updates(o, key="key", ts="event_time", value="price", size=size,
                                grace="0 seconds", partition="partition", order=["offset"],
                                out="total").select("offset", "key", "window_start", "total")


def aggregate_app_before(orders: DataFrame) -> DataFrame:
    """Order records with their key's total before the micro-batch: the stream
    that ``aggregate_app_writer`` takes."""
    return with_state_before(_orders(orders), "key", "price")


def aggregate_app_writer(out_path: str, **kw) -> Callable[[DataFrame, int], None]:
    """``aggregate_app`` as a ``foreachBatch`` sink: hot keys are split."""
    return running_sum_writer(out_path, "key", value="price", out="total", **kw)


def windows_app_writer(out_path: str, state_path: str, size: str = WINDOW_SIZE, grace: str = WINDOW_GRACE,
                       **kw) -> Callable[[DataFrame, int], None]:
    """``windows_app`` as a ``foreachBatch`` sink: the batch form's windows on
    any number of partitions, and hot partitions are split."""
    fn = window_writer(out_path, state_path, "key", "timestamp", "price", size, grace, emit="final", **kw)
    return lambda batch, batch_id: fn(_orders(batch), batch_id)


def time_app_writer(out_path: str, state_path: str, size: str = WINDOW_SIZE, **kw
                    ) -> Callable[[DataFrame, int], None]:
    """``time_app`` as a ``foreachBatch`` sink: one update per accepted record."""
    fn = window_writer(out_path, state_path, "key", "event_time", "price", size, "0 seconds", emit="updates", **kw)
    return lambda batch, batch_id: fn(with_event_time(_orders(batch), "time", "event_time"), batch_id)


def join_app(appliance: DataFrame, electronic: DataFrame, users: DataFrame,
             within: str = JOIN_WINDOW, lookup: str = "latest",
             clock: Column | None = None) -> DataFrame:
    """Appliance and electronic orders of one user within ``within`` of each
    other, combined, then enriched with the user's name.

    ``lookup='latest'`` joins the table's current snapshot (``users`` is
    then a static table even for streaming inputs); ``lookup='asof'`` takes
    the user record as of the combined order's time (batch).  ``clock``
    gives the combined record's ``time``; default: the later event time, in
    epoch ms.
    """
    a = appliance.select(F.col("key").alias("a_key"), F.col("timestamp").alias("a_ts"),
                         F.col("value.order_id").alias("a_order_id"),
                         F.col("value.appliance_id").alias("appliance_id"))
    e = electronic.select(F.col("key").alias("e_key"), F.col("timestamp").alias("e_ts"),
                          F.col("value.order_id").alias("e_order_id"))
    j = interval_join(a, e, "a_key", "e_key", "a_ts", "e_ts", within)
    j = j.withColumn("__ts", F.greatest("a_ts", "e_ts"))
    time = clock if clock is not None else timestamp_to_millis("__ts")
    combined = combine_orders(j.withColumn("__time", time), "a_key", "a_order_id",
                              "appliance_id", "e_order_id", F.col("__time"))
    if lookup == "latest":
        names = table_snapshot(users.select("key", "offset", "value"), "key", "offset", "value")
        names = names.select(F.col("key").alias("u_key"), F.col("value.name").alias("name"))
        return enrich_latest(combined, names, "key", "u_key", "name", "user_name")
    if lookup != "asof":
        raise ValueError(f"unknown lookup {lookup!r}")
    if clock is not None:
        raise ValueError("the as-of lookup needs the event-time clock (clock=None)")
    combined = combined.withColumn("__ts", F.timestamp_millis("time"))
    changes = users.select("key", "offset", "timestamp", F.col("value.name").alias("name"),
                           F.col("value").isNull().alias("__deleted"))
    r = enrich_asof(combined, changes, "key", "key", "__ts", "timestamp", ["name"],
                    change_order="offset", deleted=F.col("__deleted"), out_cols=["__name"])
    return r.withColumn("user_name", F.coalesce("__name", "user_name")).drop("__name", "__ts")


def errors_app(topic: DataFrame, marker: str = ERROR_MARKER,
               threshold: int = ORDER_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """The basic chain with the error app's marker, plus the side output of
    records whose order number does not parse (instead of a crash)."""
    good = order_number_chain(topic, marker, threshold).select("offset", "key", "value")
    return good, quarantine_non_numeric(topic, marker)
