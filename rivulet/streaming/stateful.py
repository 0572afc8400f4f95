"""Per-record stateful stream operators on Spark's own state store.

Every operator is a ``transformWithState`` processor: its state variables live
in the RocksDB store of the query's checkpoint, a micro-batch reads and writes
the keys it touches (never the history), a replayed micro-batch starts from the
version before it, and ``read_state`` shows any variable as a DataFrame through
the ``statestore`` reader.

Spark's native streaming aggregates emit once per key per micro-batch and close
windows by one watermark for the whole query.  Where the result must be per
record, or every topic partition must follow its own clock, these operators keep
the state themselves.

A processor gets the rows of one key (or topic partition) of one micro-batch.
Where the order within it matters they are held and sorted, so size the
micro-batch (``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``) by what a task
can hold; ``with_state_before`` streams through instead, and its writers in
``streaming.sinks`` leave the ordering to the batch operators, which split hot
keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rivulet.functions.hashing import log_partition
from rivulet.functions.time import as_event_time, duration_micros, local_time_to_micros
from rivulet.operators.quality import (DEFAULT_ERROR_BUDGET, DEFAULT_MAX_RECORD_BYTES,
                                       ErrorBudgetExceeded)


def read_state(spark: SparkSession, checkpoint: str, variable: str, operator: int = 0) -> DataFrame:
    """A state variable of a query as of its last finished micro-batch: the
    key's columns and the value's, flat.  ``variable``: as named by the
    operator (see each one)."""
    s = (spark.read.format("statestore").option("operatorId", operator)
         .option("stateVarName", variable).load(checkpoint))
    parts = [c for c in ("key", "user_map_key", "value", "user_map_value") if c in s.columns]
    return s.select(*[f"{c}.*" for c in parts])


def _micros(df: DataFrame, c: str) -> Column:
    if isinstance(df.schema[c].dataType, T.TimestampNTZType):
        return local_time_to_micros(c)
    return F.unix_micros(F.col(c).cast("timestamp"))


def _from_micros(c: str, like: T.DataType) -> Column:
    """Epoch microseconds as a time of type ``like``."""
    if isinstance(like, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", F.col(c), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))
    return F.timestamp_micros(c)


def _named(rows: Iterator[pd.DataFrame], names: list[str]) -> Iterator[pd.DataFrame]:
    """Frames under their column names: names that are no identifiers, or begin
    with an underscore, arrive as positions."""
    for pdf in rows:
        pdf.columns = names
        yield pdf


def _in_order(rows: Iterator[pd.DataFrame], names: list[str], order: Sequence[str]) -> pd.DataFrame:
    return pd.concat(list(_named(rows, names)), ignore_index=True).sort_values(list(order), kind="stable", ignore_index=True)


def _state(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def _plain(v: Any) -> Any:
    """A cell as a Python value; missing ones as None."""
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    return v.item() if hasattr(v, "item") else v


def _cell(v: Any, kind: T.DataType) -> Any:
    """The same, with whole numbers whole: a column with nulls arrives as floats."""
    v = _plain(v)
    return int(v) if isinstance(kind, T.IntegralType) and v is not None else v


# ---- user folds -----------------------------------------------------------

@dataclass(frozen=True)
class StreamFold:
    """A user's fold, one record at a time: the initializer and aggregator of a
    keyed stream application.

    ``initial``: the accumulator a key starts from (a tuple); ``step(acc, row)``:
    the accumulator after a record (``row``: dict of its columns); ``state``: the
    accumulator's DDL; ``finish(acc)``: the result."""

    initial: tuple
    step: Callable[[tuple, dict], tuple]
    state: str
    finish: Callable[[tuple], Any] = lambda acc: acc[0]


class _FoldRows(StatefulProcessor):
    """State ``acc``: the accumulator of a key."""

    def __init__(self, fold: StreamFold, order: list[str], fields: list[T.StructField], out: str):
        self.fold, self.order, self.cols, self.out = fold, order, [f.name for f in fields], out
        self.kinds = [f.dataType for f in fields]
        self.schema = T.StructType.fromDDL(fold.state)      # needs the driver's session

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        acc = tuple(self.acc.get()) if self.acc.exists() else self.fold.initial
        pdf = _in_order(rows, self.cols, self.order)
        results = []
        for values in zip(*[pdf[c] for c in self.cols]):
            acc = self.fold.step(acc, {c: _cell(v, t) for c, v, t in zip(self.cols, values, self.kinds)})
            results.append(self.fold.finish(acc))
        self.acc.update(acc)
        pdf[self.out] = pd.Series(results, dtype=object)
        yield pdf[[*self.cols, self.out]]

    def close(self) -> None:
        pass


def fold_stream(df: DataFrame, key: str, order: Sequence[str], fold: StreamFold, out: str = "folded",
                out_type: str = "double") -> DataFrame:
    """One output per record: the user's fold of its key so far, in ``order``.

    Records with a null key belong to none.  State variable: ``acc``.  Output
    mode ``append``.  The batch twin is ``operators.fold_updates``, which needs
    an associative merge instead of a step."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T._parse_datatype_string(out_type))])
    return df.filter(F.col(key).isNotNull()).groupBy(key).transformWithStateInPandas(
        _FoldRows(fold, list(order), df.schema.fields, out), schema, "append", "none")


def _affine_fold(x: np.ndarray, acc0: float, decay: float, block: int = 256) -> np.ndarray:
    """Running ``acc = acc * decay + x`` over ``x``, vectorised per block:
    inside a block of ``b`` rows the running values are one ``b x b``
    lower-triangular product (weights ``decay ** (k - i)``), so no Python
    loop runs per record and no large powers appear."""
    out = np.empty(len(x), dtype="float64")
    acc = float(acc0)
    for s in range(0, len(x), block):
        xb = x[s:s + block]
        b = len(xb)
        k = np.arange(b)
        expo = k[:, None] - k[None, :]
        w = np.where(expo >= 0, np.power(decay, np.clip(expo, 0, None)), 0.0)
        run = w @ xb + acc * np.power(decay, k + 1)
        out[s:s + b] = run
        acc = float(run[-1])
    return out


class _Affine(StatefulProcessor):
    """State ``acc``: ``acc * decay + value`` over a key's records."""

    def __init__(self, value: str, order: list[str], cols: list[str], out: str, initial: float, decay: float):
        self.value, self.order, self.cols, self.out = value, order, cols, out
        self.initial, self.decay = float(initial), float(decay)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", _state(acc=T.DoubleType()))

    def handleInputRows(self, key, rows, timerValues):
        acc = self.acc.get()[0] if self.acc.exists() else self.initial
        pdf = _in_order(rows, self.cols, self.order)
        x = pdf[self.value].to_numpy(dtype=np.float64)
        pdf[self.out] = acc + np.cumsum(x) if self.decay == 1.0 else _affine_fold(x, acc, self.decay)
        self.acc.update((float(pdf[self.out].iloc[-1]),))
        yield pdf[[*self.cols, self.out]]

    def close(self) -> None:
        pass


def fold_by_key_stream(df: DataFrame, key: str = "key", order: Sequence[str] = ("offset",),
                       value: str = "value", out: str = "folded", init: float = 0.0,
                       decay: float = 1.0) -> DataFrame:
    """Ordered fold ``acc = acc * decay + value`` per key on a stream.

    One output per input record (the fold so far); null keys and values are
    skipped.  State variable: ``acc``.  Output mode ``append``.
    """
    cols = list(df.columns)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
    d = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return d.groupBy(key).transformWithStateInPandas(
        _Affine(value, list(order), cols, out, init, decay), schema, "append", "none")


def running_sum_stream(df: DataFrame, key: str = "key", value: str = "value",
                       order: Sequence[str] = ("offset",), out: str = "total") -> DataFrame:
    """One output per input record: the key's total so far, in ``order``: the
    fold with nothing decaying.  State variable: ``acc``."""
    return fold_by_key_stream(df, key, order, value, out, 0.0, 1.0)


# ---- what a key's state was before the micro-batch --------------------------

class _Before(StatefulProcessor):
    """State ``state``: the sum (or the greatest) of a key's values.  Rows are
    passed on batch by batch as they come, none is held."""

    def __init__(self, how: str, value: str, cols: list[str], out: str):
        self.how, self.value, self.cols, self.out = how, value, cols, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", _state(state=T.DoubleType() if self.how == "sum" else T.LongType()))

    def handleInputRows(self, key, rows, timerValues):
        before = self.state.get()[0] if self.state.exists() else None
        after = before
        for pdf in _named(rows, self.cols):
            own = pdf[self.value].dropna()
            if len(own):
                new = float(own.sum()) if self.how == "sum" else int(own.max())
                after = new if after is None else after + new if self.how == "sum" else max(after, new)
            out = pdf[self.cols].copy()
            out[self.out] = pd.Series([before] * len(out), dtype="float64" if self.how == "sum" else "Int64", index=out.index)
            yield out
        if after is not None:
            self.state.update((after,))

    def close(self) -> None:
        pass


def with_state_before(df: DataFrame, key: str, value: str, how: str = "sum", out: str = "__before") -> DataFrame:
    """Every record with the sum (``how='max'``: the greatest, a long) of
    ``value`` over its key's records of *earlier* micro-batches, null if none.

    No order is needed and no row is held, so a key of any size streams through;
    ``running_sum_writer`` and ``mark_late_writer`` add what happens within the
    micro-batch with the batch operators.  State variable: ``state``."""
    if how not in ("sum", "max"):
        raise ValueError("how is 'sum' or 'max'")
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType() if how == "sum" else T.LongType())])
    return df.filter(F.col(key).isNotNull()).groupBy(key).transformWithStateInPandas(
        _Before(how, value, list(df.columns), out), schema, "append", "none")


def with_clock_before(df: DataFrame, partition: str = "partition", ts: str = "timestamp", out: str = "__before") -> DataFrame:
    """Every record with its topic partition's stream time (epoch microseconds)
    after earlier micro-batches, null if none: ``mark_late_writer``'s input."""
    return with_state_before(df.withColumn("rv_us", _micros(df, ts)), partition, "rv_us", "max", out).drop("rv_us")


# ---- bad input ---------------------------------------------------------------

class _Budget(StatefulProcessor):
    """State ``bad``: bad records so far, over all partitions and restarts."""

    def __init__(self, budget: int, cols: list[str], order: list[str]):
        self.budget, self.cols, self.order = budget, cols, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bad = handle.getValueState("bad", _state(bad=T.LongType()))

    def handleInputRows(self, key, rows, timerValues):
        before = self.bad.get()[0] if self.bad.exists() else 0
        kept = []               # at most the rest of the budget, and the record after it
        for pdf in _named(rows, self.cols):
            kept = [pd.concat([*kept, pdf]).sort_values(self.order, kind="stable").head(max(self.budget - before, 0) + 1)]
        pdf = kept[0].reset_index(drop=True)
        if before + len(pdf) > self.budget:
            at = ", ".join(f"{c} {pdf[c].iloc[-1]}" for c in self.order)
            raise ErrorBudgetExceeded(f"bad record budget of {self.budget} exceeded at {at}")
        self.bad.update((before + len(pdf),))
        pdf["nth_bad"] = before + 1 + pd.RangeIndex(len(pdf))
        yield pdf[[c for c in self.cols if c != "rv_all"] + ["nth_bad"]]

    def close(self) -> None:
        pass


def budget_stream(tagged: DataFrame, budget: int = DEFAULT_ERROR_BUDGET, value: str = "value",
                  order: Sequence[str] = ("offset", "partition")) -> DataFrame:
    """What ``read_topic(on_bad='tag')`` gives, with a budget of bad records.

    Good records pass untouched; bad ones are counted in the state store, in
    ``order`` within a micro-batch, and come out with their number in
    ``nth_bad`` (null for good ones).  The record over the budget fails the
    query (``ErrorBudgetExceeded``), before its micro-batch is committed, and
    does so again after a restart, whichever partitions the earlier ones came
    from.  Only bad records pass through the processor, and it holds no more of
    them than the budget.  State variable: ``bad``.  Output mode ``append``.
    """
    good = tagged.filter(~F.col("bad")).withColumn("nth_bad", F.lit(None).cast("long"))
    flat = tagged.filter("bad").drop(value).withColumn("rv_all", F.lit(0))
    schema = T.StructType([*[f for f in flat.schema.fields if f.name != "rv_all"], T.StructField("nth_bad", T.LongType())])
    bad = flat.groupBy("rv_all").transformWithStateInPandas(_Budget(budget, flat.columns, list(order)), schema, "append", "none")
    bad = bad.withColumn(value, F.lit(None).cast(tagged.schema[value].dataType))
    return good.unionByName(bad)


# ---- producing: partitions and offsets ---------------------------------------

class _Offsets(StatefulProcessor):
    """State ``next``: the offset that a topic partition's next record gets."""

    def __init__(self, order: list[str], cols: list[str]):
        self.order, self.cols = order, cols

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.next = handle.getValueState("next", _state(next=T.LongType()))

    def handleInputRows(self, key, rows, timerValues):
        at = self.next.get()[0] if self.next.exists() else 0
        pdf = _in_order(rows, self.cols, self.order)
        good = pdf["error"].isna()
        pdf["offset"] = (at - 1 + good.cumsum()).where(good).astype("Int64")
        self.next.update((at + int(good.sum()),))
        yield pdf[[c for c in self.cols if not c.startswith("rv_o")] + ["offset"]]

    def close(self) -> None:
        pass


def produce_stream(df: DataFrame, topic: str, key: Column | str, order: Sequence[str], *,
                   value: Column | None = None, time_millis: Column | str | None = None,
                   partitions: int = 1, max_bytes: int = DEFAULT_MAX_RECORD_BYTES) -> DataFrame:
    """A stream as topic records with their partitions and offsets.

    The log's partitioner places a key (records without one go to partition 0);
    within a partition offsets run on without a gap, in ``order`` inside a
    micro-batch, from the state store.  A replayed micro-batch gets the same
    offsets.  A record whose serialised value is over ``max_bytes`` is refused:
    ``error`` says so, and it takes no offset.  Columns: topic, partition,
    offset, timestamp, key, value (text; JSON of a struct), error.  State
    variable: ``next``.  Output mode ``append``; see ``receipts_writer``.
    """
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    v = value if value is not None else F.struct(*[F.col(c) for c in df.columns])
    kind = df.select(v.alias("v")).schema["v"].dataType
    text = F.to_json(v) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else v.cast("string")
    key_c = as_col(key).cast("string")
    millis = as_col(time_millis) if time_millis is not None else F.unix_millis(F.current_timestamp())
    size = F.octet_length(text)
    d = df.select(F.lit(topic).alias("topic"), F.coalesce(log_partition(key_c, partitions), F.lit(0)).alias("partition"),
                  millis.cast("long").alias("millis"), key_c.alias("key"), text.alias("value"),
                  F.when(size > max_bytes, F.concat(F.lit("record too large: "), size.cast("string"), F.lit(" bytes"))).alias("error"),
                  *[F.col(c).alias(f"rv_o{i}") for i, c in enumerate(order)])
    keep = [f for f in d.schema.fields if not f.name.startswith("rv_o")]
    schema = T.StructType([*keep, T.StructField("offset", T.LongType())])
    r = d.groupBy("partition").transformWithStateInPandas(
        _Offsets([f"rv_o{i}" for i in range(len(order))], d.columns), schema, "append", "none")
    return r.select("topic", "partition", "offset", F.timestamp_millis("millis").alias("timestamp"), "key", "value", "error")


# ---- lateness and windows by each partition's own clock ---------------------

class _Clock(StatefulProcessor):
    """State ``clock``: the stream time of a topic partition, in microseconds."""

    def __init__(self, order: list[str], cols: list[str], size: int, grace: int):
        self.order, self.cols, self.size, self.grace = order, cols, size, grace

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.clock = handle.getValueState("clock", _state(clock=T.LongType()))

    def judged(self, rows) -> tuple[pd.DataFrame, int | None]:
        """Records in order with ``rv_clock``, ``rv_start`` and ``rv_late``, and
        the clock after them.  A record without a time moves no clock."""
        pdf = _in_order(rows, self.cols, self.order)
        before = self.clock.get()[0] if self.clock.exists() else None
        us = pdf["rv_us"].astype("Int64")
        run = us.cummax().ffill()
        if before is not None:
            run = run.fillna(before).clip(lower=before)
        start = us // self.size * self.size
        pdf["rv_clock"], pdf["rv_start"] = run, start
        pdf["rv_late"] = (start + self.size + self.grace <= run).astype("boolean")
        now = None if pd.isna(run.iloc[-1]) else int(run.iloc[-1])
        if now is not None:
            self.clock.update((now,))
        return pdf, now

    def handleInputRows(self, key, rows, timerValues):
        pdf, _ = self.judged(rows)
        yield pdf[[*self.cols, "rv_clock", "rv_late"]]

    def close(self) -> None:
        pass


def mark_late_stream(df: DataFrame, ts: str = "timestamp", size: str = "10 seconds",
                     grace: str = "0 seconds", partition: str = "partition",
                     order: Sequence[str] = ("offset",)) -> DataFrame:
    """Judge lateness record by record, as a partitioned log does.

    Within a micro-batch the partition's records are taken in ``order``.  Adds
    ``stream_time`` (highest event time so far) and ``is_late`` (``window end +
    grace <= stream time``).  State variable: ``clock``.  Output mode ``append``.
    """
    d = df.withColumn("rv_us", _micros(df, ts))
    schema = T.StructType([*d.schema.fields, T.StructField("rv_clock", T.LongType()), T.StructField("rv_late", T.BooleanType())])
    r = d.groupBy(partition).transformWithStateInPandas(
        _Clock(list(order), d.columns, duration_micros(size), duration_micros(grace)), schema, "append", "none")
    return r.select(*df.columns, _from_micros("rv_clock", df.schema[ts].dataType).alias("stream_time"), F.col("rv_late").alias("is_late"))


class _Windows(_Clock):
    """State ``clock``; ``open``: (window start, key) -> sum so far; ``due``:
    the window starts that are open, by which the partition's clock finds the
    windows to close without looking at the others."""

    def __init__(self, order, cols, size, grace, key: str, key_type: T.DataType, value: str, updates: bool):
        super().__init__(order, cols, size, grace)
        self.key, self.key_type, self.value, self.updates = key, key_type, value, updates

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.open = handle.getMapState("open", _state(start=T.LongType(), k=self.key_type), _state(total=T.DoubleType()))
        self.due = handle.getMapState("due", _state(start=T.LongType()), _state(n=T.LongType()))

    def handleInputRows(self, key, rows, timerValues):
        pdf, now = self.judged(rows)
        kept = pdf[~pdf["rv_late"].fillna(True) & pdf[self.key].notna() & pdf[self.value].notna()].copy()
        groups = kept.groupby(["rv_start", self.key], sort=False)[self.value]
        totals = {}
        for (start, k), added in groups.sum().items():
            at = int(start), _plain(k)
            was = self.open.getValue(at)[0] if self.open.containsKey(at) else 0.0
            totals[at] = was, was + float(added)
            self.open.updateValue(at, (was + float(added),))
        for start in {s for s, _ in totals}:
            if not self.due.containsKey((start,)):
                self.due.updateValue((start,), (1,))
        if self.updates and len(kept):
            before = [totals[int(s), _plain(k)][0] for s, k in zip(kept["rv_start"], kept[self.key])]
            kept["rv_total"] = groups.cumsum() + before
            yield kept[[*self.cols, "rv_start", "rv_total"]]
        closed = set() if now is None else {s for (s,) in list(self.due.keys()) if s + self.size + self.grace <= now}
        if not closed:
            return
        ended = [(at, total) for at, (total,) in list(self.open.iterator()) if at[0] in closed]
        for at, _ in ended:
            self.open.removeKey(tuple(at))
        for s in closed:
            self.due.removeKey((s,))
        if not self.updates and ended:
            ended.sort(key=lambda e: (e[0][0], str(e[0][1])))
            yield pd.DataFrame({self.key: [at[1] for at, _ in ended], "rv_start": [at[0] for at, _ in ended],
                                "rv_total": [t for _, t in ended]})


def window_stream(df: DataFrame, key: str = "key", ts: str = "timestamp", value: str = "value",
                  size: str = "10 seconds", grace: str = "0 seconds", partition: str = "partition",
                  order: Sequence[str] = ("offset",), out: str = "total", emit: str = "final") -> DataFrame:
    """Tumbling sums with every topic partition on its own clock.

    No watermark: a record is late, and a window closes, by the stream time of
    its own partition, as in ``tumbling_sum_final`` / ``tumbling_sum_updates``,
    however far another partition has run ahead.  ``emit='final'``: (key,
    window_start, out) once the partition has closed the window;
    ``emit='updates'``: every accepted record with ``window_start`` and the
    window's sum so far.  Closed windows leave the state.  State variables:
    ``clock``, ``open``, ``due``.  Output mode ``append``.
    """
    if emit not in ("final", "updates"):
        raise ValueError("emit is 'final' or 'updates'")
    updates = emit == "updates"
    d = df.withColumn("rv_us", _micros(df, ts))
    key_type = df.schema[key]
    fields = d.schema.fields if updates else [key_type]
    schema = T.StructType([*fields, T.StructField("rv_start", T.LongType()), T.StructField("rv_total", T.DoubleType())])
    r = d.groupBy(partition).transformWithStateInPandas(
        _Windows(list(order), d.columns, duration_micros(size), duration_micros(grace), key,
                 key_type.dataType, value, updates), schema, "append", "none")
    keep = df.columns if updates else [key]
    return r.select(*keep, _from_micros("rv_start", df.schema[ts].dataType).alias("window_start"), F.col("rv_total").alias(out))


def tumbling_sum_stream(df: DataFrame, key: str = "key", ts: str = "timestamp",
                        value: str = "value", size: str = "10 seconds",
                        grace: str = "0 seconds", out: str = "total",
                        exact_late: bool = False, partition: str = "partition",
                        order: Sequence[str] = ("offset",)) -> DataFrame:
    """Windowed sum per key by Spark's watermark: one clock for all partitions,
    moving per micro-batch (``window_stream`` has one per partition and record).

    Start it with output mode ``append`` for final results only (a window
    is emitted once the watermark passes ``end + grace``) or ``update`` for
    every change per micro-batch.  With ``exact_late`` records are first judged
    late per topic partition and per record (``mark_late_stream``).
    """
    d = df.withColumn(ts, as_event_time(ts))
    if exact_late:
        # judged before the null filter: every record advances stream time
        d = mark_late_stream(d, ts, size, grace, partition, order)
        d = d.filter(~F.col("is_late")).drop("stream_time", "is_late")
    d = d.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    return (d.withWatermark(ts, grace)
            .groupBy(key, F.window(ts, size).alias("window"))
            .agg(F.sum(value).alias(out))
            .select(key, F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), out))


# ---- as-of lookup with history ----------------------------------------------

class _AsOf(StatefulProcessor):
    """State ``versions``: (time, tie) -> value of a key's table record, each
    until it is ``history`` older than the key's newest time and another one
    covers what is kept; ``newest``: that time."""

    def __init__(self, names: list[str], fields: list[T.StructField], cols: list[str], outs: list[str], history: int | None):
        self.names, self.fields, self.cols, self.outs, self.history = names, fields, cols, outs, history

    def init(self, handle: StatefulProcessorHandle) -> None:
        value = T.StructType([T.StructField(f.name, f.dataType) for f in self.fields])
        self.versions = handle.getMapState("versions", _state(t=T.LongType(), tie=T.LongType()), value)
        self.newest = handle.getValueState("newest", _state(t=T.LongType()))

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(_named(rows, self.names)), ignore_index=True)
        change = (pdf["rv_side"] == 0).to_numpy()
        new = pdf[change].sort_values(["rv_t", "rv_tie"], kind="stable")
        gone = new["rv_del"].fillna(False).astype(bool)
        for t, tie, dead, *vals in zip(new["rv_t"], new["rv_tie"], gone, *[new[f"rv_v_{f.name}"] for f in self.fields]):
            self.versions.updateValue((int(t), int(tie)), tuple(
                None if dead else _cell(v, f.dataType) for v, f in zip(vals, self.fields)))
        known = sorted((tuple(k), tuple(v)) for k, v in list(self.versions.iterator())) if len(pdf) else []
        records = pdf[~change]
        if len(records):
            times = np.array([k[0] for k, _ in known], np.int64)
            at = np.searchsorted(times, records["rv_t"].to_numpy(np.int64), "right") - 1
            res = pd.DataFrame({c: records[f"rv_s_{c}"].to_numpy() for c in self.cols})
            for i, o in enumerate(self.outs):
                res[o] = pd.Series([known[j][1][i] if j >= 0 else None for j in at], dtype=object)
            yield res
        if self.history is None:
            return
        newest = int(pdf["rv_t"].max())
        if self.newest.exists():
            newest = max(newest, self.newest.get()[0])
        self.newest.update((newest,))
        old = [k for k, _ in known if k[0] <= newest - self.history]
        for k in old[:-1]:              # the last of them still covers what follows it
            self.versions.removeKey(k)

    def close(self) -> None:
        pass


def enrich_asof_stream(stream: DataFrame, changes: DataFrame, stream_key: str,
                       change_key: str, stream_ts: str, change_ts: str,
                       value_cols: Sequence[str], out_cols: Sequence[str] | None = None,
                       change_order: str | None = None, deleted: str | None = None,
                       history: str | None = None) -> DataFrame:
    """As-of table lookup on a stream: each stream record gets the table
    value of its key as of its time, also when newer changes came before it.

    Both streams are merged and grouped by key; the state holds the key's table
    records by time (``deleted`` names a boolean column marking tombstones).
    Once all changes up to a record's time have arrived, its result equals
    ``operators.enrich_asof``; a change that arrives in a later micro-batch than
    a record does not correct it.  ``history`` (a duration) lets versions
    expire: records up to that much older than the key's newest time are still
    answered by their own time.  Without it every version is kept.  State
    variables: ``versions``, ``newest``.  Output mode ``append``.
    """
    outs = list(out_cols or value_cols)
    scols = list(stream.columns)
    vfields = [changes.schema[c] for c in value_cols]
    tie = F.col(change_order).cast("long") if change_order else F.lit(0).cast("long")
    dele = F.coalesce(F.col(deleted).cast("boolean"), F.lit(False)) if deleted else F.lit(False)
    a = changes.filter(F.col(change_key).isNotNull() & F.col(change_ts).isNotNull()).select(
        F.col(change_key).cast("string").alias("rv_k"), _micros(changes, change_ts).alias("rv_t"),
        F.lit(0).alias("rv_side"), tie.alias("rv_tie"), dele.alias("rv_del"),
        *[F.lit(None).cast(stream.schema[c].dataType).alias(f"rv_s_{c}") for c in scols],
        *[F.col(c).alias(f"rv_v_{c}") for c in value_cols])
    b = stream.filter(F.col(stream_key).isNotNull() & F.col(stream_ts).isNotNull()).select(
        F.col(stream_key).cast("string").alias("rv_k"), _micros(stream, stream_ts).alias("rv_t"),
        F.lit(1).alias("rv_side"), F.lit(0).cast("long").alias("rv_tie"), F.lit(False).alias("rv_del"),
        *[F.col(c).alias(f"rv_s_{c}") for c in scols],
        *[F.lit(None).cast(f.dataType).alias(f"rv_v_{f.name}") for f in vfields])
    schema = T.StructType([*stream.schema.fields, *[T.StructField(o, f.dataType) for o, f in zip(outs, vfields)]])
    both = a.unionByName(b)
    return both.groupBy("rv_k").transformWithStateInPandas(
        _AsOf(both.columns, vfields, scols, outs, duration_micros(history) if history else None), schema, "append", "none")
