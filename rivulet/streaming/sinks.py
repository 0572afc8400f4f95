"""Idempotent ``foreachBatch`` sinks.

``foreachBatch`` is at-least-once: after a failure the last batch runs
again with the same id.  Every sink here writes a batch into its own
``_batch=<id>`` folder in overwrite mode, so a replay replaces what the
first attempt wrote instead of adding to it.

* ``changelog_writer`` -- update-mode results, one folder per batch.
* ``start_table`` / ``read_table`` -- an upsert table in a query's state
  store, and its content.
* ``enrich_latest_writer`` -- lookup in such a table while it keeps changing.
* ``running_sum_writer``, ``mark_late_writer`` -- each micro-batch computed
  with the batch operator, so hot keys are split within a micro-batch, on top
  of what ``with_state_before`` has found in the state store.
* ``window_writer`` -- tumbling sums, final or every update, with every topic
  partition on its own clock (no watermark).
* ``error_budget_writer`` -- quarantine and a bad-record budget across
  restarts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rivulet.operators.quality import DEFAULT_ERROR_BUDGET, ErrorBudgetExceeded
from rivulet.operators.tables import table_from_topic

BATCH_COL = "_batch"


def _batch_dir(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{BATCH_COL}={batch_id}"


def _bad_so_far(spark: SparkSession, path: str, batch_id: int) -> int:
    """Rows in the batch folders before ``batch_id`` (0 when none exist yet)."""
    try:
        d = spark.read.parquet(path)
    except AnalysisException:
        return 0
    return d.filter(F.col(BATCH_COL) < batch_id).count()


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Write one micro-batch to its own folder (replay-safe)."""
    df.write.mode("overwrite").format(fmt).save(_batch_dir(path, batch_id))


def changelog_writer(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Sink for update-mode results (file sinks only append): every batch's
    updates land in ``path/_batch=<id>``; read them back with
    ``spark.read.parquet(path)``, ``_batch`` then tells their order."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id, fmt)
    return fn


def has_finished_batch(spark: SparkSession, checkpoint: str) -> bool:
    """Whether the query of a checkpoint has committed a micro-batch."""
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/commits")
    fs = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(commits) and any(f.getPath().getName().isdigit() for f in fs.listStatus(commits))


def start_table(topic: DataFrame, app_id: str, *, key: str = "key", offset: str = "offset", value: str = "value",
                carry: tuple[str, ...] = (), changes: str | None = None, **kw) -> StreamingQuery:
    """Materialise an upsert topic as a table: the latest record per key, in
    the query's own state store (a native aggregate: hot keys are reduced
    before the shuffle, and a micro-batch touches the keys it holds, whatever
    the history).  ``read_table`` shows it; ``changes`` names a folder for the
    changelog (``changelog_writer``), else updates go nowhere.  Deletes stay in
    the state, so that an older record that comes late cannot undo one."""
    from rivulet.streaming.runner import start_stream

    def nowhere(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("noop").mode("overwrite").save()

    return start_stream(table_from_topic(topic, key, offset, value, carry), app_id, output_mode="update",
                        foreach_batch=changelog_writer(changes) if changes else nowhere, **kw)


def read_table(spark: SparkSession, checkpoint: str, key: str = "key", offset: str = "offset",
               value: str = "value", carry: tuple[str, ...] = (), deletes: bool = False) -> DataFrame:
    """The table of a ``start_table`` query as of its last finished micro-batch,
    read from its state store: one row per key, not one per record.  The
    column names are those given to ``start_table``; ``deletes`` keeps deleted
    keys (null value)."""
    s = spark.read.format("statestore").load(checkpoint)
    k = s.schema["key"].dataType.names[0]
    latest = next(f.name for f in s.schema["value"].dataType.fields if isinstance(f.dataType, T.StructType))
    names = s.schema["value"].dataType[latest].dataType.names
    t = s.select(F.col(f"key.{k}").alias(key), *[F.col(f"value.{latest}.{n}").alias(n) for n in names])
    t = t.select(key, offset, value, *carry)
    return t if deletes else t.filter(F.col(value).isNotNull())


def enrich_latest_writer(table_checkpoint: str, out_path: str, stream_key: str, name_col: str,
                         out: str = "user_name", key: str = "key", offset: str = "offset",
                         value: str = "value", default: str = ""
                         ) -> Callable[[DataFrame, int], None]:
    """Stream-table lookup against a table that keeps changing.

    A stream-static join fixes the table's file listing when the query starts.
    This sink reads the state of the table's query (``start_table``) for every
    micro-batch, so each batch sees the table as it is when the batch runs (the
    processing-time lookup of a changelog table), joins it with
    ``enrich_latest`` and writes the batch to its own folder.  ``name_col`` is a
    field of the table's value struct.  Before the table's query has finished a
    micro-batch there is no table, and every name is the default.
    """
    from rivulet.operators.joins import enrich_latest

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if has_finished_batch(spark, table_checkpoint):
            t = read_table(spark, table_checkpoint, key, offset, value)
            names = t.select(F.col(key).alias("__tk"), F.col(f"{value}.{name_col}").alias("__tn"))
        else:
            names = spark.createDataFrame([], "__tk string, __tn string")
        write_batch(enrich_latest(batch, names, stream_key, "__tk", "__tn", out, default),
                    out_path, batch_id)
    return fn


def running_sum_writer(out_path: str, key: str = "key", value: str = "value", order: tuple[str, ...] = ("offset",),
                       out: str = "total", before: str = "__before", rows_per_chunk: int | None = None
                       ) -> Callable[[DataFrame, int], None]:
    """Per-record running totals on a stream, with hot keys split.

    Feed it ``with_state_before(stream, key, value)``: the key's total before
    the micro-batch comes from Spark's state store, and the micro-batch is
    summed with the batch operator (``operators.scan.running``: a hot key is
    cut into chunks).  A replayed batch starts from the same state and replaces
    its own folder.
    """
    from rivulet.operators.scan import DEFAULT_ROWS_PER_CHUNK, running

    rpc = rows_per_chunk or DEFAULT_ROWS_PER_CHUNK

    def fn(batch: DataFrame, batch_id: int) -> None:
        d = batch.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).persist()
        try:
            r = running(d, [key], list(order), value, "sum", "__run", rows_per_chunk=rpc)
            write_batch(r.withColumn(out, F.col("__run") + F.coalesce(F.col(before), F.lit(0.0))).drop("__run", before),
                        out_path, batch_id)
        finally:
            d.unpersist()
    return fn


def mark_late_writer(out_path: str, ts: str = "timestamp", size: str = "10 seconds", grace: str = "0 seconds",
                     partition: str = "partition", order: tuple[str, ...] = ("offset",), before: str = "__before",
                     rows_per_chunk: int | None = None) -> Callable[[DataFrame, int], None]:
    """Per-record lateness on a stream, with hot topic partitions split.

    Feed it ``with_clock_before(stream, partition, ts)``: each micro-batch gets
    ``window_start``, ``stream_time`` and ``is_late`` from the batch operator
    (running max per topic partition, cut into chunks), raised to the
    partition's clock before the batch.
    """
    from rivulet.functions.time import interval
    from rivulet.operators.scan import DEFAULT_ROWS_PER_CHUNK
    from rivulet.operators.windows import stream_time, window_start
    from rivulet.streaming.stateful import _from_micros

    rpc = rows_per_chunk or DEFAULT_ROWS_PER_CHUNK

    def fn(batch: DataFrame, batch_id: int) -> None:
        d = batch.persist()
        try:
            marked = stream_time(d, partition, list(order), ts, "__st", rows_per_chunk=rpc)
            clock = _from_micros(before, d.schema[ts].dataType)
            marked = marked.withColumn("stream_time", F.greatest("__st", clock)).drop("__st", before)
            marked = marked.withColumn("window_start", window_start(ts, size))
            closes = F.col("window_start") + interval(size) + interval(grace)
            write_batch(marked.withColumn("is_late", closes <= F.col("stream_time")), out_path, batch_id)
        finally:
            d.unpersist()
    return fn


def window_writer(out_path: str, state_path: str, key: str = "key", ts: str = "timestamp",
                  value: str = "value", size: str = "10 seconds", grace: str = "0 seconds",
                  partition: str = "partition", order: tuple[str, ...] = ("offset",),
                  out: str = "total", emit: str = "final", rows_per_chunk: int | None = None
                  ) -> Callable[[DataFrame, int], None]:
    """Tumbling sums on a stream with every topic partition on its own clock.

    No watermark is involved: a record is late, and a window closes, by the
    stream time of its own partition, as in the batch operators, however far
    another partition has run ahead.  ``emit='final'`` writes a window's sum
    once its partition has closed it; ``emit='updates'`` writes every accepted
    record with the running sum of its window.

    State after a batch: the clock of each partition, and the sums of windows
    that are still open, each written whole to the batch's own folder; a batch
    reads the folder of the batch before it and nothing older.  Closed windows
    leave the state, so it is as large as the open windows.
    """
    from rivulet.functions.time import interval
    from rivulet.operators.scan import DEFAULT_ROWS_PER_CHUNK, running
    from rivulet.operators.windows import stream_time, window_start

    if emit not in ("final", "updates"):
        raise ValueError("emit is 'final' or 'updates'")
    rpc = rows_per_chunk or DEFAULT_ROWS_PER_CHUNK
    groups = [partition, key, "window_start"]
    ends = interval(size) + interval(grace)

    def earlier(spark: SparkSession, part: str, batch_id: int, schema: T.StructType) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(_batch_dir(f"{state_path}/{part}", batch_id - 1))

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        d = batch.persist()
        try:
            types = {c: d.schema[c].dataType for c in (partition, key, ts)}
            clock = earlier(spark, "clock", batch_id, T.StructType([
                T.StructField(partition, types[partition]), T.StructField("__clock", types[ts])]))
            sums = earlier(spark, "open", batch_id, T.StructType([
                T.StructField(partition, types[partition]), T.StructField(key, types[key]),
                T.StructField("window_start", types[ts]), T.StructField("__sum", T.DoubleType())]))
            # one row per topic partition: bounded by the partition count
            timed = stream_time(d, partition, list(order), ts, "__st", rows_per_chunk=rpc)
            timed = timed.join(F.broadcast(clock), partition, "left").withColumn(
                "__st", F.greatest("__st", "__clock")).drop("__clock")
            timed = timed.withColumn("window_start", window_start(ts, size))
            now = (timed.select(partition, F.col("__st").alias("__clock")).unionByName(clock)
                   .groupBy(partition).agg(F.max("__clock").alias("__clock")))
            write_batch(now, f"{state_path}/clock", batch_id)
            now = spark.read.schema(clock.schema).parquet(_batch_dir(f"{state_path}/clock", batch_id))
            kept = timed.filter((F.col("window_start") + ends > F.col("__st"))
                                & F.col(key).isNotNull() & F.col(value).isNotNull()).drop("__st")
            added = kept.groupBy(*groups).agg(F.sum(value).cast("double").alias("__sum"))
            total = sums.unionByName(added).groupBy(*groups).agg(F.sum("__sum").alias("__sum"))
            closed = F.col("window_start") + ends <= F.col("__clock")
            judged = total.join(F.broadcast(now), partition)
            if emit == "final":
                write_batch(judged.filter(closed).select(
                    key, "window_start", F.col("__sum").alias(out)), out_path, batch_id)
            else:
                before = sums.groupBy(key, "window_start").agg(F.sum("__sum").alias("__prior"))
                run = running(kept, [key, "window_start"], list(order), value, "sum", out, rows_per_chunk=rpc)
                run = run.join(before, [key, "window_start"], "left")
                write_batch(run.withColumn(out, F.col(out) + F.coalesce("__prior", F.lit(0.0)))
                            .drop("__prior"), out_path, batch_id)
            write_batch(judged.filter(~closed).drop("__clock"), f"{state_path}/open", batch_id)
        finally:
            d.unpersist()
    return fn


def receipts_writer(path: str, receipts: str, value_type: T.DataType = T.StringType()
                    ) -> Callable[[DataFrame, int], None]:
    """Write ``produce_stream`` records and a receipt for each of them.

    Accepted records go to the topic at ``path`` (values decoded to
    ``value_type``), and every record, refused ones too, leaves one row in
    ``receipts``: partition, offset, timestamp, key and ``error`` (null: written).
    Both are the batch's own folder, so a replay replaces them.
    """
    from rivulet.sources.topics import decode_value

    def fn(batch: DataFrame, batch_id: int) -> None:
        d = batch.persist()
        try:
            write_batch(decode_value(d.filter("error is null").drop("error"), value_type), path, batch_id)
            write_batch(d.select("topic", "partition", "offset", "timestamp", "key", "error"), receipts, batch_id)
        finally:
            d.unpersist()
    return fn


def error_budget_writer(out_path: str, quarantine_path: str, is_bad: Column,
                        order: str = "offset", budget: int = DEFAULT_ERROR_BUDGET
                        ) -> Callable[[DataFrame, int], None]:
    """Sink with a bad-record budget that survives restarts.

    Bad records go to ``quarantine_path``; good ones to ``out_path``.  The
    count of bad records so far is read back from the quarantine (earlier
    batches only, so a replay does not count itself twice).  When the
    budget is used up, the records before the first bad record over budget
    are still written, then ``ErrorBudgetExceeded`` stops the query.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prior = _bad_so_far(spark, quarantine_path, batch_id)
        flagged = batch.withColumn("__bad", F.coalesce(is_bad, F.lit(False)))
        allowed = max(budget - prior, 0)
        over = (flagged.filter("__bad").select(order).orderBy(order)
                .limit(allowed + 1).collect())
        exceeded = len(over) > allowed
        if exceeded:
            flagged = flagged.filter(F.col(order) < F.lit(over[allowed][0]))
        write_batch(flagged.filter(~F.col("__bad")).drop("__bad"), out_path, batch_id)
        write_batch(flagged.filter("__bad").drop("__bad"), quarantine_path, batch_id)
        if exceeded:
            raise ErrorBudgetExceeded(
                f"bad record budget of {budget} exceeded in batch {batch_id}")
    return fn
