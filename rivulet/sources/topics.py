"""Topic tables: the file-backed (or Kafka) log that every operator reads.

A topic table has the columns of Spark's Kafka source -- ``topic,
partition, offset, timestamp, key, value`` -- so a job can switch between a
folder of parquet files and a real broker by changing options only.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.hashing import log_partition
from rivulet.sources.schemas import DATE_COL, RecordSchema, topic_schema


# Default size limits of one micro-batch.  Per-key stateful
# stream operators handle one key's rows of one micro-batch in a task, so the
# micro-batch must be bounded even when a backlog is waiting.
DEFAULT_MAX_FILES_PER_TRIGGER = 1000
DEFAULT_MAX_OFFSETS_PER_TRIGGER = 100_000_000
# Records that ``write_topic`` puts into one file at most.
DEFAULT_RECORDS_PER_FILE = 1_000_000


def read_topic(spark: SparkSession, path: str | None = None, *,
               value_type: T.DataType | RecordSchema = T.StringType(),
               stream: bool = False, fmt: str = "parquet",
               options: dict | None = None,
               max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
               max_offsets_per_trigger: int | None = DEFAULT_MAX_OFFSETS_PER_TRIGGER,
               by_date: bool = False, on_bad: str = "null",
               start: dict[int, int] | datetime | None = None,
               max_records_per_trigger: int | None = None,
               records_per_file: int = DEFAULT_RECORDS_PER_FILE) -> DataFrame:
    """Read a topic as a batch or streaming DataFrame.

    With ``options`` holding ``kafka.bootstrap.servers`` the Kafka source is
    used (``subscribe`` names the topic, start is ``earliest`` unless given);
    the value is then decoded from JSON to ``value_type``.  Otherwise ``path``
    is a folder of topic-table files.  A file topic is always read whole
    from its start -- the stream starts at the earliest record.  ``by_date``
    reads a topic written with ``write_topic(by_date=True)``: a filter on
    the ``date`` column then prunes whole folders before any file is opened.

    ``on_bad`` says what becomes of a text value that does not decode (values
    come as text from a broker, and from files when ``options`` has
    ``values='text'``): ``"null"`` leaves it to
    ``decode_value``; ``"tag"`` adds the
    columns ``bad`` and ``raw`` (``tag_bad``), so that the record can be routed
    aside and, in a table topic, is not taken for a delete.

    ``start`` says where to begin instead of at the earliest record: offsets by
    partition (partitions that it does not name: from their start), or a time.
    On files both are filters that reach the scan (row groups before them are
    skipped); a restarted stream goes on from its checkpoint.

    Streams read at most ``max_files_per_trigger`` files (file topic) or
    ``max_offsets_per_trigger`` records (Kafka) per micro-batch, so a
    backlog is worked off in bounded batches (``None`` lifts the limit).
    ``max_records_per_trigger`` bounds a micro-batch by records: a file of
    ``write_topic`` holds ``records_per_file`` at most, and as many files are
    taken as are sure to stay within it (one file at least).
    """
    if on_bad not in ("null", "tag"):
        raise ValueError("on_bad is 'null' or 'tag'")
    options = dict(options or {})
    vtype = value_type.struct if isinstance(value_type, RecordSchema) else value_type
    reader = spark.readStream if stream else spark.read
    if "kafka.bootstrap.servers" in options:
        if isinstance(start, datetime):
            options.setdefault("startingTimestamp", str(int(start.timestamp() * 1000)))
        elif start:
            # the broker source wants every partition named, and says so where one is missing
            options.setdefault("startingOffsets", json.dumps({options["subscribe"]: {str(p): o for p, o in start.items()}}))
        else:
            options.setdefault("startingOffsets", "earliest")
        if max_records_per_trigger:
            max_offsets_per_trigger = max_records_per_trigger
        if stream and max_offsets_per_trigger:
            options.setdefault("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        # needs the spark-sql-kafka package; Spark's own error says so
        raw = reader.format("kafka").options(**options).load()
        raw = raw.select("topic", "partition", "offset", "timestamp",
                         F.col("key").cast("string").alias("key"),
                         F.col("value").cast("string").alias("value"))
        return tag_bad(raw, vtype) if on_bad == "tag" else decode_value(raw, vtype)
    text = options.pop("values", None) == "text"
    if max_records_per_trigger:
        within = max(1, max_records_per_trigger // records_per_file)
        max_files_per_trigger = min(within, max_files_per_trigger or within)
    if stream and max_files_per_trigger:
        options.setdefault("maxFilesPerTrigger", str(max_files_per_trigger))
    stored = T.StringType() if text else vtype
    records = reader.format(fmt).schema(topic_schema(stored, by_date)).options(**options).load(path)
    if isinstance(start, datetime):
        records = records.filter(F.col("timestamp") >= F.lit(start))
    elif start:
        begun = ~F.col("partition").isin(*start)
        for p, o in start.items():
            begun = begun | ((F.col("partition") == p) & (F.col("offset") >= o))
        records = records.filter(begun)
    if not text:        # typed files hold no undecoded value
        return records.withColumns({"bad": F.lit(False), "raw": F.lit(None).cast("string")}) if on_bad == "tag" else records
    return tag_bad(records, vtype) if on_bad == "tag" else decode_value(records, vtype)


def tag_bad(df: DataFrame, value_type: T.DataType, col: str = "value") -> DataFrame:
    """Decode a text value once: ``col`` as ``value_type``, ``bad`` (the text is
    no such value: malformed JSON, a wrong type in it, or no double or long) and
    ``raw`` (the text of a bad record).

    A null value is no bad record: in a table topic it is a delete.  A bad one
    has a null ``col`` too, and ``bad`` tells them apart: route it aside
    (``filter('bad')``) before the table sees it."""
    text = F.col(col).cast("string")
    if isinstance(value_type, T.StringType):
        return df.withColumn(col, text).withColumns({"bad": F.lit(False), "raw": F.lit(None).cast("string")})
    if isinstance(value_type, T.StructType):
        schema = T.StructType([*value_type.fields, T.StructField("_corrupt_record", T.StringType())])
        parsed = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
        d = df.withColumn("__text", text).withColumn("__parsed", parsed)
        bad = F.col("__text").isNotNull() & (F.col("__parsed").isNull() | F.col("__parsed._corrupt_record").isNotNull())
        value = F.col("__parsed").dropFields("_corrupt_record")
    else:
        d = df.withColumn("__text", text).withColumn("__parsed", text.try_cast(value_type))
        bad, value = F.col("__text").isNotNull() & F.col("__parsed").isNull(), F.col("__parsed")
    d = d.withColumn("bad", bad)
    return d.select(*[F.when(~F.col("bad") & F.col("__text").isNotNull(), value).alias(col) if c == col else F.col(c)
                      for c in df.columns], "bad", F.when(F.col("bad"), F.col("__text")).alias("raw"))


def decode_value(df: DataFrame, value_type: T.DataType, col: str = "value") -> DataFrame:
    """Decode a text value to ``value_type``.

    Strings pass through; doubles and longs use ``try_cast`` (a value that
    does not parse becomes null -- see ``quality.split_malformed`` for the
    side output); structs are parsed as JSON.
    """
    c = F.col(col)
    if isinstance(value_type, T.StringType):
        return df.withColumn(col, c.cast("string"))
    if isinstance(value_type, T.StructType):
        return df.withColumn(col, F.from_json(c.cast("string"), value_type))
    return df.withColumn(col, F.expr(f"try_cast(`{col}` as {value_type.simpleString()})"))


def decode_checked(df: DataFrame, value_type: T.DataType, col: str = "value"
                   ) -> tuple[DataFrame, DataFrame]:
    """Decode a text value to ``value_type``; returns ``(good, rejected)``.

    Rejected rows keep their text: malformed JSON, or text that is no double
    or long.  A null value is no bad record (in a table topic it is a
    delete) and stays in ``good``."""
    from rivulet.operators.quality import split_malformed

    if isinstance(value_type, T.StringType):
        return decode_value(df, value_type, col), df.limit(0)
    if isinstance(value_type, T.StructType):
        present = df.filter(F.col(col).isNotNull())
        good, bad = split_malformed(present, value_type, col)
        deletes = decode_value(df.filter(F.col(col).isNull()), value_type, col)
        return good.unionByName(deletes), bad
    parsed = F.expr(f"try_cast(`{col}` as {value_type.simpleString()})")
    bad = F.col(col).isNotNull() & parsed.isNull()
    return df.filter(~bad).withColumn(col, parsed), df.filter(bad)


def with_log_offsets(df: DataFrame, partition: str = "partition", order: Sequence[str] = ("timestamp",),
                     out: str = "offset", start: DataFrame | None = None,
                     rows_per_chunk: int | None = None) -> DataFrame:
    """Gapless offsets per topic partition: 0, 1, 2 ... in ``order``.

    Two passes: records are counted per partition (a large one in slices of the
    order), then every slice is numbered on from the ones before it, so no task
    holds a whole partition.  With a total ``order`` (numeric or a time first)
    another run, on other partitions of the frame, gives the same offsets.
    ``start``: (partition, next offset) of a topic that exists
    (``next_offsets``).
    """
    from rivulet.operators.scan import DEFAULT_ROWS_PER_CHUNK, running

    d = running(df, [partition], list(order), F.lit(1), "count", "__nth", rows_per_chunk=rows_per_chunk or DEFAULT_ROWS_PER_CHUNK)
    nth = F.col("__nth") - 1
    if start is None:
        return d.withColumn(out, nth.cast("long")).drop("__nth")
    # one row per topic partition
    at = F.broadcast(start.select(F.col(start.columns[0]).alias("__p"), F.col(start.columns[1]).alias("__at")))
    d = d.join(at, F.col(partition) == F.col("__p"), "left")
    return d.withColumn(out, (nth + F.coalesce("__at", F.lit(0))).cast("long")).drop("__nth", "__p", "__at")


def next_offsets(topic: DataFrame) -> DataFrame:
    """(partition, next offset) of a topic's records so far."""
    return topic.groupBy("partition").agg((F.max("offset") + 1).alias("next"))


def to_topic_records(df: DataFrame, topic: str, key: Column | str, *,
                     value: Column | None = None, time_millis: Column | str | None = None,
                     offset: Column | str | None = None, partition: Column | str | None = None,
                     partitions: int = 1, order: Sequence[str] | None = None,
                     start: DataFrame | None = None) -> DataFrame:
    """Shape a frame as topic records (what a producer writes).

    ``key`` picks the record key from a field; ``value`` defaults to the
    struct of all input columns; ``time_millis`` gives the record timestamp
    from an epoch-millisecond field (default: now); ``partition`` defaults to
    the log's own partitioner of the key over ``partitions``; records without a
    key go round by their place in ``order`` (its first column, if a whole
    number), or by a hash of the record.

    Offsets: ``offset`` names a column; else ``order`` (columns of ``df``) gives
    every partition gapless offsets in that order (``with_log_offsets``), after
    those of ``start``; with neither, a batch gets a unique increasing id, which
    another run may assign differently, and a stream is refused.
    """
    if df.isStreaming and offset is None:
        raise ValueError("a stream has no default offset: name the offset column")
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    key_c = as_col(key).cast("string")
    value_c = value if value is not None else F.struct(*[F.col(c) for c in df.columns])
    ts_c = (F.timestamp_millis(as_col(time_millis)) if time_millis is not None
            else F.current_timestamp())
    if partition is not None:
        part_c = as_col(partition).cast("int")
    else:
        turns = bool(order) and isinstance(df.schema[order[0]].dataType, T.IntegralType)
        other = F.col(order[0]) if turns else F.xxhash64(*df.columns)
        part_c = F.coalesce(log_partition(key_c, partitions), F.pmod(other, F.lit(partitions)).cast("int"))
    fields = [F.lit(topic).alias("topic"), part_c.alias("partition"), ts_c.alias("timestamp"),
              key_c.alias("key"), value_c.alias("value")]
    names = ["topic", "partition", "offset", "timestamp", "key", "value"]
    if offset is None and order:
        records = df.select(*fields, *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)])
        return with_log_offsets(records, "partition", [f"__o{i}" for i in range(len(order))], "offset", start).select(*names)
    off_c = (as_col(offset).cast("long") if offset is not None
             else F.monotonically_increasing_id())
    return df.select(*fields, off_c.alias("offset")).select(*names)


def write_topic(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "append",
                checkpoint: str | None = None, trigger: dict | None = None,
                query_name: str | None = None, options: dict | None = None,
                by_date: bool = False, records_per_file: int = DEFAULT_RECORDS_PER_FILE):
    """Append records to a topic.

    Batch frames are written at once; a streaming frame starts a query with
    ``checkpoint`` as its progress (file sinks are exactly-once) and the
    started ``StreamingQuery`` is returned.  No file holds more than
    ``records_per_file`` records, so that readers can bound a micro-batch by
    records.  With ``kafka.bootstrap.servers``
    in ``options`` the records go to a broker instead of files.
    """
    options = dict(options or {})
    kafka = "kafka.bootstrap.servers" in options
    out = df
    if kafka:
        # the sink writes to the partition that a record names, if it names one
        explicit = [F.col("partition").cast("int").alias("partition")] if "partition" in df.columns else []
        out = df.select(*explicit, F.col("key").cast("string").alias("key"),
                        F.to_json(F.col("value")).alias("value")
                        if isinstance(df.schema["value"].dataType, T.StructType)
                        else F.col("value").cast("string").alias("value"))
        fmt = "kafka"
    else:
        options.setdefault("maxRecordsPerFile", str(records_per_file))
    parts = []
    if by_date and not kafka:
        out = out.withColumn(DATE_COL, F.to_date("timestamp"))
        parts = [DATE_COL]
    if not df.isStreaming:
        w = out.write.format(fmt).mode(mode).options(**options).partitionBy(*parts)
        (w.save() if kafka else w.save(path))
        return None
    w = out.writeStream.format(fmt).outputMode("append").options(**options)
    if parts:
        w = w.partitionBy(*parts)
    w = w.option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start() if kafka else w.start(path)


def write_report(df: DataFrame, name: str, offset: str = "offset",
                 ts: str = "timestamp") -> tuple[DataFrame, Observation | str]:
    """Delivery report: count and offset/time range of what passes here.

    Batch: returns ``(df, Observation)``; read ``obs.get`` after an action.
    Stream: returns ``(df, name)``; the metrics appear per micro-batch in
    ``query.lastProgress['observedMetrics'][name]``.
    """
    metrics = [F.count(F.lit(1)).alias("records")]
    if offset in df.columns:
        metrics += [F.min(offset).alias("min_offset"), F.max(offset).alias("max_offset")]
    if ts in df.columns:
        metrics += [F.min(ts).alias("min_timestamp"), F.max(ts).alias("max_timestamp")]
    if df.isStreaming:
        return df.observe(name, *metrics), name
    obs = Observation(name)
    return df.observe(obs, *metrics), obs
