import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.sources import (ELECTRONIC_ORDER, conform, read_topic, to_topic_records,
                             write_report, write_topic)
from rivulet.streaming import run_stream, stream_checkpoint
from tests.fixtures import T0, topic


def test_topic_round_trip_batch_and_stream(spark, tmp_path):
    orders = spark.createDataFrame(
        [("o1", "tv", "u1", 10.0, T0), ("o2", "tv", "u2", 20.0, T0 + 5)],
        ELECTRONIC_ORDER.struct)
    recs = to_topic_records(orders, "orders", "electronic_id", time_millis="time",
                            offset=F.lit(None), partitions=4)
    recs = recs.withColumn("offset", F.when(F.col("value.order_id") == "o1", 0).otherwise(1)
                           .cast("long"))
    path = str(tmp_path / "topic")
    write_topic(recs, path)
    back = read_topic(spark, path, value_type=ELECTRONIC_ORDER)
    assert back.count() == 2
    assert {r["key"] for r in back.collect()} == {"tv"}
    assert {r["partition"] for r in back.collect()} <= set(range(4))
    s = read_topic(spark, path, value_type=ELECTRONIC_ORDER, stream=True)
    q = write_topic(s, str(tmp_path / "copy"), checkpoint=stream_checkpoint(spark, "copy", True))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 2


def test_conform_fills_defaults_and_rejects_missing_required(spark):
    df = spark.createDataFrame([("o1", "tv", "u1", 5, "extra"), ("o2", None, "u2", 6, "x")],
                               "order_id string, electronic_id string, user_id string, "
                               "time int, junk string")
    good, bad = conform(df, ELECTRONIC_ORDER, keep=())
    g = good.collect()
    assert good.columns == ELECTRONIC_ORDER.fields
    assert [(r["order_id"], r["price"], r["time"]) for r in g] == [("o1", 0.0, 5)]
    b = bad.collect()
    assert [(r["order_id"], r["missing"]) for r in b] == [("o2", ["electronic_id"])]


def test_delivery_report(spark):
    df = spark.createDataFrame([(0, "a"), (7, "b")], "offset long, value string")
    out, obs = write_report(df, "report")
    out.collect()
    assert obs.get["records"] == 2 and obs.get["max_offset"] == 7


def test_date_partitioned_topic_prunes_folders(spark, tmp_path, capsys):
    import datetime as dt

    recs = spark.createDataFrame(
        [("t", 0, 0, dt.datetime(2024, 1, 1, 5), "k", "a"),
         ("t", 0, 1, dt.datetime(2024, 1, 2, 5), "k", "b")],
        "topic string, partition int, offset long, timestamp timestamp, key string, "
        "value string")
    path = str(tmp_path / "topic")
    write_topic(recs, path, by_date=True)
    t = read_topic(spark, path, by_date=True)
    day = t.filter(F.col("date") == F.lit("2024-01-02").cast("date"))
    assert [r["value"] for r in day.collect()] == ["b"]
    capsys.readouterr()
    day.explain("formatted")
    assert "PartitionFilters: [isnotnull(date" in capsys.readouterr().out


def test_delivery_report_on_a_stream(spark, tmp_path):
    from rivulet.operators import split_oversize, tap
    from rivulet.streaming import run_stream
    from tests.fixtures import topic, write_files

    t = topic(spark, [(0, i, i, "k", "x" * (i * 10)) for i in range(5)])
    s = spark.readStream.schema(t.schema).parquet(write_files(t, str(tmp_path / "in"), False))
    s, name = write_report(s, "delivered")
    s, probe = tap(s, "probe", "value")
    ok, too_big = split_oversize(s, "value", 25)
    q = run_stream(too_big, "oversize", fmt="memory", checkpoint=str(tmp_path / "ck"))
    assert sorted(r["offset"] for r in spark.sql("select * from oversize").collect()) == [3, 4]
    metrics = [p["observedMetrics"] for p in q.recentProgress if p.get("observedMetrics")]
    assert metrics[0][name]["records"] == 5 and metrics[0][name]["max_offset"] == 4
    assert metrics[0][probe]["value_non_null"] == 5


def test_decode_primitive_and_json_values(spark):
    from pyspark.sql import types as T

    from rivulet.sources import decode_value

    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "value string")
    assert [r["value"] for r in decode_value(df, T.DoubleType()).collect()] == [1.5, None, None]
    assert [r["value"] for r in decode_value(df, T.LongType()).collect()] == [None, None, None]
    js = spark.createDataFrame([('{"name": "Ann", "user_id": "u1"}',)], "value string")
    r = decode_value(js, T.StructType([T.StructField("name", T.StringType()),
                                       T.StructField("user_id", T.StringType())])).first()
    assert r["value"]["name"] == "Ann"


def test_conform_a_struct_value_by_name(spark):
    from rivulet.sources import COMBINED_ORDER

    df = spark.createDataFrame(
        [("k1", 0, ("e1", "a1", "x1", 5, "extra")), ("k2", 1, ("e2", None, "x2", 6, "y"))],
        "key string, offset long, value struct<electronic_order_id:string, "
        "appliance_order_id:string, appliance_id:string, time:long, junk:string>")
    good, bad = conform(df, COMBINED_ORDER, value_col="value", keep=("key", "offset"))
    g = good.collect()
    assert good.schema["value"].dataType.fieldNames() == COMBINED_ORDER.fields
    assert [(r["key"], r["value"]["user_name"], r["value"]["time"]) for r in g] == [("k1", "", 5)]
    b = bad.collect()
    assert [(r["key"], r["missing"]) for r in b] == [("k2", ["appliance_order_id"])]


def test_date_partitioned_topic_from_a_stream(spark, tmp_path):
    from rivulet.streaming import stream_checkpoint
    from tests.fixtures import topic, write_files

    t = topic(spark, [(0, 0, T0, "k", "a"), (0, 1, T0 + 86_400_000, "k", "b")])
    s = spark.readStream.schema(t.schema).parquet(write_files(t, str(tmp_path / "in"), True))
    path = str(tmp_path / "topic")
    write_topic(s, path, by_date=True,
                checkpoint=stream_checkpoint(spark, "bydate", True)).awaitTermination()
    back = read_topic(spark, path, by_date=True)
    assert sorted((str(r["date"]), r["value"]) for r in back.collect()) == [
        ("2023-11-14", "a"), ("2023-11-15", "b")]


def test_stream_backlog_is_read_in_bounded_batches(spark, tmp_path):
    from tests.fixtures import topic, write_files

    t = topic(spark, [(0, i, T0 + i, "k", str(i)) for i in range(6)])
    path = write_files(t, str(tmp_path / "in"), True)
    s = read_topic(spark, path, stream=True, max_files_per_trigger=2)
    q = s.writeStream.format("memory").queryName("bounded") \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert sizes == [2, 2, 2]


def test_decode_checked_keeps_bad_text_aside(spark):
    from pyspark.sql import types as T

    from rivulet.sources.topics import decode_checked

    df = spark.createDataFrame([(1, "1.5"), (2, "x"), (3, None)], "n int, value string")
    good, bad = decode_checked(df, T.DoubleType())
    assert sorted((r["n"], r["value"]) for r in good.collect() if r["n"] < 3) == [(1, 1.5)]
    assert [r["n"] for r in good.collect() if r["value"] is None] == [3]   # a delete, not a bad record
    assert [(r["n"], r["value"]) for r in bad.collect()] == [(2, "x")]
    js = spark.createDataFrame([(1, '{"a": 1}'), (2, "{a"), (3, None)], "n int, value string")
    good, bad = decode_checked(js, T.StructType([T.StructField("a", T.LongType())]))
    assert sorted(r["n"] for r in good.collect()) == [1, 3]
    assert [r["n"] for r in bad.collect()] == [2]


def test_conform_rejects_a_wrong_typed_field(spark):
    from rivulet.sources.schemas import ELECTRONIC_ORDER, conform

    df = spark.createDataFrame(
        [("o1", "e", "u", "1.5", "7"), ("o2", "e", "u", "cheap", "7"), ("o3", "e", "u", None, "7"), ("o4", "e", "u", "1", "soon")],
        "order_id string, electronic_id string, user_id string, price string, time string")
    good, bad = conform(df, ELECTRONIC_ORDER)
    assert sorted((r["order_id"], r["price"]) for r in good.collect()) == [("o1", 1.5), ("o3", 0.0)]
    assert sorted((r["order_id"], r["invalid"]) for r in bad.collect()) == [("o2", ["price"]), ("o4", ["time"])]


def test_stream_needs_a_named_offset(spark, tmp_path):
    import pytest

    from rivulet.sources.topics import to_topic_records

    spark.range(1).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="offset"):
        to_topic_records(s, "t", "id")
    assert to_topic_records(s, "t", "id", offset="id").isStreaming


# Known results of the log's key hash (signed 32 bits).
HASHES = {"21": -973932308, "foobar": -790332482, "a-little-bit-long-string": -985981536,
          "a-little-bit-longer-string": -1486304829, "abc": 479470107,
          "lkjh234lh9fiuh90y23oiuhsafujhadof229phr9h19h89h8": -58897971}


def test_log_partitioner(spark):
    from rivulet.functions import log_partition, murmur2

    df = spark.createDataFrame([(k,) for k in HASHES] + [(None,)], "k string")
    rows = {r["k"]: (r["h"], r["p"]) for r in df.select("k", murmur2("k").alias("h"), log_partition("k", 7).alias("p")).collect()}
    assert {k: h - 2**32 if h >= 2**31 else h for k, (h, _) in rows.items() if k} == HASHES
    assert all(p == (h & 0x7FFFFFFF) % 7 for k, (h, p) in rows.items() if k) and rows[None] == (None, None)


@pytest.mark.parametrize("rows_per_chunk", [1 << 20, 40])
def test_offsets_are_gapless_and_the_same_on_every_run(spark, rows_per_chunk, monkeypatch):
    from rivulet.operators import scan
    from rivulet.sources import next_offsets

    monkeypatch.setattr(scan, "DEFAULT_ROWS_PER_CHUNK", rows_per_chunk)
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    runs = []
    for parts in (1, 7):
        r = to_topic_records(e.repartition(parts), "t", "user_id", value=F.col("event_id"), partitions=3, order=["event_id"])
        runs.append(sorted((x["partition"], x["offset"], x["value"]) for x in r.collect()))
    assert runs[0] == runs[1]
    for p in {x[0] for x in runs[0]}:
        own = [x for x in runs[0] if x[0] == p]
        assert [x[1] for x in own] == list(range(len(own))) and own == sorted(own, key=lambda x: x[2])
    topic = to_topic_records(e, "t", "user_id", partitions=3, order=["event_id"])
    more = to_topic_records(e, "t", "user_id", partitions=3, order=["event_id"], start=next_offsets(topic))
    both = sorted((x["partition"], x["offset"]) for x in topic.unionByName(more).select("partition", "offset").collect())
    assert both == [(p, i) for p in sorted({x[0] for x in runs[0]}) for i in range(2 * len([x for x in runs[0] if x[0] == p]))]


def test_bad_values_are_tagged_by_the_read(spark, tmp_path):
    """Bad JSON, doubles and longs go aside; a delete is no bad record, and a
    bad record of a table topic deletes nothing."""
    from rivulet.operators import table_from_topic

    text = T.StringType()
    kinds = {T.LongType(): (["1", "x", None, "9" * 30, "4.5", ""], [0, 1, 0, 1, 1, 1]),
             T.DoubleType(): (["1", "x", None, "1e3", "4.5", ""], [0, 1, 0, 0, 0, 1]),
             T.StructType([T.StructField("a", T.LongType())]): (['{"a":1}', '{"a":', None, '{"a":"x"}', "{}", "nonsense"], [0, 1, 0, 1, 0, 1])}
    for n, (kind, (values, bad)) in enumerate(kinds.items()):
        path = str(tmp_path / f"t{n}")
        raw = topic(spark, [(0, i, i, "k" if i < 3 else f"k{i}", v) for i, v in enumerate(values)])
        assert raw.schema["value"].dataType == text
        raw.write.parquet(path)
        for stream in (False, True):
            t = read_topic(spark, path, value_type=kind, options={"values": "text"}, on_bad="tag", stream=stream)
            if stream:
                run_stream(t, f"tagged{n}", fmt="memory", checkpoint=str(tmp_path / f"ck{n}"))
                t = spark.sql(f"select * from tagged{n}")
            got = sorted(t.collect(), key=lambda r: r["offset"])
            assert [int(r["bad"]) for r in got] == bad
            assert [r["raw"] for r in got] == [v if b else None for v, b in zip(values, bad)]
            assert all((r["value"] is None) == (bool(b) or v is None) for r, v, b in zip(got, values, bad))
        # the bad second record of key "k" must not be its table value; the delete after it must
        good = read_topic(spark, path, value_type=kind, options={"values": "text"}, on_bad="tag").filter("not bad")
        assert table_from_topic(good.filter("offset < 2")).filter("key = 'k'").first()["value"] is not None
        assert table_from_topic(good).filter("key = 'k'").first()["value"] is None
        if not isinstance(kind, T.StructType):      # bad JSON decodes to a struct of nulls
            plain = read_topic(spark, path, value_type=kind, options={"values": "text"})
            assert plain.filter("value is null").count() == sum(bad) + 1


def test_start_and_batches_by_records(spark, tmp_path):
    """A topic read from an offset per partition, from a time, and in
    micro-batches of bounded records, over a restart."""
    import datetime as dt

    path, out, ck = (str(tmp_path / n) for n in ("topic", "out", "ck"))
    rows = [(i % 2, i // 2, T0 + 1000 * i, f"k{i}", str(i)) for i in range(95)]
    write_topic(topic(spark, rows).repartition(3), path, records_per_file=10)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 95 and max(sizes) <= 10
    start = {0: 30}
    want = sorted((p, o) for p, o, *_ in rows if p != 0 or o >= 30)
    assert sorted((r["partition"], r["offset"]) for r in read_topic(spark, path, start=start).collect()) == want
    since = dt.datetime.fromtimestamp(T0 / 1000 + 40, dt.timezone.utc)
    assert read_topic(spark, path, start=since).count() == 55
    plan = read_topic(spark, path, start=start)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(offset,30)" in plan

    def run():
        s = read_topic(spark, path, start=start, stream=True, max_records_per_trigger=25, records_per_file=10)
        return run_stream(s, "started", path=out, checkpoint=ck)

    q = run()
    read = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert sum(read) == 95 and max(read) <= 25 and len(read) >= 4       # files read; the filter keeps those from the start on
    write_topic(topic(spark, [(0, 48, T0, "a", "95"), (1, 47, T0, "b", "96"), (0, 3, T0, "c", "old")]), path, records_per_file=10)
    run()
    got = sorted((r["partition"], r["offset"]) for r in spark.read.parquet(out).collect())
    assert got == sorted([*want, (0, 48), (1, 47)])
