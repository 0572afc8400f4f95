import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rivulet.operators import late_records, mark_late, tumbling_sum, with_event_time
from rivulet.plans.apps import time_app, windows_app
from rivulet.streaming import run_stream
from rivulet.sources.schemas import ELECTRONIC_ORDER
from tests.fixtures import T0, _write_in_order, late_loader, topic, windows_loader, write_files


def _totals(rows):
    return sorted((r["key"], round(r["total"], 6)) for r in rows)


WINDOWS_EXPECTED = sorted([("HDTV-2333", 2000.00), ("HDTV-2333", 1999.23),
                           ("HDTV-2333", 4500.00), ("HDTV-2333", 1333.98),
                           ("HDTV-2333", 1333.98), ("SUPER-WIDE-TV-2333", 5333.98)])


def test_windows_app_final_results_batch(spark):
    assert _totals(windows_app(windows_loader(spark)).collect()) == WINDOWS_EXPECTED


@pytest.mark.parametrize("per_record", [True, False])
def test_windows_app_final_results_stream(spark, tmp_path, per_record):
    src = write_files(windows_loader(spark), str(tmp_path / "in"), per_record)
    s = spark.readStream.schema(windows_loader(spark).schema).parquet(src)
    name = f"win_{per_record}"
    run_stream(windows_app(s), name, fmt="memory", output_mode="append",
               checkpoint=str(tmp_path / "ckpt"))
    assert _totals(spark.sql(f"select * from {name}").collect()) == WINDOWS_EXPECTED


def _window_sums(rows):
    return sorted((int(r["window_start"].timestamp() * 1000) - T0, round(r["total"], 6))
                  for r in rows)


def test_late_rule_is_per_record(spark):
    out = windows_app(late_loader(spark), size="10 seconds", grace="5 seconds")
    assert _window_sums(out.collect()) == [(0, 5.0), (10000, 10.0), (40000, 32.0)]
    o = late_loader(spark).select("partition", "offset", "timestamp", "key",
                                  F.col("value.price").alias("price"))
    late = late_records(o, ts="timestamp", size="10 seconds", grace="0 seconds")
    assert sorted(r["offset"] for r in late.collect()) == [2, 4]


@pytest.mark.parametrize("per_record", [True, False])
def test_late_rule_exact_on_stream(spark, tmp_path, per_record):
    src = write_files(late_loader(spark), str(tmp_path / "in"), per_record)
    s = spark.readStream.schema(late_loader(spark).schema).option("maxFilesPerTrigger", 1) \
        .parquet(src)
    name = f"late_{per_record}"
    run_stream(windows_app(s, "10 seconds", "5 seconds"), name, fmt="memory",
               checkpoint=str(tmp_path / "ckpt"))
    got = _window_sums(spark.sql(f"select * from {name}").collect())
    assert got == [(0, 5.0), (10000, 10.0), (40000, 32.0)]


def test_grace_boundary(spark):
    # window [0,10s), grace 5 s: stream time 14.999 s keeps it open, 15 s closes it
    rows = [(0, 0, T0 + 14999, "k", 1.0), (0, 1, T0 + 1, "k", 2.0),
            (0, 2, T0 + 15000, "k", 4.0), (0, 3, T0 + 2, "k", 8.0)]
    t = topic(spark, rows).withColumn("value", F.col("value").cast("double"))
    m = mark_late(t, ts="timestamp", size="10 seconds", grace="5 seconds")
    assert {r["offset"]: r["is_late"] for r in m.collect()} == {0: False, 1: False, 2: False,
                                                               3: True}


def test_event_time_from_payload_skips_negative(spark):
    df = spark.createDataFrame([(1, T0), (2, -5)], "id long, time long")
    out = with_event_time(df).collect()
    assert [r["id"] for r in out] == [1]
    assert out[0]["event_time"] == dt.datetime.fromtimestamp(T0 / 1000, dt.timezone.utc) \
        .replace(tzinfo=None)


def test_time_app_emits_every_update(spark):
    out = time_app(windows_loader(spark)).orderBy("offset").collect()
    assert len(out) == 7
    assert [round(r["total"], 2) for r in out] == [2000.0, 1999.23, 4500.0, 1333.98, 1333.98,
                                                   5333.98, 4333.98]


def test_tumbling_windows_are_epoch_aligned(spark):
    df = spark.createDataFrame([("k", 1.0, T0 + 9999), ("k", 2.0, T0 + 10000)],
                               "key string, value double, t long") \
        .withColumn("ts", F.timestamp_millis("t"))
    got = sorted((int(r["window_start"].timestamp() * 1000) - T0, r["total"])
                 for r in tumbling_sum(df, "key", "ts", "value", "10 seconds").collect())
    assert got == [(0, 1.0), (10000, 2.0)]


def _null_key_topic(spark):
    from rivulet.sources.schemas import ELECTRONIC_ORDER

    recs = [("k", 1.0, 0), (None, 2.0, 15000), ("k", 4.0, 1), ("k", 8.0, 40000)]
    rows = [(0, i, T0 + t, k, (f"o{i}", k, "u", p, T0 + t)) for i, (k, p, t) in enumerate(recs)]
    return topic(spark, rows, ELECTRONIC_ORDER.struct)


def test_null_key_record_advances_stream_time(spark, tmp_path):
    # the null-key record at 15 s closes [0, 10 s) (grace 5 s): the 4.0 is late
    got = _window_sums(windows_app(_null_key_topic(spark), "10 seconds", "5 seconds").collect())
    assert got == [(0, 1.0)]
    t = _null_key_topic(spark)
    s = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(
        write_files(t, str(tmp_path / "in"), True))
    run_stream(windows_app(s, "10 seconds", "5 seconds"), "nullkey", fmt="memory",
               checkpoint=str(tmp_path / "ck"))
    assert _window_sums(spark.sql("select * from nullkey").collect()) == [(0, 1.0)]


def test_late_rule_on_stream_in_another_session_zone(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = late_loader(spark)
        s = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(
            write_files(t, str(tmp_path / "in"), True))
        run_stream(windows_app(s, "10 seconds", "5 seconds"), "late_ny", fmt="memory",
                   checkpoint=str(tmp_path / "ck"))
        got = _window_sums(spark.sql("select * from late_ny").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(0, 5.0), (10000, 10.0), (40000, 32.0)]


def test_stream_time_column_is_zone_independent(spark, tmp_path):
    from rivulet.streaming import mark_late_stream

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = late_loader(spark).select("partition", "offset", "timestamp")
        s = spark.readStream.schema(t.schema).parquet(write_files(t, str(tmp_path / "in"),
                                                                  False))
        run_stream(mark_late_stream(s, "timestamp", "7 hours", "0 seconds"), "st_ny",
                   fmt="memory", checkpoint=str(tmp_path / "ck"))
        rows = spark.sql("select offset, unix_millis(stream_time) as st, "
                         "unix_millis(timestamp) as t from st_ny").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    got = {r["offset"]: r["st"] - T0 for r in rows}
    assert got == {0: 0, 1: 14999, 2: 14999, 3: 15000, 4: 15000, 5: 40000, 6: 90000}


def _lagging(spark):
    """Two partitions; partition 1 arrives batches after partition 0 has gone
    far ahead, with records that are on time by its own clock."""
    def record(p, off, sec, key, price):
        return (p, off, T0 + sec * 1000, key, (None, None, None, price, T0 + sec * 1000))

    return [[record(0, 0, 1, "a", 1.0), record(1, 0, 2, "b", 3.0)], [record(0, 1, 40, "a", 2.0)], [record(0, 2, 102, "a", 5.0)],
            [record(1, 1, 3, "b", 4.0), record(1, 2, 12, "b", 8.0)], [record(1, 3, 1, "b", 16.0), record(1, 4, 60, "b", 32.0)],
            [record(0, 3, 50, "a", 64.0), record(1, 5, 130, None, 1.0)]]


@pytest.mark.parametrize("rows_per_chunk", [None, 2])
def test_partitions_close_their_own_windows_on_a_stream(spark, tmp_path, rows_per_chunk):
    from rivulet.plans.apps import time_app_writer, windows_app_writer

    batches = _lagging(spark)
    whole = topic(spark, [r for b in batches for r in b], value_type=ELECTRONIC_ORDER.struct)
    folders = str(tmp_path / "in")
    os.makedirs(folders)
    for i, b in enumerate(batches):
        _write_in_order(topic(spark, b, value_type=ELECTRONIC_ORDER.struct).toArrow(), f"{folders}/{i}.parquet", i)
    for name, app, writer, cols in (("final", windows_app, windows_app_writer, ["key", "window_start", "total"]),
                                    ("updates", time_app, time_app_writer, ["offset", "key", "window_start", "total"])):
        s = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(folders)
        out = str(tmp_path / name)
        run_stream(s, f"lag_{name}_{rows_per_chunk}", checkpoint=str(tmp_path / f"ckpt_{name}"),
                   foreach_batch=writer(out, str(tmp_path / f"state_{name}"), rows_per_chunk=rows_per_chunk))
        got = sorted(tuple(r) for r in spark.read.parquet(out).select(*cols).collect())
        want = sorted(tuple(r) for r in app(whole).select(*cols).collect())
        assert got == want and len(got) >= 4


@pytest.mark.parametrize("files", [1, 2])
def test_apps_close_each_partition_by_its_own_clock(spark, tmp_path, files):
    """The applications themselves on a stream, restarted half way, with one
    partition far behind: the batch form's rows, and closed windows gone from
    the state."""
    from rivulet.streaming import read_state

    batches = _lagging(spark)
    whole = topic(spark, [r for b in batches for r in b], value_type=ELECTRONIC_ORDER.struct)
    folder = str(tmp_path / "in")
    os.makedirs(folder)

    def put(some):
        for i in some:
            _write_in_order(topic(spark, batches[i], value_type=ELECTRONIC_ORDER.struct).toArrow(), f"{folder}/{i}.parquet", i)

    for part, some in (("a", range(3)), ("b", range(3, 6))):
        put(some)
        for name, app in (("final", windows_app), ("updates", time_app)):
            s = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", files).parquet(folder)
            assert "Watermark" not in app(s)._jdf.queryExecution().logical().toString()
            run_stream(app(s), f"own_{name}", path=str(tmp_path / name), checkpoint=str(tmp_path / f"ckpt_{name}"))
    for name, app, cols in (("final", windows_app, ["key", "window_start", "total"]),
                            ("updates", time_app, ["offset", "key", "window_start", "total"])):
        got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / name)).select(*cols).collect())
        want = sorted(tuple(r) for r in app(whole).select(*cols).collect())
        assert got == want and len(got) >= 4
    ckpt = str(tmp_path / "ckpt_final")
    clocks = {r["partition"]: r["clock"] // 1_000_000 - T0 // 1000 for r in read_state(spark, ckpt, "clock").collect()}
    assert clocks == {0: 102, 1: 130}
    still = sorted((r["partition"], r["k"], r["start"] // 1_000_000 - T0 // 1000) for r in read_state(spark, ckpt, "open").collect())
    assert still == [(0, "a", 100)]
    assert read_state(spark, ckpt, "due").count() == 1
