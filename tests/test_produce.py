"""Produced records get gapless offsets and receipts; resets by run."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rivulet.functions import log_partition
from rivulet.sources import ELECTRONIC_ORDER
from rivulet.streaming import (changelog_writer, produce_stream, read_state, receipts_writer, run_stream,
                               running_sum_stream, stream_run)
from tests.fixtures import T0, _write_in_order

ORDERS = ELECTRONIC_ORDER.struct


def _orders(spark, n0, n1):
    rows = [(f"o{i}", "x" * 500 if i % 10 == 3 else "tv", None if i % 11 == 0 else f"u{i % 4}", float(i), T0 + i)
            for i in range(n0, n1)]
    return spark.createDataFrame(rows, ORDERS)


def test_offsets_receipts_replay_and_restart(spark, tmp_path):
    """A sink that fails once, and a restart with more input: every record has
    one receipt, receipts equal what was written, offsets have no gap."""
    folder, out, receipts, ck = (str(tmp_path / n) for n in ("in", "out", "receipts", "ck"))
    os.makedirs(folder)
    inner, flag = receipts_writer(out, receipts, ORDERS), str(tmp_path / "failed")

    def sink(batch, batch_id):
        inner(batch, batch_id)
        if batch_id == 1 and not os.path.exists(flag):
            open(flag, "w").close()
            raise RuntimeError("after the write")

    def run():
        s = spark.readStream.schema(ORDERS).option("maxFilesPerTrigger", 1).parquet(folder)
        run_stream(produce_stream(s, "orders", "user_id", ["time"], time_millis="time", partitions=3, max_bytes=300),
                   "produce", foreach_batch=sink, checkpoint=ck)

    for i in range(3):
        _write_in_order(_orders(spark, 20 * i, 20 * i + 20).toArrow(), f"{folder}/{i}.parquet", i)
    with pytest.raises(StreamingQueryException):
        run()
    run()
    _write_in_order(_orders(spark, 60, 75).toArrow(), f"{folder}/3.parquet", 3)
    run()

    every = _orders(spark, 0, 75)
    got = spark.read.parquet(out).select("partition", "offset", "timestamp", "key", "value").collect()
    told = spark.read.parquet(receipts).collect()
    assert len(told) == 75
    refused = [r for r in told if r["error"]]
    assert len(refused) == sum(i % 10 == 3 for i in range(75)) and all(
        r["offset"] is None and "record too large" in r["error"] for r in refused)
    assert sorted((r["partition"], r["offset"], r["timestamp"], r["key"] or "") for r in told if not r["error"]) == sorted(
        (r["partition"], r["offset"], r["timestamp"], r["key"] or "") for r in got)
    for p in {r["partition"] for r in got}:
        own = sorted((r for r in got if r["partition"] == p), key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == list(range(len(own)))
        assert [r["value"]["time"] for r in own] == sorted(r["value"]["time"] for r in own)
    place = {r["user_id"]: r["p"] for r in every.select("user_id", log_partition("user_id", 3).alias("p")).distinct().collect()}
    assert all(r["partition"] == (place[r["key"]] if r["key"] else 0) for r in got)
    assert {r["value"]["order_id"] for r in got} == {f"o{i}" for i in range(75) if i % 10 != 3}
    nexts = {r["partition"]: r["next"] for r in read_state(spark, ck, "next").collect()}
    assert nexts == {p: sum(r["partition"] == p for r in got) for p in nexts}


def test_reset_starts_a_run_of_its_own(spark, tmp_path):
    """After a reset, and a restart after it, only the new run's rows are read."""
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    _write_in_order(_orders(spark, 0, 10).toArrow(), f"{folder}/0.parquet", 0)
    app = f"resets_{os.getpid()}_{tmp_path.name}"

    def run(reset=False):
        r = stream_run(spark, app, reset)
        s = spark.readStream.schema(ORDERS).parquet(folder).withColumn("k", F.lit("a"))
        run_stream(running_sum_stream(s, "k", "price", ["time"]).select("order_id", "total"), "resets",
                   foreach_batch=changelog_writer(r.path("totals")), checkpoint=r.checkpoint)
        return r

    first = run()
    assert spark.read.parquet(first.path("totals")).count() == 10
    second = run(reset=True)
    assert second.number == first.number + 1 and second.path("totals") != first.path("totals")
    _write_in_order(_orders(spark, 10, 15).toArrow(), f"{folder}/1.parquet", 1)
    again = run()
    assert again == second
    got = spark.read.parquet(again.path("totals"))
    assert got.count() == 15 and got.agg(F.max("total")).first()[0] == sum(range(15))
    assert spark.read.parquet(first.path("totals")).count() == 10
    assert stream_run(spark, app) == second
