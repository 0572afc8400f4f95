import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.operators import (ErrorBudgetExceeded, check_error_budget, error_budget,
                               split_malformed, split_oversize)
from rivulet.sources.schemas import ELECTRONIC_ORDER
from rivulet.streaming import error_budget_writer, start_stream
from tests.fixtures import topic, write_files


def _budget_topic(spark, n_bad=30, every=3):
    rows, bad = [], 0
    for i in range(n_bad * every):
        v = "{bad json" if i % every == 0 else '{"order_id": "o%d", "price": 1.0}' % i
        rows.append((0, i, i, "k", v))
    return topic(spark, rows)


def test_budget_batch_cut_at_26th_bad(spark):
    t = _budget_topic(spark)
    good, bad = split_malformed(t, ELECTRONIC_ORDER.struct)
    assert bad.count() == 30
    flagged = t.withColumn("bad", F.col("value").startswith("{bad"))
    out = error_budget(flagged, F.col("bad"), "offset", 25)
    n = {r["status"]: r["count"] for r in out.groupBy("status").count().collect()}
    cut = 25 * 3   # offset of the 26th bad record
    assert n == {"ok": 50, "skipped": 25, "failed": 1, "unprocessed": t.count() - cut - 1}
    assert out.filter("status = 'failed'").first()["offset"] == cut
    with pytest.raises(ErrorBudgetExceeded):
        check_error_budget(26)
    check_error_budget(25)


def test_budget_stream_survives_restart_and_fails_on_26th(spark, tmp_path):
    t = _budget_topic(spark)
    src = write_files(t, str(tmp_path / "in"), False)
    # split the input over several files so the budget spans micro-batches
    s = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out, quar = str(tmp_path / "out"), str(tmp_path / "quarantine")
    sink = error_budget_writer(out, quar, F.col("value").startswith("{bad"), "offset", 25)
    q = start_stream(s, "budget", foreach_batch=sink, checkpoint=str(tmp_path / "ckpt"))
    with pytest.raises(StreamingQueryException, match="budget"):
        q.awaitTermination()
    assert spark.read.parquet(quar).count() == 25
    assert spark.read.parquet(out).agg(F.max("offset")).first()[0] == 25 * 3 - 1
    # a restart replays the failed batch: still 25 quarantined, fails again
    q = start_stream(s, "budget", foreach_batch=sink, checkpoint=str(tmp_path / "ckpt"))
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()
    assert spark.read.parquet(quar).count() == 25


def test_split_malformed_types(spark):
    t = topic(spark, [(0, 0, 0, "k", '{"order_id":"a","price":2.5,"time":5}'),
                      (0, 1, 1, "k", '{"order_id":"b","price":"cheap"}'),
                      (0, 2, 2, "k", None)])
    good, bad = split_malformed(t, ELECTRONIC_ORDER.struct)
    assert [r["value"]["order_id"] for r in good.collect()] == ["a"]
    assert sorted(r["offset"] for r in bad.collect()) == [1, 2]


def test_split_oversize(spark):
    df = spark.createDataFrame([("a" * 10,), ("é" * 10,), ("b" * 30,)], "value string")
    ok, big = split_oversize(df, "value", 15)
    assert sorted(r["n_bytes"] for r in ok.collect()) == [10]
    assert sorted(r["n_bytes"] for r in big.collect()) == [20, 30]
    assert isinstance(big.schema["n_bytes"].dataType, T.IntegerType)


def test_budget_with_repeated_offsets_over_partitions(spark):
    """Partitions are read in step; no row of another partition vanishes."""
    rows = [(0, 0, 0, "k", "{bad"), (0, 1, 1, "k", "{bad"), (0, 2, 2, "k", "{bad"),
            (1, 0, 0, "k", "a"), (1, 1, 1, "k", "b"), (1, 2, 2, "k", "c"), (1, 3, 3, "k", "d")]
    t = topic(spark, rows)
    out = error_budget(t, F.col("value").startswith("{bad"), "offset", 2)
    got = {(r["partition"], r["offset"]): r["status"] for r in out.collect()}
    assert got == {(0, 0): "skipped", (1, 0): "ok", (0, 1): "skipped", (1, 1): "ok", (0, 2): "failed",
                   (1, 2): "unprocessed", (1, 3): "unprocessed"}


def test_bad_records_are_counted_over_partitions_and_restarts(spark, tmp_path):
    """Text read with tags: the 25th bad record passes aside, the 26th fails the
    query, again after a restart, and good records are not held up before it."""
    import os

    import pytest
    from pyspark.errors import StreamingQueryException
    from pyspark.sql import types as T

    from rivulet.sources import read_topic
    from rivulet.streaming import budget_stream, read_state, run_stream
    from tests.fixtures import _write_in_order, topic

    folder, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    os.makedirs(folder)
    n = [0, 0]

    def put(name, bad):
        rows = []
        for i in range(20):
            p = i % 2
            value = "nonsense" if i < bad else None if i == 19 else str(i)
            rows.append((p, n[p], i, f"k{i}", value))
            n[p] += 1
        _write_in_order(topic(spark, rows).toArrow(), f"{folder}/{name}.parquet", name)

    def run():
        t = read_topic(spark, folder, value_type=T.LongType(), stream=True, options={"values": "text"}, on_bad="tag",
                       max_files_per_trigger=1)
        run_stream(budget_stream(t), "budget", path=out, checkpoint=ck)

    put(0, 10)
    put(1, 10)
    run()
    put(2, 5)
    run()                                       # 25 by now
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 60 and sorted(r["nth_bad"] for r in rows if r["bad"]) == list(range(1, 26))
    assert all(r["raw"] == "nonsense" and r["value"] is None for r in rows if r["bad"])
    assert sum(r["value"] is None and not r["bad"] for r in rows) == 3          # deletes
    put(3, 0)
    run()
    put(4, 1)
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="bad record budget of 25 exceeded at offset 40, partition 0"):
            run()
    assert spark.read.parquet(out).count() == 80
    assert [r["bad"] for r in read_state(spark, ck, "bad").collect()] == [25]
