import os

import pytest
from pyspark.errors import StreamingQueryException

from rivulet.streaming import (RetryPolicy, changelog_writer, read_state, read_table, run_stream,
                               run_with_policy, start_stream, start_table, stream_checkpoint)
from rivulet.session import checkpoint_root
from tests.fixtures import _write_in_order, topic, write_files


def _flaky_sink(out, flag, message):
    inner = changelog_writer(out)

    def fn(batch, batch_id):
        inner(batch, batch_id)  # written, then the batch fails once
        if not os.path.exists(flag):
            open(flag, "w").close()
            raise RuntimeError(message)
    return fn


def _source(spark, tmp_path):
    t = topic(spark, [(0, i, i, "k", f"order-{1000 + i}") for i in range(6)])
    src = write_files(t, str(tmp_path / "in"), True)
    return spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 2).parquet(src)


def test_retryable_failure_restarts_from_checkpoint(spark, tmp_path):
    s = _source(spark, tmp_path)
    out, flag = str(tmp_path / "out"), str(tmp_path / "flag")
    sink = _flaky_sink(out, flag, "Retryable transient error")
    policy = RetryPolicy(max_restarts=2)
    run_with_policy(lambda: start_stream(s, "flaky", foreach_batch=sink,
                                         checkpoint=str(tmp_path / "ckpt")), policy)
    assert policy.restarts == 1
    got = spark.read.parquet(out)
    assert got.count() == 6  # the replayed batch overwrote its own folder
    assert sorted(r["offset"] for r in got.collect()) == list(range(6))


def test_other_failure_stops(spark, tmp_path):
    s = _source(spark, tmp_path)
    sink = _flaky_sink(str(tmp_path / "out"), str(tmp_path / "flag"), "disk on fire")
    with pytest.raises(StreamingQueryException, match="disk on fire"):
        run_with_policy(lambda: start_stream(s, "fatal", foreach_batch=sink,
                                             checkpoint=str(tmp_path / "ckpt")))


def test_checkpoint_identity(spark):
    root = checkpoint_root(spark)
    assert stream_checkpoint(spark, "app") == f"{root}/streams/app"
    assert stream_checkpoint(spark, "app", reset=True) != stream_checkpoint(spark, "app", True)


def test_materialized_table_upserts_and_deletes(spark, tmp_path):
    rows = [(0, 0, 0, "a", "1"), (0, 1, 1, "b", "2"), (0, 2, 2, "a", "3"),
            (0, 3, 3, "b", None), (0, 4, 4, "c", "5")]
    t = topic(spark, rows)
    src = write_files(t, str(tmp_path / "in"), True)
    s = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 2).parquet(src)
    ckpt = str(tmp_path / "ckpt")
    start_table(s, "store", checkpoint=ckpt).awaitTermination()
    snap = {r["key"]: r["value"] for r in read_table(spark, ckpt).collect()}
    assert snap == {"a": "3", "c": "5"}


def test_state_survives_restart(spark, tmp_path):
    """Stop after the first files, add more, restart on the same checkpoint:
    the per-record totals continue from the saved state."""
    from rivulet.plans.apps import aggregate_app
    from tests.test_aggregates import golden_topic

    t = golden_topic(spark)
    folder = str(tmp_path / "in")
    write_files(t.filter("offset < 2"), folder, True)
    out = str(tmp_path / "out")
    ckpt = str(tmp_path / "ckpt")

    def run():
        s = spark.readStream.schema(t.schema).parquet(folder)
        start_stream(aggregate_app(s), "restart", foreach_batch=changelog_writer(out),
                     checkpoint=ckpt).awaitTermination()

    run()
    import pyarrow.parquet as pq
    pq.write_table(t.filter("offset = 2").toArrow(), f"{folder}/part-late.parquet")
    run()
    got = sorted((r["offset"], r["total"]) for r in spark.read.parquet(out).collect())
    assert got == [(0, 5.0), (1, 20.0), (2, 45.0)]


def test_table_state_keeps_latest_and_costs_its_keys(spark, tmp_path):
    """Deletes and late older records, over many micro-batches and a restart:
    the state holds one row per key, and every batch writes what it touches."""
    rows = [(0, i, i, k, v) for i, (k, v) in enumerate(
        [("a", "1"), ("b", "2"), ("a", "3"), ("b", None), ("c", "5"), ("a", None),
         ("d", "7"), ("c", "8")])]
    t = topic(spark, rows)
    folder, ckpt = str(tmp_path / "in"), str(tmp_path / "ckpt")
    write_files(t, folder, True)

    def run():
        s = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        q = start_table(s, "table_state", checkpoint=ckpt, changes=str(tmp_path / "changes"))
        q.awaitTermination()
        return q

    run()
    assert {r["key"]: (r["offset"], r["value"]) for r in read_table(spark, ckpt).collect()} == {"c": (7, "8"), "d": (6, "7")}
    late = topic(spark, [(0, 1, 1, "b", "old"), (0, 9, 9, "d", None)])
    _write_in_order(late.toArrow(), f"{folder}/part-99999.parquet", 99)
    q = run()
    assert {r["key"]: r["value"] for r in read_table(spark, ckpt).collect()} == {"c": "8"}
    kept = {r["key"]: (r["offset"], r["value"]) for r in read_table(spark, ckpt, deletes=True).collect()}
    assert kept == {"a": (5, None), "b": (3, None), "c": (7, "8"), "d": (9, None)}
    assert spark.read.parquet(str(tmp_path / "changes")).count() == 10


def test_a_hundred_batches_cost_the_same(spark, tmp_path):
    """State stays as large as the keys, and a late micro-batch reads and writes
    no more state rows and files than an early one."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from rivulet.streaming import running_sum_stream

    folder, ckpt = str(tmp_path / "in"), str(tmp_path / "ckpt")
    os.makedirs(folder)
    for i in range(100):
        path = f"{folder}/{i:03d}.parquet"
        pq.write_table(pa.table({"key": ["a", f"k{i % 5}"], "offset": [2 * i, 2 * i + 1], "value": [1.0, 2.0]}), path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    s = spark.readStream.schema("key string, offset long, value double").option("maxFilesPerTrigger", 1).parquet(folder)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    keep = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "200")
    try:
        q = run_stream(running_sum_stream(s), "hundred", fmt="noop", checkpoint=ckpt)
        steps = [p["stateOperators"][0] for p in q.recentProgress if p["numInputRows"]]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", keep)
    assert len(steps) == 100
    early, late = steps[10:20], steps[90:]
    for field in ("numRowsUpdated", "numRowsTotal"):
        assert max(x[field] for x in late) <= max(x[field] for x in early)
    reads = lambda xs: max(x["customMetrics"].get("rocksdbGetCount", 0) for x in xs)
    assert reads(late) <= reads(early)
    got = {r["key"]: r["acc"] for r in read_state(spark, ckpt, "acc").collect()}
    assert got == {"a": 100.0, **{f"k{i}": 40.0 for i in range(5)}}


def test_lookup_sees_table_updates_between_batches(spark, tmp_path):
    from rivulet.sources.schemas import USER
    from rivulet.streaming import enrich_latest_writer

    users = topic(spark, [(0, 0, 0, "u1", ("Ann", "x", "u1"))], USER.struct)
    users2 = topic(spark, [(0, 1, 1, "u1", ("Anna", "x", "u1"))], USER.struct)
    orders = topic(spark, [(0, 0, 0, "u1", "o1")])
    orders2 = topic(spark, [(0, 1, 1, "u1", "o2"), (0, 2, 2, "u9", "o3")])
    out = str(tmp_path / "out")
    uck = str(tmp_path / "uck")

    def users_run(df, name):
        import pyarrow.parquet as pq
        os.makedirs(tmp_path / "uin", exist_ok=True)
        pq.write_table(df.toArrow(), str(tmp_path / "uin" / f"part-{name}.parquet"))
        s = spark.readStream.schema(users.schema).parquet(str(tmp_path / "uin"))
        start_table(s, "users", checkpoint=uck).awaitTermination()

    def orders_run(df, name):
        import pyarrow.parquet as pq
        os.makedirs(tmp_path / "oin", exist_ok=True)
        pq.write_table(df.toArrow(), str(tmp_path / "oin" / f"part-{name}.parquet"))
        s = spark.readStream.schema(orders.schema).parquet(str(tmp_path / "oin"))
        start_stream(s, "orders", foreach_batch=enrich_latest_writer(uck, out, "key", "name"),
                     checkpoint=str(tmp_path / "ock")).awaitTermination()

    orders_run(topic(spark, [(0, 5, 5, "u1", "o0")]), "0")      # before there is a table
    users_run(users, "a")
    orders_run(orders, "a")
    users_run(users2, "b")
    orders_run(orders2, "b")
    got = sorted((r["value"], r["user_name"]) for r in spark.read.parquet(out).collect())
    assert got == [("o0", ""), ("o1", "Ann"), ("o2", "Anna"), ("o3", "")]
