"""Stream twins give the batch results (several file layouts)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rivulet.operators import enrich_asof, fold_by_key, table_from_topic
from rivulet.streaming import (changelog_writer, enrich_asof_stream, fold_by_key_stream,
                               run_stream, start_stream)
from tests.fixtures import T0, _write_in_order, topic, write_files, write_ordered_files

SF = "/root/testdata/sf0.001"


def _events_topic(spark, kind=None):
    e = spark.read.parquet(f"{SF}/events.parquet")
    if kind:
        e = e.filter(F.col("event_type") == kind)
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.mark.parametrize("files", [1, 5])
def test_fold_stream_equals_batch(spark, tmp_path, files):
    e = _events_topic(spark)
    src = write_ordered_files(e, str(tmp_path / "in"), "event_id", files)
    s = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(src)
    name = f"fold_{files}"
    run_stream(fold_by_key_stream(s, "user_id", ["event_id"], "value", "f", 0.0, 0.5),
               name, fmt="memory", checkpoint=str(tmp_path / "ckpt"))
    got = spark.sql(f"select user_id, max_by(f, event_id) as f from {name} group by user_id")
    want = {r["user_id"]: r["f"] for r in
            fold_by_key(e, "user_id", ["event_id"], "value", "f", 0.0, 0.5).collect()}
    rows = got.collect()
    assert len(rows) == len(want)
    for r in rows:
        assert r["f"] == pytest.approx(want[r["user_id"]], rel=1e-9, abs=1e-9)


def test_asof_stream_equals_batch(spark, tmp_path):
    p = _events_topic(spark, "purchase").select("event_id", "user_id", "ts")
    sgn = _events_topic(spark, "signup").select("user_id", F.col("ts").alias("sts"), "value")
    # one micro-batch holding both sides: the stream form must equal the batch form
    ps, ss = str(tmp_path / "p"), str(tmp_path / "s")
    p.write.parquet(ps)
    sgn.write.parquet(ss)
    pst = spark.readStream.schema(p.schema).parquet(ps)
    sst = spark.readStream.schema(sgn.schema).parquet(ss)
    out = enrich_asof_stream(pst, sst, "user_id", "user_id", "ts", "sts", ["value"],
                             out_cols=["signup_value"])
    run_stream(out, "asof_stream", fmt="memory", checkpoint=str(tmp_path / "ckpt"))
    got = {r["event_id"]: r["signup_value"] for r in spark.sql("select * from asof_stream")
           .collect()}
    want = {r["event_id"]: r["signup_value"] for r in enrich_asof(
        p, sgn, "user_id", "user_id", "ts", "sts", ["value"],
        out_cols=["signup_value"]).collect()}
    assert got == want


def test_asof_stream_state_carries_across_batches(spark, tmp_path):
    ch = topic(spark, [(0, 0, T0, "u", "A"), (0, 1, T0 + 20, "u", None)]) \
        .withColumn("deleted", F.col("value").isNull())
    st = topic(spark, [(0, 0, T0 + 10, "u", "x"), (0, 1, T0 + 30, "u", "y")])
    # changes first, then records; one file each, one file per micro-batch
    folder = str(tmp_path / "ch")
    write_files(ch.filter("offset = 0"), folder + "/a", False)
    write_files(ch.filter("offset = 1"), folder + "/b", False)
    chs = spark.readStream.schema(ch.schema).parquet(folder + "/a")
    sts = spark.readStream.schema(st.schema).parquet(
        write_files(st.filter("offset = 0"), str(tmp_path / "st"), False))
    out = enrich_asof_stream(sts, chs.withColumnRenamed("value", "name"), "key", "key",
                             "timestamp", "timestamp", ["name"], deleted="deleted")
    run_stream(out, "asof_state", fmt="memory", checkpoint=str(tmp_path / "ck"))
    assert [r["name"] for r in spark.sql("select * from asof_state").collect()] == ["A"]


def test_table_snapshot_in_update_mode(spark, tmp_path):
    rows = [(0, 0, 0, "a", "1"), (0, 1, 1, "b", "2"), (0, 2, 2, "a", "3"), (0, 3, 3, "b", None)]
    t = topic(spark, rows)
    src = write_files(t, str(tmp_path / "in"), True)
    s = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 2).parquet(src)
    path = str(tmp_path / "updates")
    q = start_stream(table_from_topic(s), "snap", output_mode="update",
                     foreach_batch=changelog_writer(path), checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    upd = spark.read.parquet(path)
    latest = {r["key"]: r["value"] for r in table_from_topic(
        upd.withColumn("offset", F.col("offset")), "key", "offset", "value").collect()}
    assert latest == {"a": "3", "b": None}


@pytest.mark.parametrize("files", [4, 1])
def test_running_sum_writer_splits_hot_keys_and_equals_batch(spark, tmp_path, files):
    from rivulet.streaming import running_sum_writer, with_state_before

    e = spark.read.parquet(f"{SF}/events.parquet").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    src = write_ordered_files(e, str(tmp_path / "in"), "event_id", files)
    s = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = str(tmp_path / "out")
    sink = running_sum_writer(out, "user_id", "value", ("event_id",), "rt", rows_per_chunk=40)
    start_stream(with_state_before(s, "user_id", "value"), f"rsw_{files}", foreach_batch=sink,
                 checkpoint=str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(out).select("event_id", "rt").toPandas()
    pdf = e.toPandas().sort_values("event_id")
    pdf["bf"] = pdf.groupby("user_id")["value"].cumsum()
    m = got.merge(pdf[["event_id", "bf"]], on="event_id")
    assert len(m) == len(pdf) and (m["rt"] - m["bf"]).abs().max() < 1e-6


@pytest.mark.parametrize("files", [1, 4])
def test_mark_late_equals_batch(spark, tmp_path, files):
    """The processor, and the writer that splits hot partitions."""
    from rivulet.operators import mark_late
    from rivulet.streaming import mark_late_stream, mark_late_writer, with_clock_before

    e = spark.read.parquet(f"{SF}/events.parquet").withColumn(
        "arrival", F.col("event_id") + (F.col("event_id") * 7919) % 50) \
        .withColumn("part", F.col("user_id") % 2)
    src = write_ordered_files(e, str(tmp_path / "in"), "arrival", files)
    s = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(src)
    rule = dict(ts="ts", size="6 hours", grace="0 minutes", partition="part")
    want = {r["event_id"]: (r["stream_time"], r["is_late"]) for r in mark_late(
        e, order=["arrival", "event_id"], **rule).collect()}
    out = str(tmp_path / "out")
    sink = mark_late_writer(out, order=("arrival", "event_id"), rows_per_chunk=50, **rule)
    start_stream(with_clock_before(s, "part", "ts"), f"latew_{files}", foreach_batch=sink,
                 checkpoint=str(tmp_path / "ck")).awaitTermination()
    run_stream(mark_late_stream(s, order=["arrival", "event_id"], **rule), f"lates_{files}", fmt="memory",
               checkpoint=str(tmp_path / "ck2"))
    for rows in (spark.read.parquet(out), spark.sql(f"select * from lates_{files}")):
        got = {r["event_id"]: (r["stream_time"], r["is_late"]) for r in rows.collect()}
        assert got == want
    assert sum(1 for _, late in want.values() if late) > 0


@pytest.mark.parametrize("files", [1, 4])
def test_user_fold_stream_equals_batch(spark, tmp_path, files):
    """The rising-run fold by records in order, and as a merge of pieces."""
    from rivulet.operators import fold_updates, rising_run
    from rivulet.streaming import StreamFold, fold_stream, read_state

    e = _events_topic(spark).select("event_id", "user_id", "value").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))

    def step(acc, row):
        best, cur, last = acc
        cur = 0 if row["value"] is None else cur + 1 if last is not None and row["value"] > last else 1
        return max(best, cur), cur, row["value"]

    fold = StreamFold((0, 0, None), step, "best long, cur long, last double")
    src = write_ordered_files(e, str(tmp_path / "in"), "event_id", files)
    s = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(src)
    run_stream(fold_stream(s, "user_id", ["event_id"], fold, "longest", "long"), f"ufold_{files}", fmt="memory",
               checkpoint=str(tmp_path / "ck"))
    got = {r["event_id"]: r["longest"] for r in spark.sql(f"select * from ufold_{files}").collect()}
    batch = fold_updates(e, ["user_id"], ["event_id"], rising_run("value"), "f", 60, 8).collect()
    assert got == {r["event_id"]: r["f"]["longest"] for r in batch}
    state = {r["user_id"]: (r["best"], r["last"]) for r in read_state(spark, str(tmp_path / "ck"), "acc").collect()}
    last = {}
    for r in sorted(batch, key=lambda r: r["event_id"]):
        last[r["user_id"]] = tuple(r["f"])
    assert state == last


@pytest.mark.parametrize("files", [1, 5])
def test_asof_stream_in_time_order_equals_batch(spark, tmp_path, files):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    src = write_ordered_files(ev, str(tmp_path / "in"), "ts", files)
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)

    def sides(e):
        return (e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"),
                e.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("sts"), "value"))

    run_stream(enrich_asof_stream(*sides(s), "user_id", "user_id", "ts", "sts", ["value"], out_cols=["sv"],
                                  history="1 hour"), f"asof_h_{files}", fmt="memory", checkpoint=str(tmp_path / "ck"))
    got = {r["event_id"]: r["sv"] for r in spark.sql(f"select * from asof_h_{files}").collect()}
    want = {r["event_id"]: r["sv"] for r in enrich_asof(
        *sides(ev), "user_id", "user_id", "ts", "sts", ["value"], out_cols=["sv"]).collect()}
    assert got == want and any(v is not None for v in want.values())


def test_asof_stream_answers_late_records_by_their_own_time(spark, tmp_path):
    """Records that come after newer changes, changes that come late, deletes,
    and versions that expire."""
    from rivulet.streaming import read_state

    schema = "kind string, k string, at timestamp, v int, gone boolean, n int"
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    change = lambda k, s, v, gone=False: ("c", k, t(s), v, gone, None)
    record = lambda k, s, n: ("r", k, t(s), None, None, n)
    batches = [
        [change("a", 10, 1), change("b", 1, 7), record("a", 12, 1)],
        [change("a", 5, 2), change("a", 30, 3), record("a", 7, 2), record("a", 29, 3), record("a", 30, 4), record("a", 4, 5)],
        [change("b", 30, None, True), record("a", 11, 6), record("b", 31, 7), record("b", 2, 8)],
        [change("a", 500, 9), record("a", 480, 10), record("a", 20, 11)],
        [record("a", 395, 12), record("a", 499, 13)],
    ]
    folder = tmp_path / "in"
    folder.mkdir()
    for i, b in enumerate(batches):
        _write_in_order(spark.createDataFrame(b, schema).toArrow(), f"{folder}/{i}.parquet", i)
    want = {1: 1, 2: 2, 3: 1, 4: 3, 5: None, 6: 1, 7: None, 8: 7, 10: 3, 11: 1, 12: 3, 13: 3}
    for name, history in (("keep", None), ("expire", "100 seconds")):
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
        out = enrich_asof_stream(s.filter("kind = 'r'").select("k", "at", "n"), s.filter("kind = 'c'").select("k", "at", "v", "gone"),
                                 "k", "k", "at", "at", ["v"], deleted="gone", history=history)
        ck = str(tmp_path / f"ck_{name}")
        run_stream(out, f"asof_{name}", fmt="memory", checkpoint=ck)
        got = {r["n"]: r["v"] for r in spark.sql(f"select * from asof_{name}").collect()}
        # 1, 2 and 6 came before the change that their time is after, or with it
        assert got == want
        left = sorted(r["t"] for r in read_state(spark, ck, "versions").filter("rv_k = 'a'").collect())
        assert len(left) == (4 if history is None else 2)     # 30 still covers 400 to 500
