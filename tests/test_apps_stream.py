"""The stateless applications give the same records on a stream as in batch."""

import pytest
from pyspark.sql import functions as F

from rivulet.operators import rekey, unwindow_key
from rivulet.plans.apps import basic_app, errors_app, hello_app, table_app, time_app
from rivulet.streaming import changelog_writer, run_stream, start_stream
from tests.fixtures import ERROR_VALUES, topic, windows_loader, write_files

VALUES = ["order-1001", "order-999", None, "bogus-5000", "order-12-x", "order-7000",
          "orderNumber-4000", "orderNumber-9-9"]


def _text_topic(spark):
    return topic(spark, [(0, i, i, f"k{i % 3}", v) for i, v in enumerate(VALUES)])


def _stream(spark, df, folder, per_record=True):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 3).parquet(
        write_files(df, folder, per_record))


def _same(spark, name, stream_df, batch_df, tmp_path, cols):
    run_stream(stream_df, name, fmt="memory", checkpoint=str(tmp_path / f"ck_{name}"))
    got = sorted(tuple(str(r[c]) for c in cols) for r in spark.sql(f"select * from {name}")
                 .collect())
    want = sorted(tuple(str(r[c]) for c in cols) for r in batch_df.collect())
    assert got == want
    return got


@pytest.mark.parametrize("app", ["basic", "table"])
def test_stateless_apps_stream_equals_batch(spark, tmp_path, app):
    t = _text_topic(spark)
    s = _stream(spark, t, str(tmp_path / "in"))
    fn = {"basic": basic_app, "table": table_app}[app]
    _same(spark, f"app_{app}", fn(s), fn(t), tmp_path, ["offset", "key", "value"])


def test_errors_app_stream_side_output(spark, tmp_path):
    t = topic(spark, [(0, i, i, "k", v) for i, v in enumerate(ERROR_VALUES + VALUES)])
    s = _stream(spark, t, str(tmp_path / "in"))
    good_s, bad_s = errors_app(s)
    good_b, bad_b = errors_app(t)
    _same(spark, "err_good", good_s, good_b, tmp_path, ["offset", "value"])
    got = _same(spark, "err_bad", bad_s, bad_b, tmp_path, ["offset", "order_number"])
    assert got == [("14", "9-9")]


def test_hello_app_stream(spark, tmp_path):
    t = topic(spark, [(0, i, i, None, n) for i, n in enumerate(["Ann", "Bo"])])
    s = _stream(spark, t, str(tmp_path / "in"))
    _same(spark, "hello", hello_app(s), hello_app(t), tmp_path, ["greeting"])


def test_time_app_stream_updates_end_in_batch_totals(spark, tmp_path):
    t = windows_loader(spark)
    s = _stream(spark, t, str(tmp_path / "in"))
    path = str(tmp_path / "updates")
    q = start_stream(time_app(s), "time_updates", foreach_batch=changelog_writer(path), checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    upd = spark.read.parquet(path)
    last = upd.groupBy("key", "window_start").agg(F.max_by("total", "offset").alias("total"))
    batch = time_app(t).groupBy("key", "window_start").agg(
        F.max_by("total", "offset").alias("total"))
    norm = lambda df: sorted((r["key"], str(r["window_start"]), round(r["total"], 6))  # noqa
                             for r in df.collect())
    assert norm(last) == norm(batch)


def test_rekey_and_unwindow(spark):
    df = spark.createDataFrame([(7, "a", 1.0)], "user_id long, k string, total double") \
        .withColumn("window", F.struct(F.lit(0).alias("start")))
    r = rekey(df, "user_id")
    assert r.collect()[0]["key"] == "7"
    assert unwindow_key(r).columns == ["user_id", "k", "total", "key"]
