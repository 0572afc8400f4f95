import pytest
from pyspark.sql import functions as F

from rivulet.operators import enrich_asof, enrich_latest, interval_join
from rivulet.plans.apps import join_app
from rivulet.streaming import run_stream
from tests.fixtures import MIN, T0, join_loaders, topic, write_files

EXPECTED = [("10261998", "remodel-1", "remodel-1", "dishwasher-1333"),
            ("10261999", "remodel-2", "remodel-2", "stove-2333")]


def _rows(df):
    return sorted((r["key"], r["electronic_order_id"], r["appliance_order_id"],
                   r["appliance_id"], r["user_name"]) for r in df.collect())


def test_join_app_latest_lookup(spark):
    left, right, users = join_loaders(spark)
    got = _rows(join_app(left, right, users, lookup="latest"))
    assert got == [e + (n,) for e, n in zip(EXPECTED, ["Elizabeth Jones", "Art Vandelay"])]


def test_join_app_asof_lookup_misses_users_written_later(spark):
    left, right, users = join_loaders(spark)
    got = _rows(join_app(left, right, users, lookup="asof"))
    assert got == [e + ("",) for e in EXPECTED]


def test_join_app_clock_is_a_parameter(spark):
    left, right, users = join_loaders(spark)
    out = join_app(left, right, users, clock=F.lit(42).cast("long")).collect()
    assert {r["time"] for r in out} == {42}
    out = join_app(left, right, users).collect()
    assert sorted(r["time"] for r in out) == [T0 + 2, T0 + 3]


def _pair(spark, dt_ms):
    l = spark.createDataFrame([("u", 1, T0)], "lk string, lid int, lt long") \
        .withColumn("lts", F.timestamp_millis("lt"))
    r = spark.createDataFrame([("u", 2, T0 + dt_ms)], "rk string, rid int, rt long") \
        .withColumn("rts", F.timestamp_millis("rt"))
    return interval_join(l, r, "lk", "rk", "lts", "rts", "30 minutes").count()


@pytest.mark.parametrize("dt_ms,n", [(30 * MIN, 1), (-30 * MIN, 1), (30 * MIN + 1, 0),
                                     (-30 * MIN - 1, 0), (0, 1), (29 * MIN, 1)])
def test_interval_bounds_inclusive(spark, dt_ms, n):
    assert _pair(spark, dt_ms) == n


def test_interval_join_matches_brute_force(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    l = e.select(F.col("event_id").alias("a"), F.col("user_id").alias("ua"),
                 F.col("ts").alias("ta"))
    r = e.select(F.col("event_id").alias("b"), F.col("user_id").alias("ub"),
                 F.col("ts").alias("tb"))
    got = {(x["a"], x["b"]) for x in interval_join(l, r, "ua", "ub", "ta", "tb",
                                                   "3 hours").collect()}
    pdf = e.toPandas()
    m = pdf.merge(pdf, on="user_id")
    m = m[(m["ts_y"] - m["ts_x"]).abs() <= __import__("pandas").Timedelta(hours=3)]
    assert got == set(zip(m["event_id_x"], m["event_id_y"]))


def test_unknown_user_keeps_default_name(spark):
    s = spark.createDataFrame([("x", "")], "key string, user_name string")
    t = spark.createDataFrame([("y", "Y")], "k string, name string")
    assert enrich_latest(s, t, "key", "k", "name").collect()[0]["user_name"] == ""


def test_asof_tombstone_clears_value(spark):
    s = spark.createDataFrame([("u", 10), ("u", 30)], "key string, t long") \
        .withColumn("ts", F.timestamp_millis("t"))
    ch = spark.createDataFrame([("u", 5, "A", False), ("u", 20, None, True)],
                               "key string, t long, name string, deleted boolean") \
        .withColumn("ts", F.timestamp_millis("t"))
    out = enrich_asof(s, ch, "key", "key", "ts", "ts", ["name"], deleted=F.col("deleted"),
                      out_cols=["nm"])
    assert sorted((r["t"], r["nm"]) for r in out.collect()) == [(10, "A"), (30, None)]


def test_join_app_stream(spark, tmp_path):
    left, right, users = join_loaders(spark)
    ls = spark.readStream.schema(left.schema).parquet(
        write_files(left, str(tmp_path / "l"), False))
    rs = spark.readStream.schema(right.schema).parquet(
        write_files(right, str(tmp_path / "r"), False))
    run_stream(join_app(ls, rs, users), "join_stream", fmt="memory",
               checkpoint=str(tmp_path / "ckpt"))
    got = _rows(spark.sql("select * from join_stream"))
    assert got == [e + (n,) for e, n in zip(EXPECTED, ["Elizabeth Jones", "Art Vandelay"])]


def test_null_keys_are_skipped_by_both_joins(spark):
    l = spark.createDataFrame([(None, 1, T0), ("u", 2, T0)], "lk string, lid int, lt long") \
        .withColumn("lts", F.timestamp_millis("lt"))
    r = spark.createDataFrame([(None, 3, T0), ("u", 4, T0)], "rk string, rid int, rt long") \
        .withColumn("rts", F.timestamp_millis("rt"))
    pairs = interval_join(l, r, "lk", "rk", "lts", "rts").collect()
    assert [(p["lid"], p["rid"]) for p in pairs] == [(2, 4)]
    t = spark.createDataFrame([("u", "U")], "k string, name string")
    out = enrich_latest(l, t, "lk", "k", "name", "user_name").collect()
    assert [(o["lid"], o["user_name"]) for o in out] == [(2, "U")]


def test_interval_join_of_width_zero(spark):
    from rivulet.operators import interval_join

    a = spark.sql("select 'k' as lk, timestamp'2024-01-01 00:00:01' as lt union all select 'k', timestamp'2024-01-01 00:00:02'")
    b = spark.sql("select 'k' as rk, timestamp'2024-01-01 00:00:01' as rt")
    assert interval_join(a, b, "lk", "rk", "lt", "rt", "0 seconds").count() == 1
