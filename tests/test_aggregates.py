import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivulet.operators import fold_by_key, keyed_sum, running, running_sum
from rivulet.plans.apps import aggregate_app
from rivulet.sources.schemas import ELECTRONIC_ORDER
from rivulet.streaming import run_stream
from tests.fixtures import aggregate_loader, topic, write_files

SF = "/root/testdata/sf0.001"


def golden_topic(spark):
    orders = [("1", "one", "vandeley", 5.0, 5), ("2", "one", "penny-packer", 15.0, 5),
              ("3", "one", "romanov", 25.0, 5)]
    return topic(spark, [(0, i, 0, o[1], o) for i, o in enumerate(orders)],
                 ELECTRONIC_ORDER.struct)


def test_golden_running_total_batch(spark):
    out = aggregate_app(golden_topic(spark)).orderBy("offset").collect()
    assert [r["total"] for r in out] == [5.0, 20.0, 45.0]


@pytest.mark.parametrize("per_record", [True, False])
def test_golden_running_total_stream(spark, tmp_path, per_record):
    src = write_files(golden_topic(spark), str(tmp_path / "in"), per_record)
    s = spark.readStream.schema(golden_topic(spark).schema).parquet(src)
    name = f"agg_{per_record}"
    run_stream(aggregate_app(s), name, fmt="memory",
               checkpoint=str(tmp_path / "ckpt"))
    got = [r["total"] for r in spark.sql(f"select * from {name}").orderBy("offset").collect()]
    assert got == [5.0, 20.0, 45.0]


def test_aggregate_loader_changelog(spark):
    out = aggregate_app(aggregate_loader(spark)).orderBy("offset").collect()
    assert [r["total"] for r in out] == pytest.approx([2000.00, 3999.23, 8499.23, 9833.21],
                                                      abs=1e-6)
    final = keyed_sum(aggregate_loader(spark).select("key", F.col("value.price").alias("p")),
                      "key", "p").collect()
    assert final[0]["total"] == pytest.approx(9833.21, abs=1e-6)


def _events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


@pytest.mark.parametrize("chunks", [1, 7, 64])
def test_running_sum_matches_brute_force_for_any_chunking(spark, chunks):
    e = _events(spark)
    chunk = F.floor(F.col("event_id") / F.lit(max(1, 1000 // chunks)))
    got = running_sum(e, "user_id", ["event_id"], "value", "rt", 2, chunk=chunk).toPandas()
    pdf = e.toPandas().sort_values("event_id")
    pdf["rt"] = pdf.groupby("user_id")["value"].cumsum()
    m = got.merge(pdf[["event_id", "rt"]], on="event_id", suffixes=("", "_bf"))
    assert len(m) == len(pdf)
    assert (m["rt"] - m["rt_bf"]).abs().max() < 1e-6


def test_running_last_and_max_with_chunks(spark):
    e = _events(spark).withColumn(
        "v", F.when(F.col("event_type") == "signup", F.col("value")))
    chunk = F.floor(F.col("event_id") / F.lit(37))
    r = running(e, ["user_id"], ["event_id"], "v", "last", "last_v", chunk)
    r = running(r, ["user_id"], ["event_id"], "value", "max", "max_v", chunk).toPandas()
    pdf = e.toPandas().sort_values("event_id")
    pdf["last_v"] = pdf.groupby("user_id")["v"].ffill()
    pdf["max_v"] = pdf.groupby("user_id")["value"].cummax()
    m = r.merge(pdf, on="event_id", suffixes=("", "_bf"))
    assert ((m["last_v"].fillna(-1) - m["last_v_bf"].fillna(-1)).abs() < 1e-9).all()
    assert ((m["max_v"] - m["max_v_bf"]).abs() < 1e-9).all()


@pytest.mark.parametrize("decay", [1.0, 0.5, 0.9])
def test_fold_by_key_matches_sequential_fold(spark, decay):
    e = _events(spark)
    chunk = F.floor(F.col("event_id") / F.lit(53))
    got = fold_by_key(e, "user_id", ["event_id"], "value", "f", 1.5, decay, chunk).toPandas()
    pdf = e.toPandas().sort_values("event_id")
    expect = {}
    for uid, g in pdf.groupby("user_id"):
        a = 1.5
        for x in g["value"]:
            a = a * decay + x
        expect[uid] = a
    assert len(got) == len(expect)
    for uid, f in zip(got["user_id"], got["f"]):
        assert f == pytest.approx(expect[uid], rel=1e-9, abs=1e-9)


def test_keyed_sum_skips_null_key_and_value(spark):
    df = spark.createDataFrame(pd.DataFrame({"key": ["a", "a", None, "b"],
                                             "value": [1.0, None, 5.0, 2.0]}))
    got = {r["key"]: r["total"] for r in keyed_sum(df).collect()}
    assert got == {"a": 1.0, "b": 2.0}


def test_running_keeps_null_key_group_whole(spark):
    e = _events(spark).withColumn(
        "k", F.when(F.col("user_id") % 5 == 0, F.lit(None)).otherwise(F.col("user_id")))
    chunk = F.floor(F.col("event_id") / F.lit(40))
    got = running(e, ["k"], ["event_id"], "value", "sum", "rt", chunk).toPandas()
    pdf = e.toPandas().sort_values("event_id")
    pdf["bf"] = pdf.groupby("k", dropna=False)["value"].cumsum()
    m = got.merge(pdf[["event_id", "bf"]], on="event_id")
    assert len(m) == len(pdf) and (m["rt"] - m["bf"]).abs().max() < 1e-9


def test_sums_do_not_depend_on_order_or_partitions(spark):
    """Terms of very different sizes: bit-equal totals, near the exact sum."""
    import math
    import random
    import struct

    from rivulet.functions import order_free_sum
    from rivulet.operators import tumbling_sum

    r = random.Random(4)
    rows = [(f"k{i % 3}", r.choice([-1, 1]) * r.random() * 10.0 ** r.randrange(-12, 16), i) for i in range(3000)]
    rows += [("k0", None, 1), ("none", None, 1), ("one", 0.1, 1), ("inf", math.inf, 1), ("inf", 1.0, 2), ("big", 1e300, 1), ("big", 2.5, 2)]
    seen = set()
    for parts in (1, 3, 8, 64):
        r.shuffle(rows)
        df = spark.createDataFrame(rows, "key string, value double, i long").repartition(parts)
        got = {x["key"]: x["total"] for x in df.groupBy("key").agg(order_free_sum("value").alias("total")).collect()}
        ts = df.withColumn("timestamp", F.timestamp_seconds(F.lit(100)))
        assert {x["key"]: x["total"] for x in tumbling_sum(ts).collect()} == {k: v for k, v in got.items() if v is not None}
        assert {x["key"]: x["total"] for x in keyed_sum(df).collect()} == {k: v for k, v in got.items() if v is not None}
        seen.add(tuple(sorted((k, v if v is None else struct.pack("d", v)) for k, v in got.items())))
    assert len(seen) == 1
    for k in ("k0", "k1", "k2"):
        exact = math.fsum(v for key, v, _ in rows if key == k and v is not None)
        assert abs(got[k] - exact) <= 2 * math.ulp(exact) + 1e-14
    assert got["none"] is None and got["one"] == 0.1 and got["inf"] == math.inf and got["big"] == 1e300
