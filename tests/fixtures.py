"""Topic fixtures built from the applications' loaders (see FIXTURES.md)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.sources.schemas import APPLIANCE_ORDER, ELECTRONIC_ORDER, USER, topic_schema

# The loaders' records below (keys, users, prices, names,
# minute offsets) are the fixtures listed in FIXTURES.md; T0 replaces "now".
T0 = 1_700_000_000_000  # ms, a multiple of 10 s
SEC, MIN = 1000, 60_000


def topic(spark: SparkSession, rows: list[tuple], value_type: T.DataType = T.StringType(),
          name: str = "t") -> DataFrame:
    """rows: (partition, offset, time_ms, key, value)."""
    data = [(name, p, o, t, k, v) for p, o, t, k, v in rows]
    schema = T.StructType([
        T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()), T.StructField("time_ms", T.LongType()),
        T.StructField("key", T.StringType()), T.StructField("value", value_type)])
    df = spark.createDataFrame(data, schema)
    return df.select("topic", "partition", "offset",
                     F.timestamp_millis("time_ms").alias("timestamp"), "key", "value")


def write_files(df: DataFrame, folder: str, one_file_per_record: bool) -> str:
    """Lay a topic out as parquet files, in offset order."""
    os.makedirs(folder, exist_ok=True)
    tbl = df.orderBy("offset").toArrow()
    parts = ([tbl.slice(i, 1) for i in range(tbl.num_rows)] if one_file_per_record
             else [tbl])
    for i, part in enumerate(parts):
        _write_in_order(part, f"{folder}/part-{i:05d}.parquet", i)
    return folder


def _write_in_order(table, path: str, i: int) -> None:
    """The file stream source takes files by modification time: give each
    file its own, increasing one, so arrival order is the file order."""
    import time

    import pyarrow.parquet as pq

    pq.write_table(table, path)
    t = time.time() - 1000 + i
    os.utime(path, (t, t))


def write_ordered_files(df: DataFrame, folder: str, order: str, n_files: int) -> str:
    """Lay ``df`` out as ``n_files`` parquet files in ``order`` (arrival order)."""
    os.makedirs(folder, exist_ok=True)
    tbl = df.orderBy(order).toArrow()
    step = -(-tbl.num_rows // n_files)
    for i in range(n_files):
        _write_in_order(tbl.slice(i * step, step), f"{folder}/part-{i:05d}.parquet", i)
    return folder


def electronic(order_id, electronic_id, user_id, price, time):
    return (order_id, electronic_id, user_id, price, time)


def aggregate_loader(spark):
    prices = [("10261998", 2000.00, 0), ("1033737373", 1999.23, 10 * SEC),
              ("1026333", 4500.00, 20 * SEC), ("1038884844", 1333.98, 32 * SEC)]
    rows = [(0, i, T0 + dt, "HDTV-2333",
             electronic("instore-1", "HDTV-2333", u, p, T0 + dt))
            for i, (u, p, dt) in enumerate(prices)]
    return topic(spark, rows, ELECTRONIC_ORDER.struct, "aggregate-input")


def windows_loader(spark):
    recs = [("HDTV-2333", "10261998", 2000.00, 0), ("HDTV-2333", "1033737373", 1999.23, 15),
            ("HDTV-2333", "1026333", 4500.00, 30), ("HDTV-2333", "1038884844", 1333.98, 45),
            ("HDTV-2333", "1038884844", 1333.98, 63),
            ("SUPER-WIDE-TV-2333", "1038884844", 5333.98, 63),
            ("SUPER-WIDE-TV-2333", "1038884844", 4333.98, 108)]
    rows = [(0, i, T0 + m * MIN, k, electronic("instore-1", k, u, p, T0 + m * MIN))
            for i, (k, u, p, m) in enumerate(recs)]
    return topic(spark, rows, ELECTRONIC_ORDER.struct, "window-input")


def late_loader(spark):
    recs = [(1.0, 0), (2.0, 14999), (4.0, 1), (8.0, 15000), (16.0, 2), (32.0, 40000),
            (0.0, 90000)]
    rows = [(0, i, T0 + t, "k", electronic(f"o{i}", "k", "u", p, T0 + t))
            for i, (p, t) in enumerate(recs)]
    return topic(spark, rows, ELECTRONIC_ORDER.struct, "late-input")


def join_loaders(spark):
    left = topic(spark, [
        (0, 0, T0, "10261998", ("remodel-1", "dishwasher-1333", "10261998", T0)),
        (0, 1, T0 + 1, "10261999", ("remodel-2", "stove-2333", "10261999", T0 + 1))],
        APPLIANCE_ORDER.struct, "left-topic")
    right = topic(spark, [
        (0, 0, T0 + 2, "10261998",
         electronic("remodel-1", "television-2333", "10261998", 0.0, T0 + 2)),
        (0, 1, T0 + 3, "10261999",
         electronic("remodel-2", "laptop-5333", "10261999", 0.0, T0 + 3))],
        ELECTRONIC_ORDER.struct, "right-topic")
    users = topic(spark, [
        (0, 0, T0 + 4, "10261998", ("Elizabeth Jones", "5405 6th Avenue", "10261998")),
        (0, 1, T0 + 5, "10261999", ("Art Vandelay", "407 64th Street", "10261999"))],
        USER.struct, "table-topic")
    return left, right, users


ERROR_VALUES = ["orderNumber-1001", "orderNumber-5000", "orderNumber-999", "orderNumber-3330",
                "bogus-1", "bogus-2", "orderNumber-8400"]


def errors_loader(spark):
    return topic(spark, [(0, i, T0 + i, "order-key", v) for i, v in enumerate(ERROR_VALUES)],
                 name="error-input")
