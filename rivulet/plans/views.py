"""Topics derived from the driver tables, shared by queries, tests and bench.

Both views keep every row of their table; the rules below only decide what
a record looks like (deletes, malformed values, arrival order).

* ``order_text_topic`` -- orders as a text topic keyed by customer: offset
  is the order key; every 13th order is a delete (null value); orders with
  status P carry a ``bogus-`` prefix instead of ``order-``; every 97th order
  number has a ``-x`` suffix and so is not a number.
* ``event_arrivals`` -- events arriving out of order: ``arrival = event_id +
  (event_id * 7919) % 50``, read in ``(arrival, event_id)`` order from topic
  partition ``user_id % 8``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rules of the derived topics (see module doc).
DELETE_EVERY = 13
NON_NUMERIC_EVERY = 97
ARRIVAL_JITTER_MULT = 7919
ARRIVAL_JITTER_MOD = 50
TOPIC_PARTITIONS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_text_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    text = F.concat(
        F.when(F.col("o_orderstatus") == "P", F.lit("bogus-")).otherwise(F.lit("order-")),
        k.cast("string"),
        F.when(k % NON_NUMERIC_EVERY == 0, F.lit("-x")).otherwise(F.lit("")))
    return o.select(k.alias("off"), F.col("o_custkey").cast("string").alias("key"),
                    F.when(k % DELETE_EVERY == 0, F.lit(None).cast("string"))
                    .otherwise(text).alias("value"))


def event_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        "event_id", "ts", "user_id", "event_type", "value",
        (eid + (eid * ARRIVAL_JITTER_MULT) % ARRIVAL_JITTER_MOD).alias("arrival"),
        (F.col("user_id") % TOPIC_PARTITIONS).alias("part"))


def events_of_type(spark: SparkSession, sf_dir: str, kind: str, *cols: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == kind)
    return e.select(*cols) if cols else e


# SQL spellings of the same views (DuckDB), used by the oracle queries.
SQL_AFTER_DASH = "substring(value, strpos(value, '-') + 1)"


def sql_parse_long(expr: str) -> str:
    return (f"(CASE WHEN regexp_full_match({expr}, '[+-]?[0-9]+') "
            f"THEN TRY_CAST({expr} AS BIGINT) END)")


SQL_TXT = f"""txt AS (
  SELECT o_orderkey AS off, CAST(o_custkey AS VARCHAR) AS key,
         CASE WHEN o_orderkey % {DELETE_EVERY} = 0 THEN NULL
              ELSE (CASE WHEN o_orderstatus = 'P' THEN 'bogus-' ELSE 'order-' END)
                   || CAST(o_orderkey AS VARCHAR)
                   || (CASE WHEN o_orderkey % {NON_NUMERIC_EVERY} = 0 THEN '-x' ELSE '' END)
         END AS value
  FROM orders)"""

SQL_ARR = f"""arr AS (
  SELECT event_id, ts, user_id, event_type, value,
         event_id + (event_id * {ARRIVAL_JITTER_MULT}) % {ARRIVAL_JITTER_MOD} AS arrival,
         user_id % {TOPIC_PARTITIONS} AS part
  FROM events)"""
