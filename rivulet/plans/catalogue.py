"""The query catalogue: one Spark query per operator, each with its SQL twin.

Every query reads the driver tables (or a view derived from them, see
``plans.views``) whole.  Sums are taken as ``decimal(18,2)`` and cast back
to double so that the shuffle order cannot change a result; times are
returned as TIMESTAMP_NTZ like the zone-less tables they come from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.text import after_first_dash, parse_long
from rivulet.functions.time import local_time_to_millis, millis_to_local_time
from rivulet.operators import (combine_orders, enrich_asof, enrich_latest, error_budget,
                               fold_by_key, fold_keys, fold_updates, hello_values, interval_join,
                               keyed_sum, late_records, order_number_chain,
                               quarantine_non_numeric, rising_run, running_sum, split_oversize, stream_time, table_from_topic,
                               table_order_changelog, table_snapshot, tumbling_sum,
                               tumbling_sum_final, tumbling_sum_updates, window_start,
                               with_event_time)
from rivulet.plans.views import (SQL_AFTER_DASH, SQL_ARR, SQL_TXT, TOPIC_PARTITIONS,
                                 event_arrivals, events_of_type, order_text_topic,
                                 sql_parse_long, table)
from rivulet.sources.schemas import ELECTRONIC_ORDER, conform
from rivulet.sources.topics import decode_checked, tag_bad, to_topic_records

# Parameters of the catalogue queries.
MARKER = "order-"
THRESHOLD = 1000
BUDGET = 25
SINK_MAX_BYTES = 4096
WINDOW = "6 hours"
GRACE = "30 minutes"
JOIN_WITHIN = "30 minutes"
DECAY = 0.5
SCALE = 2

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
INPUTS: dict[str, tuple[str, ...]] = {}


def query(name: str, sql: str | None, inputs: tuple[str, ...] = ("events",)):
    """Register a query, its SQL twin and the tables it reads."""
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        INPUTS[name] = inputs
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _arr_kw(grace: str) -> dict:
    return dict(key="user_id", ts="ts", value="value", size=WINDOW, grace=grace,
                partition="part", order=["arrival", "event_id"], exact_scale=SCALE)


_PARSED_AFTER = sql_parse_long(SQL_AFTER_DASH)
_DEC_SUM = "CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE)"


# --- stateless chain and its side outputs ---------------------------------

@query("stateless_chain", f"""
WITH {SQL_TXT}
SELECT off, key, v AS value FROM (
  SELECT off, key, {SQL_AFTER_DASH} AS v FROM txt WHERE contains(value, '{MARKER}'))
WHERE {sql_parse_long('v')} > {THRESHOLD}""", ("orders",))
def stateless_chain(spark, sf_dir):
    return order_number_chain(order_text_topic(spark, sf_dir), MARKER, THRESHOLD)


@query("quarantine_non_numeric", f"""
WITH {SQL_TXT}
SELECT off, key, value, {SQL_AFTER_DASH} AS order_number FROM txt
WHERE contains(value, '{MARKER}') AND {_PARSED_AFTER} IS NULL""", ("orders",))
def quarantine_non_numeric_q(spark, sf_dir):
    return quarantine_non_numeric(order_text_topic(spark, sf_dir), MARKER)


@query("error_budget", f"""
WITH {SQL_TXT},
t AS (SELECT *, (value IS NOT NULL AND {_PARSED_AFTER} IS NULL) AS bad FROM txt),
r AS (SELECT *, SUM(CASE WHEN bad THEN 1 ELSE 0 END) OVER (
        ORDER BY off ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nbad FROM t)
SELECT off, key, value, CASE WHEN nbad > {BUDGET} THEN
         CASE WHEN bad AND nbad = {BUDGET} + 1 THEN 'failed' ELSE 'unprocessed' END
       WHEN bad THEN 'skipped' ELSE 'ok' END AS status
FROM r""", ("orders",))
def error_budget_q(spark, sf_dir):
    t = order_text_topic(spark, sf_dir)
    bad = F.col("value").isNotNull() & parse_long(after_first_dash("value")).isNull()
    return error_budget(t, bad, "off", BUDGET)


@query("split_oversize", f"""
SELECT doc_id, octet_length(encode(text)) AS n_bytes FROM documents
WHERE octet_length(encode(text)) > {SINK_MAX_BYTES}""", ("documents",))
def split_oversize_q(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    _, too_large = split_oversize(docs, "text", SINK_MAX_BYTES)
    return too_large.select("doc_id", F.col("n_bytes").cast("long").alias("n_bytes"))


@query("hello_values", """
SELECT c_custkey AS off, '(DSL) Hello, ' || c_name AS greeting FROM customer""", ("customer",))
def hello_values_q(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("off"), F.col("c_name").alias("value"))
    return hello_values(names, "value", "greeting").select("off", "greeting")


@query("conform_orders", """
SELECT CAST(event_id AS VARCHAR) AS order_id, event_type AS electronic_id,
       CAST(user_id AS VARCHAR) AS user_id,
       coalesce(CASE WHEN event_type = 'purchase' THEN value END, 0.0) AS price,
       epoch_us(ts) // 1000 AS time
FROM events""")
def conform_orders(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    raw = e.select(F.col("event_id").cast("string").alias("order_id"),
                   F.col("event_type").alias("electronic_id"),
                   F.col("user_id").alias("user_id"),
                   F.when(F.col("event_type") == "purchase", F.col("value")).alias("price"),
                   local_time_to_millis("ts").alias("time"))
    good, _ = conform(raw, ELECTRONIC_ORDER)
    return good


@query("topic_records", f"""
SELECT 'events' AS topic, CAST(user_id % {TOPIC_PARTITIONS} AS INTEGER) AS partition,
       event_id AS "offset", make_timestamp((epoch_us(ts) // 1000) * 1000) AS "timestamp",
       CAST(user_id AS VARCHAR) AS key, props AS value
FROM events""")
def topic_records(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    r = to_topic_records(e, "events", "user_id", value=F.col("props"),
                         time_millis=local_time_to_millis("ts"), offset="event_id",
                         partition=F.col("user_id") % TOPIC_PARTITIONS)
    # the record time as UTC wall clock, like the zone-less source table
    return r.withColumn("timestamp", millis_to_local_time(F.unix_millis("timestamp")))


_SQL_WORD = "(b[4*i+1] + (b[4*i+2] << 8) + (b[4*i+3] << 16) + (b[4*i+4] << 24))"


@query("topic_offsets", f"""
WITH e AS (SELECT event_id, CAST(user_id AS VARCHAR) AS key FROM events),
y AS (SELECT event_id, key, len(key) AS n,
             list_transform(string_split(key, ''), lambda x: CAST(ord(x) AS BIGINT)) AS b FROM e),
w AS (SELECT *, list_transform(range(0, n // 4), lambda i: ({_SQL_WORD} * 1540483477) & 4294967295) AS w FROM y),
h AS (SELECT *, list_reduce(list_prepend(xor(2538058380, n), list_transform(w, lambda k: (xor(k, k >> 24) * 1540483477) & 4294967295)),
                            lambda a, k: xor((a * 1540483477) & 4294967295, k)) AS h FROM w),
t AS (SELECT *, CASE n % 4 WHEN 0 THEN h ELSE
        (xor(h, b[n - n % 4 + 1] + CASE WHEN n % 4 > 1 THEN b[n - n % 4 + 2] << 8 ELSE 0 END
                + CASE WHEN n % 4 > 2 THEN b[n - n % 4 + 3] << 16 ELSE 0 END) * 1540483477) & 4294967295 END AS t FROM h),
f AS (SELECT event_id, key, (xor(t, t >> 13) * 1540483477) & 4294967295 AS f FROM t),
p AS (SELECT event_id, key, CAST(CASE WHEN key IS NULL THEN event_id % {TOPIC_PARTITIONS}
             ELSE (xor(f, f >> 15) & 2147483647) % {TOPIC_PARTITIONS} END AS INTEGER) AS partition FROM f)
SELECT event_id, key, partition, row_number() OVER (PARTITION BY partition ORDER BY event_id) - 1 AS "offset" FROM p""")
def topic_offsets(spark, sf_dir):
    """Records with a key and no offset: the log's partitioner, gapless offsets."""
    e = table(spark, sf_dir, "events")
    r = to_topic_records(e, "events", "user_id", value=F.col("event_id"), partitions=TOPIC_PARTITIONS, order=["event_id"])
    return r.select(F.col("value").alias("event_id"), "key", "partition", "offset")


@query("topic_bad_values", f"""
WITH {SQL_TXT}
SELECT off AS "offset", key, TRY_CAST({SQL_AFTER_DASH} AS DOUBLE) AS value,
       value IS NOT NULL AND TRY_CAST({SQL_AFTER_DASH} AS DOUBLE) IS NULL AS bad,
       CASE WHEN TRY_CAST({SQL_AFTER_DASH} AS DOUBLE) IS NULL THEN {SQL_AFTER_DASH} END AS raw
FROM txt""", ("orders",))
def topic_bad_values(spark, sf_dir):
    """A table topic of numbers as text, decoded once: deletes and values that
    are no numbers are both null, and told apart."""
    t = order_text_topic(spark, sf_dir).withColumnRenamed("off", "offset")
    return tag_bad(t.withColumn("value", after_first_dash("value")), T.DoubleType()).select("offset", "key", "value", "bad", "raw")


# --- upsert table -----------------------------------------------------------

@query("table_snapshot", f"""
WITH {SQL_TXT}
SELECT key, off, value FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY off DESC) AS rn
  FROM txt WHERE key IS NOT NULL)
WHERE rn = 1 AND value IS NOT NULL""", ("orders",))
def table_snapshot_q(spark, sf_dir):
    return table_snapshot(order_text_topic(spark, sf_dir), "key", "off", "value")


@query("table_latest", f"""
WITH {SQL_TXT}
SELECT key, off, value FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY off DESC) AS rn
  FROM txt WHERE key IS NOT NULL)
WHERE rn = 1""", ("orders",))
def table_latest_q(spark, sf_dir):
    """Latest record per key with deletes kept (null value)."""
    return table_from_topic(order_text_topic(spark, sf_dir), "key", "off", "value")


@query("table_order_changelog", f"""
WITH {SQL_TXT}
SELECT off, key,
       CASE WHEN contains(value, '{MARKER}') AND coalesce({_PARSED_AFTER} > {THRESHOLD}, false)
            THEN {SQL_AFTER_DASH} END AS value
FROM txt""", ("orders",))
def table_order_changelog_q(spark, sf_dir):
    return table_order_changelog(order_text_topic(spark, sf_dir), MARKER, THRESHOLD,
                                 "key", "off", "value")


# --- keyed aggregates -------------------------------------------------------

@query("keyed_sum", f"""
SELECT user_id, {_DEC_SUM} AS total FROM events
WHERE user_id IS NOT NULL AND value IS NOT NULL GROUP BY user_id""")
def keyed_sum_q(spark, sf_dir):
    return keyed_sum(table(spark, sf_dir, "events"), "user_id", "value", "total", SCALE)


@query("running_sum", """
SELECT event_id, user_id,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL""")
def running_sum_q(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    r = running_sum(e, "user_id", ["event_id"], "value", "running_total", SCALE)
    return r.select("event_id", "user_id", "running_total")


def _sql_rising(keys: str) -> str:
    """Runs of rising values per ``keys``: k is a record's place in its run."""
    return f"""b AS (
  SELECT *, CASE WHEN value > lag(value) OVER (PARTITION BY {keys} ORDER BY event_id) THEN 0 ELSE 1 END AS cut
  FROM e),
r AS (SELECT *, SUM(cut) OVER (PARTITION BY {keys} ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM b),
k AS (SELECT *, CASE WHEN value IS NULL THEN 0
                     ELSE row_number() OVER (PARTITION BY {keys}, run ORDER BY event_id) END AS k FROM r)"""


_SQL_WINDOW = f"time_bucket(INTERVAL '{WINDOW}', ts, TIMESTAMP '1970-01-01')"


@query("user_fold", f"""
WITH e AS (SELECT * FROM events WHERE user_id IS NOT NULL), {_sql_rising('user_id')}
SELECT user_id, MAX(k) AS longest_rise, arg_max(value, event_id) AS last_value FROM k GROUP BY user_id""")
def user_fold_q(spark, sf_dir):
    f = fold_keys(table(spark, sf_dir, "events"), ["user_id"], ["event_id"], rising_run("value"))
    return f.select("user_id", F.col("folded.longest").alias("longest_rise"), F.col("folded.last").alias("last_value"))


@query("user_fold_updates", f"""
WITH e AS (SELECT * FROM events WHERE user_id IS NOT NULL), {_sql_rising('user_id')}
SELECT event_id, user_id, value AS last_value,
       MAX(k) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS longest_rise FROM k""")
def user_fold_updates_q(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    f = fold_updates(e, ["user_id"], ["event_id"], rising_run("value"))
    return f.select("event_id", "user_id", F.col("folded.last").alias("last_value"),
                    F.col("folded.longest").alias("longest_rise"))


@query("user_fold_windows", f"""
WITH e AS (SELECT *, {_SQL_WINDOW} AS window_start FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
{_sql_rising('user_id, window_start')}
SELECT user_id, window_start, MAX(k) AS longest_rise, arg_max(value, event_id) AS last_value
FROM k GROUP BY user_id, window_start""")
def user_fold_windows_q(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("window_start", window_start("ts", WINDOW))
    f = fold_keys(e, ["user_id", "window_start"], ["event_id"], rising_run("value"))
    return f.select("user_id", "window_start", F.col("folded.longest").alias("longest_rise"),
                    F.col("folded.last").alias("last_value"))


@query("fold_by_key", f"""
SELECT user_id,
       round(list_reduce(list_prepend(0.0, list(value ORDER BY event_id)),
                         lambda a, x: a * {DECAY} + x), 6) AS folded
FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL GROUP BY user_id""")
def fold_by_key_q(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    f = fold_by_key(e, "user_id", ["event_id"], "value", "folded", 0.0, DECAY)
    return f.select("user_id", F.round("folded", 6).alias("folded"))


# --- windows ----------------------------------------------------------------

_SQL_MARKED = """m AS (
  SELECT *, max(ts) OVER (PARTITION BY part ORDER BY arrival, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st,
         time_bucket(INTERVAL '{size}', ts) AS ws
  FROM arr)"""
_SQL_LATE = "(ws + INTERVAL '{size}' + INTERVAL '{grace}' <= st)"


def _marked(grace: str) -> str:
    return _SQL_MARKED.format(size=WINDOW), _SQL_LATE.format(size=WINDOW, grace=grace)


@query("tumbling_sum", f"""
SELECT user_id, time_bucket(INTERVAL '{WINDOW}', ts) AS window_start, {_DEC_SUM} AS total
FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2""")
def tumbling_sum_q(spark, sf_dir):
    return tumbling_sum(table(spark, sf_dir, "events"), "user_id", "ts", "value", WINDOW,
                        "total", SCALE)


@query("tumbling_sum_final", f"""
WITH {SQL_ARR}, {_marked(GRACE)[0]},
fin AS (SELECT part, max(ts) AS fst FROM arr GROUP BY part)
SELECT m.user_id, m.ws AS window_start, {_DEC_SUM} AS total
FROM m JOIN fin USING (part)
WHERE NOT {_marked(GRACE)[1]} AND ws + INTERVAL '{WINDOW}' + INTERVAL '{GRACE}' <= fst
  AND m.user_id IS NOT NULL AND m.value IS NOT NULL
GROUP BY m.user_id, m.ws""")
def tumbling_sum_final_q(spark, sf_dir):
    return tumbling_sum_final(event_arrivals(spark, sf_dir), out="total", **_arr_kw(GRACE))


@query("tumbling_sum_updates", f"""
WITH {SQL_ARR}, {_marked(GRACE)[0]}
SELECT event_id, user_id, ws AS window_start,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id, ws
            ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DOUBLE) AS running_total
FROM m WHERE NOT {_marked(GRACE)[1]} AND user_id IS NOT NULL AND value IS NOT NULL""")
def tumbling_sum_updates_q(spark, sf_dir):
    r = tumbling_sum_updates(event_arrivals(spark, sf_dir), out="running_total",
                             **_arr_kw(GRACE))
    return r.select("event_id", "user_id", "window_start", "running_total")


@query("tumbling_sum_updates_nograce", f"""
WITH {SQL_ARR}, {_marked("0 minutes")[0]}
SELECT event_id, user_id, ws AS window_start,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id, ws
            ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DOUBLE) AS running_total
FROM m WHERE NOT {_marked("0 minutes")[1]} AND user_id IS NOT NULL AND value IS NOT NULL""")
def tumbling_sum_updates_nograce_q(spark, sf_dir):
    """The time application's output: every update, no grace."""
    r = tumbling_sum_updates(event_arrivals(spark, sf_dir), out="running_total",
                             **_arr_kw("0 minutes"))
    return r.select("event_id", "user_id", "window_start", "running_total")


def _late_sql(grace: str) -> str:
    marked, late = _marked(grace)
    return f"""
WITH {SQL_ARR}, {marked}
SELECT event_id, user_id, part, ts, ws AS window_start, st AS stream_time
FROM m WHERE {late}"""


def _late(spark, sf_dir, grace):
    kw = _arr_kw(grace)
    a = event_arrivals(spark, sf_dir)
    r = late_records(a, ts=kw["ts"], size=WINDOW, grace=grace, partition="part",
                     order=kw["order"])
    return r.select("event_id", "user_id", "part", "ts", "window_start", "stream_time")


@query("late_records", _late_sql(GRACE))
def late_records_q(spark, sf_dir):
    return _late(spark, sf_dir, GRACE)


@query("late_records_nograce", _late_sql("0 minutes"))
def late_records_nograce_q(spark, sf_dir):
    return _late(spark, sf_dir, "0 minutes")


@query("stream_time", f"""
WITH {SQL_ARR}
SELECT event_id, part, max(ts) OVER (PARTITION BY part ORDER BY arrival, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time
FROM arr""")
def stream_time_q(spark, sf_dir):
    a = event_arrivals(spark, sf_dir)
    return stream_time(a, "part", ["arrival", "event_id"], "ts", "stream_time") \
        .select("event_id", "part", "stream_time")


@query("event_time_from_millis", """
SELECT event_id, epoch_us(ts) // 1000 AS time,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS event_time
FROM events WHERE epoch_us(ts) // 1000 >= 0""")
def event_time_from_millis(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", local_time_to_millis("ts").alias("time"))
    r = with_event_time(e, "time", "event_time")
    return r.withColumn("event_time", millis_to_local_time("time"))


# --- joins ------------------------------------------------------------------

def _views_purchases(spark, sf_dir):
    v = events_of_type(spark, sf_dir, "view").select(
        F.col("event_id").alias("view_id"), F.col("user_id").alias("v_user"),
        F.col("ts").alias("v_ts"), F.col("props").alias("v_props"))
    p = events_of_type(spark, sf_dir, "purchase").select(
        F.col("event_id").alias("purchase_id"), F.col("user_id").alias("p_user"),
        F.col("ts").alias("p_ts"))
    return interval_join(v, p, "v_user", "p_user", "v_ts", "p_ts", JOIN_WITHIN)


_SQL_IJ = f"""ij AS (
  SELECT v.user_id, v.event_id AS view_id, p.event_id AS purchase_id, v.props AS v_props,
         greatest(v.ts, p.ts) AS time
  FROM events v JOIN events p
    ON v.user_id = p.user_id
   AND p.ts BETWEEN v.ts - INTERVAL '{JOIN_WITHIN}' AND v.ts + INTERVAL '{JOIN_WITHIN}'
  WHERE v.event_type = 'view' AND p.event_type = 'purchase')"""


@query("interval_join", f"""
WITH {_SQL_IJ}
SELECT user_id, view_id, purchase_id, time FROM ij""")
def interval_join_q(spark, sf_dir):
    j = _views_purchases(spark, sf_dir)
    return j.select(F.col("v_user").alias("user_id"), "view_id", "purchase_id",
                    F.greatest("v_ts", "p_ts").alias("time"))


@query("enrich_latest", """
SELECT p.event_id, p.user_id, coalesce(c.c_name, '') AS user_name
FROM events p LEFT JOIN customer c ON p.user_id = c.c_custkey
WHERE p.event_type = 'purchase' AND p.user_id IS NOT NULL""", ("events", "customer"))
def enrich_latest_q(spark, sf_dir):
    p = events_of_type(spark, sf_dir, "purchase", "event_id", "user_id")
    c = table(spark, sf_dir, "customer")
    return enrich_latest(p, c, "user_id", "c_custkey", "c_name", "user_name")


@query("enrich_asof", """
SELECT p.event_id, p.user_id, p.ts, s.value AS signup_value
FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'
      AND user_id IS NOT NULL) p
ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'signup') s
  ON p.user_id = s.user_id AND p.ts >= s.ts""")
def enrich_asof_q(spark, sf_dir):
    p = events_of_type(spark, sf_dir, "purchase", "event_id", "user_id", "ts")
    s = events_of_type(spark, sf_dir, "signup", "user_id", "ts", "value")
    return enrich_asof(p, s, "user_id", "user_id", "ts", "ts", ["value"],
                       out_cols=["signup_value"])


@query("join_enriched", f"""
WITH {_SQL_IJ}
SELECT CAST(ij.user_id AS VARCHAR) AS key, CAST(purchase_id AS VARCHAR) AS electronic_order_id,
       CAST(view_id AS VARCHAR) AS appliance_order_id, v_props AS appliance_id,
       coalesce(c.c_name, '') AS user_name, epoch_us(time) // 1000 AS time
FROM ij LEFT JOIN customer c ON ij.user_id = c.c_custkey""", ("events", "customer"))
def join_enriched(spark, sf_dir):
    j = _views_purchases(spark, sf_dir).select(
        F.col("v_user").cast("string").alias("key"),
        F.col("purchase_id").cast("string").alias("purchase_id"),
        F.col("view_id").cast("string").alias("view_id"), "v_props",
        local_time_to_millis(F.greatest("v_ts", "p_ts")).alias("t_ms"))
    combined = combine_orders(j, "key", "view_id", "v_props", "purchase_id", F.col("t_ms"))
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("user_key"), "c_name")
    return enrich_latest(combined, users, "key", "user_key", "c_name", "user_name")


# --- hot keys: the same results when every larger key is split -------------
# Rows per chunk small enough that keys of the small tables split.
SPLIT_KEY_ROWS, SPLIT_PARTITION_ROWS = 20, 1000


@query("running_sum_split", ORACLE["running_sum"])
def running_sum_split_q(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return running_sum(e, "user_id", ["event_id"], "value", "running_total", exact_scale=SCALE,
                       rows_per_chunk=SPLIT_KEY_ROWS).select("event_id", "user_id", "running_total")


@query("stream_time_split", ORACLE["stream_time"])
def stream_time_split_q(spark, sf_dir):
    arr = event_arrivals(spark, sf_dir)
    return stream_time(arr, "part", ["arrival", "event_id"], "ts", "stream_time",
                       rows_per_chunk=SPLIT_PARTITION_ROWS).select("event_id", "part", "stream_time")


@query("enrich_asof_split", ORACLE["enrich_asof"])
def enrich_asof_split_q(spark, sf_dir):
    p = events_of_type(spark, sf_dir, "purchase", "event_id", "user_id", "ts")
    s = events_of_type(spark, sf_dir, "signup", "user_id", "ts", "value")
    return enrich_asof(p, s, "user_id", "user_id", "ts", "ts", ["value"],
                       out_cols=["signup_value"], rows_per_chunk=SPLIT_KEY_ROWS)


@query("enrich_asof_deletes", """
SELECT p.event_id, p.user_id, p.ts, s.value AS signup_value
FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'
      AND user_id IS NOT NULL) p
ASOF LEFT JOIN (SELECT user_id, ts, CASE WHEN event_id % 5 <> 0 THEN value END AS value
                FROM events WHERE event_type = 'signup') s
  ON p.user_id = s.user_id AND p.ts >= s.ts""")
def enrich_asof_deletes_q(spark, sf_dir):
    p = events_of_type(spark, sf_dir, "purchase", "event_id", "user_id", "ts")
    s = events_of_type(spark, sf_dir, "signup", "event_id", "user_id", "ts", "value")
    return enrich_asof(p, s, "user_id", "user_id", "ts", "ts", ["value"], deleted=F.col("event_id") % 5 == 0,
                       out_cols=["signup_value"])


# --- bad input: kept aside, whatever its kind ------------------------------

@query("decode_bad_numbers", """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(event_id + 0 AS VARCHAR) END AS number,
       CASE WHEN event_id % 7 = 0 THEN CAST(event_id AS VARCHAR) || 'x' END AS rejected FROM events""")
def decode_bad_numbers_q(spark, sf_dir):
    text = F.concat(F.col("event_id").cast("string"), F.when(F.col("event_id") % 7 == 0, "x").otherwise(""))
    good, bad = decode_checked(table(spark, sf_dir, "events").select("event_id", text.alias("value")), T.LongType())
    return good.select("event_id", F.col("value").cast("string").alias("number"), F.lit(None).cast("string").alias("rejected")).unionByName(
        bad.select("event_id", F.lit(None).cast("string").alias("number"), F.col("value").alias("rejected")))


@query("decode_bad_json", """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id, event_id % 7 = 0 AS rejected
FROM events WHERE user_id IS NOT NULL""")
def decode_bad_json_q(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("user_id is not null")
    text = F.concat(F.lit('{"user_id": '), F.col("user_id").cast("string"), F.when(F.col("event_id") % 7 == 0, ", ").otherwise("}"))
    shape = T.StructType([T.StructField("user_id", e.schema["user_id"].dataType)])
    good, bad = decode_checked(e.select("event_id", text.alias("value")), shape)
    return good.select("event_id", F.col("value.user_id").cast("string").alias("user_id"), F.lit(False).alias("rejected")).unionByName(
        bad.select("event_id", F.lit(None).cast("string").alias("user_id"), F.lit(True).alias("rejected")))


@query("conform_rejects", """
SELECT CAST(event_id AS VARCHAR) AS order_id,
       CASE WHEN event_id % 7 = 0 THEN 'price' ELSE '' END AS invalid,
       CASE WHEN event_id % 11 = 0 THEN 'electronic_id' ELSE '' END AS missing
FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0""")
def conform_rejects_q(spark, sf_dir):
    n = F.col("event_id")
    raw = table(spark, sf_dir, "events").select(
        n.cast("string").alias("order_id"), F.when(n % 11 != 0, F.col("event_type")).alias("electronic_id"),
        F.coalesce(F.col("user_id").cast("string"), F.lit("none")).alias("user_id"),
        F.when(n % 7 == 0, "cheap").otherwise("1.5").alias("price"), local_time_to_millis("ts").alias("time"))
    _, bad = conform(raw, ELECTRONIC_ORDER)
    return bad.select("order_id", F.array_join("invalid", ",").alias("invalid"), F.array_join("missing", ",").alias("missing"))
