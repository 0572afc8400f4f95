"""Running (prefix) aggregates that stay parallel on hot keys.

A plain ``agg().over(partitionBy(key).orderBy(o))`` puts every row of a key
into one task.  With one key holding a third of the rows that task is the
whole job.  ``running`` therefore splits only the *hot* keys -- those with
more than ``rows_per_chunk`` rows -- into chunks along the ordering column:

1. one partial aggregate counts rows per key; the keys over the limit are
   listed once (up to ``MAX_BROADCAST_KEYS`` are broadcast, more are joined by
   shuffle).  A second one, over the rows of hot keys only, summarises their
   order column (mergeable quantile summaries, of a size that follows the
   number of chunks) and reads the cuts that give about ``rows_per_chunk`` rows
   per chunk, however the values lie: a burst, or one record fifty years before
   the rest, moves no cut far.  The cuts are fixed once, so that every part of
   the plan, and a task that runs again, cuts alike;
2. the window runs per ``(key, chunk)`` -- every other key is one chunk and
   costs exactly the plain window;
3. one total per hot chunk (a partial aggregate over the hot rows) and a
   small window over those totals give each chunk the carry of the chunks
   before it, joined back on (key, chunk), the window's own partitioning.

Whether a key is hot changes the plan, not the rows; only plain-double sums
may differ in their last digits.

A caller that knows the data can give a chunk column of its own instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.time import local_time_to_micros
from rivulet.session import new_folder

# Rows one task is meant to hold for one key: keys above it are split.
DEFAULT_ROWS_PER_CHUNK = 1 << 20

# The most hot keys whose ranges are broadcast (a few numbers per key).
MAX_BROADCAST_KEYS = 10_000

_CHUNK = "__chunk"
_HOT = "__hot"
_LOCAL = "__local"
_TOT = "__tot"
_CARRY = "__carry"


def _num(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    if isinstance(t, T.TimestampNTZType):
        return local_time_to_micros(c)
    if isinstance(t, T.TimestampType):
        return F.unix_micros(F.col(c))
    if isinstance(t, T.DateType):
        return F.unix_date(F.col(c)).cast("long")
    return F.col(c)


def with_hot_key_chunks(df: DataFrame, keys: Sequence[str], order_col: str,
                        rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
                        stats_from: DataFrame | None = None) -> DataFrame:
    """Add ``__chunk`` (0 for ordinary keys) and ``__hot`` to each row.

    A key with more than ``rows_per_chunk`` rows is cut at quantiles of its own
    order values into chunks of about ``rows_per_chunk`` rows each; rows of one
    order value stay together, and a null value is in the first chunk.  Rows
    with a null key stay one unsplit group.  ``stats_from`` may give a cheaper
    frame holding a superset of ``df``'s rows (same key and order columns) to
    size the chunks from, so that an expensive ``df`` is not evaluated once
    more just for its counts.
    """
    keys = list(keys)
    src = df if stats_from is None else stats_from
    o = _num(df, order_col)
    hot = (src.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
           .filter(F.col("__n") > F.lit(rows_per_chunk)))
    hot = hot.select(*[F.col(k).alias(f"__hk{i}") for i, k in enumerate(keys)], "__n")
    # Taken once, here: mostly no key is hot, and then the plan has no join,
    # no totals and no carries at all.  A list of checked size is broadcast;
    # a longer one is joined by shuffle, where AQE splits the hot keys.
    found = hot.limit(MAX_BROADCAST_KEYS + 1).collect()
    if not found:
        return df.withColumn(_CHUNK, F.lit(0).cast("long")).withColumn(_HOT, F.lit(False))
    few = len(found) <= MAX_BROADCAST_KEYS
    if few:
        hot = F.broadcast(df.sparkSession.createDataFrame(found, hot.schema))
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & (F.col(k) == F.col(f"__hk{i}"))
    most = max(2, -(-hot.agg(F.max("__n")).first()[0] // rows_per_chunk))
    rows = src.select(*keys, _num(src, order_col).alias("__o")).join(hot, cond)
    cuts = rows.groupBy(*[f"__hk{i}" for i in range(len(keys))]).agg(
        F.max("__n").alias("__n"), F.percentile_approx(
            "__o", [i / most for i in range(1, most + 1)], max(10_000, 20 * most)).alias("__q"))
    # ranks have to be constants: those of the hottest key, of which others take every so many
    n = F.least(F.ceil(F.col("__n") / F.lit(rows_per_chunk)).cast("int"), F.lit(int(most)))
    at = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.get(
        F.col("__q"), F.greatest(F.round(i * most / n).cast("int") - 1, F.lit(0))))
    cuts = cuts.select(*[f"__hk{i}" for i in range(len(keys))], F.array_sort(F.array_distinct(at)).alias("__cuts"))
    if few:     # one number per chunk of a hot key: rows / rows_per_chunk in all
        cuts = F.broadcast(df.sparkSession.createDataFrame(cuts.collect(), cuts.schema))
    else:
        path = new_folder(df.sparkSession, "scan", "cuts")
        cuts.write.parquet(path)
        cuts = df.sparkSession.read.schema(cuts.schema).parquet(path)
    d = df.join(cuts, cond, "left")
    # how many cuts are below the row's value, by binary search
    size = F.coalesce(F.size("__cuts"), F.lit(0))
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(int(most).bit_length()))])
    below = F.aggregate(steps, F.lit(0), lambda c, s: F.when(
        (c + s <= size) & (F.get("__cuts", c + s - 1) < o), c + s).otherwise(c))
    hot_row = F.col("__hk0").isNotNull()
    return (d.withColumn(_CHUNK, F.when(hot_row & o.isNotNull(), below).otherwise(F.lit(0)).cast("long"))
            .withColumn(_HOT, hot_row).drop(*[f"__hk{i}" for i in range(len(keys))], "__cuts"))


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
            value: Column | str, how: str, out: str, chunk: Column | None = None,
            rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
            stats_from: DataFrame | None = None) -> DataFrame:
    """Add ``out`` = running ``how`` of ``value`` per ``keys`` in ``order``.

    ``how`` is ``sum``, ``max``, ``min``, ``count`` or ``last`` (last non-null
    value; wrap a value in a struct when a null must still count, e.g. a
    delete).  The frame is ``rows between unbounded preceding and current
    row``, so give a total ``order`` for a deterministic result.

    Without ``chunk`` only hot keys are split (see the module doc; the first
    ``order`` column must be numeric or a time).  With ``chunk`` -- a column
    that does not decrease along ``order`` within a key -- every key is cut
    by it.  ``stats_from``: see ``with_hot_key_chunks``.
    """
    keys = list(keys)
    v = F.col(value) if isinstance(value, str) else value
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    if chunk is None:
        if not isinstance(order[0], str):
            raise ValueError("hot-key splitting needs the first order column by name")
        d = with_hot_key_chunks(df, keys, order[0], rows_per_chunk, stats_from)
    else:
        # Rows with a null key form one group that is not split (it has no
        # carry), so the join below can use plain equality: a null-safe join
        # key would not match the window's partitioning and cost a shuffle.
        has_key = F.lit(True)
        for k in keys:
            has_key = has_key & F.col(k).isNotNull()
        d = (df.withColumn(_CHUNK, F.when(has_key, chunk).otherwise(F.lit(0).cast("long")))
             .withColumn(_HOT, has_key))
    w_local = (Window.partitionBy(*keys, _CHUNK).orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_carry = (Window.partitionBy(*keys).orderBy(_CHUNK)
               .rowsBetween(Window.unboundedPreceding, -1))
    tot_col = F.col(_TOT)
    if how == "sum":
        local, carry = F.sum(v), F.sum(tot_col)
    elif how == "count":
        local, carry = F.count(v), F.sum(tot_col)
    elif how == "max":
        local, carry = F.max(v), F.max(tot_col)
    elif how == "min":
        local, carry = F.min(v), F.min(tot_col)
    elif how == "last":
        local, carry = F.last(v, ignorenulls=True), F.last(tot_col, ignorenulls=True)
    else:
        raise ValueError(f"unknown running aggregate {how!r}")

    with_local = d.withColumn(_LOCAL, local.over(w_local))
    # One total per chunk of a split key, straight from the input with a
    # map-side partial aggregate (a tiny shuffle).  Taking it from the
    # window's output instead re-reads and re-sorts the big shuffle; that
    # measured slower (sf0.1: running sum 2.4 s vs 1.7 s).
    total = {"sum": F.sum(v), "count": F.count(v), "max": F.max(v), "min": F.min(v),
             "last": F.max_by(v, F.when(v.isNotNull(), F.struct(*order_cols)))}[how]
    totals = d.filter(F.col(_HOT)).groupBy(*keys, _CHUNK).agg(total.alias(_TOT))
    carries = (totals.select(*keys, _CHUNK, carry.over(w_carry).alias(_CARRY))
               .filter(F.col(_CARRY).isNotNull())
               .select(*[F.col(k).alias(f"__rk{i}") for i, k in enumerate(keys)],
                       F.col(_CHUNK).alias("__rchunk"), _CARRY))
    cond = F.col(_CHUNK) == F.col("__rchunk")
    for i, k in enumerate(keys):
        cond = cond & (F.col(k) == F.col(f"__rk{i}"))
    j = with_local.join(carries, cond, "left")
    loc, car = F.col(_LOCAL), F.col(_CARRY)
    if how in ("sum", "count"):
        res = F.when(loc.isNull(), car).otherwise(loc + F.coalesce(car, F.lit(0)))
    elif how == "max":
        res = F.greatest(loc, car)
    elif how == "min":
        res = F.least(loc, car)
    else:
        res = F.coalesce(loc, car)
    return j.select(*df.columns, res.alias(out))
