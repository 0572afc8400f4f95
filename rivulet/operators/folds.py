"""User folds: any associative accumulator, per key, in order, in parallel.

A keyed stream application aggregates with an initializer and an aggregator
(``acc = aggregator(key, record, acc)``).  Run literally, that is one task per
key.  ``Fold`` states the same computation so that it can be cut anywhere:

* ``lift`` -- one record as an accumulator (a Column over the input),
* ``merge(a, b)`` -- the accumulator of a run of records followed by another
  run's; it must be associative, and need not be commutative or affine,
* ``init`` -- the accumulator the first record meets (optional),
* ``finish(acc)`` -- the result.

All are Catalyst expressions; no row passes through Python.  Hot keys are cut
into slices of the order column (``operators.scan``), records are numbered
within (key, slice), and blocks of ``BLOCK`` consecutive records are folded by a
higher-order function over an array.  Block totals are blocked again until one
total is left per slice, and then per key, so no array holds more than ``BLOCK``
accumulators and no task a whole hot key.  ``fold_updates`` also goes the way
down: what is before a block is merged in front of each of its running values,
which gives the accumulator after every record (the changelog of the table).

For windowed folds add the window's start to ``keys``.  ``streaming.state`` has
the stream form, one record at a time on Spark's state store.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.scan import _CHUNK, DEFAULT_ROWS_PER_CHUNK, with_hot_key_chunks

# Accumulators in one array.
BLOCK = 256


@dataclass(frozen=True)
class Fold:
    """An associative fold over records in order (see the module doc)."""

    lift: Column
    merge: Callable[[Column, Column], Column]
    finish: Callable[[Column], Column] = lambda acc: acc
    init: Column | None = None


def _numbered(df: DataFrame, keys: list[str], order: Sequence[str], fold: Fold,
              rows_per_chunk: int, payload: list[str]) -> DataFrame:
    """(keys, chunk, __i, __a, __row): records lifted and numbered per slice."""
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    d = with_hot_key_chunks(df.filter(has_key).withColumn("__a", fold.lift), keys, order[0], rows_per_chunk)
    w = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    row = F.struct(*[F.col(c) for c in payload]) if payload else F.lit(None).cast("int")
    return d.select(*keys, _CHUNK, (F.row_number().over(w) - 1).cast("long").alias("__i"), "__a", row.alias("__row"))


def _blocked(d: DataFrame, keys: list[str], fold: Fold, block: int) -> DataFrame:
    """One row per block: its records in order and the running accumulators."""
    acc = d.schema["__a"].dataType.simpleString()
    rows = d.groupBy(*keys, _CHUNK, F.floor(F.col("__i") / block).alias("__b")).agg(
        F.sort_array(F.collect_list(F.struct("__i", "__a", "__row"))).alias("__e"))
    running = F.aggregate(
        F.col("__e.__a"), F.array().cast(f"array<{acc}>"),
        lambda s, x: F.concat(s, F.array(F.when(F.size(s) == 0, x).otherwise(
            fold.merge(F.element_at(s, -1), x)).cast(acc))))
    return rows.withColumn("__s", running)


def _above(blocks: DataFrame, keys: list[str]) -> DataFrame:
    return blocks.select(*keys, _CHUNK, F.col("__b").alias("__i"), F.element_at("__s", -1).alias("__a"),
                         F.lit(None).cast("int").alias("__row"))


def _climb(d: DataFrame, keys: list[str], fold: Fold, block: int) -> list[tuple[str, DataFrame]]:
    """Rounds of blocks, lowest first, up to one block per key.  Between the
    rounds within slices and those over slices, totals are numbered by slice."""
    n_rows, n_slices = d.groupBy(*keys).agg(
        F.max("__i").alias("i"), F.countDistinct(_CHUNK).alias("c")).agg(F.max("i"), F.max("c")).first()
    rounds, most = [], (n_rows if n_rows is not None else 0) + 1
    while True:
        rounds.append(("block", _blocked(d, keys, fold, block)))
        d = _above(rounds[-1][1], keys)
        if most <= block:
            break
        most = -(-most // block)
    if (n_slices or 1) > 1:
        w = Window.partitionBy(*keys).orderBy(_CHUNK)
        d = d.select(*keys, F.lit(0).cast("long").alias(_CHUNK), (F.row_number().over(w) - 1).cast("long").alias("__i"),
                     "__a", F.col(_CHUNK).alias("__row"))
        most, first = n_slices, True
        while True:
            rounds.append(("slice" if first else "block", _blocked(d, keys, fold, block)))
            d, first = _above(rounds[-1][1], keys), False
            if most <= block:
                break
            most = -(-most // block)
    return rounds


def fold_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str], fold: Fold, out: str = "folded",
              rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK, block: int = BLOCK) -> DataFrame:
    """The fold of all records of each key: (keys, out).

    Give a total ``order``; its first column must be numeric or a time.  Records
    with a null in ``keys`` belong to no key.
    """
    keys = list(keys)
    d = _numbered(df, keys, order, fold, rows_per_chunk, [])
    total = _above(_climb(d, keys, fold, block)[-1][1], keys)
    acc = F.col("__a") if fold.init is None else fold.merge(fold.init, F.col("__a"))
    return total.select(*keys, fold.finish(acc).alias(out))


def fold_updates(df: DataFrame, keys: Sequence[str], order: Sequence[str], fold: Fold, out: str = "folded",
                 rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK, block: int = BLOCK) -> DataFrame:
    """Every record with the fold of its key so far, itself included."""
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    d = _numbered(df, keys, order, fold, rows_per_chunk, payload)
    acc_type = d.schema["__a"].dataType.simpleString()
    rounds = _climb(d, keys, fold, block)
    start = F.lit(None) if fold.init is None else fold.init
    before = None           # (keys, chunk, block number, what is before it)
    for level in range(len(rounds) - 1, -1, -1):
        kind, blocks = rounds[level]
        if before is None:
            blocks = blocks.withColumn("__before", start.cast(acc_type))
        else:
            blocks = blocks.join(before, [*keys, _CHUNK, "__b"])
        rows = blocks.select(*keys, _CHUNK, "__b", "__before", "__s", F.posexplode("__e").alias("__p", "__x"))
        join = lambda a, b: F.when(a.isNull(), b).otherwise(fold.merge(a, b)).cast(acc_type)
        if level == 0:
            acc = join(F.col("__before"), F.get("__s", F.col("__p")))
            flat = rows.select(*keys, "__x.__row.*", fold.finish(acc).alias(out))
            return flat.select(*df.columns, out)
        ahead = F.when(F.col("__p") == 0, F.col("__before")).otherwise(
            join(F.col("__before"), F.get("__s", F.col("__p") - 1)))
        if kind == "slice":     # entries are slices: their one block is block 0
            before = rows.select(*keys, F.col("__x.__row").alias(_CHUNK), F.lit(0).cast("long").alias("__b"), ahead.alias("__before"))
        else:
            before = rows.select(*keys, _CHUNK, F.col("__x.__i").alias("__b"), ahead.alias("__before"))
    raise AssertionError("no round")


# A record as the run of records it is: for the longest rising run of a column.
def rising_run(value: str, last: str | None = None) -> Fold:
    """The longest run of consecutive records with rising ``value`` -- an
    associative fold that is neither affine nor commutative -- with the last
    value of ``last``.  Result: struct(longest, last).  A null value breaks
    every run and is in none."""
    v = F.col(value).cast("double")
    one = F.when(v.isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long")
    lift = F.struct(F.lit(1).cast("long").alias("n"), v.alias("head"), v.alias("tail"), one.alias("prefix"),
                    one.alias("suffix"), one.alias("best"), F.col(last or value).alias("last"))

    def merge(a: Column, b: Column) -> Column:
        joined = F.coalesce(a["tail"] < b["head"], F.lit(False))
        return F.struct(
            (a["n"] + b["n"]).alias("n"), a["head"].alias("head"), b["tail"].alias("tail"),
            F.when(joined & (a["prefix"] == a["n"]), a["n"] + b["prefix"]).otherwise(a["prefix"]).alias("prefix"),
            F.when(joined & (b["suffix"] == b["n"]), a["suffix"] + b["n"]).otherwise(b["suffix"]).alias("suffix"),
            F.greatest(a["best"], b["best"], F.when(joined, a["suffix"] + b["prefix"]).otherwise(F.lit(0))).alias("best"),
            b["last"].alias("last"))

    return Fold(lift, merge, lambda a: F.struct(a["best"].alias("longest"), a["last"].alias("last")))
