"""Keyed folds: final value per key, running changelog, ordered folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.sums import order_free_sum
from rivulet.operators.scan import (_CHUNK, DEFAULT_ROWS_PER_CHUNK, running,
                                    with_hot_key_chunks)


def _amount(value: str, exact_scale: int | None) -> Column:
    """The summed column; as a decimal when the result must not depend on
    summation order (a shuffle does not keep arrival order)."""
    v = F.col(value)
    return v.cast(f"decimal(18,{exact_scale})") if exact_scale is not None else v


def keyed_sum(df: DataFrame, key: str = "key", value: str = "value", out: str = "total",
              exact_scale: int | None = None) -> DataFrame:
    """Group by the existing key and sum; null keys and null values are skipped.
    The total does not depend on the order of the records.

    A partial aggregate runs before the shuffle, so a hot key sends one row
    per task.
    """
    s = (order_free_sum(value) if exact_scale is None
         else F.sum(_amount(value, exact_scale)).cast("double"))
    return (df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
            .groupBy(key).agg(s.alias(out)))


def running_sum(df: DataFrame, key: str = "key", order: Sequence[str] = ("offset",),
                value: str = "value", out: str = "total", exact_scale: int | None = None,
                chunk: Column | None = None,
                rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """The keyed sum as a changelog: one output per input, running total in
    ``order``.  Hot keys are split (see ``operators.scan``)."""
    d = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    d = d.withColumn("__amount", _amount(value, exact_scale))
    r = running(d, [key], list(order), "__amount", "sum", out, chunk, rows_per_chunk)
    if exact_scale is not None:
        r = r.withColumn(out, F.col(out).cast("double"))
    return r.drop("__amount")


def fold_by_key(df: DataFrame, key: str = "key", order: Sequence[str] = ("offset",),
                value: str = "value", out: str = "folded", init: float = 0.0,
                decay: float = 1.0, chunk: Column | None = None,
                rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Ordered fold ``acc = acc * decay + value`` per key, from ``init``.

    The fold is affine, so it is associative over consecutive runs of rows:
    a run of ``n`` rows folds to ``(n, s)`` and runs combine as
    ``s1 * decay**n2 + s2``.  A hot key (over ``rows_per_chunk`` rows) is cut
    into chunks folded in their own tasks and combined with a small window
    over the chunk table -- no key's rows are ever gathered in one place.
    ``chunk`` cuts every key by the given column instead.  ``decay=1`` is the
    plain keyed sum.
    """
    d = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    if chunk is None:
        d = with_hot_key_chunks(d, [key], order[0], rows_per_chunk)
    else:
        d = d.withColumn(_CHUNK, chunk)
    after = F.row_number().over(
        Window.partitionBy(key, "__chunk").orderBy(*[F.col(o).desc() for o in order])) - 1
    d = d.withColumn("__after", after)
    per_chunk = d.groupBy(key, "__chunk").agg(
        F.sum(F.col(value) * F.pow(F.lit(decay), F.col("__after"))).alias("__s"),
        F.count(F.lit(1)).alias("__n"))
    later = F.coalesce(F.sum("__n").over(
        Window.partitionBy(key).orderBy(F.col("__chunk").desc())
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_chunk = per_chunk.withColumn("__later", later)
    return per_chunk.groupBy(key).agg(
        (F.sum(F.col("__s") * F.pow(F.lit(decay), F.col("__later")))
         + F.lit(init) * F.pow(F.lit(decay), F.sum("__n"))).alias(out))
