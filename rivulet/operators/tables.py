"""Upsert tables read from a changelog topic.

A table is the latest value per key of a topic; a null value is a delete
(tombstone).  Filters and maps on a table act on its changelog: a row that
fails a table filter becomes a delete for its key instead of vanishing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import after_first_dash, contains, parse_long


def table_from_topic(df: DataFrame, key: str = "key", offset: str = "offset",
                     value: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    """Latest record per key, deletes included (value null).

    ``max_by`` over a struct is a partial aggregate: each task reduces its
    rows to one per key before the shuffle, so a hot key costs one row per
    task, not all its rows in one task.  Null keys are skipped.
    """
    rec = F.struct(F.col(offset).alias(offset), F.col(value).alias(value),
                   *[F.col(c).alias(c) for c in carry])
    latest = (df.filter(F.col(key).isNotNull())
              .groupBy(key).agg(F.max_by(rec, F.col(offset)).alias("_latest")))
    return latest.select(key, "_latest.*")


def table_snapshot(df: DataFrame, key: str = "key", offset: str = "offset",
                   value: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    """Current contents of an upsert topic: latest per key, deletes removed."""
    return table_from_topic(df, key, offset, value, carry).filter(F.col(value).isNotNull())


def table_filter(df: DataFrame, pred: Column, value: str = "value") -> DataFrame:
    """Filter on a changelog: a failing row becomes a delete (null value)."""
    return df.withColumn(value, F.when(pred, F.col(value)))


def table_map_values(df: DataFrame, fn: Callable[[Column], Column],
                     value: str = "value") -> DataFrame:
    """Map the value of each changelog row; a delete stays a delete."""
    v = F.col(value)
    return df.withColumn(value, F.when(v.isNotNull(), fn(v)))


def table_to_changelog(df: DataFrame, key: str = "key", offset: str = "offset",
                       value: str = "value") -> DataFrame:
    """The table as its stream of updates (deletes included), one per input."""
    return df.select(offset, key, value)


def table_order_changelog(df: DataFrame, marker: str = "order-", threshold: int = 1000,
                          key: str = "key", offset: str = "offset", value: str = "value",
                          strict: bool = True) -> DataFrame:
    """Filter -> map -> filter over an upsert table, emitted as its changelog.

    Every input update gives one output update: the order number, or a
    delete when the value fails a filter (or was already a delete).
    """
    t = table_filter(df, contains(value, marker), value)
    t = table_map_values(t, after_first_dash, value)
    t = table_filter(t, F.coalesce(parse_long(value, strict) > F.lit(threshold), F.lit(False)),
                     value)
    return table_to_changelog(t, key, offset, value)
