"""Per-record filters and maps (no state, no shuffle).

Each is a Column expression, so a chain of them fuses into one
whole-stage-codegen span and filters on plain columns reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rivulet.functions.text import after_first_dash, contains, hello, parse_long


def filter_contains(df: DataFrame, text: str, col: str = "value") -> DataFrame:
    """Keep records whose value contains ``text`` (null values are dropped)."""
    return df.filter(contains(col, text))


def value_after_dash(df: DataFrame, col: str = "value") -> DataFrame:
    """Replace the value with the text after its first dash."""
    return df.withColumn(col, after_first_dash(col))


def filter_numeric_gt(df: DataFrame, threshold: int = 1000, col: str = "value",
                      strict: bool = True) -> DataFrame:
    """Keep records whose value parses as a long strictly above ``threshold``.

    Values that do not parse are dropped here; ``quality.quarantine_non_numeric``
    gives them as a side output instead of failing the job.
    """
    return df.filter(parse_long(col, strict) > F.lit(threshold))


def order_number_chain(df: DataFrame, marker: str = "order-", threshold: int = 1000,
                       col: str = "value", strict: bool = True) -> DataFrame:
    """The basic stream chain: contains marker -> text after dash -> number > threshold."""
    return filter_numeric_gt(value_after_dash(filter_contains(df, marker, col), col),
                             threshold, col, strict)


def tap(df: DataFrame, name: str, *cols: str) -> tuple[DataFrame, Observation | str]:
    """Observe records passing a point without changing them.

    Records a count and, per named column, the number of non-null values.
    Batch: returns an ``Observation``; stream: the metrics are in
    ``lastProgress['observedMetrics'][name]``.
    """
    metrics = [F.count(F.lit(1)).alias("records")]
    metrics += [F.count(F.col(c)).alias(f"{c}_non_null") for c in cols]
    if df.isStreaming:
        return df.observe(name, *metrics), name
    obs = Observation(name)
    return df.observe(obs, *metrics), obs


def unwindow_key(df: DataFrame, key: str = "key", window: str = "window",
                 *values: str) -> DataFrame:
    """Windowed key -> plain key: drop the window bounds."""
    keep = [c for c in df.columns if c != window] if not values else [key, *values]
    return df.select(*keep)


def rekey(df: DataFrame, key: Column | str, out: str = "key") -> DataFrame:
    """Take the record key from a field (as a string, like a topic key)."""
    k = F.col(key) if isinstance(key, str) else key
    return df.withColumn(out, k.cast("string"))


def hello_values(df: DataFrame, col: str = "value", out: str = "greeting") -> DataFrame:
    """Terminal action of the hello app, as data: the greeting per value."""
    return df.withColumn(out, hello(col))
