"""Bad records as data: side outputs instead of crashes, and error budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.text import after_first_dash, byte_length, contains, parse_long

# Default limits of the error policies.
DEFAULT_ERROR_BUDGET = 25          # bad input records skipped before the job fails
DEFAULT_MAX_RECORD_BYTES = 1048576  # largest record a sink accepts


class ErrorBudgetExceeded(RuntimeError):
    """More bad input records than the budget allows."""


def split_malformed(df: DataFrame, value_type: T.StructType, col: str = "value",
                    corrupt: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Decode JSON values to ``value_type``; returns ``(good, malformed)``.

    Undecodable records (bad JSON, wrong types, or null) go to ``malformed``
    with their raw text, instead of failing the read.
    """
    schema = T.StructType(list(value_type.fields) + [T.StructField(corrupt, T.StringType())])
    parsed = df.withColumn("__parsed", F.from_json(
        F.col(col).cast("string"), schema,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}))
    bad_c = F.col(col).isNull() | F.col(f"__parsed.{corrupt}").isNotNull()
    good = parsed.filter(~bad_c).withColumn(col, F.col("__parsed").dropFields(corrupt)) \
        .drop("__parsed")
    bad = parsed.filter(bad_c).drop("__parsed")
    return good, bad


def split_oversize(df: DataFrame, col: str = "value",
                   max_bytes: int = DEFAULT_MAX_RECORD_BYTES) -> tuple[DataFrame, DataFrame]:
    """Records that fit the sink vs. those too large for it (``n_bytes`` added)."""
    d = df.withColumn("n_bytes", byte_length(col))
    return d.filter(F.col("n_bytes") <= max_bytes), d.filter(F.col("n_bytes") > max_bytes)


def non_numeric_order(col: str = "value", marker: str = "order-") -> Column:
    """Marked as an order, but the text after the dash is not a number."""
    return contains(col, marker) & parse_long(after_first_dash(col)).isNull()


def quarantine_non_numeric(df: DataFrame, marker: str = "order-", col: str = "value"
                           ) -> DataFrame:
    """Records the numeric filter cannot parse, kept instead of crashing."""
    return df.filter(non_numeric_order(col, marker)).withColumn(
        "order_number", after_first_dash(col))


def error_budget(df: DataFrame, is_bad: Column, order: str | Sequence[str] = "offset",
                 budget: int = DEFAULT_ERROR_BUDGET) -> DataFrame:
    """What a run with a bad-record budget does with each record, in batch.

    Bad records are skipped while at most ``budget`` have been seen; the
    next one fails the run.  No row is dropped: ``status`` is ``ok`` or
    ``skipped`` before the cut, ``failed`` for the record that fails the run
    and ``unprocessed`` after it.  ``order`` is the arrival order; when only
    ``offset`` is given and the records have a ``partition``, partitions are
    read in step (offset, then partition), since offsets repeat over them.
    The cut is a distributed top-k over the bad records only (``budget + 1``
    rows reach the driver).
    """
    names = [order] if isinstance(order, str) else list(order)
    if names == ["offset"] and "partition" in df.columns:
        names.append("partition")
    bad = F.coalesce(is_bad, F.lit(False))
    first = df.filter(bad).select(*names).orderBy(*names).limit(budget + 1).collect()
    before = F.when(bad, "skipped").otherwise("ok")
    if len(first) <= budget:
        return df.withColumn("status", before)
    here = F.struct(*[F.col(n) for n in names])
    cut = F.struct(*[F.lit(v).alias(n) for n, v in zip(names, first[budget])])
    return df.withColumn("status", F.when(here < cut, before)
                         .when((here == cut) & bad, "failed").otherwise("unprocessed"))


def check_error_budget(bad_so_far: int, budget: int = DEFAULT_ERROR_BUDGET) -> None:
    """Raise once more than ``budget`` bad records have been seen."""
    if bad_so_far > budget:
        raise ErrorBudgetExceeded(
            f"{bad_so_far} bad records exceed the budget of {budget}")
