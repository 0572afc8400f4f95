"""Sums of doubles that do not depend on the order of their terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A double is cut into whole numbers of 2**40, of 2**-10 in the
# rest, and of 2**-60 in the rest of that.
_HIGH, _LOW = 40, 60
# Beyond this (and for NaN) a term is summed as it is.
_LARGEST = 2.0 ** 100


def order_free_sum(c: Column | str) -> Column:
    """The sum of a double column, bit-equal in any order and partitioning.

    Every term is cut exactly into three whole numbers (what is below 2**-60 is
    dropped, about 1e-18 a term); those are summed exactly, as decimals, with
    partial aggregates, and put together at the end.  An aggregate like
    ``F.sum``: nulls are skipped, no term gives null.
    """
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    plain = F.abs(x) < _LARGEST
    v = F.when(plain, x).otherwise(F.when(x.isNotNull(), F.lit(0.0)))
    high = F.floor(v / 2.0 ** _HIGH)
    rest = v - high * F.lit(2.0 ** _HIGH)               # exact, as is every step
    middle = F.floor(rest * 2.0 ** 10)
    low = F.floor((rest - middle * F.lit(2.0 ** -10)) * 2.0 ** _LOW)
    whole = lambda n: F.sum(n.cast("decimal(20,0)")).cast("double")
    total = whole(low) * 2.0 ** -_LOW + whole(middle) * 2.0 ** -10 + whole(high) * 2.0 ** _HIGH
    wild = F.sum(F.when(~plain | F.isnan(x), x))
    return F.when(wild.isNotNull(), total + wild).otherwise(total)
