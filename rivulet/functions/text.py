"""Column functions for text values (all JVM-side, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The digits a Java-style long parser accepts (optional sign,
# one or more ASCII digits, nothing else -- no spaces).
LONG_PATTERN = r"\A[+-]?[0-9]+\z"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains(c: Column | str, text: str) -> Column:
    """Substring test; null in, null out."""
    return _c(c).contains(text)


def after_first_dash(c: Column | str) -> Column:
    """Text after the first ``-``; the whole text when there is none."""
    c = _c(c)
    return F.substr(c, F.instr(c, "-") + F.lit(1))


def parse_long(c: Column | str, strict: bool = True) -> Column:
    """Text to bigint, null when it does not parse.

    ``strict`` follows a Java-style parser: sign and digits only, so
    ``' 2000'`` is rejected (Spark's own cast would trim it to 2000).
    Overflow gives null either way.
    """
    c = _c(c)
    casted = c.try_cast("bigint")
    if not strict:
        return casted
    return F.when(c.rlike(LONG_PATTERN), casted)


def hello(c: Column | str, greeting: str = "(DSL) Hello, ") -> Column:
    """The greeting line printed for each value of a keyless topic."""
    return F.concat(F.lit(greeting), _c(c))


def byte_length(c: Column | str) -> Column:
    """UTF-8 size of a string value."""
    return F.octet_length(_c(c))
