"""Global order without a global sort: ranges of a column and gapless numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def range_of(df: DataFrame, column: str, n: int) -> tuple[Column, int]:
    """Which of about ``n`` ranges, cut at approximate quantiles, a row's value
    is in (ascending; nulls behind all), and how many ranges there are.  Equal
    values are in one range.  The cuts (at most n numbers) go into the plan."""
    cuts = df.agg(F.percentile_approx(F.col(column), [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0]
    cuts = sorted(set(cuts or []))
    if not cuts:
        return F.lit(0), 1
    edges = F.array(*[F.lit(c) for c in cuts])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(cuts).bit_length()))])
    # how many cuts are below the value, by binary search
    below = F.aggregate(steps, F.lit(0), lambda c, s: F.when(
        (c + s <= len(cuts)) & (F.get(edges, c + s - 1) < F.col(column)), c + s).otherwise(c))
    return F.when(F.col(column).isNull(), len(cuts) + 1).otherwise(below).cast("int"), len(cuts) + 2


def number(df: DataFrame, keys: list[str], part: Column, order: list, name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2 ... within equal ``keys``, by (part, order).

    ``part`` cuts a hot key into pieces of bounded size that follow the order:
    a window numbers the rows of a piece, and the pieces before it are counted
    by a partial aggregate (one row per key and piece)."""
    rows = df.withColumn("__part", part)
    piece = [*keys, "__part"]
    counts = rows.groupBy(*piece).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    counts = counts.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(piece)], "__before")
    same = F.lit(True)
    for i, c in enumerate(piece):
        same = same & rows[c].eqNullSafe(counts[f"__c{i}"])
    own = Window.partitionBy(*piece).orderBy(*order)
    return (rows.withColumn("__row", F.row_number().over(own)).join(counts, same)
            .withColumn(name, (F.col("__before") + F.col("__row") - 1).cast("long"))
            .drop("__part", "__row", "__before", *[f"__c{i}" for i in range(len(piece))]))
