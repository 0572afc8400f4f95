"""Written tables that cut lineage, and connected components over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.session import new_folder


EDGES = 250_000


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: later
    jobs survive the loss of any executor without recomputing it."""
    path = new_folder(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each made longer until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph with long node ids.

    ``edges``: columns ``a``, ``b``.  Returns (node, root): every node that
    has an edge to another node, and the smallest node it reaches.

    Alternates large-star and small-star steps until nothing changes.  Only
    minima are grouped (partial aggregates); neighbours are never collected,
    and a hot node's edges meet its minimum in a join that AQE can split.
    Each step runs in tasks of about ``EDGES`` edges.
    """
    def distinct(df: DataFrame) -> DataFrame:
        return df.where("u <> v").distinct()

    def signature(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = store(distinct(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), "edges")
    seen = signature(e)
    while seen[0]:
        tasks = seen[0] // EDGES + 1
        both = e.select(F.col("v").alias("x"), F.col("v").alias("y")).union(
            e.select(F.col("u").alias("x"), F.col("v").alias("y")))
        # every neighbour above x goes to the smallest of x and its neighbours
        low = both.groupBy("x").agg(F.min("y").alias("m"))
        large = distinct(e.join(low, e.v == low.x).select("u", F.col("m").alias("v")).coalesce(tasks)).coalesce(tasks)
        low = large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        joined = large.join(low, large.u == low.x)
        small = distinct(joined.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").coalesce(tasks))
        e = store(small.coalesce(tasks), "edges")
        now = signature(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
