"""Mixing sources to target weights by a multivariate-hypergeometric tree.

Each source's documents are put in one permuted order (by a hash of the id)
and cut into blocks of ``block`` words; a document belongs to the block of its
first word.  A source's target words, over as many epochs as it takes, are an
exact quota of blocks.  The quotas of all sources are split between the output
shards by a binary tree: at each node the left half's blocks are a draw
without replacement (multivariate hypergeometric) from the node's quotas, so
every shard gets a random share of each source and the shares add up exactly.
Within a source, a seeded permutation of its blocks deals disjoint runs of
them to the shards, and a shard orders its documents by another hash.

The tree works on one row per source, on the driver, up to ``MAX_SOURCES``.
Beyond, sources are numbered in ranges, shares are found by aggregates, and the
tree goes in two steps: the driver draws for buckets of sources, then a task
per bucket draws for its sources what the bucket was given; a draw from a draw
has the law of one.  Documents are only scanned, counted per (source, piece of the
order), and numbered within pieces, so a source of any size is cut into
pieces of about ``PIECE`` documents.  The shuffled rows are (id, source,
size, hash).

Targets: sources by code point, nulls last, weigh ``weights`` in turn and share
all words; a target stops at ``cap`` times its source, and the excess is
shared again by weight.  The last document of a source's last epoch may be
taken in part, so a source gives its target to the word.

Edge cases: null and empty texts have size 0 and are never taken; a null
source is a source; a source without words has target 0; repeated rows count
each; a null id is ordered by its text's hash, and rows of equal order by
another hash of the text; texts of any length are counted whole, one at a time;
other columns are not read by ``mix`` and stay as they are in ``take``, whatever
their names; empty tables give empty results.
"""

from __future__ import annotations

from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm._store import store, unused

WEIGHTS, CAP, SHARDS, BLOCK, SEED = (5, 2, 1), 3, 8, 4096, "mix-1"
MAX_SOURCES, PIECE = 100_000, 200_000
PLAN = ("source_ string, source_size long, target double, whole long, rest long, per_epoch long, blocks long, "
        "step long, shift long, cuts array<long>")
PLAN_COLUMNS = [c.split()[0] for c in PLAN.split(", ")]
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[int], cap: int = CAP) -> list[float]:
    """Share sum(sizes) by weight; nobody gets more than cap * size."""
    total, full = sum(sizes), set()
    while True:
        open_ = [i for i in range(len(sizes)) if i not in full]
        if not open_:
            return [float(cap * s) for s in sizes]
        share = (total - sum(cap * sizes[i] for i in full)) / sum(weights[i] for i in open_)
        over = {i for i in open_ if weights[i] * share > cap * sizes[i]}
        if not over:
            return [float(cap * sizes[i]) if i in full else weights[i] * share for i in range(len(sizes))]
        full |= over


def split(quotas: np.ndarray, shards: int, rng: np.random.Generator, given: np.ndarray | None = None) -> np.ndarray:
    """Blocks of each source for each shard (sources x shards): at every node
    of a binary tree the left shards' blocks are drawn from the node's.  Shards
    get equal shares, or as many blocks as ``given`` says."""
    out = np.zeros((len(quotas), shards), np.int64)

    def node(blocks: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo == 1:
            out[:, lo] = blocks
            return
        mid = (lo + hi) // 2
        n = int(blocks.sum())
        k = n * (mid - lo) // (hi - lo) if given is None else int(given[lo:mid].sum())
        left = rng.multivariate_hypergeometric(blocks, k, method="marginals") if n else blocks
        node(left, lo, mid)
        node(blocks - left, mid, hi)

    if len(quotas):
        node(quotas.astype(np.int64), 0, shards)
    return out


def plan(totals: list[tuple[str | None, int]], weights=WEIGHTS, cap: int = CAP, shards: int = SHARDS,
         block: int = BLOCK, seed: str = SEED) -> list[tuple]:
    """One row per source: source, source_size, target, epochs taken whole,
    words of the last epoch, blocks per epoch, blocks taken, multiplier and
    shift of the block permutation, shard boundaries in permuted blocks."""
    totals = sorted(totals, key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [s for _, s in totals]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], cap)
    rng = np.random.Generator(np.random.PCG64([len(totals), *seed.encode()]))
    rows = []
    for (source, size), target in zip(totals, goal):
        quota = int(np.floor(target + 0.5))
        whole, rest = divmod(quota, size) if size else (0, 0)
        per_epoch = -(-size // block)
        rows.append([source, size, target, whole, rest, per_epoch, whole * per_epoch + -(-rest // block)])
    parts = split(np.array([r[6] for r in rows], np.int64), shards, rng)
    return [(*row, *_permutation(row[6], rng), np.cumsum(part).tolist()) for row, part in zip(rows, parts)]


def _permutation(blocks: int, rng: np.random.Generator) -> tuple[int, int]:
    """Multiplier and shift."""
    n = max(1, blocks)
    step = int(rng.integers(1, n + 1))
    while gcd(step, n) != 1:
        step = step % n + 1
    return step, int(rng.integers(0, n))


def plan_many(found: DataFrame, weights, cap: int, shards: int, block: int, seed: str) -> DataFrame:
    """``plan`` as a table, for any number of sources.  ``found``: source,
    size, n.  The driver sees one row per ``MAX_SOURCES`` sources."""
    spark, most = found.sparkSession, MAX_SOURCES
    named = found.where("source is not null")
    ranged = store(named.repartitionByRange(named.count() // most + 1, "source").withColumn("part", F.spark_partition_id()), "ranged")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row per range
    counts = ranged.groupBy("part").agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("earlier"))
    own = Window.partitionBy("part").orderBy("source")
    numbered = ranged.withColumn("row", F.row_number().over(own)).join(counts, "part").select(
        "source", "size", (F.col("earlier") + F.col("row") - 1).alias("i"))
    numbered = numbered.unionByName(found.where("source is null").select("source", "size", F.lit(ranged.count()).cast("long").alias("i")))
    every = F.array(*[F.lit(w) for w in weights])
    numbered = store(numbered.withColumn("w", F.get(every, (F.col("i") % len(weights)).cast("int"))), "numbered")
    # as ``targets``: the share only grows, so those beyond their cap are known from it
    total, used = numbered.agg(F.sum("size"), F.sum("w")).first()
    share, full = total / used, 0
    while True:
        over = F.col("w") * F.lit(share) > cap * F.col("size")
        capped, used, n = numbered.agg(
            F.coalesce(F.sum(F.when(over, cap * F.col("size"))), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("w"))), F.lit(0)),
            F.count_if(over)).first()
        if n == full:
            break
        full, share = n, (total - capped) / used if used else float("inf")
    goal = F.when(F.col("w") * F.lit(share) > cap * F.col("size"), (cap * F.col("size")).cast("double")).otherwise(F.col("w") * F.lit(share))
    quota, size = F.col("quota"), F.greatest(F.col("size"), F.lit(1))
    rows = numbered.withColumn("target", goal).withColumn("quota", F.floor(F.col("target") + 0.5)).select(
        F.floor(F.col("i") / most).alias("bucket"), "i", F.col("source").alias("source_"), F.col("size").alias("source_size"), "target",
        F.when(F.col("size") > 0, F.floor((quota - quota % size) / size)).otherwise(0).cast("long").alias("whole"),
        F.when(F.col("size") > 0, quota % size).otherwise(0).cast("long").alias("rest"),
        F.ceil(F.col("size") / block).alias("per_epoch"))
    rows = store(rows.withColumn("blocks", F.col("whole") * F.col("per_epoch") + F.ceil(F.col("rest") / block)), "quotas")
    buckets = rows.groupBy("bucket").agg(F.sum("blocks").alias("n")).orderBy("bucket").collect()
    rng = np.random.Generator(np.random.PCG64([full, *seed.encode()]))
    quotas = np.array([r["n"] for r in buckets], np.int64)
    # numpy draws from less than 1e9 blocks at once: runs of buckets that have no more
    runs = np.cumsum(quotas) // (4 * 10**8) if quotas.sum() >= 9 * 10**8 else np.zeros(len(quotas), np.int64)
    parts = np.concatenate([split(quotas[runs == r], shards, rng) for r in np.unique(runs)])
    given = spark.createDataFrame([(r["bucket"], p.tolist()) for r, p in zip(buckets, parts)], "bucket long, given array<long>")

    def draw(table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        blocks = table["blocks"].to_numpy()
        rng = np.random.Generator(np.random.PCG64([table["bucket"][0].as_py() + 1, *seed.encode()]))
        parts = split(blocks, shards, rng, np.array(table["given"][0].as_py()))
        moves = [_permutation(int(n), rng) for n in blocks]
        for k, name in enumerate(("step", "shift")):
            table = table.append_column(name, pa.array([m[k] for m in moves], pa.int64()))
        table = table.append_column("cuts", pa.array(np.cumsum(parts, axis=1).tolist(), pa.list_(pa.int64())))
        return table.select(PLAN_COLUMNS)

    return store(rows.join(given, "bucket").groupBy("bucket").applyInArrow(draw, PLAN), "plan")


def _draw_key(seed: str, id_col: str, text_col: str) -> Column:
    key = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    return F.md5(F.concat(F.lit(seed + ":"), key))


def _placed(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, shards: int = SHARDS, block: int = BLOCK, seed: str = SEED,
            id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, int]:
    """Every row with its source's plan and ``before``, the words ahead of it
    in its source's order, and the block size.  Rows of equal ``draw`` and
    ``text_key`` in one source follow each other in the order."""
    spark = docs.sparkSession
    thin = store(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        _draw_key(seed, id_col, text_col).alias("draw"), F.xxhash64(text_col).alias("text_key")), "sizes")
    totals = thin.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    found = totals.limit(MAX_SOURCES + 1).collect()
    many = len(found) > MAX_SOURCES
    if many:
        totals = store(totals, "totals")
        size, n = totals.agg(F.sum("size"), F.sum("n")).first()
    else:
        size, n = sum(r["size"] for r in found), sum(r["n"] for r in found)
    # so that no source, however large, needs more than 1e8 blocks or so
    block = max(block, -(-size // 10**8))
    if many:
        sources = plan_many(totals, weights, cap, shards, block, seed)
    else:
        # at most MAX_SOURCES rows of fixed width
        sources = F.broadcast(spark.createDataFrame(
            plan([(r["source"], r["size"]) for r in found], weights, cap, shards, block, seed), PLAN))
    # words before a document in its source's order: of earlier pieces, and within its piece
    pieces = n // PIECE + 1
    rows = thin.withColumn("part", F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("double") * pieces / float(1 << 32)).cast("int"))
    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("source", "part").orderBy("draw", "size", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(sums, rows["source"].eqNullSafe(sums["s"]) & (rows["part"] == sums["p"]))
    rows = rows.join(sources, rows["source"].eqNullSafe(sources["source_"]))
    return rows.withColumn("before", F.col("earlier") + F.col("within")), block


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, shards: int = SHARDS, block: int = BLOCK, seed: str = SEED,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document: id, source, size, source_size, target, taken (words), and
    draws: one (epoch, shard, block, words, place) for each time it is taken;
    ``words`` below the size means the first words only, ``place`` orders the
    documents of a shard."""
    rows, block = _placed(docs, weights, cap, shards, block, seed, id_col, text_col, source_col)
    before = F.col("before")
    last = F.least(F.greatest(F.col("rest") - before, F.lit(0)), F.col("size"))

    def draw(epoch: Column) -> Column:
        number = epoch * F.col("per_epoch") + F.floor(before / block)
        rank = F.pmod(number * F.col("step") + F.col("shift"), F.greatest(F.col("blocks"), F.lit(1)))
        return F.struct(
            epoch.cast("int").alias("epoch"),
            F.size(F.filter("cuts", lambda c: c <= rank)).alias("shard"), rank.alias("block"),
            F.when(epoch < F.col("whole"), F.col("size")).otherwise(last).alias("words"),
            F.xxhash64("draw", epoch).alias("place"))

    draws = F.filter(F.transform(F.sequence(F.lit(0).cast("long"), F.col("whole")), draw), lambda d: d["words"] > 0)
    out = rows.withColumn("draws", draws)
    return out.select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target",
        F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["words"]).alias("taken"), "draws")


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         n_chars_col: str | None = "n_chars", seed: str = SEED, **options) -> DataFrame:
    """The mix as documents: the rows of ``docs``, all columns, once for each
    time a document is taken; one taken in part keeps its first words, joined
    by one space.  Rows are found by draw key, text and source, not by id: rows
    with a null id or a repeated one are each taken as ``mix`` says."""
    placed, _ = _placed(docs, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, **options)

    def row_key(draw: Column, text_key: Column, source: Column) -> Column:
        # concat_ws leaves a null source out
        return F.concat_ws(":", draw, text_key.cast("string"), F.concat(F.lit("s"), source.cast("string")))

    # docs may have columns of any name
    row, nth, words, key, before, size, whole, rest = unused(
        docs, "__row", "__nth", "__words", "__key", "__before", "__size", "__whole", "__rest")
    # one row per key: rows of equal keys follow each other, the first is `before` words into its source
    wanted = placed.where("size > 0 and (whole > 0 or before < rest)").groupBy(
        row_key(F.col("draw"), F.col("text_key"), F.col("source")).alias(key)).agg(
        F.min("before").alias(before), F.first("size").alias(size),
        F.first("whole").alias(whole), F.first("rest").alias(rest))
    rows = docs.withColumn(row, row_key(_draw_key(seed, id_col, text_col), F.xxhash64(text_col), F.col(source_col)))
    rows = rows.withColumn(nth, F.row_number().over(Window.partitionBy(row).orderBy(row)) - 1)
    rows = rows.join(wanted, F.col(row) == F.col(key))
    last = F.least(F.greatest(F.col(rest) - F.col(before) - F.col(nth) * F.col(size), F.lit(0)), F.col(size))
    rows = rows.withColumn(words, F.explode(F.filter(
        F.concat(F.array_repeat(F.col(size), F.col(whole).cast("int")), F.array(last)), lambda n: n > 0)))
    cut = F.when(F.col(words) < F.col(size), F.array_join(F.slice(
        F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0)), F.lit(1), F.col(words).cast("int")), " "))
    rows = rows.withColumn(text_col, F.coalesce(cut, F.col(text_col)))
    if n_chars_col in docs.columns:
        rows = rows.withColumn(n_chars_col, F.length(text_col).cast(docs.schema[n_chars_col].dataType))
    return rows.select(*docs.columns)
