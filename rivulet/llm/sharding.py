"""Sharding by rendezvous hashing of stable record keys.

Every record draws one number per shard from a hash of its key and the shard,
weighted by the shard's share, and goes to the shard with the best draw.  The
key and the shard list decide alone, so each row is placed on its own, in one
scan, and reruns agree.  A new shard takes exactly the rows that it wins;
between old shards nothing moves.  Changing one weight moves rows to or from
that shard only.

A slot numbers the rows of a shard from 0 without gaps, in an order drawn from
the key as well (a shuffle that reruns repeat).  Slots are counted in pieces
of about ``PIECE`` rows, so a shard may be any size.

Edge cases: a row with a null key is placed by its text instead, so that null
keys don't gather in one shard; rows that repeat a key share its shard; equal
rows get neighbouring slots; a very long text is only measured and hashed, in
its row; ``with_shard`` keeps all other columns (one that is named as the result
is replaced), ``assign`` reads none; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm._order import number
from rivulet.llm._store import store

PIECE = 500_000


def record_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    return F.coalesce(F.concat(F.lit("k"), F.col(id_col).cast("string")),
                      F.concat(F.lit("t"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard of a string key: shard i draws -ln(u) / weight with u uniform
    in (0, 1]; the smallest draw wins, the lower shard on a tie."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")

    def draw(i: int, w: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(i)), 11) + 1) / F.lit(float(1 << 53))
        return F.struct((-F.log(u) / F.lit(float(w))).alias("draw"), F.lit(i).alias("shard"))

    return F.array_min(F.array(*[draw(i, w) for i, w in enumerate(weights)]))["shard"]


def assign(docs: DataFrame, weights: list[float], id_col: str = "doc_id", text_col: str = "text",
           piece: int = PIECE) -> DataFrame:
    """Per row: id, size (UTF-8 bytes of the text plus 1), text_crc32, shard, slot."""
    key = record_key(id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    thin = store(docs.select(
        F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        key.alias("key")).withColumn("shard", rendezvous(F.col("key"), weights))
        .withColumn("draw", F.xxhash64("key", F.lit("slot"))), "shards")
    pieces = thin.count() // piece + 1
    # equal pieces of the range of the draw, in its order
    part = F.floor((F.col("draw") / F.lit(2.0 ** 64) + 0.5) * pieces).cast("int")
    return number(thin, ["shard"], part, ["draw", "key", "text_crc32", "size"], "slot").select(
        id_col, "size", "text_crc32", "key", "shard", "slot")


def with_shard(docs: DataFrame, weights: list[float], id_col: str = "doc_id", text_col: str = "text",
               name: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row (a column of that name is replaced)."""
    return docs.withColumn(name, rendezvous(record_key(id_col, text_col), weights))


def write_shards(docs: DataFrame, weights: list[float], path: str, files_per_shard: int = 16,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write one folder per shard, each in ``files_per_shard`` files."""
    rows = with_shard(docs, weights, id_col, text_col)
    salt = F.pmod(F.xxhash64(record_key(id_col, text_col), F.lit("file")), F.lit(files_per_shard))
    rows.repartition(len(weights) * files_per_shard, "shard", salt).write.partitionBy("shard").parquet(path)
