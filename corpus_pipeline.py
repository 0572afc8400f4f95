"""The corpus pipeline: documents in, sharded training mix out.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns the columns of ``documents``; the last adds ``shard``.  ``run``
writes each stage's rows below the shared checkpoint folder and reads them
back, so a lost executor costs at most one stage.

All stages take null ids, sources and languages, empty tables and columns of any
further name.  Null, empty and blank texts (no letter) go in the first stage.  Of
equal rows one stays in the second; texts of any length are judged whole in every
stage; ties in the mix are drawn by hashes, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm import decontaminate, language, mixing, near_duplicates, sharding
from rivulet.llm._store import store

SHARDS = [1.0] * 8
#: near duplicates of the stage: Jaccard of 0.8 and more; 31 bands of 4 miss a
#: pair at 0.8 with probability 8e-8 (op7 has its own, stricter threshold)
NEAR = dict(bands=31, rows=4, threshold=80)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letter, or without text, go."""
    model = language.fit(docs, F.col("doc_id").isNotNull() & ~language.held_out())
    return language.keep_identified(docs, model)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_duplicates.keep_one(docs, **NEAR)


def benchmark_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last of a source in part."""
    return mixing.take(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard; equal ids share one."""
    return sharding.with_shard(docs, SHARDS)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicate_removal),
    ("decontamination", benchmark_removal),
    ("mixing", source_mix),
    ("sharding", shards),
]

#: language ID and the sketches are not SQL; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
