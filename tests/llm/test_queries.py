"""Registered queries against their SQL (DuckDB), and the pipeline against a
brute-force version, at the smallest scale."""

import re
import sys
from collections import defaultdict

import duckdb
import pandas as pd
import pytest

from rivulet.llm.queries import ORACLE, QUERIES

from .test_exact import brute_components, brute_hits, brute_mix, brute_shard, key

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "benchmark", "conversations", "labels"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def normal(df):
    df = df[sorted(df.columns)]
    return sorted(tuple("null" if not isinstance(v, str) and pd.isna(v) else str(int(v)) if isinstance(v, float) and v.is_integer()
                        else repr(round(v, 9)) if isinstance(v, float) else str(v) for v in row) for row in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_every_document(spark, name):
    got = QUERIES[name](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert not any(kind == "void" for _, kind in got.dtypes)


def test_all_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import corpus_pipeline

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    left = [r for r in docs if any(c.isalpha() for c in r[1] or "")]
    stay = {r[0] for r in brute_components(left, 80) if r[3]}
    left = [r for r in left if r[0] in stay]
    hit = {r[0] for r in brute_hits(left, items) if r[5]}
    left = [r for r in left if r[0] not in hit]
    want = {r[0]: (r[1], r[4]) for r in brute_mix(left)}
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id].append(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)))
        assert r.shard == brute_shard(key(r.doc_id, r.text), corpus_pipeline.SHARDS)
    assert {i: sum(n) for i, n in got.items()} == {i: n for i, (_, n) in want.items() if n}
    assert all(len(n) <= 3 for n in got.values())
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "decontamination", "mixing", "sharding"]


