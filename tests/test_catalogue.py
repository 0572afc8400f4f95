"""Every catalogue query against its SQL twin (DuckDB) at sf0.001."""

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry
from rivulet.plans.catalogue import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["customer", "orders", "events", "documents"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(df):
    cols = sorted(df.columns)
    rows = []
    for row in df[cols].itertuples(index=False):
        rows.append(tuple("∅" if (v is None or (not isinstance(v, str) and pd.isna(v)))
                          else repr(round(v, 9)) if isinstance(v, float) else str(v)
                          for v in row))
    return sorted(rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _norm(got) == _norm(want)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    assert entry(spark).count() >= 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_stays_jvm_side(spark, name, capsys):
    capsys.readouterr()
    QUERIES[name](spark, SF).explain("formatted")
    plan = capsys.readouterr().out
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
               "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert op not in plan, (name, op)
