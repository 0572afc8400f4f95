from pyspark.sql import functions as F

from rivulet.functions.text import after_first_dash, contains, parse_long
from rivulet.operators import hello_values, order_number_chain, quarantine_non_numeric, tap
from rivulet.plans.apps import basic_app, errors_app, hello_app
from tests.fixtures import ERROR_VALUES, errors_loader, topic

# value, contains 'order-', after first dash, strict parse, in basic chain output
EDGE = [
    ("order-1001", True, "1001", 1001, True),
    ("order-999", True, "999", 999, False),
    ("order-1000", True, "1000", 1000, False),
    ("order-12-3", True, "12-3", None, False),
    ("x-order-5000", True, "order-5000", None, False),
    ("order-", True, "", None, False),
    ("order- 2000", True, " 2000", None, False),
    ("order-+2000", True, "+2000", 2000, True),
    ("orderNumber-5000", False, "5000", 5000, False),
    ("nodash", False, "nodash", None, False),
]


def test_text_functions_edge_cases(spark):
    df = spark.createDataFrame([(v,) for v, *_ in EDGE], "value string")
    got = df.select("value", contains("value", "order-").alias("c"),
                    after_first_dash("value").alias("a"),
                    parse_long(after_first_dash("value")).alias("n")).collect()
    by_v = {r["value"]: r for r in got}
    for v, c, a, n, _ in EDGE:
        assert by_v[v]["c"] == c, v
        assert by_v[v]["a"] == a, v
        assert by_v[v]["n"] == n, v


def test_chain_edge_cases(spark):
    rows = [(0, i, i, "k", v) for i, (v, *_) in enumerate(EDGE)] + [(0, 99, 99, "k", None)]
    out = basic_app(topic(spark, rows))
    got = [r["value"] for r in out.orderBy("offset").collect()]
    assert got == [a for v, c, a, n, keep in EDGE if keep]


def test_quarantine_holds_unparsable_orders(spark):
    rows = [(0, i, i, "k", v) for i, (v, *_) in enumerate(EDGE)]
    q = quarantine_non_numeric(topic(spark, rows), "order-")
    got = sorted(r["value"] for r in q.collect())
    assert got == sorted(v for v, c, a, n, _ in EDGE if c and n is None)


def test_errors_app_values(spark):
    good, bad = errors_app(errors_loader(spark))
    assert [r["value"] for r in good.orderBy("offset").collect()] == ["1001", "5000", "3330",
                                                                       "8400"]
    assert bad.count() == 0
    # the basic app's marker matches none of these records
    assert basic_app(errors_loader(spark)).count() == 0
    assert len(ERROR_VALUES) == 7


def test_hello(spark):
    users = topic(spark, [(0, 0, 0, None, "Ann"), (0, 1, 1, None, None)])
    got = [r["greeting"] for r in hello_app(users).collect()]
    assert sorted(got, key=str) == sorted(["(DSL) Hello, Ann", None], key=str)
    assert hello_values(users).columns[-1] == "greeting"


def test_tap_counts_without_changing_rows(spark):
    df = spark.range(10).withColumn("value", F.when(F.col("id") % 2 == 0, F.col("id")))
    out, obs = tap(df, "probe", "value")
    assert out.count() == 10
    assert obs.get == {"records": 10, "value_non_null": 5}


def test_chain_filters_reach_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    topic(spark, [(0, 0, 0, "k", "order-2000")]).write.parquet(path)
    capsys.readouterr()
    order_number_chain(spark.read.parquet(path)).explain("formatted")
    plan = capsys.readouterr().out
    assert "StringContains(value,order-)" in plan
    assert "WholeStageCodegen" in plan or "* Filter" in plan


def test_parse_long_rejects_a_trailing_newline(spark):
    from pyspark.sql import functions as F

    from rivulet.functions.text import parse_long

    df = spark.createDataFrame([("2000\n",), ("2000",), ("+7",), ("",)], "v string")
    assert [r[0] for r in df.select(parse_long(F.col("v"))).collect()] == [None, 2000, 7, None]
