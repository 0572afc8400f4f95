from rivulet.operators import table_from_topic, table_snapshot
from rivulet.plans.apps import table_app
from tests.fixtures import topic

F8 = [("a", "order-1001"), ("a", "order-999"), ("b", "bogus-1"), ("a", "order-2000"),
      ("b", "order-5000"), ("a", None)]


def _topic(spark):
    return topic(spark, [(0, i, i, k, v) for i, (k, v) in enumerate(F8)])


def test_changelog_emits_deletes(spark):
    out = table_app(_topic(spark)).orderBy("offset").collect()
    assert [(r["key"], r["value"]) for r in out] == [
        ("a", "1001"), ("a", None), ("b", None), ("a", "2000"), ("b", "5000"), ("a", None)]


def test_snapshot_drops_deleted_keys(spark):
    snap = table_snapshot(_topic(spark)).collect()
    assert [(r["key"], r["value"]) for r in snap] == [("b", "order-5000")]
    latest = {r["key"]: r["value"] for r in table_from_topic(_topic(spark)).collect()}
    assert latest == {"a": None, "b": "order-5000"}


def test_null_key_is_skipped(spark):
    t = topic(spark, [(0, 0, 0, None, "order-1"), (0, 1, 1, "k", "order-2")])
    assert [r["key"] for r in table_snapshot(t).collect()] == ["k"]
