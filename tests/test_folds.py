"""User folds against a record-at-a-time fold, with hot keys cut into pieces."""

import pytest
from pyspark.sql import functions as F

from rivulet.operators import Fold, fold_keys, fold_updates, rising_run
from rivulet.operators import folds

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    e = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id", "value", "ts")
    v = F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("value"))
    return e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))) \
        .withColumn("value", v).cache()


def rising(values):
    best, cur, before, out = 0, 0, None, []
    for x in values:
        cur = 0 if x is None else cur + 1 if before is not None and x > before else 1
        best, before = max(best, cur), x
        out.append((best, x))
    return out


def by_key(events, fold):
    rows = sorted(events.collect(), key=lambda r: r.event_id)
    out = {}
    for k in {r.user_id for r in rows if r.user_id is not None}:
        own = [r for r in rows if r.user_id == k]
        out[k] = dict(zip([r.event_id for r in own], fold([r.value for r in own])))
    return out


@pytest.mark.parametrize("rows_per_chunk, block", [(1 << 20, 256), (60, 8), (40, 3)])
def test_rising_run(events, rows_per_chunk, block):
    want = by_key(events, rising)
    got = fold_updates(events, ["user_id"], ["event_id"], rising_run("value"), "f", rows_per_chunk, block).collect()
    assert {(r.user_id, r.event_id): tuple(r.f) for r in got} == {
        (k, i): x for k, v in want.items() for i, x in v.items()}
    assert len(got) == sum(map(len, want.values())) and got[0].__fields__ == [*events.columns, "f"]
    last = fold_keys(events, ["user_id"], ["event_id"], rising_run("value"), "f", rows_per_chunk, block).collect()
    assert {r.user_id: tuple(r.f) for r in last} == {k: v[max(v)] for k, v in want.items()}


def test_not_commutative_with_an_initial_value(events):
    """Strings in order: any two records swapped would show."""
    f = Fold(F.col("event_id").cast("string"), lambda a, b: F.concat(a, F.lit(","), b), lambda a: F.upper(a), F.lit("start"))
    rows = sorted((r.user_id, r.event_id) for r in events.collect() if r.user_id is not None)
    want = {k: "START" + "".join(f",{i}" for u, i in rows if u == k) for k in {u for u, _ in rows}}
    for size, block in ((1 << 20, 256), (50, 4)):
        got = fold_keys(events, ["user_id"], ["event_id"], f, "s", size, block)
        assert {r.user_id: r.s for r in got.collect()} == want
        runs = fold_updates(events, ["user_id"], ["event_id"], f, "s", size, block)
        assert {(r.user_id, r.event_id): r.s for r in runs.collect()} == {
            (u, i): "START" + "".join(f",{j}" for v, j in rows if v == u and j <= i) for u, i in rows}


def test_hot_key_is_in_many_small_pieces(events, monkeypatch):
    """The hot key is cut: no array holds more than a block of its records."""
    seen = []
    plain = folds._blocked

    def spy(d, keys, fold, block):
        out = plain(d, keys, fold, block)
        seen.append(out.agg(F.max(F.size("__e")), F.count("*")).first())
        return out

    monkeypatch.setattr(folds, "_blocked", spy)
    hot = events.filter("user_id = 0")
    n = hot.count()
    assert n > 300
    got = fold_keys(hot, ["user_id"], ["event_id"], rising_run("value"), "f", 50, 8).collect()
    assert len(got) == 1 and all(most <= 8 for most, _ in seen)
    assert seen[0][1] >= n // 8 and len(seen) >= 3
    # slices of about 50 records exist: more than one chunk was numbered on its own
    assert got[0].f.longest == max(b for b, _ in rising([r.value for r in sorted(hot.collect(), key=lambda r: r.event_id)]))


def test_windows_nulls_and_empty(spark, events):
    f = fold_keys(events.withColumn("w", F.window("ts", "6 hours").start), ["user_id", "w"], ["event_id"], rising_run("value"), "f")
    assert f.count() == events.filter("user_id is not null").select("user_id", F.window("ts", "6 hours").start).distinct().count()
    none = spark.createDataFrame([], "event_id long, user_id long, value double")
    assert fold_keys(none, ["user_id"], ["event_id"], rising_run("value")).collect() == []
    assert fold_updates(none, ["user_id"], ["event_id"], rising_run("value")).collect() == []
    lost = spark.createDataFrame([(1, None, 2.0), (2, 5, None)], "event_id long, user_id long, value double")
    assert [(r.user_id, tuple(r.folded)) for r in fold_updates(lost, ["user_id"], ["event_id"], rising_run("value")).collect()] == [
        (5, (0, None))]
