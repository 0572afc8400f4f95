"""Property: running aggregates do not depend on how keys are chunked."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.operators import running

rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                          st.one_of(st.none(), st.integers(-50, 50))),
                min_size=1, max_size=40)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, width=st.integers(1, 12), how=st.sampled_from(["sum", "max", "last",
                                                                  "count", "min"]))
def test_running_is_chunk_invariant(spark, data, width, how):
    recs = [(i, k, v) for i, (k, v) in enumerate(data)]
    pdf = pd.DataFrame(recs, columns=["o", "k", "v"]).astype({"v": "float64"})
    df = spark.createDataFrame(recs, "o long, k string, v long")
    got = running(df, ["k"], ["o"], "v", how, "r",
                  F.floor(F.col("o") / F.lit(width))).toPandas().set_index("o")["r"]
    # SQL running aggregates over "unbounded preceding .. current row",
    # computed the slow way: nulls are skipped, null until a value is seen.
    want, seen = [], {}
    for _, k, v in recs:
        seen.setdefault(k, [])
        if v is not None:
            seen[k].append(v)
        vals = seen[k]
        if how == "count":
            want.append(len(vals))
        elif not vals:
            want.append(None)
        else:
            want.append({"sum": sum, "max": max, "min": min,
                         "last": lambda xs: xs[-1]}[how](vals))
    for o, w in zip(pdf["o"], want):
        r = got[o]
        assert (pd.isna(r) and w is None) or r == w, (o, r, w)


times = st.lists(st.integers(0, 20_000), min_size=1, max_size=25)


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lt=times, rt=times, within_s=st.integers(1, 5))
def test_interval_join_equals_brute_force(spark, lt, rt, within_s):
    from rivulet.operators import interval_join

    left = spark.createDataFrame([(i, "k", t) for i, t in enumerate(lt)],
                                 "a long, lk string, lt long") \
        .withColumn("lts", F.timestamp_millis("lt"))
    right = spark.createDataFrame([(i, "k", t) for i, t in enumerate(rt)],
                                  "b long, rk string, rt long") \
        .withColumn("rts", F.timestamp_millis("rt"))
    got = sorted((r["a"], r["b"]) for r in interval_join(
        left, right, "lk", "rk", "lts", "rts", f"{within_s} seconds").collect())
    want = sorted((i, j) for i, x in enumerate(lt) for j, y in enumerate(rt)
                  if abs(x - y) <= within_s * 1000)
    assert got == want
