"""Stages on documents with columns of any name, inner ones included."""

from pyspark.sql import functions as F

from rivulet.llm import decontaminate, language, mixing, near_duplicates, sharding

from .conftest import SCHEMA, corpus

INNER = ["__key", "__kept", "__nth", "__row", "__words", "__before", "__size", "__whole", "__rest", "__KEY_", "key", "draw",
         "class", "id", "root", "best", "words", "null", "shard_", "size", "text_key", "set_id", "set"]


def test_stages_keep_columns_of_any_name(spark):
    """The rows and columns of the plain table come back, with the extra ones."""
    plain = spark.createDataFrame(corpus()[:40], SCHEMA)
    # some extra columns hold texts, some numbers, one differs on every row
    wide = plain.select("*", *[F.lit(i).alias(n) if i % 2 else F.concat(F.lit(n), F.col("text")).alias(n) for i, n in enumerate(INNER)])
    model = language.fit(plain)
    items = spark.createDataFrame([("q", " ".join((corpus()[0][1] or "").split()[:12]))], "item_id string, text string")
    stages = [lambda d: language.keep_identified(d, model), lambda d: near_duplicates.keep_one(d, bands=31, rows=4, threshold=80),
              lambda d: decontaminate.remove_contaminated(d, items), mixing.take]
    for stage in stages:
        want = sorted((tuple(r) for r in stage(plain).collect()), key=str)
        got = stage(wide)
        assert got.columns == wide.columns
        assert sorted((tuple(r) for r in got.select(*plain.columns).collect()), key=str) == want
    assert sharding.with_shard(wide, [1.0] * 8).columns == [*wide.columns, "shard"]
