import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    """A small table with every awkward case: nulls, empty and blank texts, a
    very long text, exact and near copies, shared passages, repeated rows."""
    r = random.Random(5)
    vocabulary = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 8))) for _ in range(900)]
    words = lambda n: [r.choice(vocabulary) for _ in range(n)]
    passage, short = words(70), words(55)
    rows = []

    def add(text, source="s1", lang="en", doc_id=None):
        rows.append((len(rows) * 3 if doc_id is None else doc_id, text, lang, source, len(text or "")))

    for i in range(30):
        add(" ".join(words(r.randint(1, 160))), source=f"s{i % 4}")
    base = words(150)
    for _ in range(6):                      # near copies
        w = list(base)
        for _ in range(r.randint(1, 6)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        add(" ".join(w))
    add(" ".join(base))
    add("  ".join(base).upper())            # equal after folding and splitting
    for i in range(6):                      # a shared passage in other texts
        add(" ".join(words(20) + (passage if i % 2 else short) + words(30)), source=None)
    add("\n".join([" ".join(words(8))] * 60))   # repeats of its own
    add(" ".join(words(4000)), source="s2")     # very long
    for text in (None, "", " \t\n ", "one", "two words", "1234 !!", "Ünïcode wörter ß 汉字 😀 é", "a" * 700):
        add(text, lang=None if text in (None, "one") else "de")
    rows.append(rows[3])                    # a repeated row
    rows.append((None, "a row without an id " * 12, "en", "s1", 0))
    rows.append((None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def crowded(docs):
    """The same with extra columns whose names clash with results."""
    from pyspark.sql import functions as F

    names = ["id", "g", "bucket", "size", "shard", "slot", "n_words", "component_id", "kept", "items", "words",
             "key", "draw", "family", "unit", "set_id", "host", "quality", "entries", "edited", "target", "__x"]
    return docs.select("*", *[F.lit("x").alias(n) for n in names])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
