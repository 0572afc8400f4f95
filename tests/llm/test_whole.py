"""The whole job, with nothing left out: near copies at the stage's threshold,
rows without an id or with a repeated one, any number of groups."""

import random
import re
import sys
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from .conftest import SCHEMA
from .test_exact import BLANK, fold

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import corpus_pipeline  # noqa: E402


def words(seed, n):
    r = random.Random(seed)
    return ["".join(r.choices("abcdefghijklmnop", k=7)) for _ in range(n)]


def changed(w, *at):
    return [f"new{i}" if i in at else x for i, x in enumerate(w)]


def shingles(text):
    w = re.findall(BLANK, fold(text))
    return {tuple(w[j: j + 5]) for j in range(max(1, len(w) - 4))} if w else set()


def classes(texts, threshold):
    """Class of each text: connected over pairs of ``threshold`` % Jaccard."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= threshold * len(x | y):
                root = [root[a] if r == root[b] else r for r in root]
    return root


def test_pipeline_links_from_80_percent(spark):
    """Pairs of Jaccard 0.80 to 0.85 lose one document in the stage."""
    rows = []
    for i in range(12):
        w = words(i, 104)                       # 100 shingles
        rows.append((2 * i, " ".join(w), "en", "s", 0))
        rows.append((2 * i + 1, " ".join(changed(w, 20, 40) if i % 2 else changed(w, 20, 40, 60)), "en", "s", 0))
    texts = [r[1] for r in rows]
    x, y = shingles(texts[2]), shingles(texts[3])
    assert 0.80 <= len(x & y) / len(x | y) < 0.85
    want = {min(r[0] for r, c in zip(rows, classes(texts, 80)) if c == k) for k in classes(texts, 80)}
    got = corpus_pipeline.near_duplicate_removal(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert {r.doc_id for r in got.collect()} == want and len(want) == 18


def test_pipeline_at_its_threshold(spark):
    """The pipeline against brute force that links from 0.8."""
    from .test_exact import brute_hits, brute_mix
    from .test_queries import SF

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    left = sorted((r for r in docs if any(c.isalpha() for c in r[1] or "")), key=lambda r: r[0])
    seen = set()
    left = [r for r, c in zip(left, classes([r[1] for r in left], 80)) if not (c in seen or seen.add(c))]
    hit = {r[0] for r in brute_hits(left, items) if r[5]}
    want = {r[0]: r[4] for r in brute_mix([r for r in left if r[0] not in hit]) if r[4]}
    got = Counter()
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id] += len(re.findall(BLANK, r.text))
    assert got == want


def without_ids():
    """A third of the ids null, some texts and ids several times."""
    r = random.Random(11)
    rows = []
    for i in range(60):
        rows.append((None if i % 3 == 0 else i, " ".join(words(100 + i, r.randint(5, 60))), "en", (None, "a", "b", "c")[i % 4], 0))
    rows += [rows[0]] * 3 + [rows[1]] * 4               # equal rows
    rows += [(2, " ".join(words(7, len(rows[2][1].split()))), "en", rows[2][3], 0)]   # an id with two texts of one length
    rows += [(None, rows[0][1], "en", "c", 0), (None, rows[5][1], "en", rows[5][3], 0)]   # texts in other rows
    return rows + [(None, None, "en", "a", 0), (None, "", "en", "b", 0), (None, " ", None, None, None)]


def test_take_takes_what_mix_says(spark, docs):
    """Null and repeated ids too: words by (id, source) are those of the mix."""
    from rivulet.llm import mixing

    for table in (spark.createDataFrame(without_ids(), SCHEMA).repartition(4), docs):
        mixed = mixing.mix(table).collect()
        want, got = Counter(), Counter()
        for r in mixed:
            want[r.doc_id, r.source] += r.taken
        n = 0
        for r in mixing.take(table).collect():
            got[r.doc_id, r.source] += len(re.findall(BLANK, r.text))
            n += 1
        assert got == Counter({k: v for k, v in want.items() if v})
        assert n == sum(len(r.draws) for r in mixed)
        by_source, target = Counter(), {}
        for (_, source), v in got.items():
            by_source[source] += v
        for r in mixed:
            target[r.source] = r.target
        assert all(abs(by_source[s] - t) <= 0.5 for s, t in target.items())


def null_copies():
    """Copies and near copies in rows without an id."""
    base, hub, lone = words(1, 120), words(2, 104), words(3, 90)
    text = " ".join
    return [
        (5, text(base), "en", "s", 0), (None, text(changed(base, 60)), "en", "s", 0),
        # 20 and 21 are near only through the row without an id
        (20, text(changed(hub, 10, 11)), "en", "s", 0), (21, text(changed(hub, 90, 91)), "en", "s", 0), (None, text(hub), "en", "s", 0),
        *[(None, text(lone), "en", "s", 0)] * 5, (None, "  ".join(lone).upper(), "en", "s", 0), (None, text(changed(lone, 2)), "en", "s", 0),
        # an id with two texts, one of them a copy
        (30, text(words(4, 50)), "en", "s", 0), (30, text(base), "en", "s", 0), (31, text(words(4, 50)), "en", "s", 0),
        (None, " ", "en", "s", 0), (None, None, "en", "s", 0), (None, None, "en", "s", 0), (40, "", "en", "s", 0), (41, "", "en", "s", 0)]


def test_rows_without_an_id_link(spark):
    from rivulet.llm import near_duplicates

    rows = null_copies()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    root, least = classes([r[1] for r in rows], 85), defaultdict(list)
    for r, c in zip(rows, root):
        least[c].append(r[0])
    want = Counter((r[0], min((i for i in least[c] if i is not None), default=None)) for r, c in zip(rows, root))
    assert want[None, 5] == 1 and want[21, 20] == 1
    for small in (1000, 1):
        got = near_duplicates.near_duplicates(df, small=small).collect()
        assert Counter((r.doc_id, r.component_id) for r in got) == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_keep_one_of_rows_without_an_id(spark):
    from rivulet.llm import near_duplicates

    rows = null_copies()
    root = classes([r[1] for r in rows], 85)
    got = [(r.doc_id, r.text) for r in near_duplicates.keep_one(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()]
    number = {r[1]: c for r, c in zip(rows, root) if shingles(r[1])}
    assert Counter(number[t] for _, t in got if shingles(t)) == Counter(set(number.values()))
    assert sorted((str(i), str(t)) for i, t in got if not shingles(t)) == sorted((str(r[0]), str(r[1])) for r in rows if not shingles(r[1]))
    assert sorted(str(i) for i, t in got if shingles(t)) == ["20", "30", "5", "None"]


def test_any_number_of_languages(spark, monkeypatch):
    """90 languages; the two ways to count give the same model."""
    import numpy as np

    from rivulet.llm import language

    rows = []
    for k in range(90):
        r = random.Random(k)
        own = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)]
        rows += [(100 * k + i, " ".join(r.choices(own, k=40)), f"l{k:03}", "s", 0) for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    model = language.fit(df, F.col("doc_id") % 100 < 5)
    assert len(model.languages) == 90
    got = language.identify(df, model).join(df.select("doc_id", "lang"), "doc_id").where("doc_id % 100 = 5")
    assert got.count() == 90 and got.where("lang = lang_pred").count() >= 88
    sparse = language.identify(df, model).orderBy("doc_id").collect()
    monkeypatch.setattr(language, "DENSE", 1000)
    dense = language.fit(df, F.col("doc_id") % 100 < 5)
    assert np.allclose(model.weight, dense.weight, atol=1e-5) and np.allclose(model.centre, dense.centre)
    same = language.identify(df, dense).orderBy("doc_id").collect()
    assert [r.lang_pred for r in sparse] == [r.lang_pred for r in same]
    code = language.codewords(2000)
    assert code.shape[0] == 2000 and len(np.unique(code, axis=0)) == 2000


def test_any_number_of_sources(spark, monkeypatch):
    """More sources than the driver plans for: targets as before, and blocks
    that add up."""
    from rivulet.llm import mixing

    from .test_exact import brute_mix, rows

    table = [(i, " ".join(words(i, i * 7 % 90)), "en", None if i % 23 == 22 else f"h{i % 23}", 0) for i in range(200)]
    table += [(900, "", "en", "empty", 0), (901, " ".join(words(901, 2000)), "en", "h1", 0)]
    want = brute_mix(table)
    df = spark.createDataFrame(table, SCHEMA).repartition(3)
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    for most in (100_000, 4):
        monkeypatch.setattr(mixing, "MAX_SOURCES", most)
        got = mixing.mix(df, block=32).cache()
        assert [(a, b, c, round(d, 6), e) for a, b, c, d, e in rows(got, *columns)] == want
        draws = got.select("source", F.explode("draws").alias("d")).select("source", "d.*")
        assert draws.where("shard < 0 or shard >= 8").count() == 0
        assert draws.groupBy("source", "block").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0
        assert draws.select("shard").distinct().count() == 8
    totals = spark.createDataFrame([(f"s{i:04}" if i else None, i * 50 % 999, 1) for i in range(300)], "source string, size long, n long")
    plan = mixing.plan_many(totals, (5, 2, 1), 3, 8, 32, "x").collect()
    assert len(plan) == 300 and all(r.cuts[-1] == r.blocks and r.cuts == sorted(r.cuts) for r in plan)
    shards = [sum(r.cuts[k] - (r.cuts[k - 1] if k else 0) for r in plan) for k in range(8)]
    assert max(shards) - min(shards) <= 3
    want = {r[0]: r[1:7] for r in mixing.plan([(t.source, t["size"]) for t in totals.collect()], (5, 2, 1), 3, 8, 32, "x")}
    assert {r.source_: tuple(r)[1:7] for r in plan} == want
