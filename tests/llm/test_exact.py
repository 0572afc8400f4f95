"""Operators with exact results, against brute force in plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rivulet.llm import decontaminate, mixing, near_duplicates, repeated_bytes, repeated_passages, sharding

from .conftest import corpus

BLANK = r"[^\x20\x09-\x0D]+"


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def brute_passages(table, window):
    texts = [(i, re.findall(BLANK, t or "")) for i, t, *_ in table]
    first = {}
    for i, w in texts:
        for j in range(len(w) - window + 1):
            k = tuple(w[j: j + window])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in texts:
        gone = set()
        for j in range(len(w) - window + 1):
            if i is not None and first[tuple(w[j: j + window])] < i:
                gone.update(range(j, j + window))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window, group, bucket", [(50, 24 << 20, 48 << 20), (50, 3000, 5000), (7, 2000, 3000), (1, 9000, 9000)])
def test_passages(docs, crowded, window, group, bucket):
    want = brute_passages(corpus(), window)
    for table in (docs, crowded):
        got = repeated_passages.remove_repeats(table, window, group, bucket)
        assert rows(got, "doc_id", "n_words", "n_removed", "kept_text") == want
    assert sum(r[2] for r in want) > 0


def brute_bytes(table, length):
    texts = [(i, (t or "").encode()) for i, t, *_ in table]
    seen = Counter(b[j: j + length] for _, b in texts for j in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - length + 1):
            if seen[b[j: j + length]] > 1:
                gone[j: j + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) > 0).sum())
        out.append((i, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=str)


@pytest.mark.parametrize("length, options", [
    (200, {}), (200, dict(group_bytes=3000, bucket_bytes=5000, shard=2000)),
    (200, dict(group_bytes=3000, bucket_bytes=5000, hot=0)), (40, dict(group_bytes=5000, bucket_bytes=9000, hot=3, shard=500))])
def test_bytes(docs, crowded, length, options):
    want = brute_bytes(corpus(), length)
    for table in (docs, crowded):
        got = repeated_bytes.remove_repeated_bytes(table, length, **options)
        got = sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.select(
            "doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()), key=str)
        assert got == want
    assert sum(r[2] for r in want) > 0


def test_interval_expansion():
    rng = np.random.RandomState(1)
    for length in (3, 6, 15):
        for _ in range(40):
            runs = [bytes(rng.choice([97, 98, 0], rng.randint(length, 50)).astype(np.uint8)) for _ in range(rng.randint(1, 8))]
            seen = Counter(r[i: i + length] for r in runs for i in range(len(r) - length + 1))
            for r, hit in zip(runs, repeated_bytes.repeated_starts(runs, length)):
                assert [seen[r[i: i + length]] > 1 for i in range(len(r) - length + 1)] == hit.tolist()


def brute_components(table, threshold=85):
    sets = []
    for i, t, *_ in table:
        w = re.findall(BLANK, fold(t))
        sets.append((i, {tuple(w[j: j + 5]) for j in range(max(1, len(w) - 4))} if w else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= threshold * len(x | y):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)].append(i)
    return sorted(((i, len(s), min(least[find(k)], default=None), i == min(least[find(k)], default=None))
                   for k, (i, s) in enumerate(sets)), key=str)


@pytest.mark.parametrize("small", [1000, 2])
def test_components(docs, crowded, small):
    """Both ways of a family: in one task, and by star and blocks."""
    want = brute_components(corpus())
    for table in (docs, crowded):
        got = near_duplicates.near_duplicates(table, small=small)
        assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == want
    assert len({r[2] for r in want}) < len(want) - 4


def test_keep_one(docs):
    kept = near_duplicates.keep_one(docs)
    want = {r[0] for r in brute_components(corpus()) if r[3] and r[0] is not None}
    got = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns
    assert sorted(x for x in got if x is not None) == sorted(want)
    assert got.count(None) == 2


def test_sketch_estimates_similarity():
    rng = np.random.RandomState(3)
    for n, shared in ((400, 300), (12, 9), (3000, 1500)):
        x = rng.randint(1, 2**62, 2 * n - shared).astype(np.uint64)
        a, b = np.sort(x[:n]), np.sort(x[n - shared:])
        s = near_duplicates.sketches(np.concatenate([a, b]), np.array([0, n, 2 * n]), 500)
        assert not (s == np.uint64(2**64 - 1)).any()
        assert abs((s[0] == s[1]).mean() - shared / (2 * n - shared)) < 0.09


ITEMS = [(1, "Alpha beta, gamma! Delta epsilon zeta eta theta iota kappa lambda mu"), (22, "one"), (3, None), (4, ""),
         (None, "two words"), (22, "nothing like it")]


def brute_hits(table, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))
    wins = []
    for i, t in items:
        w = words(t)
        wins += [("" if i is None else str(i), w[j: j + window]) for j in range(max(1, len(w) - window + 1)) if w]
    out = []
    for i, t, *_ in table:
        w, hit, got = words(t), set(), set()
        for item, k in wins:
            for j in range(len(w) - len(k) + 1):
                if w[j: j + len(k)] == k:
                    hit.update(range(j, j + len(k)))
                    got.add(item)
        out.append((i, len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def planted():
    text = corpus()[5][1]
    long = "x y ALPHA beta gamma delta epsilon zeta-eta theta iota kappa lambda mu z alpha beta gamma delta epsilon zeta eta theta iota kappa"
    return [*corpus(), (900, long, "en", "s1", 0), (901, "kappa. Two, words", "en", "s1", 0)], [*ITEMS, (7, " ".join(text.split()[:14]))]


@pytest.mark.parametrize("block", [16 << 20, 40])
def test_decontamination(spark, docs, block):
    table, items = planted()
    df = spark.createDataFrame(table, docs.schema).withColumn("items", F.lit(1)).withColumn("n_hit", F.lit(2))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit(0))
    found = decontaminate.find_matches(df, bench, block_bytes=block)
    want = brute_hits(table, items)
    assert rows(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    best = found.where("doc_id = 900").select("matches").first()[0]
    assert [(m.item_id, m.item_pos, m.doc_pos, m.n_words) for m in best] == [("1", 0, 2, 12), ("1", 0, 15, 10)]
    clean = decontaminate.remove_contaminated(df, bench, block_bytes=block)
    assert clean.columns == df.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r[0]) for r in want if not r[5])


def key(doc_id, text):
    return f"k{doc_id}" if doc_id is not None else "t" + hashlib.sha256((text or "").encode()).hexdigest()


def spark_xxhash(*parts):
    seed = 42
    for p in parts:
        data = p.encode() if isinstance(p, str) else int(p).to_bytes(4, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def brute_shard(k, weights):
    draw = [-np.log(((spark_xxhash(k, i) >> 11) + 1) / 2**53) / w for i, w in enumerate(weights)]
    return int(np.argmin(draw))


@pytest.mark.parametrize("piece", [500_000, 5])
def test_shards(docs, crowded, piece):
    table = corpus()
    for source in (docs, crowded):
        got = sharding.assign(source, [1.0, 2.0, 1.0], piece=piece)
        want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), brute_shard(key(i, t), [1.0, 2.0, 1.0]))
                       for i, t, *_ in table), key=str)
        assert rows(got, "doc_id", "size", "text_crc32", "shard") == want
        slots = defaultdict(list)
        for r in got.collect():
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    a = {tuple(r) for r in sharding.assign(docs, [1.0] * 3, piece=piece).select("key", "shard", "slot").distinct().collect()}
    b = {tuple(r) for r in sharding.assign(docs, [1.0] * 3, piece=7).select("key", "shard", "slot").distinct().collect()}
    assert a == b


def test_more_shards_take_rows_only_into_the_new_one(spark):
    ids = spark.range(20000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    moved = ids.select(sharding.rendezvous(F.col("key"), [1.0] * 8).alias("a"), sharding.rendezvous(F.col("key"), [1.0] * 9).alias("b"))
    assert moved.where("a <> b and b <> 8").count() == 0
    assert abs(moved.where("a <> b").count() - 20000 / 9) < 250
    sizes = [r["count"] for r in ids.groupBy(sharding.rendezvous(F.col("key"), [1.0, 3.0])).count().collect()]
    assert abs(max(sizes) - 15000) < 400


def test_write_shards(spark, docs, tmp_path):
    sharding.write_shards(docs.where("text is not null"), [1.0, 1.0], str(tmp_path / "out"), 2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.where("text is not null").count()


def brute_mix(table, seed="mix-1"):
    size = lambda t: len(re.findall(BLANK, t or ""))
    sources = sorted({s for _, _, _, s, _ in table}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size(t) for _, t, _, x, _ in table if x == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target = dict.fromkeys(sources, 0.0)
    left, open_ = float(sum(total.values())), {s for s in sources if total[s]}
    while left > 1e-9 and open_:     # pour round after round
        w = sum(weight[s] for s in open_)
        step = {s: min(left * weight[s] / w, 3 * total[s] - target[s]) for s in open_}
        for s in open_:
            target[s] += step[s]
        left -= sum(step.values())
        open_ = {s for s in open_ if target[s] < 3 * total[s] - 1e-9}
    out = []
    for s in sources:
        q, at = int(target[s] + 0.5 + 1e-7), 0
        own = [(hashlib.md5(f"{seed}:{i if i is not None else hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest(),
                size(t), i) for i, t, _, x, _ in table if x == s]
        for _, n, i in sorted(own, key=lambda r: r[:2]):
            whole, rest = divmod(q, total[s]) if total[s] else (0, 0)
            out.append((i, n, total[s], round(target[s], 6), whole * n + min(max(rest - at, 0), n)))
            at += n
    return sorted(out, key=str)


@pytest.mark.parametrize("piece", [200_000, 4])
def test_mix(docs, crowded, piece, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", piece)
    want = brute_mix(corpus())
    for table in (docs, crowded):
        got = mixing.mix(table, block=32)
        assert [(a, b, c, round(d, 6), e) for a, b, c, d, e in rows(got, "doc_id", "size", "source_size", "target", "taken")] == want
    again = mixing.mix(docs, block=32)
    assert rows(got, "doc_id", "draws") == rows(again, "doc_id", "draws")
    # whole epochs of a block go to one shard; every draw has a shard
    draws = got.select("source", F.explode("draws").alias("d")).select("source", "d.*")
    assert draws.where("shard < 0 or shard >= 8").count() == 0
    assert draws.groupBy("source", "block").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


def test_split_is_exact():
    quotas = np.array([100, 7, 0, 33])
    parts = mixing.split(quotas, 6, np.random.Generator(np.random.PCG64(1)))
    assert (parts.sum(axis=1) == quotas).all()
    assert parts.sum(axis=0).max() - parts.sum(axis=0).min() <= 2


def test_take(docs):
    mixed = {r.doc_id: r for r in mixing.mix(docs).collect()}
    got = defaultdict(int)
    taken = mixing.take(docs)
    assert taken.columns == docs.columns
    for r in taken.collect():
        got[r.doc_id] += len(re.findall(BLANK, r.text))
    twice = corpus()[3][0]
    for i, r in mixed.items():
        if i is not None and i != twice:
            assert got.get(i, 0) == r.taken


def test_empty_tables(spark, empty, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for df in (repeated_passages.remove_repeats(empty), repeated_bytes.remove_repeated_bytes(empty),
               near_duplicates.near_duplicates(empty), near_duplicates.keep_one(empty), sharding.assign(empty, [1.0, 1.0]),
               mixing.mix(empty), mixing.take(empty), decontaminate.find_matches(empty, items)):
        assert df.count() == 0
    clean = decontaminate.remove_contaminated(docs, items.limit(0))
    assert clean.count() == docs.count()
