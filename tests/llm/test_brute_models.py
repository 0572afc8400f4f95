"""Language codes and site posteriors against plain versions, row by row."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import language, quality

from .conftest import SCHEMA, corpus


# ------------------------------------------------------------------ language

def brute_grams(text):
    """Counts of n-gram features of one text, blanks left out."""
    raw = [0x20, *(text or "").encode(), 0x20]
    c = [b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in raw]
    out = Counter((x << 8) | y for x, y in zip(c, c[1:]) if (x, y) != (0x20, 0x20))
    for x, y, z in zip(c, c[1:], c[2:]):
        f = (((((x << 16) | (y << 8) | z) * 0x9E3779B1) & 0xFFFFFFFF) >> 16) + 65536
        if f != (((0x202020 * 0x9E3779B1) & 0xFFFFFFFF) >> 16) + 65536:
            out[f] += 1
    return out


def brute_language(rows):
    """Per row: the predicted language and its score, learnt from all rows."""
    langs = sorted({r[2] for r in rows if r[2] is not None})
    counts = {x: Counter() for x in langs}
    for _, text, lang, *_ in rows:
        if lang is not None:
            counts[lang].update(brute_grams(text))
    n_features = 131072
    total = {x: sum(counts[x].values()) + 0.5 * n_features for x in langs}
    share = lambda x, f: (counts[x][f] + 0.5) / total[x]
    seen = set().union(*counts.values())
    code = language.codewords(len(langs))
    bits = []
    for b in range(code.shape[1]):
        sides = [[x for i, x in enumerate(langs) if (code[i, b] > 0) == up] for up in (True, False)]
        mean = lambda side, f: sum(share(x, f) for x in side) / len(side)
        w = {f: float(np.float32(max(-4, min(4, math.log(mean(sides[0], f) / mean(sides[1], f)))))) for f in seen}
        rest = [sum(0.5 / total[x] for x in side) / len(side) for side in sides]
        unseen = max(-4, min(4, math.log(rest[0] / rest[1])))
        others = n_features - 2 - len(seen)
        up = sum(mean(sides[0], f) * w[f] for f in seen) + others * rest[0] * unseen
        down = sum(mean(sides[1], f) * w[f] for f in seen) + others * rest[1] * unseen
        bits.append((w, unseen, (up + down) / 2, max((up - down) / 2, 1e-6)))
    halves = sum(h for *_, h in bits)
    out = []
    for _, text, *_ in rows:
        if not any(ch.isalpha() for ch in text or ""):
            out.append(("und", 0.0))
            continue
        grams = brute_grams(text)
        n = sum(grams.values())
        loss = [0.0] * len(langs)
        for b, (w, unseen, centre, half) in enumerate(bits):
            s = sum(k * w.get(f, unseen) for f, k in grams.items())
            z = max(-3, min(3, ((s + 8 * centre) / (n + 8) - centre) / half))
            for i in range(len(langs)):
                loss[i] += math.exp(-z * code[i, b]) * half / halves
        best = min(range(len(langs)), key=lambda i: loss[i])
        out.append((langs[best], 1 / sum(math.exp(4 * (loss[best] - x)) for x in loss)))
    return out


@pytest.mark.parametrize("n", [2, 4, 7])
def test_language_as_brute_force(spark, n):
    r = random.Random(n)
    letters = ["abcdefg", "hijklmn", "opqrstu", "vwxyzab", "éèêabcd", "汉字语言文中", "ßäöüxyz"]
    rows = []
    for i in range(12 * n):
        own = letters[i % n] + ("e" if i % n < 5 else "")
        words = ["".join(r.choices(own, k=r.randint(1, 7))) for _ in range(r.randint(1, 40))]
        rows.append((i, " ".join(words).title() if i % 5 == 0 else " ".join(words), None if i % 11 == 10 else f"l{i % n}", "s", 0))
    rows += [(900, None, "l0", "s", 0), (901, "", "l1", "s", 0), (902, "12 !!", None, "s", 0), (903, "qq zz qq", None, "s", 0), rows[3]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((x.doc_id, x.lang_pred, x.score) for x in language.identify(docs, language.fit(docs)).collect())
    want = sorted((row[0], *x) for row, x in zip(rows, brute_language(rows)))
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want], atol=2e-4)


# ------------------------------------------------------------------ quality

def brute_shrink(rows):
    """(own posterior, host's, path's) of rows (host, path, p)."""
    def strength(groups, priors):
        some = {k: v for k, v in groups.items() if len(v) > 1}
        n = sum(len(v) for v in some.values())
        if not n:
            return 1e6
        spread = sum(len(v) * (sum(v) / len(v) - priors[k]) ** 2 for k, v in some.items())
        noise = max(sum(len(v) * priors[k] * (1 - priors[k]) for k, v in some.items()) / n, 1e-6)
        between = (spread - len(some) * noise) / n
        return min(max(noise / between if between > 0 else 1e6, 1.0), 1e6)

    hosts, paths = defaultdict(list), defaultdict(list)
    for host, path, p in rows:
        hosts[host].append(p)
        paths[host, path].append(p)
    mean = sum(p for *_, p in rows) / len(rows)
    a = strength(hosts, {h: mean for h in hosts})
    of_host = {h: (sum(v) + mean * a) / (len(v) + a) for h, v in hosts.items()}
    b = strength(paths, {k: of_host[k[0]] for k in paths})
    odds = lambda q: math.log(min(max(q, 1e-6), 1 - 1e-6) / (1 - min(max(q, 1e-6), 1 - 1e-6)))
    out = []
    for host, path, p in rows:
        h, k = hosts[host], paths[host, path]
        at_host = (sum(h) - p + mean * a) / (len(h) - 1 + a)
        at_path = (sum(k) - p + at_host * b) / (len(k) - 1 + b)
        out.append((1 / (1 + math.exp(-(odds(p) + odds(at_path) - odds(mean)))), at_host, at_path))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_site_posteriors_as_brute_force(spark, seed):
    r = random.Random(seed)
    rows = []
    for i in range(400):
        host = r.choice([None, "a", "b", "big", "big", "big", f"rare{i}"])
        path = r.choice([None, "x", "y", f"p{i % 40}"])
        base = {"a": 0.2, "b": 0.8}.get(host, 0.5) + (0.15 if path == "x" else 0)
        rows.append((host, path, min(max(r.gauss(base, 0.2), 0.001), 0.999)))
    rows += rows[:3]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "i int, host string, path string, p double").repartition(5)
    got = {x.i: (x.q, x.q_host, x.q_path) for x in quality.shrink(df, "p", "host", "path", "q").collect()}
    want = brute_shrink(rows)
    assert len(got) == len(rows)
    for i, w in enumerate(want):
        assert np.allclose(got[i], w, atol=1e-9), (i, rows[i])


def test_learnt_texts_count_once(spark):
    """Copies and repeated rows of one text weigh as one, whatever joins them."""
    texts = [f"word{i} word{i % 3} shared" for i in range(20)]
    rows = [(i, texts[i % 20], "en", "s", 0) for i in range(60)] + [(5, texts[5], "en", "s", 0)] * 3
    labels = [(i, int(i % 20 < 10), int(i % 20 == 3)) for i in range(60)] + [(7, 1, 0), (7, None, 1), (None, 1, 0), (999, 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    known = table.where("doc_id is not null and quality is not null and toxic is not null").select(
        F.col("doc_id").alias("__id"), F.col("quality").cast("double").alias("quality"), F.col("toxic").cast("double").alias("toxic"))
    named = docs.select(F.col("doc_id").alias("id"), "text")
    counts = []
    for most in (quality.MOST_BROADCAST, 0):
        quality.MOST_BROADCAST, keep = most, quality.MOST_BROADCAST
        try:
            learnt = quality.learnt_texts(named, known)
            assert learnt.count() == 20 and learnt.agg(F.sum("quality"), F.sum("toxic")).first()[:] == (10.0, 1.0)
            counts.append(sorted(tuple(x) for x in quality.count_features(quality._with_labels(named, learnt)).collect()))
        finally:
            quality.MOST_BROADCAST = keep
    assert counts[0] == counts[1]
    plain = Counter()
    for t in texts:
        import pyarrow as pa
        for _, _, f, _ in quality.features(pa.array([t])):
            plain.update(f.tolist())
    assert {x[0]: x[1] for x in counts[0]} == plain
