"""Merkle manifest, conversation trie and robust outliers against plain
versions on small tables with nulls, ties, repeats, long and empty inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import merkle, prefix_trie, quality_rules

from .conftest import SCHEMA, corpus


# ------------------------------------------------------------------ manifest

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_leaf(row, more=0):
    i, text, lang, source, n = row
    return H(*[brute_field(v) for v in (i, source, lang, None if n is None else n + more, text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        n = out[-1]
        out.append([H(*n[i: i + 2]) for i in range(0, len(n), 2)])
    return out


def siblings(lv, i):
    return [(n[(i >> k) ^ 1] if (i >> k) ^ 1 < len(n) else None, (i >> k) & 1) for k, n in enumerate(lv[:-1])]


def brute_manifest(table):
    groups = defaultdict(list)
    for r in table:
        groups[r[2]].append((r[0] is not None, r[0] or 0, brute_leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for n, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            path = siblings(trees[g], n) + siblings(top, k)
            h = brute_leaf(r, 1 if bad else 0)
            for s, odd in path:
                h = H(h) if s is None else H(s, h) if odd else H(h, s)
            out.append((r[0], leaf, trees[g][-1][0], top[-1][0], H(*[s for s, _ in path if s]), h, h == top[-1][0]))
    return sorted(out, key=str)


def audited(table):
    m = merkle.audit(table, F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    return sorted((tuple(r) for r in m.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(), "folded_root", "verified").collect()),
                  key=str)


def test_manifest(spark, docs, empty):
    crowd = ["k", "g", "id", "hash", "n", "m", "e", "block", "position", "proof", "root", "carry", "leaf", "__p", "__v"]
    want = brute_manifest(corpus())
    assert audited(docs) == want
    assert audited(docs.select("*", *[F.lit("x").alias(n) for n in crowd])) == want
    assert audited(empty) == []


def test_manifest_of_ties_nulls_and_far_ids(spark):
    """Ids of both signs and of all sizes, many rows without id, many of one id
    (equal or not), and several groups of sizes around a block."""
    r = random.Random(3)
    rows = [(None, f"t{r.randrange(40)}", "a", None, 5) for _ in range(150)]
    rows += [(7, f"u{r.randrange(90)}", "a", "s", r.choice([None, 3])) for _ in range(200)]
    rows += [(i, "", "b", "s", 0) for i in range(-300, 214)]                       # two full blocks and 2
    rows += [(r.choice([-1, 1]) * r.getrandbits(r.randrange(1, 64)) % 2**63, None, "", "s", None) for _ in range(257)]
    rows += [(-(2**63), "x", "ä", "s", 1), (2**63 - 1, "y", "ä", "s", 1), (63, "z", "ä", "s", 1), (62, "z", "ä", "s", 1)]
    rows += [(1, "w" * 3_000_000, None, "s", 1), (2, None, "z", "s", 2**63 - 2)]
    assert audited(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute_manifest(rows)


def test_manifest_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PIECE", 20)
    monkeypatch.setattr(merkle, "COPIES", 7)
    monkeypatch.setattr(merkle, "BLOCK", 3)
    rows = [(None, f"t{i % 90}", "a", None, 1) for i in range(200)] + [(i % 5, "same", None, None, 1) for i in range(100)]
    assert audited(spark.createDataFrame(rows, SCHEMA)) == brute_manifest(rows)


# ------------------------------------------------------------------ trie

CHATS = "conv_id long, turn long, role string, text string"


def chats():
    r = random.Random(11)
    rows = []
    for c in range(-7, 60):
        if c % 9 == 4:
            continue
        for t in range(r.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["hi", "yes", "no", "é" * 3, "", "a b"])))
    rows += [(61, None, None, "first"), (61, None, "user", None), (61, 3, None, None), (61, 3, None, None), (61, 1, "user", "x")]
    rows += [(c, t, "user", f"long {t}") for c in (100, 101, 200) for t in range(400)]
    rows += [(300 + i, 0, "user", "same") for i in range(120)]                      # one popular conversation
    rows += [(None, 0, "user", "nobody's"), (None, None, None, None)]
    rows += [(1000, 0, "user", "v" * 2_000_000)]
    return rows


def numbered(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((t is not None, t or 0, H(f"{len(role.encode())}:", role, text), role, text))
    return {c: [x[3:] for x in sorted(v)] for c, v in own.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    return out


def brute_trie(convs):
    members = defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        bytes_ = len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * bytes_
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    H(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)))) for p, m in members.items()), key=str)


FIELDS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    return sorted((tuple(r) for r in df.select(*FIELDS).collect()), key=str)


@pytest.mark.parametrize("segment, batch, ends", [(4096, 1 << 18, 50_000), (3, 40, 10)])
def test_trie(spark, monkeypatch, segment, batch, ends):
    monkeypatch.setattr(prefix_trie, "ENDS", ends)
    if ends == 10:
        monkeypatch.setattr(prefix_trie, "PIECE", 50)       # long conversations are numbered in pieces
    table = spark.createDataFrame(chats(), CHATS).repartition(3)
    table = table.select("*", *[F.lit("x").alias(n) for n in ("c", "k", "hash", "bytes", "depth", "name", "n", "b", "h", "p", "__v")])
    own = prefix_trie.turns(table)
    c = F.col("c")
    again, convs = prefix_trie.with_shared_openings(own, c - c % 5, F.crc32(c.cast("string")) % 9, 8)
    assert found(prefix_trie.trie(prefix_trie.named(again), convs, segment, batch)) == brute_trie(rebuilt(numbered(chats())))


def test_trie_edges(spark):
    none = spark.createDataFrame([], CHATS)
    assert found(prefix_trie.conversation_trie(none)) == []
    assert found(prefix_trie.conversation_trie(spark.createDataFrame([(None, 0, "user", "x")], CHATS))) == []
    rows = [(5, 0, "user", "a"), (6, 0, "user", "a"), (6, 1, "assistant", "b")]
    assert found(prefix_trie.conversation_trie(spark.createDataFrame(rows, CHATS))) == brute_trie(numbered(rows))


def test_zfast_trie_against_prefix_sets():
    r = random.Random(1)
    for seed in range(60):
        strings = [["root"] for _ in range(r.randrange(1, 30))]
        for s in strings:
            for _ in range(r.randrange(0, 20)):
                s.append(H(s[-1], str(r.randrange(2))))     # a name tells all letters before it
        t, want = prefix_trie.ZFastTrie(), defaultdict(list)
        for c, s in enumerate(strings):
            t.insert(0, s, c)
            for d in range(1, len(s)):
                want[d, s[d], s[d - 1]].append(c)
        got = {(d, n, u): (k, c) for d, n, u, k, c in t.expand()}
        assert got == {k: (len(v), min(v)) for k, v in want.items()}
        assert all(t.handles[f, n].low < f <= t.handles[f, n].high for f, n in t.handles)
    assert prefix_trie.two_fattest(0, 7) == 4 and prefix_trie.two_fattest(4, 7) == 6 and prefix_trie.two_fattest(6, 7) == 7


# ------------------------------------------------------------------ quality rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i: i + 8])].append(i)
    again = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(again))


def test_counts(spark, docs, empty):
    r = random.Random(2)
    texts = [t for _, t, *_ in corpus()] + [
        "a\na\n\n \na \nb", "x\r\nx\r\nx", "# # * <b> $5 100% &amp; |", "\n\n\n", "é è 漢字 😀 é", "w " * 100,
        " ".join(r.choice("ab") for _ in range(400)), "a b c d e f g h " * 2, "a b c d e f g h a b c d e f g",
        "y" * 5_000_000, " ".join(["long"] * 300_000), ("line of words\n" * 50)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in quality_rules.document_counts(table, ["doc_id"]).collect()}
    assert got == {i: brute_counts(t) for i, t in enumerate(texts)}


def brute_mcd(x):
    """The robust estimate of the rows of ``x`` as the module says it."""
    q, unit = quality_rules, quality_rules.UNIT
    floors = np.array(q.FLOORS) * unit
    ij = tuple(np.array(q.PAIRS).T)

    def inverse(cov):
        cov = cov.copy()
        d = np.arange(q.P)
        cov[d, d] = np.maximum(cov[d, d], floors**2)
        return np.linalg.inv(cov), np.linalg.slogdet(cov)[1]

    def distance(mu, inv):
        d = x - mu
        return np.maximum(np.einsum("ni,ij,nj->n", d, inv, d), 0)

    def estimate(rows, share):
        mu = rows.mean(axis=0)
        ss = (rows[:, ij[0]] * rows[:, ij[1]]).mean(axis=0) - mu[ij[0]] * mu[ij[1]]
        cov = np.zeros((q.P, q.P))
        cov[ij] = ss * q.consistency(share)
        cov = cov + np.triu(cov, 1).T
        return mu, *inverse(cov)

    v = np.floor(x / (unit // 64))
    at = lambda k, p: (sorted(v[:, k])[math.ceil(p * len(x)) - 1] + 0.5) * (unit // 64)
    lo, mid, hi = (np.array([at(k, p) for k in range(q.P)]) for p in (0.25, 0.5, 0.75))
    scale = np.maximum((hi - lo) / 1.349, floors)
    z = (x - mid) / scale
    size = np.sqrt((z * z).sum(axis=1))
    signs = np.where(size[:, None] > 0, z / np.where(size > 0, size, 1)[:, None], 0)
    found = []
    for k, own in enumerate([None, np.round(np.tanh(z) * unit), np.round(signs * unit)]):
        full = np.eye(q.P)
        if own is not None:
            mean = own.mean(axis=0) if k == 1 else np.zeros(q.P)
            cov = own.T @ own / len(x) - np.outer(mean, mean)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            full = cov / np.outer(sd, sd)
            np.fill_diagonal(full, 1)
            full = 0.9 * full + 0.1 * np.eye(q.P)
        mu, (inv, det) = mid, inverse(full * np.outer(scale, scale))
        for _ in range(q.STEPS):
            bins = np.floor(np.log(distance(mu, inv) + 1e-9) * q.BINS)
            cut = sorted(bins)[math.ceil(q.CORE * len(x)) - 1]
            mu, inv, det = estimate(x[bins <= cut], q.CORE)
        found.append((round(det, 9), k, mu, inv))
    _, _, mu, inv = min(found, key=lambda f: f[:2])
    mu, inv, _ = estimate(x[distance(mu, inv) <= q.chi2_quantile(q.NEAR, q.P)], q.NEAR)
    return distance(mu, inv)


def mixed_corpus():
    r = random.Random(9)
    voc = {g: ["".join(r.choices("abcdefghij", k=r.randint(2, 9) + g)) for _ in range(500)] for g in (0, 3)}
    rows = []
    for i in range(420):
        lang, source = ("en", "de")[i % 2], ("s1", "s2", None)[i % 3] if i < 400 else f"rare{i}"
        w = [r.choice(voc[3 * (i % 2)]) for _ in range(int(r.lognormvariate(5, 0.7)) + 20)]
        if i % 17 == 0:
            w = [r.choice(["#", "$$", "<<>>", "|", "x"]) for _ in w]
        if i % 23 == 0:
            w = w[:60] * 2
        rows.append((i, "\n".join(" ".join(w[j: j + 12]) for j in range(0, len(w), 12)), lang, source, 0))
    return rows + [(None, None, None, None, None), (1, "", "en", "s1", 0), rows[5], rows[5], (None, rows[8][1], None, None, 0)]


def test_outliers(spark, empty):
    rows = mixed_corpus()
    counts = [brute_counts(r[1]) for r in rows]
    failed = [c[0] < 20 or 100 * c[5] > 30 * c[0] for c in counts]
    pairs, langs = defaultdict(list), defaultdict(list)
    for i, r in enumerate(rows):
        if not failed[i]:
            pairs[r[2], r[3]].append(i)
    groups, rest = [], []
    for (lang, _), own in pairs.items():
        (groups if len(own) >= 50 else langs[lang]).append(own)
    for lang, parts in langs.items():
        own = [i for p in parts for i in p]
        if len(own) >= 50:
            groups.append(own)
        else:
            rest += own
    if len(rest) >= 50:
        groups.append(rest)
    near = [None] * len(rows)
    for own in groups:
        n, chars, sym, lines, dup, rep = (np.array([counts[i][k] for i in own], float) for k in range(6))
        x = np.round(np.stack([np.log(n), np.log(chars / n), np.sqrt(sym / n), np.sqrt(dup / np.maximum(lines, 1)), np.sqrt(rep / n)],
                              axis=1) * quality_rules.UNIT)
        for i, d in zip(own, brute_mcd(x)):
            near[i] = d
    cut = quality_rules.chi2_quantile(1 - quality_rules.REJECT, quality_rules.P)
    want = [(r[0], *counts[i], failed[i], not failed[i] and (near[i] is None or near[i] <= cut)) for i, r in enumerate(rows)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    crowd = table.select("*", *[F.lit("x").alias(n) for n in ("g", "n_words", "kept", "distance", "mu", "x0", "start", "judged", "__k0")])
    for t in (table, crowd):
        got = quality_rules.judge(t).collect()
        assert sorted((tuple(r[:7]) + (r.base_failed, r.kept) for r in got), key=str) == sorted(want, key=str)
    told = sorted(d for d in near if d is not None)
    assert np.allclose(sorted(r.distance for r in got if r.distance is not None), told, rtol=1e-6, atol=1e-6)
    junk = [i for i in range(0, 400, 17) if not failed[i]]
    assert junk and not any(want[i][-1] for i in junk)
    assert sum(w[-1] for i, w in enumerate(want[:400]) if not failed[i] and i % 17) > 0.97 * sum(not f for i, f in enumerate(failed[:400]) if i % 17)
    assert quality_rules.judge(empty).collect() == []


def test_chi2():
    assert abs(quality_rules.chi2(11.0705, 5) - 0.95) < 1e-5 and abs(quality_rules.chi2_quantile(0.975, 5) - 12.8325) < 1e-3
