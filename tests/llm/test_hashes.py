"""Texts built to cancel in hashes that are sums of powers modulo 2**64."""

import random
import time

import numpy as np
import pytest

from rivulet.llm import decontaminate, near_duplicates, repeated_bytes, repeated_passages
from rivulet.llm._text import U64, Spans, byte_strings, combine, mix, windows

from .conftest import SCHEMA

SIZES = [512, 1024, 2048, 4096]


def alternating(n, letters="ab"):
    """n letters by the parity of the ones of their place, and the other way round."""
    ones = [bin(i).count("1") % 2 for i in range(n)]
    return "".join(letters[b] for b in ones), "".join(letters[1 - b] for b in ones)


def documents(spark, texts):
    return spark.createDataFrame([(i + 1, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)


def filler(n, seed):
    r = random.Random(seed)
    return ["".join(r.choices("cdefgh", k=7)) for _ in range(n)]


def test_alternating_words(spark):
    pairs = [alternating(n) for n in SIZES]
    alone = documents(spark, [w for p in pairs for w in p])
    assert near_duplicates.near_duplicates(alone).where("not kept").count() == 0
    texts, want = [], []
    for i, (a, b) in enumerate(pairs):
        w = filler(49, i)
        texts += [" ".join([*w, a]), " ".join([*w, b]), " ".join([*w, b])]
        want += [0, 0, 50]
    got = repeated_passages.remove_repeats(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r.n_removed for r in got] == want
    items, texts = [], []
    for i, (a, b) in enumerate(pairs):
        w = filler(9, 50 + i)
        items.append((f"q{i}", " ".join([*w, a])))
        texts += [" ".join([*w, a]), " ".join([*w, b])]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.find_matches(documents(spark, texts), bench).orderBy("doc_id").collect()
    assert [r.contaminated for r in got] == [True, False] * len(pairs)


def test_alternating_pieces_of_bytes(spark):
    r = random.Random(7)
    piece = "".join(r.choices("xyz", k=31))
    ones = [bin(i).count("1") % 2 for i in range(1024)]
    # one letter of each piece alternates; the letter before it is random, so that no 200 bytes repeat
    fill = ["".join(r.choices("mnopqrstuvw", k=68)) for _ in ones]
    texts = ["".join(f + piece + "ab"[(b + side) % 2] for f, b in zip(fill, ones)) for side in (0, 1)]
    strings = [{t[i: i + 200] for i in range(len(t) - 199)} for t in texts]
    assert not strings[0] & strings[1] and all(len(s) == len(t) - 199 for s, t in zip(strings, texts))
    got = repeated_bytes.remove_repeated_bytes(documents(spark, texts)).collect()
    assert [r.n_removed for r in got] == [0, 0]


@pytest.mark.parametrize("width", [1, 2, 5, 8, 10, 25, 50])
def test_windows_tell_sequences_apart(width):
    r = np.random.default_rng(width)
    words = mix(np.arange(3, dtype=U64))
    x = words[r.integers(0, 3, 4000)]
    h = windows(x, width)
    by_hash, by_words = {}, {}
    for i in range(len(x) - width + 1):
        by_hash.setdefault(int(h[i]), []).append(i)
        by_words.setdefault(x[i: i + width].tobytes(), []).append(i)
    assert sorted(by_hash.values()) == sorted(by_words.values())
    assert len(windows(x[:width], width)) == 1 and len(windows(x[: width - 1], width)) == 0


def test_byte_strings_and_spans_tell_substrings_apart():
    r = np.random.default_rng(1)
    data = r.integers(97, 99, 5000).astype(np.uint8)
    b = r.integers(0, 4000, 3000)
    e = b + r.integers(1, 700, 3000)
    long = np.flatnonzero(e - b >= 40)
    for h, rows in ((byte_strings(data, b, e), np.arange(3000)), (Spans(data, 40).of(b[long], e[long]), long)):
        seen = {}
        for v, i in zip(h.tolist(), rows.tolist()):
            assert seen.setdefault(v, data[b[i]: e[i]].tobytes()) == data[b[i]: e[i]].tobytes()
        assert len(seen) == len({data[b[i]: e[i]].tobytes() for i in rows.tolist()})
    for size in (40, 64, 200):
        every = Spans(data, 40).everywhere(size)
        some = np.array([0, 7, 4800, len(data) - size])
        assert (Spans(data, 40).strings(some, size) == every[some]).all()
        seen = {}
        for i, v in enumerate(every.tolist()):
            assert seen.setdefault(v, data[i: i + size].tobytes()) == data[i: i + size].tobytes()
        assert len(every) == len(data) - size + 1 and len(seen) == len({data[i: i + size].tobytes() for i in range(len(every))})
    two = byte_strings(np.frombuffer(b"abcdefghij-abcdefghij", np.uint8), np.array([0, 11]), np.array([10, 21]))
    assert two[0] == two[1] and combine(two[:1], two[:1]) != two[:1]


def test_a_passage_that_all_items_share(spark):
    """3,000 items with one head against a text of 3,000 heads: no work per
    item and occurrence."""
    head = " ".join(f"head{i}" for i in range(10))
    items = spark.createDataFrame([(f"q{i:04d}", f"{head} tail{i} more{i}") for i in range(3000)], "item_id string, text string")
    docs = documents(spark, [" ".join([head] * 3000), f"{head} tail7 more7", "nothing of it"])
    start = time.time()
    got = decontaminate.find_matches(docs, items, matches=False).orderBy("doc_id").collect()
    assert time.time() - start < 60
    assert [(r.n_words, r.n_hit, r.n_items) for r in got] == [(30_000, 30_000, 3000), (12, 12, 3000), (3, 0, 0)]
    assert got[0]["items"] == sorted(f"q{i:04d}" for i in range(3000))


def test_the_largest_and_the_smallest_id(spark):
    w = " ".join(filler(60, 8))
    rows = [(2**63 - 1, w, "en", "s", 0), (-(2**63), w + " after", "en", "s", 0), (0, "before " + w, "en", "s", 0), (None, w, "en", "s", 0)]
    got = {r.doc_id: r.n_removed for r in repeated_passages.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {2**63 - 1: 60, -(2**63): 0, 0: 60, None: 0}
