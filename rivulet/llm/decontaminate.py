"""Benchmark decontamination with training suffix arrays.

Each task cuts its documents into shards of about a megabyte and builds one
suffix array per shard over word ids.  Every window of the benchmark (every
test suffix, cut at ``window`` words) is binary-searched in it; consecutive
windows that match on one diagonal join to the longest verbatim match, with
its place in item and document.

A document lies whole in one shard, so no row is shuffled: the plan is one
scan.  Only the benchmark, a stated query set, is sent to the tasks, in blocks
of at most ``block_bytes`` of text by its measured size, each a broadcast of
its own.

Words: ASCII letters are folded to lower case; digits, a-z and every
non-ASCII character are word characters.  An item shorter than ``window``
words is one window; an item without words has none.

Edge cases: null or empty texts have no words and are never contaminated; a
null item text has no windows; a null item id counts as the empty string;
repeated rows (documents or items) each count for themselves, and equal item
ids are one item; a very long text is one shard of one task (about 60 bytes a
byte); other columns are not read, and ``remove_contaminated`` keeps them
whatever their names; empty tables give empty or clean results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm._text import Words, chunks, covered, expand, per_doc, separators

WINDOW = 10
#: text bytes of the benchmark that one broadcast may hold
BLOCK_BYTES = 16 << 20

MATCH = pa.struct([("item_id", pa.string()), ("item_pos", pa.int32()),
                   ("doc_pos", pa.int32()), ("n_words", pa.int32())])


def _pack(tok: np.ndarray, at: np.ndarray, depth: int, per: int) -> list[np.ndarray]:
    """Sort keys of the suffixes at ``at``: ``per`` word ids to a uint64,
    first word in the highest bits.  ``tok`` ends in ``depth`` zeros."""
    bits = np.uint64(64 // per)
    keys = []
    for k in range(0, depth, per):
        key = np.zeros(len(at), np.uint64)
        for j in range(k, k + per):
            key <<= bits
            if j < depth:
                key |= tok[at + j]
        keys.append(key)
    return keys


def _bound(keys: list[np.ndarray], query: list[np.ndarray], n: int, after: bool = False) -> np.ndarray:
    """For each query, how many of the n sorted suffixes are smaller
    (``after``: not larger): one binary search, all queries in step."""
    lo = np.zeros(len(query[0]), np.int64)
    hi = np.full(len(query[0]), n, np.int64)
    while (open_ := lo < hi).any():
        mid = np.minimum((lo + hi) >> 1, n - 1)
        less = np.zeros(len(mid), bool)
        same = np.ones(len(mid), bool)
        for k, q in zip(keys, query):
            v = k[mid]
            less |= same & (v < q)
            same &= v == q
        if after:
            less |= same
        lo = np.where(open_ & less, mid + 1, lo)
        hi = np.where(open_ & ~less, mid, hi)
    return lo


class TestWindows:
    """The windows of some benchmark items, ready to be searched."""

    __test__ = False

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        self.window = window
        self.ids = sorted(set(ids))
        number = {x: i for i, x in enumerate(self.ids)}
        sep = separators("alnum")
        hashes, owner, pos, size = [], [], [], []
        for a, b, data, off in chunks(pa.array(texts, pa.string())):
            w = Words(data, off, sep, fold=True)
            for d in range(b - a):
                h = w.hash[w.first[d]: w.first[d + 1]]
                n = len(h)
                for j in range(max(1, n - window + 1) if n else 0):
                    part = h[j: j + window]
                    hashes.append(part)
                    owner.append(number[ids[a + d]])
                    pos.append(j)
                    size.append(len(part))
        flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.vocabulary = np.unique(flat)
        self.per = 4 if len(self.vocabulary) < (1 << 16) - 1 else 2
        size = np.array(size, np.int64)
        tok = np.zeros((len(size), window), np.uint64)
        inside = np.arange(window) < size[:, None]
        tok[inside] = np.searchsorted(self.vocabulary, flat) + 1
        # equal windows of all items are searched once
        rows = np.concatenate([tok, size[:, None].astype(np.uint64)], axis=1)
        unique, which = np.unique(rows, axis=0, return_inverse=True)
        which = which.reshape(-1)
        order = np.argsort(which, kind="stable")
        self.first = np.searchsorted(which[order], np.arange(len(unique) + 1))
        self.owner = np.array(owner, np.int64)[order]
        self.pos = np.array(pos, np.int64)[order]
        # the items of a window, each once however often it holds it
        held = np.unique(which[order] * max(1, len(self.ids)) + self.owner)
        self.item = held % max(1, len(self.ids))
        self.item_first = np.searchsorted(held // max(1, len(self.ids)), np.arange(len(unique) + 1))
        self.size = unique[:, window].astype(np.int64)
        full = np.uint64((1 << 64 // self.per) - 1)
        low = unique[:, :window]
        high = np.where(np.arange(window) < self.size[:, None], low, full)
        self.low, self.high = self._keys(low), self._keys(high)

    @classmethod
    def received(cls, sent) -> TestWindows:
        """From a broadcast of plain arrays."""
        t = cls.__new__(cls)
        t.__dict__.update(sent.value)
        return t

    def _keys(self, rows: np.ndarray) -> list[np.ndarray]:
        flat = np.concatenate([rows.reshape(-1), np.zeros(self.window, np.uint64)])
        return _pack(flat, np.arange(len(rows)) * rows.shape[1], self.window, self.per)

    def search(self, w: Words, n_docs: int):
        """Occurrences of the windows in one shard: (word position, window)."""
        n = len(w.hash)
        none = np.empty(0, np.int64)
        if not n or not len(self.size):
            return none, none
        at = np.searchsorted(self.vocabulary, w.hash)
        at[at == len(self.vocabulary)] = 0
        known = self.vocabulary[at] == w.hash
        # one zero behind each document: no match crosses it
        place = np.arange(n) + w.doc
        tok = np.zeros(n + n_docs + self.window + 1, np.uint64)
        tok[place] = np.where(known, at + 1, 0)
        # a suffix that begins with a word of no item can start no match
        start = place[known]
        keys = _pack(tok, start, self.window, self.per)
        suffix = np.lexsort(keys[::-1])
        keys = [k[suffix] for k in keys]
        lo = _bound(keys, self.low, len(suffix))
        hi = _bound(keys, self.high, len(suffix), after=True)
        rank, window = expand(lo, hi)
        word = np.flatnonzero(known)[suffix[rank]]
        return word, window


def _search_batch(texts: pa.Array, tests: list, matches: bool):
    """Per document of a batch: words, hit words, matching items, matches."""
    n_words, n_hit, items, found = [], [], [], []
    sep = separators("alnum")
    for a, b, data, off in chunks(texts):
        w = Words(data, off, sep, fold=True)
        hit = np.zeros(len(w.hash), bool)
        got: dict[int, set] = {}
        rows: list[tuple] = []
        for sent in tests:
            t = TestWindows.received(sent)
            word, win = t.search(w, b - a)
            if not len(word):
                continue
            hit |= covered(word, t.size[win], len(hit))
            # a window that occurs often in a document names its items once
            n_windows = len(t.size)
            once = np.unique(w.doc[word] * n_windows + win)
            k, src = expand(t.item_first[once % n_windows], t.item_first[once % n_windows + 1])
            for pair in np.unique((once // n_windows)[src] * len(t.ids) + t.item[k]).tolist():
                got.setdefault(pair // len(t.ids), set()).add(t.ids[pair % len(t.ids)])
            if matches:     # every occurrence with every place that holds it
                k, src = expand(t.first[win], t.first[win + 1])
                doc, pos = w.doc[word[src]], word[src]
                rows += _longest(t, doc, t.owner[k], t.pos[k], pos - w.first[doc], t.size[win[src]])
        n_words.append(w.count)
        n_hit.append(per_doc(hit, w.first))
        items += [sorted(got.get(d, ())) for d in range(b - a)]
        by: dict[int, list] = {}
        for d, *m in sorted(rows):
            by.setdefault(d, []).append(dict(zip(("item_id", "item_pos", "doc_pos", "n_words"), m)))
        found += [by.get(d, []) for d in range(b - a)]
    flat = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
    return flat(n_words), flat(n_hit), items, found


def _longest(t: TestWindows, doc, item, item_pos, doc_pos, size) -> list[tuple]:
    """Join windows that follow one another in item and document."""
    diag = doc_pos - item_pos
    order = np.lexsort((doc_pos, diag, item, doc))
    doc, item, item_pos, doc_pos, size, diag = (
        x[order] for x in (doc, item, item_pos, doc_pos, size, diag))
    new = np.ones(len(doc), bool)
    new[1:] = ((np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(diag) != 0)
               | (np.diff(doc_pos) > 1))
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(doc)) - 1
    return [(int(doc[h]), t.ids[item[h]], int(item_pos[h]), int(doc_pos[h]),
             int(doc_pos[e] + size[e] - doc_pos[h])) for h, e in zip(head, tail)]


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[TestWindows]:
    """The benchmark in blocks of items, each small enough to be sent out.

    Items are dealt to blocks by a hash of their id; the number of blocks
    follows the measured size of the benchmark."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.col("text"))
    total = items.agg(F.sum(F.octet_length("text") + F.octet_length("item_id") + 16).alias("n")).first()["n"]
    n = -(-(total or 0) // block_bytes)
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k)
        rows = part.toArrow()
        yield TestWindows(rows["item_id"].to_pylist(), rows["text"].to_pylist(), window)


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id",
                 text_col: str = "text", matches: bool = True) -> DataFrame:
    """Per document: id, n_words, n_hit (words inside a window that occurs),
    items (ids with an occurring window, sorted), n_items, items_sha256,
    contaminated, and matches (item_id, item_pos, doc_pos, n_words: longest
    verbatim matches, word positions from 0).  Without ``matches`` that list is
    empty, and a passage that many items share costs each document one row per
    item, not per item and occurrence."""
    sc = docs.sparkSession.sparkContext
    sent = [sc.broadcast(vars(t)) for t in _blocks(benchmark, window, block_bytes)]
    key = docs.select(F.col(id_col)).schema[0]

    def search(batches):
        for batch in batches:
            n_words, n_hit, items, found = _search_batch(batch.column(1), sent, matches)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array(items, pa.list_(pa.string())),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                pa.array(n_hit > 0, pa.bool_()),
                pa.array(found, pa.list_(MATCH)),
            ], names=[id_col, "n_words", "n_hit", "items", "n_items", "items_sha256", "contaminated", "matches"])

    schema = (f"`{id_col}` {key.dataType.simpleString()}, n_words long, n_hit long, items array<string>, "
              "n_items long, items_sha256 string, contaminated boolean, "
              "matches array<struct<item_id string, item_pos int, doc_pos int, n_words int>>")
    return docs.select(id_col, text_col).mapInArrow(search, schema)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        block_bytes: int = BLOCK_BYTES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without any occurring window."""
    sc = docs.sparkSession.sparkContext
    sent = [sc.broadcast(vars(t)) for t in _blocks(benchmark, window, block_bytes)]
    at = docs.columns.index(text_col)

    def keep(batches):
        for batch in batches:
            _, n_hit, _, _ = _search_batch(batch.column(at), sent, False)
            yield batch.filter(pa.array(n_hit == 0, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
