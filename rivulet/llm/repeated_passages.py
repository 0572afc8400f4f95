"""Substring deduplication with fixed-block anchors.

A passage of at least ``window`` words that a document with a smaller id also
holds is removed from the later document.  Any such window contains a whole
non-overlapping reference block of ``window // 2`` words of the earlier
document, so the blocks are the index and every rolling window of that many
words of every document is a probe.  Hits are extended to all passages of
``window`` words around them, and overlapping passages to maximal repeats.

Work is dealt twice.  Documents go to groups of about ``group_bytes`` of text
(by a hash of the row); anchors and passages go to buckets by their own hash.
A group sends each distinct hash once, with flags (is it a reference block
somewhere in the group, do two documents of the group hold it), sorted and
delta-coded; a bucket sees at most one entry per group of a hash, so a passage
that a third of all documents share is as cheap as any other.  The answer to
a group names the hashes that count, and the group finds them in its texts.
Nothing is collected, broadcast or paired; the shuffled texts are one exchange
that all three passes over the groups share.

Anchors are compared by 32 bits within a bucket (a false hit only widens the
candidates), passages by 64 bits within a bucket.

Words are runs of bytes other than 0x20 and 0x09-0x0D, unchanged.  Edge
cases: null and empty texts have no words; a document with fewer words than
the window keeps all; rows that repeat an id do not count as earlier than each
other; rows with a null id are neither earlier nor removed from; a very long
text is one document of one task (about 60 bytes a byte); empty tables give
empty results; other columns are not read.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm._text import U64, Words, chunks, covered, mix, separators, windows

WINDOW = 50
GROUP_BYTES = 16 << 20
BUCKET_BYTES = 24 << 20


def planes(x: np.ndarray) -> bytes:
    """Sorted unsigned integers as deltas, byte plane by byte plane: the high
    planes are nearly all zero and vanish in the shuffle's compression."""
    d = np.diff(x, prepend=x.dtype.type(0))
    return np.ascontiguousarray(d.view(np.uint8).reshape(-1, x.dtype.itemsize).T).tobytes()


def unplanes(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    d = np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)
    return np.cumsum(d, dtype=dtype)


def _rolling(w: Words, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Start words and hashes of the windows of ``width`` words."""
    at = w.fits(width)
    h = windows(w.hash, width)
    return at, mix(h[at], seed)


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return ((mix(h, 9) >> U64(32)) * U64(n)) >> U64(32)


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return np.flatnonzero(new)


def _ids(table: pa.Table, col: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and which rows have one."""
    return table[col].cast(pa.int64()).fill_null(0).to_numpy(), table[col].is_valid().to_numpy()


def _per_bucket(bucket: np.ndarray, n: int):
    edge = np.searchsorted(bucket, np.arange(n + 1, dtype=bucket.dtype))
    for b in np.flatnonzero(np.diff(edge)):
        yield int(b), slice(edge[b], edge[b + 1])


class Repeats:
    """The passes over groups and buckets, for one window length."""

    def __init__(self, window: int, n_buckets: int):
        self.window = window
        self.block = max(1, window // 2)
        self.n = n_buckets

    def _words(self, texts: pa.Array):
        sep = separators("space")
        for a, b, data, off in chunks(texts):
            yield a, b, Words(data, off, sep)

    def anchors(self, group: pa.Table) -> pa.Table:
        """Pass 1: the distinct rolling hashes of a group, by bucket."""
        doc, hashes, aligned = [], [], []
        for a, _, w in self._words(group["text"].combine_chunks()):
            at, h = _rolling(w, self.block, 1)
            hashes.append(h)
            doc.append(w.doc[at].astype(np.int32) + a)
            aligned.append((at - w.first[w.doc[at]]) % self.block == 0)
        h = np.concatenate(hashes) if hashes else np.empty(0, U64)
        doc = np.concatenate(doc) if doc else np.empty(0, np.int32)
        aligned = np.concatenate(aligned) if aligned else np.empty(0, bool)
        low = h & U64(0xFFFFFFFF)
        bucket = _bucket(h, self.n)
        order = np.argsort((bucket << U64(32)) | low, kind="stable")
        low, bucket, doc, aligned = low[order], bucket[order], doc[order], aligned[order]
        at = _runs((bucket << U64(32)) | low)
        last = np.append(at[1:], len(low)) - 1
        many = doc[at] != doc[np.maximum(last, 0)] if len(at) else np.empty(0, bool)
        index = np.logical_or.reduceat(aligned, at) if len(at) else np.empty(0, bool)
        low, bucket = low[at].astype(np.uint32), bucket[at]
        rows = [(b, planes(low[s]), np.packbits(many[s]).tobytes(), np.packbits(index[s]).tobytes())
                for b, s in _per_bucket(bucket, self.n)]
        g = group["g"][0].as_py()
        return pa.table({"g": pa.array([g] * len(rows), pa.int32()), "bucket": pa.array([r[0] for r in rows], pa.int32()),
                         "hashes": pa.array([r[1] for r in rows], pa.binary()),
                         "many": pa.array([r[2] for r in rows], pa.binary()),
                         "indexed": pa.array([r[3] for r in rows], pa.binary())})

    def probe(self, entries: pa.Table) -> pa.Table:
        """Pass 2: the hashes of a bucket that are a reference block and are
        held by two documents, told to every group that has them."""
        h = [unplanes(x.as_py(), np.uint32) for x in entries["hashes"]]
        bits = lambda col: np.concatenate(
            [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(k)) for x, k in zip(entries[col], h)]).astype(bool)
        many, indexed = bits("many"), bits("indexed")
        owner = np.repeat(np.arange(len(h), dtype=np.int32), [len(k) for k in h])
        h = np.concatenate(h)
        order = np.argsort(h, kind="stable")
        s, owner = h[order], owner[order]
        at = _runs(s)
        size = np.diff(np.append(at, len(s)))
        hit = np.logical_or.reduceat(indexed[order], at) & ((size > 1) | np.logical_or.reduceat(many[order], at))
        keep = np.repeat(hit, size)
        return self._answers(entries, s[keep], owner[keep])

    @staticmethod
    def _answers(entries: pa.Table, s: np.ndarray, owner: np.ndarray) -> pa.Table:
        order = np.argsort(owner, kind="stable")
        s, owner = s[order], owner[order]
        edge = np.searchsorted(owner, np.arange(len(entries) + 1))
        full = np.flatnonzero(np.diff(edge))
        return pa.table({"g": entries["g"].take(pa.array(full)), "bucket": entries["bucket"].take(pa.array(full)),
                         "hashes": pa.array([planes(s[edge[i]: edge[i + 1]]) for i in full], pa.binary())})

    def _told(self, answers: pa.Table, dtype, tag=None) -> list:
        return [(answers["bucket"][i].as_py(), unplanes(answers["hashes"][i].as_py(), dtype))
                for i in range(len(answers)) if tag is None or answers["kind"][i].as_py() == tag]

    def passages(self, group: pa.Table, answers: pa.Table) -> pa.Table:
        """Pass 3: hits extended to the windows around them, by bucket: hash,
        the smallest id in the group, whether other documents hold it too."""
        out = pa.schema([("g", pa.int32()), ("bucket", pa.int32()), ("hashes", pa.binary()),
                         ("least", pa.binary()), ("many", pa.binary())])
        if not len(group) or not len(answers):
            return out.empty_table()
        told = self._told(answers, np.uint32)
        known = np.sort(np.concatenate([(U64(b) << U64(32)) | h.astype(U64) for b, h in told]))
        ids, has_id = _ids(group, "id")
        hashes, owner = [], []
        for a, _, w in self._words(group["text"].combine_chunks()):
            at, h = _rolling(w, self.block, 1)
            key = (_bucket(h, self.n) << U64(32)) | (h & U64(0xFFFFFFFF))
            hit = np.zeros(len(w.hash) + 1, np.int64)
            hit[at + 1] = _member(key, known)
            hits = np.cumsum(hit)          # hits[i]: hits before word i
            at, h = _rolling(w, self.window, 2)
            near = hits[at + self.window - self.block + 1] > hits[at]
            near &= has_id[w.doc[at] + a]
            hashes.append(h[near])
            owner.append(ids[w.doc[at[near]] + a])
        h, owner = np.concatenate(hashes), np.concatenate(owner)
        bucket = _bucket(h, self.n)
        order = np.lexsort((owner, h, bucket))
        h, owner, bucket = h[order], owner[order], bucket[order]
        at = _runs(h)
        if not len(h):
            return out.empty_table()
        many = owner[at] != owner[np.append(at[1:], len(h)) - 1]
        h, owner, bucket = h[at], owner[at], bucket[at]
        rows = [(b, planes(h[s]), owner[s].tobytes(), np.packbits(many[s]).tobytes())
                for b, s in _per_bucket(bucket, self.n)]
        g = group["g"][0].as_py()
        return pa.table([pa.array([g] * len(rows), pa.int32()), *(
            pa.array([r[i] for r in rows], out.field(i + 1).type) for i in range(4))], schema=out)

    def earliest(self, entries: pa.Table) -> pa.Table:
        """Pass 4: for each group, the passages that an earlier document holds:
        in another group (kind 0), or in the same group only (kind 1)."""
        h = [unplanes(x.as_py(), np.uint64) for x in entries["hashes"]]
        size = [len(k) for k in h]
        least = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in entries["least"]])
        many = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=n)
                               for x, n in zip(entries["many"], size)]).astype(bool)
        owner = np.repeat(np.arange(len(h), dtype=np.int32), size)
        h = np.concatenate(h)
        order = np.argsort(h, kind="stable")
        h, least, many, owner = h[order], least[order], many[order], owner[order]
        at = _runs(h)
        first = np.repeat(np.minimum.reduceat(least, at), np.diff(np.append(at, len(h))))
        parts = []
        for kind, keep in ((0, first < least), (1, (first == least) & many)):
            t = self._answers(entries, h[keep], owner[keep])
            parts.append(t.append_column("kind", pa.array([kind] * len(t), pa.int32())))
        return pa.concat_tables(parts)

    def cut(self, group: pa.Table, answers: pa.Table) -> pa.Table:
        """Pass 5: mark the words of those passages and cut them out."""
        out = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                         ("kept_text", pa.string()), ("removed", pa.list_(pa.list_(pa.int32())))])
        if not len(group):
            return out.empty_table()
        told = [np.sort(np.concatenate([np.empty(0, U64), *(h for _, h in self._told(answers, np.uint64, k))]))
                for k in (0, 1)]
        ids, has_id = _ids(group, "id")
        pieces, local, text = [], [], group["text"].combine_chunks()
        for a, b, w in self._words(text):
            flag = at = np.empty(0, np.int64)
            if len(told[0]) or len(told[1]):
                at, h = _rolling(w, self.window, 2)
                own = has_id[w.doc[at] + a]
                inner = np.flatnonzero(_member(h, told[1]) & own)
                local.append((h[inner], ids[w.doc[at[inner]] + a], np.full(len(inner), len(pieces)), at[inner]))
                flag = at[_member(h, told[0]) & own]
            pieces.append((a, b, w.first, len(w.hash), w.count, flag))
        extra: dict[int, list] = {}
        if local:
            h, doc, piece, at = (np.concatenate(x) for x in zip(*local))
            order = np.lexsort((doc, h))
            h, doc, piece, at = h[order], doc[order], piece[order], at[order]
            if len(h):
                start = _runs(h)
                least = np.repeat(doc[start], np.diff(np.append(start, len(h))))
                late = doc > least
                for k in np.unique(piece[late]):
                    extra[int(k)] = at[late & (piece == k)]
        n_words, n_removed, kept, spans = [], [], [], []
        for k, (a, b, first, n, count, flag) in enumerate(pieces):
            gone = covered(np.concatenate([flag, extra.get(k, flag[:0])]), self.window, n)
            n_words.append(count)
            for d in range(b - a):
                words = (text[a + d].as_py() or "").encode().split()
                g = gone[first[d]: first[d + 1]]
                n_removed.append(int(g.sum()))
                edge = np.flatnonzero(np.diff(g.astype(np.int8), prepend=0, append=0)).tolist() if n_removed[-1] else []
                spans.append(list(zip(edge[::2], edge[1::2])))
                kept.append(b" ".join(compress(words, (~g).tolist()) if edge else words).decode())
        ident = group["id"].cast(pa.int64()).combine_chunks()
        return pa.table([ident, pa.array(np.concatenate(n_words), pa.int64()), pa.array(n_removed, pa.int64()),
                         pa.array(kept, pa.string()), pa.array(spans, out.field(4).type)], schema=out)


def _member(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which entries of x are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(x), bool)
    at = np.searchsorted(known, x)
    at[at == len(known)] = 0
    return known[at] == x


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, group_bytes: int = GROUP_BYTES,
                   bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, n_removed, kept_text (the words that stay,
    joined by one space), removed (word spans [start, end) that went)."""
    total = text_bytes(docs, text_col)
    n_groups, n_buckets = -(-total // group_bytes) or 1, -(-total // bucket_bytes) or 1
    r = Repeats(window, n_buckets)
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(id_col, text_col), F.lit(n_groups)).cast("int").alias("g")).repartition(n_groups, "g")
    anchors = texts.groupBy("g").applyInArrow(
        lambda t: r.anchors(t), "g int, bucket int, hashes binary, many binary, indexed binary")
    hits = anchors.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(lambda t: r.probe(t), "g int, bucket int, hashes binary")
    passages = texts.groupBy("g").cogroup(hits.repartition(n_groups, "g").groupBy("g")).applyInArrow(
        lambda t, u: r.passages(t, u), "g int, bucket int, hashes binary, least binary, many binary")
    earlier = passages.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(
        lambda t: r.earliest(t), "g int, bucket int, hashes binary, kind int")
    return texts.groupBy("g").cogroup(earlier.repartition(n_groups, "g").groupBy("g")).applyInArrow(
        lambda t, u: r.cut(t, u), "id long, n_words long, n_removed long, kept_text string, removed array<array<int>>",
    ).withColumnRenamed("id", id_col)
