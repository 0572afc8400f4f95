"""Exact byte-level deduplication on a Burrows-Wheeler transform.

Every byte covered by a string of ``length`` bytes that starts anywhere else
too (same document or another) is removed.

Which strings can meet is settled first, so that suffix sorting is local.  The
smallest hash of the 32-byte windows inside a string is its key: equal
strings have equal keys, and consecutive starts with one key form a run, about
85 starts long.  Documents go to groups (by a hash of the row), keys to
buckets; a group sends each distinct run once, as (key, content hash,
repeated?).  Only runs whose key occurs twice are fetched, one copy of each
content, and a bucket sorts them in shards of about ``SHARD`` bytes:

threshold-bounded interval expansion: starting from the interval of the empty
string, a breadth-first backward extension on the shard's Burrows-Wheeler
transform visits the intervals of all strings by increasing length, and sets
the common-prefix value of each boundary the first time it appears.  It stops
at ``length``; boundaries without a value then have common prefixes of at
least ``length`` bytes, and the starts on both sides are repeated.  A run that
stands for several equal ones is repeated as a whole.

A key with more than ``HOT`` different runs (the edges of a passage that very
many documents share) is split further: its starts are sent as hashes of their
whole strings, which spread over all buckets; a group sends each once.

Nothing is collected or broadcast, and no task holds more than a group, a
bucket's entries, or a shard; the shuffled texts are one exchange that the
three passes over the groups share.

Edge cases: null and empty texts have no bytes; texts shorter than ``length``
stay whole; repeated rows are copies of each other and all go; a null id is an
id like any other; a very long text is one document of one task (about 40 bytes
a byte); empty tables give empty results; other columns are not read.  Kept bytes are binary: a cut may fall inside a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm._text import U64, Spans, chunks, covered, expand, mix
from rivulet.llm.repeated_passages import _bucket, _member, _per_bucket, _runs, planes, text_bytes, unplanes

LENGTH = 200
GROUP_BYTES = 16 << 20
BUCKET_BYTES = 24 << 20
SHARD = 1 << 20
HOT = 2000


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries: block-wise running
    minima from both sides."""
    n = len(x)
    pad = -n % width
    y = np.concatenate([x, np.full(pad, U64(2**64 - 1))]).reshape(-1, width)
    ahead = np.minimum.accumulate(y, axis=1).reshape(-1)
    behind = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1: n])


def transform(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rotations by their first ``depth`` symbols at least, and
    the Burrows-Wheeler transform.  Prefix doubling: a rank is the place of a
    group of rotations that agree so far, and only such groups are sorted on."""
    n = len(symbols)
    used = np.unique(symbols)
    code = np.searchsorted(used, symbols).astype(U64)
    bits = max(1, int(len(used) - 1).bit_length())
    reach = 64 // bits
    key = np.zeros(n, U64)
    for j in range(reach):
        key = (key << U64(bits)) | np.roll(code, -j)
    order = np.argsort(key)
    place, s = np.arange(n), key[order]
    rank = np.empty(n, U64)
    while True:
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(s)))
        rank[order[place]] = np.repeat(place[at], size).astype(U64)
        if reach >= depth:
            break
        place = place[np.repeat(size > 1, size)]
        if not len(place):
            break
        tied = order[place]
        key = (rank[tied] << U64(32)) | rank[(tied + reach) % n]
        by = np.argsort(key)
        order[place] = tied[by]
        s = key[by]
        reach *= 2
    return order, symbols[order - 1]


def _ascending(x: np.ndarray, n: int) -> np.ndarray:
    """Sort distinct numbers below n."""
    if len(x) < n >> 6:
        return np.sort(x)
    mark = np.zeros(n, bool)
    mark[x] = True
    return np.flatnonzero(mark)


def long_boundaries(bwt: np.ndarray, length: int) -> np.ndarray:
    """Which entries 1..n-1 of the common-prefix array are ``length`` or more,
    by interval expansion; entry i is between suffixes i - 1 and i."""
    n = len(bwt)
    by_symbol = np.argsort(bwt, kind="stable")
    step = np.empty(n, np.int32)              # where the suffix one symbol longer stands
    step[by_symbol] = np.arange(n, dtype=np.int32)
    same = bwt[by_symbol[1:]] == bwt[by_symbol[:-1]]
    after = np.full(n, n, np.int32)           # next and previous place of the same symbol
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    before = np.full(n, -1, np.int32)
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    unset = np.ones(n + 1, bool)
    unset[0] = unset[n] = False
    lo, hi = np.zeros(1, np.int32), np.full(1, n, np.int32)
    for _ in range(length):
        if not len(lo):
            break
        if (hi - lo == 1).all():
            left = _ascending(step[lo], n)
            right = left + 1
        else:
            size = hi - lo
            at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum(), dtype=np.int32)
            left = _ascending(step[at[before[at] < np.repeat(lo, size)]], n)
            right = _ascending(step[at[after[at] >= np.repeat(hi, size)]], n) + 1
        new = unset[right]
        lo, hi = left[new].astype(np.int32), right[new].astype(np.int32)
        unset[hi] = False
    return unset


def repeated_starts(runs: list[bytes], length: int) -> list[np.ndarray]:
    """For each byte string, which of its starts begin a string of ``length``
    bytes that also starts elsewhere in ``runs``."""
    size = np.array([len(r) for r in runs], np.int64)
    data = np.frombuffer(b"\0".join(runs) + b"\0", np.uint8).astype(np.uint16) + 1
    ends = np.cumsum(size + 1) - 1
    data[ends] = 0
    order, bwt = transform(data, length)
    far = long_boundaries(bwt, length)
    hit = np.zeros(len(data), bool)
    hit[order] = far[:-1] | far[1:]
    return [hit[e - n: e - length + 1] for e, n in zip(ends.tolist(), size.tolist())]


class Repeats:
    """The passes over groups and buckets."""

    def __init__(self, length: int, n_buckets: int, hot: int = HOT, shard: int = SHARD):
        self.length, self.n, self.hot, self.shard = length, n_buckets, hot, shard
        self.kgram = Spans(np.empty(0, np.uint8), length).width

    def _loops(self, h: np.ndarray, st: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        """May a run repeat a string of its own?  Only if its key occurs twice
        in it: the leftmost and the rightmost minimum of a window differ, or
        the run is longer than a window."""
        width = self.length - self.kgram + 1
        place = np.arange(len(h)).astype(U64) & U64((1 << 20) - 1)
        top = h & U64((2**64 - 1) ^ ((1 << 20) - 1))
        left = sliding_min(top | place, width)[st] & U64((1 << 20) - 1)
        right = U64((1 << 20) - 1) - (sliding_min(top | (U64((1 << 20) - 1) - place), width)[st] & U64((1 << 20) - 1))
        return np.logical_or.reduceat(left != right, at) | (count > width)

    def _runs(self, texts: pa.Array, loops: bool = False):
        """Per chunk: first row, bytes, offsets, starts, and the runs: place in
        starts, key, content hash, number of starts, then the hashes of
        substrings (``loops``: whether each run may repeat a string of its own)."""
        for a, _, data, off in chunks(texts):
            st, doc = expand(off[:-1], np.maximum(off[:-1], off[1:] - self.length + 1))
            if not len(st):
                yield a, data, off, st, *[np.empty(0, t) for t in (np.int64, U64, U64, np.int64, bool)]
                continue
            spans = Spans(data, self.length)
            h = spans.level
            low = sliding_min(h, self.length - self.kgram + 1)[st]
            new = np.ones(len(st), bool)
            new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(new)
            count = np.diff(np.append(at, len(st)))
            b = st[at]
            content = mix(spans.of(b, b + count - 1 + self.length) ^ count.astype(U64), 8)
            yield a, data, off, st, at, low[at], content, count, self._loops(h, st, at, count) if loops else spans

    def _strings(self, spans: Spans, start: np.ndarray) -> np.ndarray:
        return mix(spans.strings(start, self.length), 10)

    ENTRIES = pa.schema([("g", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()),
                         ("contents", pa.binary()), ("many", pa.binary()), ("loops", pa.binary())])

    def entries(self, group: pa.Table) -> pa.Table:
        """Pass 1: the distinct runs of a group, by bucket of their key."""
        keys, contents, own = [], [], []
        for _, _, _, _, _, key, content, _, loops in self._runs(group["text"].combine_chunks(), loops=True):
            keys.append(key)
            contents.append(content)
            own.append(loops)
        key = np.concatenate(keys) if keys else np.empty(0, U64)
        if not len(key):
            return self.ENTRIES.empty_table()
        content, own = np.concatenate(contents), np.concatenate(own)
        bucket = _bucket(key, self.n)
        order = np.lexsort((content, key, bucket))
        key, content, bucket, own = key[order], content[order], bucket[order], own[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
        at = np.flatnonzero(new)
        many = np.diff(np.append(at, len(key))) > 1
        key, content, bucket, own = key[at], content[at], bucket[at], own[at]
        g = group["g"][0].as_py()
        rows = [(g, b, planes(key[s]), content[s].tobytes(), np.packbits(many[s]).tobytes(), np.packbits(own[s]).tobytes())
                for b, s in _per_bucket(bucket, self.n)]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), self.ENTRIES)], schema=self.ENTRIES)

    def _classes(self, entries: pa.Table):
        """The entries of a bucket sorted by (key, content): row of the entry,
        key, content, begin of each class, begin of each key (in classes), how
        often each class occurs (2: twice or more), and whether it loops."""
        key = [unplanes(x.as_py(), np.uint64) for x in entries["keys"]]
        size = [len(k) for k in key]
        content = np.concatenate([np.frombuffer(x.as_py(), U64) for x in entries["contents"]])
        many, own = (np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=n)
                                     for x, n in zip(entries[col], size)]) for col in ("many", "loops"))
        row = np.repeat(np.arange(len(size)), size)
        key = np.concatenate(key)
        order = np.lexsort((row, content, key))
        key, content, row, many, own = key[order], content[order], row[order], many[order], own[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
        at = np.flatnonzero(new)
        times = np.add.reduceat(many.astype(np.int64) + 1, at)
        return row, key, content, at, _runs(key[at]), np.minimum(times, 2), own[at]

    ASK = pa.schema([("g", pa.int32()), ("bucket", pa.int32()), ("hot", pa.bool_()), ("keys", pa.binary()),
                     ("contents", pa.binary()), ("many", pa.binary())])

    def ask(self, entries: pa.Table) -> pa.Table:
        """Pass 2: of each key that occurs twice, in two runs or in one, ask one
        group for each content; of a hot key, ask every group for its strings."""
        row, key, content, at, of_key, times, loops = self._classes(entries)
        n_classes = np.diff(np.append(of_key, len(at)))
        twice = np.repeat(np.add.reduceat(times + loops, of_key) > 1, n_classes)
        hot = np.repeat(n_classes > self.hot, n_classes)
        out = []
        for is_hot, wanted in ((False, twice & ~hot), (True, twice & hot)):
            if is_hot:
                pick = np.flatnonzero(np.repeat(wanted, np.diff(np.append(at, len(key)))))
                many = np.zeros(len(pick), bool)
            else:
                pick = at[wanted]
                many = times[wanted] > 1
            order = np.argsort(row[pick], kind="stable")
            pick, many = pick[order], many[order]
            edge = np.searchsorted(row[pick], np.arange(len(entries) + 1))
            for r in np.flatnonzero(np.diff(edge)):
                s = slice(edge[r], edge[r + 1])
                k = np.unique(key[pick[s]]) if is_hot else key[pick[s]]
                out.append((entries["g"][int(r)].as_py(), entries["bucket"][int(r)].as_py(), is_hot, planes(k),
                            b"" if is_hot else content[pick[s]].tobytes(), np.packbits(many[s]).tobytes()))
        return pa.table([pa.array([o[i] for o in out], f.type) for i, f in enumerate(self.ASK)], schema=self.ASK)

    SEND = pa.schema([("g", pa.int32()), ("bucket", pa.int32()), ("hot", pa.bool_()), ("keys", pa.binary()),
                      ("contents", pa.binary()), ("many", pa.binary()), ("runs", pa.list_(pa.binary()))])

    def send(self, group: pa.Table, asked: pa.Table) -> pa.Table:
        """Pass 3: the asked runs with their bytes, to the bucket of their key;
        the strings of hot keys as hashes, to the buckets of the hashes."""
        if not len(group) or not len(asked):
            return self.SEND.empty_table()
        rows, hot_keys = [], [np.empty(0, U64)]
        for i in range(len(asked)):
            key = unplanes(asked["keys"][i].as_py(), np.uint64)
            if asked["hot"][i].as_py():
                hot_keys.append(key)
                continue
            content = np.frombuffer(asked["contents"][i].as_py(), U64)
            many = np.unpackbits(np.frombuffer(asked["many"][i].as_py(), np.uint8), count=len(key))
            rows.append((np.full(len(key), asked["bucket"][i].as_py()), key, content, many))
        hot_keys = np.sort(np.concatenate(hot_keys))
        bucket, key, content, many = (np.concatenate(x) for x in zip(*rows)) if rows else (np.empty(0, U64),) * 4
        name = mix(key, 11) ^ content
        order = np.argsort(name)
        name, bucket, key, content, many = name[order], bucket[order], key[order], content[order], many[order]
        found: list = [None] * len(name)
        strings = []
        for _, data, _, st, at, k, c, count, hashes in self._runs(group["text"].combine_chunks()):
            if len(name):
                label = mix(k, 11) ^ c
                for r in np.flatnonzero(_member(label, name)):
                    j = int(np.searchsorted(name, label[r]))
                    if found[j] is None:
                        b = st[at[r]]
                        found[j] = data[b: b + count[r] - 1 + self.length].tobytes()
            if len(hot_keys):
                r = _member(k, hot_keys)
                if r.any():
                    pos, _ = expand(at[r], at[r] + count[r])
                    strings.append(self._strings(hashes, st[pos]))
        g = group["g"][0].as_py()
        out = []
        for b in np.unique(bucket):
            s = np.flatnonzero(bucket == b)
            s = s[np.lexsort((content[s], key[s]))]
            out.append((g, int(b), False, planes(key[s]), content[s].tobytes(), np.packbits(many[s].astype(bool)).tobytes(),
                        [found[j] for j in s]))
        if strings:
            h = np.concatenate(strings)
            b = _bucket(h, self.n)
            order = np.lexsort((h, b))
            h, b = h[order], b[order]
            at = _runs(h)
            twice = np.diff(np.append(at, len(h))) > 1
            h, b = h[at], b[at]
            out += [(g, j, True, planes(h[s]), b"", np.packbits(twice[s]).tobytes(), [])
                    for j, s in _per_bucket(b, self.n)]
        return pa.table([pa.array([o[i] for o in out], f.type) for i, f in enumerate(self.SEND)], schema=self.SEND)

    TELL = pa.schema([("g", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("contents", pa.binary()),
                      ("spans", pa.binary())])

    def _tell(self, g: np.ndarray, kind: int, key, content, spans=None) -> list:
        """One row per group: its runs (or strings), sorted by key."""
        order = np.lexsort((content, key, g))
        g, key, content = g[order], key[order], content[order]
        spans = spans[order] if spans is not None else None
        at = _runs(g)
        return [(int(g[i]), kind, planes(key[i:j]), content[i:j].tobytes(), spans[i:j].tobytes() if spans is not None else b"")
                for i, j in zip(at, np.append(at[1:], len(g)))] if len(g) else []

    def expand_intervals(self, entries: pa.Table, sent: pa.Table) -> pa.Table:
        """Pass 4: repeated starts of a bucket's runs, told to every group
        that has the run: whole (kind 0) or as spans of starts (kind 1); and
        repeated strings of hot keys (kind 2)."""
        out = []
        is_hot = sent["hot"].to_numpy(zero_copy_only=False) if len(sent) else np.empty(0, bool)
        cold = sent.filter(pa.array(~is_hot))
        if len(entries) and len(cold):
            row, key, content, at, _, _, _ = self._classes(entries)
            owner = entries["g"].to_numpy()[row]
            size = np.diff(np.append(at, len(key)))
            k = np.concatenate([unplanes(x.as_py(), np.uint64) for x in cold["keys"]])
            c = np.concatenate([np.frombuffer(x.as_py(), U64) for x in cold["contents"]])
            runs = [r.as_py() for x in cold["runs"] for r in x]
            many = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(r))
                                   for x, r in zip(cold["many"], cold["runs"].to_pylist())]).astype(bool)
            order = np.lexsort((c, k))
            k, c, many = k[order], c[order], many[order]
            runs = [runs[i] for i in order]
            # classes of the entries that were asked for, in the same order
            name = np.sort(mix(k, 11) ^ c)
            mine = np.flatnonzero(_member(mix(key[at], 11) ^ content[at], name))
            n_bytes = np.cumsum([len(r) for r in runs])
            whole = many.copy()
            part: list = []
            begin = _runs(k)
            shard_of = n_bytes[begin] // self.shard      # whole keys to a shard
            for s in np.unique(shard_of):
                i = begin[shard_of == s]
                i, j = int(i[0]), int(begin[shard_of > s][0]) if (shard_of > s).any() else len(k)
                for r, hit in enumerate(repeated_starts(runs[i:j], self.length), i):
                    if whole[r] or hit.all():
                        whole[r] = True
                    elif hit.any():
                        edge = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
                        part += [(r, x, y) for x, y in zip(edge[::2], edge[1::2])]
            w = mine[whole]
            pos, _ = expand(at[w], at[w] + size[w])
            out += self._tell(owner[pos], 0, key[pos], content[pos])
            if part:
                p = np.array(part, np.int64)
                w = mine[p[:, 0]]
                pos, src = expand(at[w], at[w] + size[w])
                out += self._tell(owner[pos], 1, key[pos], content[pos], p[src, 1:].astype(np.int32))
        hot = sent.filter(pa.array(is_hot))
        if len(hot):
            h = [unplanes(x.as_py(), np.uint64) for x in hot["keys"]]
            owner = np.repeat(hot["g"].to_numpy(), [len(x) for x in h])
            many = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(r))
                                   for x, r in zip(hot["many"], h)])
            h = np.concatenate(h)
            order = np.argsort(h, kind="stable")
            h, owner, many = h[order], owner[order], many[order]
            at = _runs(h)
            size = np.diff(np.append(at, len(h)))
            keep = np.repeat(np.add.reduceat(many.astype(np.int64) + 1, at) > 1, size)
            out += self._tell(owner[keep], 2, h[keep], h[keep])
        return pa.table([pa.array([o[i] for o in out], f.type) for i, f in enumerate(self.TELL)], schema=self.TELL)

    CUT = pa.schema([("id", pa.string()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept", pa.binary()), ("removed", pa.list_(pa.list_(pa.int32())))])

    def cut(self, group: pa.Table, told: pa.Table) -> pa.Table:
        """Pass 5: mark what was told and cut it out."""
        schema = self.CUT.set(0, group.schema.field("id"))
        if not len(group):
            return schema.empty_table()
        whole, strings = [np.empty(0, U64)], [np.empty(0, U64)]
        names, spans = [np.empty(0, U64)], [np.empty((0, 2), np.int32)]
        for i in range(len(told)):
            kind = told["kind"][i].as_py()
            key = unplanes(told["keys"][i].as_py(), np.uint64)
            name = mix(key, 11) ^ np.frombuffer(told["contents"][i].as_py(), U64)
            if kind == 0:
                whole.append(name)
            elif kind == 1:
                names.append(name)
                spans.append(np.frombuffer(told["spans"][i].as_py(), np.int32).reshape(-1, 2))
            else:
                strings.append(key)
        whole, strings = np.sort(np.concatenate(whole)), np.sort(np.concatenate(strings))
        names, spans = np.concatenate(names), np.concatenate(spans)
        order = np.argsort(names, kind="stable")
        names, spans = names[order], spans[order]
        size, gone_n, span_n, kept, cut = [], [], [], [], []
        for a, data, off, st, at, k, c, count, hashes in self._runs(group["text"].combine_chunks()):
            name = mix(k, 11) ^ c
            begin = st[at] if len(at) else at
            r = _member(name, whole)
            first, extent = [begin[r]], [count[r] - 1 + self.length]
            lo, hi = np.searchsorted(names, name), np.searchsorted(names, name, "right")
            pos, src = expand(lo, hi)
            first.append(begin[src] + spans[pos, 0])
            extent.append(spans[pos, 1] - spans[pos, 0] - 1 + self.length)
            if len(strings) and len(st):
                s = st[_member(self._strings(hashes, st), strings)]
                first.append(s)
                extent.append(np.full(len(s), self.length))
            gone = covered(np.concatenate(first).astype(np.int64), np.concatenate(extent).astype(np.int64), len(data))
            for i in range(len(off) - 1):
                text, g = data[off[i]: off[i + 1]], gone[off[i]: off[i + 1]]
                n = int(g.sum())
                edge = np.flatnonzero(np.diff(g.astype(np.int8), prepend=0, append=0)).tolist() if n else []
                size.append(len(text))
                gone_n.append(n)
                span_n.append(len(edge) // 2)
                cut.append(list(zip(edge[::2], edge[1::2])))
                kept.append((text[~g] if n else text).tobytes())
        return pa.table([group["id"].combine_chunks(), *(
            pa.array(x, f.type) for x, f in zip((size, gone_n, span_n, kept, cut), list(self.CUT)[1:]))], schema=schema)


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, group_bytes: int = GROUP_BYTES,
                          bucket_bytes: int = BUCKET_BYTES, hot: int = HOT, shard: int = SHARD,
                          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept (the bytes that
    stay, binary), removed (byte spans [start, end) that went)."""
    total = text_bytes(docs, text_col)
    n_groups, n_buckets = -(-total // group_bytes) or 1, -(-total // bucket_bytes) or 1
    r = Repeats(length, n_buckets, hot, shard)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    texts = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(id_col, text_col), F.lit(n_groups)).cast("int").alias("g")).repartition(n_groups, "g")
    entries = texts.groupBy("g").applyInArrow(
        lambda t: r.entries(t), "g int, bucket int, keys binary, contents binary, many binary, loops binary").repartition(n_buckets, "bucket")
    asked = entries.groupBy("bucket").applyInArrow(
        lambda t: r.ask(t), "g int, bucket int, hot boolean, keys binary, contents binary, many binary").repartition(n_groups, "g")
    sent = texts.groupBy("g").cogroup(asked.groupBy("g")).applyInArrow(
        lambda t, u: r.send(t, u), "g int, bucket int, hot boolean, keys binary, contents binary, many binary, runs array<binary>",
    ).repartition(n_buckets, "bucket")
    told = entries.groupBy("bucket").cogroup(sent.groupBy("bucket")).applyInArrow(
        lambda t, u: r.expand_intervals(t, u), "g int, kind int, keys binary, contents binary, spans binary").repartition(n_groups, "g")
    return texts.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(
        lambda t, u: r.cut(t, u), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, removed array<array<int>>",
    ).withColumnRenamed("id", id_col)
