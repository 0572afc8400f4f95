"""Vectorised text helpers for Arrow batches inside Spark tasks.

A batch of texts is seen as one byte buffer with offsets; words, hashes and
rolling windows are numpy arrays over it, so there is no Python loop per word
or per document.  Texts are cut into chunks of whole documents of about
``CHUNK`` bytes, which bounds the memory of a task by the longest document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK = 1 << 20

U64 = np.uint64
#: words of up to 8 * ROUNDS bytes are hashed side by side, longer ones each
ROUNDS = 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x + U64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash for the ordered pairs (a, b) of hashes.  Mixed at every step:
    unlike sums of powers, no pattern of equal terms cancels."""
    x = a * U64(0x9E3779B97F4A7C15) + (b ^ (b >> U64(31))) * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(29)
    return x


def windows(x: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive entries of the uint64 array
    ``x``; entry i covers x[i : i + width].  Runs of 1, 2, 4 ... entries are
    doubled, and those that add up to ``width`` are combined."""
    n = len(x) - width + 1
    if n <= 0:
        return np.empty(0, U64)
    out, done, step = None, 0, 1
    while True:
        if width & step:
            piece = x[done: done + n]
            out = piece if out is None else combine(out, piece)
            done += step
        if 2 * step > width:
            return out
        x = combine(x[:-step], x[step:])
        step *= 2


def byte_strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte string data[start : end], in blocks of 8 bytes."""
    size = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))   # the 8 bytes from every place on
    mask = np.array([(1 << 8 * i) - 1 for i in range(9)], U64)
    out = combine(mix(word[starts] & mask[np.minimum(size, 8)]), size.astype(U64))
    left = np.flatnonzero((size > 8) & (size <= 8 * ROUNDS))
    at = 8
    while len(left):
        block = word[starts[left] + at] & mask[np.minimum(size[left] - at, 8)]
        out[left] = combine(out[left], mix(block, at))
        at += 8
        left = left[size[left] > at]
    for i in np.flatnonzero(size > 8 * ROUNDS).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]: ends[i]].tobytes())
    return out


class Spans:
    """Hashes of substrings of one buffer.  ``level``: of every run of ``width``
    bytes (a power of two up to 32), by doubling; a substring of at least that
    many bytes is hashed from its length and the runs that tile it, the last one
    ending with it."""

    def __init__(self, data: np.ndarray, shortest: int):
        self.data = data
        self.width = min(32, 1 << (int(shortest).bit_length() - 1))
        n = max(0, len(data) - 7)
        if self.width < 8:
            padded = np.concatenate([data, np.zeros(8, np.uint8)])
            word = np.ndarray((len(data),), "<u8", padded, strides=(1,))
            self.level = mix(word & U64((1 << 8 * self.width) - 1))[: max(0, len(data) - self.width + 1)]
            return
        word = np.ascontiguousarray(np.ndarray((n,), "<u8", np.ascontiguousarray(data), strides=(1,))) if n else np.empty(0, U64)
        step = 8
        while step < self.width:
            word, step = combine(word[:-step], word[step:]), 2 * step
        self.level = mix(word) if self.width == 8 else word

    def strings(self, starts: np.ndarray, size: int) -> np.ndarray:
        """Hash of the substring of ``size`` bytes (``width`` or more) at each of
        ``starts``: runs are doubled, and the last two cover it.  Few starts are
        looked up, many computed everywhere; the hashes are the same."""
        if 4 * len(starts) > len(self.level):
            return self.everywhere(size)[starts]

        def run(at: np.ndarray, step: int) -> np.ndarray:
            if step == self.width:
                return self.level[at]
            return combine(run(at, step // 2), run(at + step // 2, step // 2))

        step = self.width
        while 2 * step <= size:
            step *= 2
        return combine(run(starts, step), run(starts + size - step, step))

    def everywhere(self, size: int) -> np.ndarray:
        """``strings`` at every place."""
        level, step = self.level, self.width
        while 2 * step <= size:
            level, step = combine(level[:-step], level[step:]), 2 * step
        n = max(0, len(self.data) - size + 1)
        return combine(level[:n], level[size - step: size - step + n])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = ends - starts
        out = combine(self.level[starts], size.astype(U64))
        long = size > 64 * self.width
        left = np.flatnonzero(~long)
        at = self.width
        while len(left):
            last = size[left] <= at + self.width
            place = np.where(last, ends[left] - self.width, starts[left] + at)
            out[left] = combine(out[left], self.level[place])
            left, at = left[~last], at + self.width
        for i in np.flatnonzero(long).tolist():
            out[i] = xxhash.xxh3_64_intdigest(self.data[starts[i]: ends[i]].tobytes())
        return out


def separators(pattern: str) -> np.ndarray:
    """Byte -> is it between words.  ``space``: 0x20 and 0x09-0x0D;
    ``alnum``: every ASCII byte but digits and a-z (after folding A-Z)."""
    t = np.zeros(256, bool)
    if pattern == "space":
        t[0x20] = True
        t[0x09:0x0E] = True
    else:
        t[:0x80] = True
        t[0x30:0x3A] = False
        t[0x61:0x7B] = False
    return t


FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32


def chunks(texts: pa.Array, limit: int = CHUNK):
    """Cut a string array into runs of whole documents of about ``limit``
    bytes.  Yields (first row, last row + 1, bytes, offsets); null texts are
    empty.  The first offset is 0."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    bufs = texts.buffers()
    off = np.frombuffer(bufs[1], np.int64)[texts.offset: texts.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(off, off[a] + limit, "right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b, data[off[a]: off[b]], off[a: b + 1] - off[a]
        a = b


class Words:
    """The words of a chunk: byte range, hash and owner of each.

    ``first[d] : first[d + 1]`` are the words of document d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, sep: np.ndarray,
                 fold: bool = False, hashed: bool = True):
        if fold:
            data = FOLD[data]
        inside = ~sep[data]
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.ones(n, bool)
        after = np.ones(n, bool)
        if n > 1:
            before[1:] = ~inside[:-1]
            after[:-1] = ~inside[1:]
        before |= edge[:n]
        after |= edge[1:]
        self.starts = np.flatnonzero(inside & before)
        self.ends = np.flatnonzero(inside & after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)
        self.data = data
        if hashed:
            self.hash = byte_strings(data, self.starts, self.ends)

    def fits(self, width: int) -> np.ndarray:
        """Start words of the windows of ``width`` words inside a document."""
        last = np.repeat(self.first[1:], self.count)
        i = np.arange(len(self.starts))
        return i[i + width <= last]


def covered(starts: np.ndarray, lengths, n: int) -> np.ndarray:
    """Mask over n positions covered by [start, start + length)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    return np.cumsum(step[:-1]) > 0


def per_doc(mask: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many entries of ``mask`` hold in each document."""
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """A list array from flat values and the length of each list."""
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges [lo, hi) and the range each comes from."""
    n = hi - lo
    owner = np.repeat(np.arange(len(lo)), n)
    base = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else lo, n)
    return np.arange(len(owner)) + base, owner
