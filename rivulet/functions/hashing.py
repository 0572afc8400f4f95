"""The keyed log's partitioner as a native expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 32-bit hash that the log's default partitioner takes of a key.
_SEED, _M, _R = 0x9747B28C, 0x5BD1E995, 24
_MASK = 0xFFFFFFFF


def _times(h: Column) -> Column:
    """h * M modulo 2**32: below 2**63, so it never overflows a long."""
    return (h * _M).bitwiseAND(F.lit(_MASK))


def _mixed(h: Column, bits: int) -> Column:
    return h.bitwiseXOR(F.shiftright(h, bits))


def murmur2(c: Column | str) -> Column:
    """Murmur2 of a text's UTF-8 bytes (or of a binary): an unsigned 32-bit
    value in a long; null for null."""
    data = (F.col(c) if isinstance(c, str) else c).cast("binary")
    digits, n = F.hex(data), F.length(data)
    byte = lambda i: F.conv(F.substring(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("long")
    shifted = lambda i, at: F.shiftleft(byte(i), at)

    def block(i: Column) -> Column:
        i = 4 * i
        word = byte(i).bitwiseOR(shifted(i + 1, 8)).bitwiseOR(shifted(i + 2, 16)).bitwiseOR(shifted(i + 3, 24))
        return _times(_mixed(_times(word), _R))

    blocks = F.when(n >= 4, F.transform(F.sequence(F.lit(0), F.floor(n / 4).cast("int") - 1), block)).otherwise(
        F.array().cast("array<long>"))
    start = F.lit(_SEED).bitwiseXOR(n.cast("long"))
    h = F.aggregate(blocks, start, lambda a, k: _times(a).bitwiseXOR(k))
    at, rest = n - n % 4, n % 4
    tail = F.when(rest >= 3, shifted(at + 2, 16)).otherwise(F.lit(0).cast("long"))
    tail = tail.bitwiseXOR(F.when(rest >= 2, shifted(at + 1, 8)).otherwise(F.lit(0).cast("long")))
    h = F.when(rest == 0, h).otherwise(_times(h.bitwiseXOR(tail).bitwiseXOR(byte(at))))
    return F.when(data.isNotNull(), _mixed(_times(_mixed(h, 13)), 15))


def log_partition(key: Column | str, partitions: int) -> Column:
    """The partition that the log's default partitioner gives a key."""
    return (murmur2(key).bitwiseAND(F.lit(0x7FFFFFFF)) % partitions).cast("int")
