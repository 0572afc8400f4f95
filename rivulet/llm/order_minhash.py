"""Document fingerprints by Order MinHash, in DataFrame functions only.

The k-mers of a text are its runs of ``k`` words.  Equal k-mers are numbered
by occurrence, each (k-mer, number) gets one hash, and the hash also deals it
to one of ``bins`` bins (one permutation in bins instead of one permutation
per entry, so a text is read once whatever the length of its fingerprint).
From each bin the ``ell`` smallest are taken, put back in text order, and the
tuple of their k-mers is hashed: two texts agree in a bin if they share its
minimal k-mers in the same order, which is what makes the signature follow
edit distance rather than overlap.  An entry is the bin and 32 bits of its
tuple's hash.

Everything is arrays of one row: no explode, no aggregate, no shuffle.  Sorts
use longs that pack 36 bits of hash with 28 bits of position, so a text may
have 2**28 words.

Edge cases: null and empty texts (and texts without a word) have the empty
fingerprint; two empty fingerprints are alike (1), an empty and another one
are not (0); a text of fewer than ``k`` words is one k-mer; equal texts have
equal fingerprints; repeated rows, and rows with equal or null ids, each give a
row; a very long text is one array of words in its row, sorted in its task; other
columns are not read, so none clashes; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm._order import range_of

K, ELL, BINS = 3, 2, 64
_POS = 28
#: bytes of text that one sorted range of ids should hold, and the most ranges
RANGE_BYTES, MAX_RANGES = 64 << 20, 20_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it as often as ``body`` likes."""
    return F.transform(F.array(value), body)[0]


def _high(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, _POS)


def _pos(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << _POS) - 1)).cast("int")


def _pack(hashed: Column, pos: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(hashed, _POS), _POS).bitwiseOR(pos.cast("long"))


def _before(sorted_: Column, i: Column, value: Column) -> Column:
    """How many of the first i entries have a smaller hash part: binary search."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(_POS))])
    return F.aggregate(steps, F.lit(0), lambda c, s: F.when(
        (c + s <= i) & (_order(_high(F.get(sorted_, c + s - 1))) < _order(value)), c + s).otherwise(c))


def _order(high: Column) -> Column:
    """Hash parts in the order of the signed longs they come from."""
    return high.bitwiseXOR(F.lit(1 << (63 - _POS)))


def fingerprint(text: Column, k: int = K, ell: int = ELL, bins: int = BINS) -> Column:
    """The entries of the fingerprint, array<long>: bin * 2**32 + hash."""
    bits = bins.bit_length() - 1
    if 1 << bits != bins:
        raise ValueError("bins must be a power of two")
    words = F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""), lambda w: F.xxhash64(w))

    def kmers(w: Column) -> Column:
        last = F.greatest(F.size(w) - k, F.lit(0))
        return F.when(F.size(w) > 0, F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
        ).otherwise(F.array().cast("array<bigint>"))

    def bin_of(q: Column) -> Column:
        return F.shiftrightunsigned(q, 64 - bits)

    def labelled(mers: Column) -> Column:
        """(occurrence hash, position), sorted by hash."""
        def number(p: Column) -> Column:
            def label(x: Column, i: Column) -> Column:
                # a first occurrence keeps the k-mer's own hash
                repeat = (i > 0) & (_high(F.get(p, i - 1)) == _high(x))
                nth = i - _before(p, i, _high(x))
                return F.when(repeat, _pack(F.xxhash64(F.get(mers, _pos(x)), nth), _pos(x))).otherwise(x)
            return F.transform(p, label)
        return F.sort_array(_let(F.sort_array(F.transform(mers, _pack)), number))

    def smallest(q: Column) -> Column:
        """The ell smallest of each bin as (bin, position), in text order."""
        taken = F.filter(q, lambda x, i: (i < ell) | (bin_of(F.get(q, i - ell)) != bin_of(x)))
        return F.sort_array(F.transform(taken, lambda x: F.shiftleft(bin_of(x), _POS).bitwiseOR(_pos(x).cast("long"))))

    def tuples(mers: Column, s: Column) -> Column:
        def entry(x: Column, i: Column) -> Column:
            own = [F.get(mers, _pos(x))]
            for j in range(1, ell):
                y = F.get(s, i + j)
                own.append(F.when(_high(y) == _high(x), F.get(mers, _pos(y))))
            head = (i == 0) | (_high(F.get(s, i - 1)) != _high(x))
            return F.when(head, F.shiftleft(_high(x), 32).bitwiseOR(F.xxhash64(*own).bitwiseAND(F.lit(0xFFFFFFFF))))
        return F.filter(F.transform(s, entry), lambda e: e.isNotNull())

    return _let(words, lambda w: _let(kmers(w), lambda mers: _let(
        _let(labelled(mers), smallest), lambda s: tuples(mers, s))))


def as_text(entries: Column) -> Column:
    """A fingerprint as a string: 10 hex digits per entry."""
    return F.array_join(F.transform(entries, lambda e: F.lpad(F.lower(F.hex(e)), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries among the bins that either fingerprint fills."""
    def filled(x: Column) -> Column:
        return F.transform(x, lambda e: F.shiftright(e, 32))
    union = F.size(F.array_union(filled(a), filled(b)))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def with_next(docs: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add ``next_<column>``: the values of the next row by descending id
    (equal ids: by text; null ids last; after the last row comes the first).

    Ids are cut into ranges at approximate quantiles, the rows of a range are
    ordered in one window, and the first row of each range (at most
    ``MAX_RANGES`` rows, found by their broadcast ids) also stands behind the
    rows of the range before it."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    n = min(MAX_RANGES, max(size // RANGE_BYTES + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # ascending ranges, nulls behind all: turned round, but for the nulls
    place, ranges = range_of(docs, id_col, n)
    place = F.when(F.col(id_col).isNull(), ranges).otherwise(ranges - place)
    rows = docs.withColumn("__range", place.cast("int"))
    # at most one row per range from here on
    first = rows.groupBy("__range").agg(F.max(id_col).alias("__first"))
    ring = Window.orderBy("__range")
    to = first.select(
        "__first", "__range", F.coalesce(F.lag("__range").over(ring), F.max("__range").over(Window.partitionBy())).alias("__to"))
    extra = rows.join(F.broadcast(to), (rows["__range"] == to["__range"]) & rows[id_col].eqNullSafe(to["__first"])).select(
        *docs.columns, F.col("__to").alias("__range"), F.lit(True).alias("__extra"))
    both = rows.withColumn("__extra", F.lit(False)).unionByName(extra)
    order = Window.partitionBy("__range").orderBy("__extra", F.col(id_col).desc_nulls_last(), text_col)
    return (both.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
            .where(~F.col("__extra")).drop("__range", "__extra"))


def compare_edits(docs: DataFrame, k: int = K, ell: int = ELL, bins: int = BINS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text (the last half of its code
    points replaced by the first of the next document, see ``with_next``).

    Returns id, text, edited, entries, edited_entries, next_entries."""
    base = docs.select(id_col, F.coalesce(text_col, F.lit("")).alias("text"))
    base = base.withColumn("entries", fingerprint(F.col("text"), k, ell, bins))
    both = with_next(base, ["text", "entries"], id_col, "text")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    return (both.select(id_col, "text", "entries", F.col("next_entries"), edited.alias("edited"))
            .withColumn("edited_entries", fingerprint(F.col("edited"), k, ell, bins)))
