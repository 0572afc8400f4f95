"""Near-duplicate detection with fast similarity sketches.

Sketch: rounds of hashed bin placement.  In round i every shingle of a text
falls into one of T bins; a bin keeps the value (i, hash) of the first round
that reaches it, the smallest hash first; from round T on, round i fills bin
i - T.  Every coordinate is filled after 2T rounds, most texts stop after a
few, and the share of equal coordinates has the concentration of T
independent ones.

Banding: 25 bands of 5 coordinates.  Two texts at the threshold 0.85 share no
band with probability 4e-7, less above it.  A band value that several sets
share links each to the smallest of them (a star, never all pairs); the
connected stars are families of candidates.

Exact verification on full sets, family by family.  A family of at most
``SMALL`` sets with ``SMALL_ITEMS`` shingles is compared in one task.  A larger
family is never gathered: every member is compared with one centre (the set
with the most copies), and members that link to it are one component.  Only
the members that do not link to the centre can still add a link; they are the
query set, compared with all members in blocks, each pair of blocks a unit of
bounded size.  Within a unit, a set is compared with all others outside its
component at once.  So no link between candidates is lost, whatever the size
of a family, and no pair of sets ever becomes a row unless it is a link that
joins two components.  Texts with equal sets are one node from the start.

Words are runs of non-blank characters, A-Z folded; a set holds the distinct
shingles of 5 words, or the whole text if it has fewer.  Shingles and sets
are identified by 64-bit hashes.

Edge cases: null, empty and blank texts have an empty set and link with
nothing; repeated rows are copies of each other; rows that repeat an id are
judged by their own text; rows with a null id count, and link others, but give
no component_id; a very long text is one document of one task (about 40 bytes a
byte while its set is made); empty tables give empty results; other columns are
not read, and ``keep_one`` keeps them whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm._store import components, store, unused
from rivulet.llm._text import U64, Words, chunks, combine, lists, mix, separators, windows

SHINGLE = 5
BANDS, ROWS = 25, 5
SMALL, SMALL_ITEMS = 1000, 4_000_000
#: link when 100 * intersection >= THRESHOLD * union
THRESHOLD = 85


def shingle_sets(texts: pa.Array):
    """Per chunk: first row, last row + 1, the sorted distinct shingles of its
    documents, and their offsets."""
    sep = separators("space")
    for a, b, data, off in chunks(texts):
        w = Words(data, off, sep, fold=True)
        at = w.fits(SHINGLE)
        full = mix(windows(w.hash, SHINGLE)[at], SHINGLE)
        few = np.flatnonzero((w.count > 0) & (w.count < SHINGLE))
        short = np.empty(len(few), U64)
        for size in range(1, SHINGLE):
            mine = w.count[few] == size
            short[mine] = mix(windows(w.hash, size)[w.first[few[mine]]], -size)
        doc = np.concatenate([w.doc[at], few])
        value = np.concatenate([full, short])
        order = np.argsort(value)
        doc, value = doc[order], value[order]
        order = np.argsort(doc.astype(np.uint16) if b - a < 1 << 16 else doc, kind="stable")
        doc, value = doc[order], value[order]
        new = np.ones(len(doc), bool)
        new[1:] = (np.diff(doc) != 0) | (value[1:] != value[:-1])
        doc, value = doc[new], value[new]
        yield a, b, value, np.searchsorted(doc, np.arange(b - a + 1))


def set_ids(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit id per set: the mixed sum of its mixed shingles."""
    total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(value, 3), dtype=U64)])
    size = np.diff(first).astype(U64)
    return mix(total[first[1:]] - total[first[:-1]] + size * U64(0x9E3779B97F4A7C15), 4).view(np.int64)


def sketches(value: np.ndarray, first: np.ndarray, bins: int) -> np.ndarray:
    """Fast similarity sketch of each non-empty set, one row of ``bins``."""
    n = len(first) - 1
    unset = U64(2**64 - 1)
    out = np.full((n, bins), unset)
    flat = out.reshape(-1)
    doc = np.repeat(np.arange(n), np.diff(first))
    live = np.flatnonzero(np.diff(first))
    x = value
    for i in range(2 * bins):
        if not len(x):
            break
        h = mix(x, 1000 + i)
        if i < bins:
            where = (((h & U64(0xFFFFFFFF)) * U64(bins)) >> U64(32)).astype(np.int64)
        else:
            where = i - bins
        np.minimum.at(flat, doc * bins + where, (h >> U64(9)) | U64(i << 55))
        open_ = (out[live] == unset).any(axis=1)
        if not open_.all():
            live = live[open_]
            still = np.zeros(n, bool)
            still[live] = True
            keep = still[doc]
            x, doc = x[keep], doc[keep]
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band: the band's number is part of the hash."""
    of_band = mix(sketch, 5).reshape(len(sketch), bands, rows)
    part = of_band[:, :, 0]
    for i in range(1, rows):
        part = combine(part, of_band[:, :, i])
    return mix(part + np.arange(bands, dtype=U64) * U64(0xD6E8FEB86659FD93), 6).view(np.int64)


def sketch_table(docs: DataFrame, bands: int = BANDS, rows: int = ROWS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, n_shingles, set_id, bands): one scan, no shuffle.  An
    empty set has no bands; text_key is a hash of the text as it is."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches):
        for batch in batches:
            size, sid, keys = [], [], []
            for _, _, value, first in shingle_sets(batch.column(2)):
                n = np.diff(first)
                size.append(n)
                sid.append(set_ids(value, first))
                keys.append(band_keys(sketches(value, first, bands * rows)[n > 0], bands, rows).reshape(-1))
            size = np.concatenate(size) if size else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(size, pa.int64()),
                pa.array(np.concatenate(sid) if sid else [], pa.int64()),
                lists(pa.array(np.concatenate(keys) if keys else [], pa.int64()), np.where(size > 0, bands, 0)),
            ], names=["id", "text_key", "n_shingles", "set_id", "bands"])

    return docs.select(id_col, F.xxhash64(text_col), text_col).mapInArrow(
        run, f"id {kind}, text_key long, n_shingles long, set_id long, bands array<long>")


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(set_id, family, items): the full set of one document per wanted set,
    as sorted 64-bit values in a binary column."""
    # the wanted ids grow with the input: both sides are shuffled at any size
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    columns = ["set_id", "family", "text"]
    joined = docs.join(wanted.where("id is not null").hint("merge"), "id").select(columns)
    # sets that only rows without an id hold: by text, of which one copy is enough
    texts = docs.where("id is null").select(F.xxhash64("text").alias("text_key"), "text").dropDuplicates(["text_key"])
    joined = joined.unionByName(texts.join(wanted.where("id is null").hint("merge"), "text_key").select(columns))

    def run(batches):
        for batch in batches:
            sid, items = [], []
            for _, _, value, first in shingle_sets(batch.column("text")):
                sid.append(set_ids(value, first))
                items += [value[i:j].tobytes() for i, j in zip(first[:-1], first[1:])]
            if not sid:
                continue
            got = pa.array(np.concatenate(sid), pa.int64())
            out = pa.RecordBatch.from_arrays(
                [got, batch.column("family"), pa.array(items, pa.binary())], names=["set_id", "family", "items"])
            # an id that repeats with another text brings that text along
            yield out.filter(pa.array(got.to_numpy() == batch.column("set_id").to_numpy()))

    return (joined.select("set_id", "family", "text")
            .mapInArrow(run, "set_id long, family long, items binary"))


def _compare(pairs: DataFrame, threshold: int) -> DataFrame:
    """(set_id, family, c, linked): each member against the centre."""
    def run(batches):
        for batch in batches:
            linked = []
            for x, c in zip(batch.column("items"), batch.column("centre")):
                x, c = np.frombuffer(x.as_buffer(), U64), np.frombuffer(c.as_buffer(), U64)
                at = np.searchsorted(c, x)
                at[at == len(c)] = 0
                both = int((c[at] == x).sum())
                linked.append(100 * both >= threshold * (len(x) + len(c) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("set_id"), batch.column("family"), batch.column("c"), pa.array(linked, pa.bool_())],
                names=["set_id", "family", "c", "linked"])

    return pairs.select("set_id", "family", "c", "items", "centre").mapInArrow(
        run, "set_id long, family long, c long, linked boolean")


def _links_of_unit(sid: np.ndarray, items: list[np.ndarray], query: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links (a, b) that connect the components of a unit: the query sets,
    which come first, against all later sets."""
    first = np.concatenate([[0], np.cumsum([len(x) for x in items])])
    size = np.diff(first)
    _, flat = np.unique(np.concatenate(items), return_inverse=True)
    flat = flat.reshape(-1)
    root = np.arange(len(sid))
    has = np.zeros(int(flat.max()) + 1, bool)
    links = []
    for i in range(min(int(query.sum()), len(sid) - 1)):
        if (root[i + 1:] == root[i]).all():
            continue
        own = flat[first[i]: first[i + 1]]
        has[own] = True
        both = np.add.reduceat(has[flat[first[i + 1]:]].astype(np.int64), first[i + 1: -1] - first[i + 1])
        has[own] = False
        for j in np.flatnonzero(100 * both >= threshold * (size[i] + size[i + 1:] - both)) + i + 1:
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                if sid[i] != sid[j]:
                    links.append((int(sid[i]), int(sid[j])))
    return links


def _unit_links(members: DataFrame, threshold: int) -> DataFrame:
    """(a, b) links within units of work.  ``members``: unit, query (is it of
    the query set), set_id, items; the rows of a unit meet in one task and
    are taken from the stream unit by unit."""
    def run(batches):
        held = None
        out: list = []

        def settle(t: pa.Table) -> None:
            unit, sid = t["unit"].to_numpy(), t["set_id"].to_numpy()
            query = t["query"].to_numpy()
            items = [np.frombuffer(x.as_buffer(), U64) for x in t["items"]]
            cut = np.flatnonzero(np.diff(unit)) + 1
            for i, j in zip([0, *cut], [*cut, len(unit)]):
                if j - i > 1:
                    out.extend(_links_of_unit(sid[i:j], items[i:j], query[i:j], threshold))

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            if not len(t):
                continue
            unit = t["unit"].to_numpy()
            last = int(np.searchsorted(unit, unit[-1]))
            if last:
                settle(t.slice(0, last))
            held = t.slice(last)
        if held is not None:
            settle(held)
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return (members.select("unit", F.col("query").cast("int").alias("query"), "set_id", "items")
            .repartition("unit").sortWithinPartitions("unit", F.col("query").desc())
            .mapInArrow(run, "a long, b long"))


def _large_links(members: DataFrame, sizes: DataFrame, threshold: int, small: int) -> DataFrame:
    """(a, b) links of families that fit no task: star, then the rest of the
    star against all members in blocks."""
    centre = members.groupBy("family").agg(F.max(F.struct("copies", "set_id")).alias("best")).select(
        "family", F.col("best.set_id").alias("c"))
    # a set may have come with several rows of one repeated id
    centre = members.select(F.col("set_id").alias("c"), F.col("items").alias("centre")).join(
        centre, "c").dropDuplicates(["family"])
    star = store(_compare(members.join(centre, "family").where("set_id <> c"), threshold), "compared")
    rest = star.where("not linked").select("family", "set_id")
    blocks = sizes.join(rest.groupBy("family").agg(F.count("*").alias("rest")), "family").select(
        # blocks of the query set and of all members, half a unit's items each
        "family", *[F.greatest(F.ceil(F.col(n) / small), F.ceil(F.col(n) / F.col("n") * F.col("total") * 2 / SMALL_ITEMS))
                    .cast("int").alias(b) for n, b in (("rest", "rows"), ("n", "columns"))])

    def dealt(rows: DataFrame, own: str, other: str, query: bool) -> DataFrame:
        spread = rows.join(blocks, "family").withColumn("own", F.pmod(F.xxhash64("set_id"), F.col(own)).cast("int"))
        spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        pair = ("own", "other") if query else ("other", "own")
        return spread.select(F.xxhash64("family", *pair).alias("unit"), F.lit(query).alias("query"), "set_id", "items")

    units = dealt(members.join(rest, ["family", "set_id"]), "rows", "columns", True).unionByName(
        dealt(members, "columns", "rows", False))
    return star.where("linked").select(F.col("set_id").alias("a"), F.col("c").alias("b")).unionByName(
        _unit_links(units, threshold))


def link_sets(docs: DataFrame, sketched: DataFrame, threshold: int = THRESHOLD, small: int = SMALL,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, root) of every set that links to another one."""
    banded = sketched.select("set_id", F.posexplode("bands").alias("band", "key"))
    bucket = (banded.groupBy("band", "key").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high"))
              .where("low <> high").select("band", "key", "low"))
    stars = (banded.join(bucket, ["band", "key"]).where("set_id <> low")
             .select(F.col("set_id").alias("a"), F.col("low").alias("b")))
    family = components(stars)
    # one document of each set brings its text
    wanted = store(
        sketched.where("n_shingles > 0").groupBy("set_id").agg(
            F.min("id").alias("id"), F.min(F.when(F.col("id").isNull(), F.col("text_key"))).alias("text_key"), F.count("*").alias("copies"))
        .join(family.select(F.col("node").alias("set_id"), F.col("root").alias("family")), "set_id"), "wanted")
    members = _full_sets(docs, wanted.select("id", "text_key", "set_id", "family"), id_col, text_col)
    members = store(members.join(wanted.select("set_id", "copies"), "set_id"), "sets")
    sizes = members.groupBy("family").agg(F.count("*").alias("n"), F.sum(F.octet_length("items") / 8).alias("total"))
    large = store(sizes.where((F.col("n") > small) | (F.col("total") > SMALL_ITEMS)), "large")
    whole = members.join(large.select("family"), "family", "left_anti").select(
        F.col("family").alias("unit"), F.lit(True).alias("query"), "set_id", "items")
    links = _unit_links(whole, threshold)
    if not large.isEmpty():
        links = links.unionByName(_large_links(
            store(members.join(large.select("family"), "family", "left_semi"), "members"), large, threshold, small))
    return components(links)


def _labelled(docs: DataFrame, bands: int, rows: int, threshold: int, small: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, n_shingles, class) of every row."""
    sketched = store(sketch_table(docs, bands, rows, id_col, text_col), "sketches")
    root = link_sets(docs, sketched, threshold, small, id_col, text_col)
    labelled = sketched.select("id", "text_key", "n_shingles", "set_id").join(
        root.select(F.col("node").alias("set_id"), "root"), "set_id", "left").select(
        "id", "text_key", "n_shingles", F.coalesce("root", "set_id").alias("class"))
    return store(labelled, "labelled")


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, threshold: int = THRESHOLD,
                    small: int = SMALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_shingles, component_id (smallest id reachable over
    links, itself included), kept (is it that document)."""
    labelled = _labelled(docs, bands, rows, threshold, small, id_col, text_col)
    # an empty set is a class of its own for each document
    least = (labelled.where("n_shingles > 0").groupBy("class").agg(F.min("id").alias("least"), F.count("*").alias("n"))
             .where("n > 1").select("class", "least"))
    out = labelled.join(least, "class", "left")
    single = F.col("least").isNull() | (F.col("n_shingles") == 0)
    return out.select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(single, F.col("id")).otherwise(F.col("least")).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, threshold: int = THRESHOLD,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each component: that
    of the smallest id (nulls last), then of the smallest hash of the text.
    Rows without a word all stay, but for those of equal id and text."""
    labelled = _labelled(docs, bands, rows, threshold, SMALL, id_col, text_col)
    best = F.min(F.struct(F.col("id").isNull().alias("null"), "id", "text_key"))
    kept = labelled.where("n_shingles > 0").groupBy("class").agg(best.alias("best")).select("best.id", "best.text_key")
    kept = kept.unionByName(labelled.where("n_shingles = 0 and id is not null").select("id", "text_key"))

    def row_key(id_: Column, text_key: Column) -> Column:
        # concat_ws leaves a null id out; one column, so the join and the window share a shuffle
        return F.concat_ws(":", text_key.cast("string"), id_.cast("string"))

    own, other, nth = unused(docs, "__key", "__kept", "__nth")      # docs may have columns of any name
    kept = kept.select(row_key(F.col("id"), F.col("text_key")).alias(other)).distinct()
    rest = docs.withColumn(own, row_key(F.col(id_col), F.xxhash64(text_col)))
    rest = rest.join(kept, F.col(own) == F.col(other), "left_semi")
    same = Window.partitionBy(own).orderBy(own)
    rest = rest.withColumn(nth, F.row_number().over(same)).where(F.col(nth) == 1).select(*docs.columns)
    blank = F.coalesce(F.trim(F.translate(text_col, "\t\n\x0b\x0c\r", "     ")), F.lit("")) == ""
    return rest.unionByName(docs.where(F.col(id_col).isNull() & blank))
