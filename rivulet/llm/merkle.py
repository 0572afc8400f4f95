"""Merkle manifest of a dataset: one hash tree per group, one tree of subroots.

Leaf coordinates come from bitmap ranks, not from sorting rows.  Ids of a group
are merged (``bit_or``, partial aggregates) into 64-bit words, and up to 64
words that are not empty form a container for 4096 ids: an occupancy word, the
words, and a directory of how many rows are before each word.  Containers are
summed up a directory of 8192-way nodes to the sign bit, and down again to how
many rows are before each container.  The rank of a row is three popcounts on
the container it is joined to.

Trees are reduced in keyed slot arrays: the 256 nodes of an aligned block go to
one row, each into its slot, and become the node of the block eight levels up;
rounds repeat until each group has one node.  Every round is written, and a
second way down gives each leaf its siblings: a block's levels yield the
siblings inside it, the block's own proof the rest.  All of it is DataFrame
functions; the driver only learns the size of the largest group.

``H`` is SHA-256 of the concatenated inputs as lowercase hex; nodes pair up, a
last node alone becomes the H of itself, and a tree of one leaf is that leaf.

Edge cases: rows with a null id come first in their group; rows of one group and
id (null ids among them) are ordered by leaf, by pieces of the leaf's range so
that none holds them all, and rows equal in everything take consecutive places;
null and empty texts have leaves like any other (null is ``-``, empty ``0:``);
texts of any length are hashed whole, once; a null group is a group, before all
others; other columns are not read, so none clashes; an empty table gives an
empty manifest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm._order import range_of
from rivulet.llm._store import store

BLOCK = 8               # levels of a block: 2**8 slots
FAN = 13                # bits of a directory level
PIECE = 200_000         # rows of one id that are ordered together, about
COPIES = 100_000        # equal rows that are written together


def _right(c: Column, bits) -> Column:
    return F.call_function("shiftright", c, F.lit(bits) if isinstance(bits, int) else bits)


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))


def _below(i: Column) -> Column:
    """A mask of the bits under bit ``i`` (0..63)."""
    return F.when(i == 63, F.lit(2**63 - 1)).otherwise(_bit(F.least(i, F.lit(62))) - 1)


def field(c: Column) -> Column:
    """A value for hashing: ``-``, or its UTF-8 length, ``:`` and the value."""
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*columns: Column) -> Column:
    """H of the fields of ``columns``, in order."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def bitmaps(rows: DataFrame) -> DataFrame:
    """(g, k, n, occ, words, before, extra): the containers of rows (g, id).

    ``k``: id >> 12.  ``before``: rows before each word; ``extra``: per word,
    the bits of ids that occur more than once, with how often more."""
    ids = rows.groupBy("g", "id").agg(F.count("*").alias("c"))
    bit = F.col("id").bitwiseAND(63)
    words = ids.groupBy("g", _right(F.col("id"), 6).alias("w")).agg(
        F.bit_or(_bit(bit)).alias("word"), F.sum("c").alias("n"),
        F.collect_list(F.when(F.col("c") > 1, F.struct(bit.alias("bit"), (F.col("c") - 1).alias("more")))).alias("extra"))
    slot = F.col("w").bitwiseAND(63)
    packed = words.groupBy("g", _right(F.col("w"), 6).alias("k")).agg(
        F.sum("n").alias("n"), F.bit_or(_bit(slot)).alias("occ"),
        F.sort_array(F.collect_list(F.struct(slot.alias("slot"), "word", "n", "extra"))).alias("e"))
    before = F.aggregate("e", F.array(F.lit(0).cast("long")),
                         lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x["n"])))
    return packed.select("g", "k", "n", "occ", F.col("e.word").alias("words"), before.alias("before"), F.col("e.extra").alias("extra"))


def directory(containers: DataFrame, groups: DataFrame) -> DataFrame:
    """(g, k, base): rows before each container in its group, null ids (the
    ``nulls`` of ``groups``) included."""
    levels = [containers.select("g", "k", "n")]
    for _ in range(4):      # 52 bits of k, 13 at a time
        levels.append(levels[-1].groupBy("g", _right(F.col("k"), FAN).alias("k")).agg(F.sum("n").alias("n")))
    before = lambda *part: F.coalesce(F.sum("n").over(Window.partitionBy(*part).orderBy("k").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    base = levels.pop().withColumn("base", before("g")).join(groups.select("g", "nulls"), "g").select(
        "g", "k", (F.col("base") + F.col("nulls")).alias("base"))
    while levels:
        up = base.withColumnsRenamed({"k": "up", "base": "above"})
        own = levels.pop().withColumn("up", _right(F.col("k"), FAN))
        own = own.withColumn("base", before("g", "up")).drop("n")
        base = own.join(up, ["g", "up"]).select("g", "k", (F.col("base") + F.col("above")).alias("base"))
    return base


def ranks(rows: DataFrame, containers: DataFrame) -> DataFrame:
    """``rows`` with ``position`` (rows before the first one of its id) and
    ``tied`` (whether others have its id)."""
    i = F.col("id")
    at = F.bit_count(F.col("occ").bitwiseAND(_below(_right(i, 6).bitwiseAND(63)))).cast("int")
    bit = i.bitwiseAND(63)
    met = rows.withColumn("k", _right(i, 12)).join(containers, ["g", "k"])
    extra = F.get("extra", at)
    more = F.aggregate(extra, F.lit(0).cast("long"), lambda a, x: a + F.when(x["bit"] < bit, x["more"]).otherwise(0))
    rank = F.col("base") + F.get("before", at) + F.bit_count(F.get("words", at).bitwiseAND(_below(bit))) + more
    return met.select(*rows.columns, rank.alias("position"), F.exists(extra, lambda x: x["bit"] == bit).alias("tied"))


def spread_ties(tied: DataFrame) -> DataFrame:
    """Rows (g, id, hash, position, ...) of equal (g, id), each moved to its own
    place: by hash, equal rows one after the other."""
    rest = [c for c in tied.columns if c not in ("g", "id", "hash", "position")]
    sets = store(tied.groupBy("g", "id", "hash").agg(F.count("*").alias("m"), *[F.first(c).alias(c) for c in ("position", *rest)]), "ties")
    sets = sets.withColumn("__v", F.conv(F.substring("hash", 1, 15), 16, 10).cast("long"))
    part, _ = range_of(sets, "__v", sets.count() // PIECE + 1)
    sets = sets.withColumn("__part", part)
    pieces = sets.groupBy("g", "id", "__part").agg(F.sum("m").alias("m"))
    earlier = lambda *p, order: F.coalesce(F.sum("m").over(Window.partitionBy(*p).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.select(F.col("g").alias("__g"), F.col("id").alias("__id"), F.col("__part").alias("__p"),
                           earlier("g", "id", order="__part").alias("__before"))
    own = sets.withColumn("__own", earlier("g", "id", "__part", order="hash")).join(
        pieces, (F.col("g") == F.col("__g")) & F.col("id").eqNullSafe(F.col("__id")) & (F.col("__part") == F.col("__p")))
    own = own.withColumn("position", F.col("position") + F.col("__before") + F.col("__own"))
    lots = own.withColumn("__lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / COPIES))))
    lots = lots.repartition("hash", "__lot").withColumn("__copy", F.explode(F.sequence(
        F.col("__lot") * COPIES, F.least(F.col("m"), (F.col("__lot") + 1) * COPIES) - 1)))
    return lots.select("g", "id", "hash", (F.col("position") + F.col("__copy")).alias("position"), *rest)


def place(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (g, id, hash, ...) with their ``position`` in their group."""
    known = rows.where("id is not null")
    containers = bitmaps(known)
    containers = store(containers, "bitmaps")
    base = directory(containers, groups)
    index = store(containers.drop("n").join(base, ["g", "k"]), "ranks")
    ranked = ranks(known, index)
    ties = containers.where(F.exists("extra", lambda x: F.size(x) > 0)).limit(1).count() > 0
    if not ties and groups.agg(F.sum("nulls")).first()[0] in (None, 0):
        return ranked.drop("tied")
    without = rows.where("id is null").withColumn("position", F.lit(0).cast("long"))
    alone = ranked.where("not tied").drop("tied")
    return alone.unionByName(spread_ties(ranked.where("tied").drop("tied").unionByName(without)))


def _next(hashes: Column) -> Column:
    """One level up: every two consecutive ones, or a last one, become their H."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / 2).cast("int")), lambda i: F.sha2(
        F.concat(F.get(hashes, 2 * i), F.coalesce(F.get(hashes, 2 * i + 1), F.lit(""))), 256))


def _height(m: Column) -> Column:
    """Levels above ``m`` nodes: the bits of m - 1."""
    return F.when(m > 1, F.length(F.bin(m - 1))).otherwise(0)


def _levels() -> Column:
    """All levels of a block, its own nodes first."""
    n = F.least(F.lit(BLOCK), _height(F.col("m")))
    first = F.array(F.col("e.hash"))
    return F.when(n == 0, first).otherwise(F.aggregate(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))), first, lambda a, _: F.concat(a, F.array(_next(F.element_at(a, -1))))))


def climb(nodes: DataFrame, totals: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Reduce every group of nodes (g, position, hash, ...) to one.

    ``totals``: (g, n).  Returns the written rounds -- rows (g, block, m, e), a
    block each, of whose group ``m`` nodes take part -- and (g, hash)."""
    rounds = []
    most = totals.agg(F.max("n")).first()[0] or 0
    carried = [c for c in nodes.columns if c not in ("g", "position", "hash")]
    sizes = totals.select("g", F.col("n").alias("m"))
    while True:
        entry = F.struct(F.col("position").bitwiseAND((1 << BLOCK) - 1).alias("slot"), "hash", *carried)
        blocks = nodes.groupBy("g", _right(F.col("position"), BLOCK).alias("block")).agg(
            F.sort_array(F.collect_list(entry)).alias("e")).join(sizes, "g")
        rounds.append(store(blocks.select("g", "block", "m", "e"), "blocks"))
        nodes = rounds[-1].select("g", F.col("block").alias("position"), F.get(F.element_at(_levels(), -1), F.lit(0)).alias("hash"))
        if most <= 1 << BLOCK:
            return rounds, nodes.drop("position")
        most = -(-most >> BLOCK)
        sizes = sizes.select("g", F.ceil(F.col("m") / (1 << BLOCK)).cast("long").alias("m"))
        carried = []


def descend(rounds: list[DataFrame], known: DataFrame) -> DataFrame:
    """Every node of the first round with its ``proof``: the sibling at each
    level, null where there is none.  ``known``: columns per ``g`` to add."""
    known_cols = [c for c in known.columns if c != "g"]
    proofs = None
    for r in range(len(rounds) - 1, -1, -1):
        blocks = rounds[r]
        if proofs is None:
            blocks = blocks.withColumn("above", F.array().cast("array<string>"))
        else:
            blocks = blocks.join(proofs.withColumnsRenamed({"position": "block", "proof": "above"}), ["g", "block"])
        if r == 0:
            blocks = blocks.join(known, "g")
        keep = known_cols if r == 0 else []
        rows = blocks.select("g", "block", _levels().alias("levels"), "above", *keep, F.explode("e").alias("n"))
        height = F.size("levels") - 1
        slot = F.col("n.slot")
        own = F.when(height == 0, F.array().cast("array<string>")).otherwise(F.transform(
            F.sequence(F.lit(0), F.greatest(height - 1, F.lit(0))),
            lambda i: F.get(F.get("levels", i), _right(slot, i).bitwiseXOR(F.lit(1)).cast("int"))))
        proofs = rows.select("g", (F.col("block") * (1 << BLOCK) + slot).alias("position"), *keep, *(
            [F.col("n").alias("node")] if r == 0 else []), F.concat(own, "above").alias("proof"))
    return proofs


def fold(start: Column, position: Column, proof: Column) -> Column:
    """What a leaf's digest and its siblings add up to."""
    steps = F.transform(proof, lambda s, i: F.struct(s.alias("s"), _right(position, i).bitwiseAND(F.lit(1)).alias("odd")))
    return F.aggregate(steps, start, lambda a, x: F.sha2(
        F.when(x["s"].isNull(), a).when(x["odd"] == 0, F.concat(a, x["s"])).otherwise(F.concat(x["s"], a)), 256))


def _numbered(groups: DataFrame) -> DataFrame:
    """``groups`` with ``i``: their place by ``g``, bytewise, counted by sorted
    partition and then within it."""
    apart = store(groups.orderBy("g").withColumn("__m", F.monotonically_increasing_id()), "groups")
    own = apart.withColumn("__p", _right(F.col("__m"), 33))
    counts = own.groupBy("__p").agg(F.count("*").alias("__n"))      # one row per partition
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    inside = F.col("__m").bitwiseAND((1 << 33) - 1)
    return own.join(counts, "__p").withColumn("i", F.col("__before") + inside).drop("__p", "__m", "__before")


def manifest(docs: DataFrame, leaf: Column, id_col: str = "doc_id", group_col: str = "lang", **carry: Column) -> DataFrame:
    """Every row of ``docs``: id, group, leaf, position, proof (siblings up to
    the subroot), subroot, group_position, group_proof (on to the root), root,
    and the columns ``carry`` (made from the row; keep them short)."""
    g = F.coalesce(F.concat(F.lit("v"), F.col(group_col).cast("string")), F.lit(""))     # null sorts first
    rows = store(docs.select(g.alias("g"), F.col(id_col).cast("long").alias("id"), leaf.alias("hash"),
                             F.struct(*[c.alias(n) for n, c in carry.items()], F.lit(0).alias("__")).alias("carry")), "leaves")
    groups = rows.groupBy("g").agg(F.count("*").alias("n"), F.count_if(F.col("id").isNull()).alias("nulls"))
    groups = store(_numbered(groups), "groups")
    rounds, subroots = climb(place(rows, groups), groups.select("g", "n"))
    subroots = store(subroots, "subroots")
    tops = groups.join(subroots, "g").select(F.lit("").alias("g"), F.col("i").alias("position"), "hash", F.col("g").alias("name"))
    top_rounds, root = climb(tops, groups.groupBy(F.lit("").alias("g")).agg(F.count("*").alias("n")))
    top = descend(top_rounds, root.select("g", F.col("hash").alias("root")))
    known = store(top.select(F.col("node.name").alias("g"), F.col("node.hash").alias("subroot"), F.col("position").alias("group_position"),
                             F.col("proof").alias("group_proof"), "root"), "tops")
    out = descend(rounds, known)
    return out.select(
        F.col("node.id").alias(id_col), F.when(F.col("g") != "", F.expr("substring(g, 2)")).alias(group_col),
        F.col("node.hash").alias("leaf"), "position", "proof", "subroot", "group_position", "group_proof", "root",
        *[F.col(f"node.carry.{n}").alias(n) for n in carry])


def recompute_root(start: Column) -> Column:
    """The root that a row's digest gives with the proofs of a manifest's row."""
    return fold(fold(start, F.col("position"), F.col("proof")), F.col("group_position"), F.col("group_proof"))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def audit(docs: DataFrame, tampered: Column) -> DataFrame:
    """The manifest of ``docs``, and what its proofs say of a copy in which
    ``n_chars`` of the rows ``tampered`` has grown by 1."""
    whole = [F.col(c) for c in FIELDS]
    other = [F.when(tampered, F.try_add(F.col(c), F.lit(1))).otherwise(F.col(c)) if c == "n_chars" else F.col(c) for c in FIELDS]
    m = manifest(docs, digest(*whole), seen=F.when(tampered, digest(*other)))
    m = m.withColumn("folded_root", recompute_root(F.coalesce("seen", "leaf")))
    return m.withColumn("verified", F.col("folded_root") == F.col("root")).drop("seen")


def proof_digest() -> Column:
    """H of a manifest row's siblings, level by level."""
    return F.sha2(F.array_join(F.concat("proof", "group_proof"), ""), 256)
