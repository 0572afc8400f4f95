"""Prefix trie of conversations, built as z-fast tries in batches.

A node stands for a distinct sequence of first turns; conversations that begin
with it are its members.  Turns are hashed once, with their depth, and running
sums of those hashes (88 bits a turn, never reduced, so the sums of different
sequences agree with probability under 2**-80) name every prefix; the texts
stay behind.

Each task takes its conversations in batches and inserts them into a z-fast
trie: compacted edges, each found in a hash table by the name of the prefix at
its handle, the two-fattest depth of the edge.  A conversation's exit node is
located by fat binary search over its own depths -- a probe per bit of its
length instead of one per turn -- then the edge is cut or gets a leaf.  A batch
ends with its edges expanded to (depth, name, parent, members, smallest
member), and equal nodes of all batches meet in one aggregate.  Very long
conversations come in segments of ``SEGMENT`` turns, each a string of its own
below the prefix before it, so neither a conversation nor a popular prefix is
ever whole in one task.

The nodes whose smallest member is c form one run of c's depths.  Subtree sums
use that: a node's own values go to its smallest member, suffix sums over that
member's depths give what each of its prefixes gets, and one aggregate per node
adds them up -- no walk from level to level.

Edge cases: turns are in the order of (turn, nulls first; then the SHA-256 of
role and text, so ties and repeated rows have one order); a null role or text
is empty; rows without a conversation id belong to none; a conversation without
turns is a member of the root and ends there; texts of any length are hashed
whole in one scan; other columns are not read, so none clashes; without any
conversation there is no node, not even a root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm._order import number, range_of
from rivulet.llm._store import store
from rivulet.operators.scan import running

SEGMENT = 4096          # turns of one conversation in one row
BATCH = 1 << 18         # turns of a batch, about
PIECE = 200_000         # turns of one conversation that are numbered together, about
ENDS = 50_000           # ids of one list of ends, about
ROOT = "0"


def turns(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(c, k, hash, bytes): every turn of a conversation, numbered from 1, with
    the hash of its role and text and the UTF-8 length of the text.  Stored."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role_col, text_col))
    thin = store(chats.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("c"), F.col(turn_col).cast("long").alias("turn"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("hash"),
        F.octet_length(text).cast("long").alias("bytes")), "turns")
    order = [F.col("turn").asc_nulls_first(), F.col("hash")]
    longest = thin.groupBy("c").agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).first()
    if (longest[0] or 0) <= PIECE:
        own = thin.withColumn("k", F.row_number().over(Window.partitionBy("c").orderBy(*order)).cast("long"))
    else:
        part, _ = range_of(thin, "turn", longest[1] // PIECE + 1)
        own = number(thin, ["c"], F.when(F.col("turn").isNull(), -1).otherwise(part), order, "k").withColumn("k", F.col("k") + 1)
    return store(own.select("c", "k", "hash", "bytes"), "numbered")


def with_shared_openings(own: DataFrame, base: Column, opening: Column, longest: int) -> tuple[DataFrame, DataFrame]:
    """Rebuild conversations: the first ``opening`` turns (up to ``longest``)
    are those of conversation ``base`` (expressions of ``c``), then its own
    after as many.  Returns turns (c, depth, hash, bytes, last) and (c, depth)
    of all conversations with the number of their turns."""
    sizes = own.groupBy("c").agg(F.count("*").alias("n"))
    convs = sizes.withColumn("b", base).withColumn("h", opening)
    convs = store(convs.join(sizes.select(F.col("c").alias("b"), F.col("n").alias("nb")), "b", "left").select(
        "c", "b", "h", "n", F.least("h", F.coalesce("nb", F.lit(0))).alias("p")), "conversations")
    after = own.join(convs.select("c", "h", "n", "p"), "c").where(F.col("k") > F.col("h")).select(
        "c", (F.col("p") + F.col("k") - F.col("h")).alias("depth"), "hash", "bytes", (F.col("k") == F.col("n")).alias("last"))
    first = own.where(F.col("k") <= longest).withColumnRenamed("c", "b").join(convs, "b").where(F.col("k") <= F.col("h")).select(
        "c", F.col("k").alias("depth"), "hash", "bytes", ((F.col("k") == F.col("p")) & (F.col("n") <= F.col("h"))).alias("last"))
    return after.unionByName(first), convs.select("c", (F.col("p") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("depth"))


def named(rebuilt: DataFrame) -> DataFrame:
    """(c, depth, name, bytes, last): every prefix, by its name.  Stored."""
    h = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("hash")), 256)
    half = lambda at: F.conv(F.substring(h, at, 11), 16, 10).cast("decimal(14,0)")
    term = half(1) * F.lit(1 << 44).cast("decimal(14,0)") + half(12)
    sums = running(rebuilt.withColumn("__term", term.cast("decimal(38,0)")), ["c"], ["depth"], "__term", "sum", "__sum",
                   rows_per_chunk=PIECE)
    return store(sums.select("c", "depth", F.col("__sum").cast("string").alias("name"), "bytes", "last"), "prefixes")


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] that the highest power of two divides."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


class _Node:
    __slots__ = ("low", "high", "path", "up", "below", "n", "least")

    def __init__(self, low, high, path, up):
        self.low, self.high, self.path, self.up = low, high, path, up     # an edge: depths low + 1 .. high of path
        self.below = {}                   # name at depth high + 1 -> child
        self.n, self.least = 0, None      # strings that end here, and their smallest owner


class ZFastTrie:
    """Strings are (first depth, names): names[i] is the prefix of depth
    first + i, and names[0] the prefix that they hang from."""

    def __init__(self):
        self.handles, self.roots, self.nodes, self.size = {}, {}, [], 0

    def _name(self, node: _Node, depth: int) -> str:
        return node.path[1][depth - node.path[0]]

    def _hash(self, node: _Node):
        f = two_fattest(node.low, node.high)
        self.handles[f, self._name(node, f)] = node

    def _unhash(self, node: _Node):
        f = two_fattest(node.low, node.high)
        del self.handles[f, self._name(node, f)]

    def exit_node(self, root: _Node, path: tuple, end: int) -> _Node:
        """The edge that the string leaves the trie from, or ends in."""
        first, names = path
        a, b, node = root.high, end, root
        while a < b:                                  # fat binary search
            f = two_fattest(a, b)
            found = self.handles.get((f, names[f - first]))
            if found is None:
                b = f - 1
            else:
                a, node = found.high, found
        if node.high < end and (node is root or names[node.high - first] == self._name(node, node.high)):
            return node.below.get(names[node.high + 1 - first], node)
        return node

    def insert(self, first: int, names: list, owner: int):
        path, end = (first, names), first + len(names) - 1
        root = self.roots.get((first, names[0]))
        if root is None:
            root = self.roots[first, names[0]] = _Node(first, first, path, None)
        node = self.exit_node(root, path, end)
        lo, hi = max(node.low, first), min(node.high, end)
        while lo < hi:                                # how far it follows the edge
            mid = (lo + hi + 1) // 2
            if names[mid - first] == self._name(node, mid):
                lo = mid
            else:
                hi = mid - 1
        if lo < node.high:                            # cut the edge there
            self._unhash(node)
            upper = _Node(node.low, lo, node.path, node.up)
            node.up.below[self._name(node, node.low + 1)] = upper
            upper.below[self._name(node, lo + 1)] = node
            node.low, node.up = lo, upper
            self.nodes.append(upper)
            self._hash(upper)
            self._hash(node)
            node = upper
        if lo < end:                                  # a leaf for the rest
            leaf = _Node(lo, end, path, node)
            node.below[names[lo + 1 - first]] = leaf
            self.nodes.append(leaf)
            self._hash(leaf)
            node = leaf
        node.n += 1
        node.least = owner if node.least is None else min(node.least, owner)
        self.size += len(names)

    def expand(self):
        """Every depth of every edge: (depth, name, parent's name, strings
        through it, smallest owner)."""
        for node in sorted(self.nodes, key=lambda x: -x.high):
            up = node.up
            if up.up is not None or up.high > up.low:
                up.n += node.n
                up.least = node.least if up.least is None else min(up.least, node.least)
            first, names = node.path
            for d in range(node.low + 1, node.high + 1):
                yield d, names[d - first], names[d - 1 - first], node.n, node.least


NODES = pa.schema([("depth", pa.int64()), ("name", pa.string()), ("up", pa.string()), ("n", pa.int64()), ("c", pa.int64())])


def batch_tries(segments: DataFrame, size: int = BATCH) -> DataFrame:
    """(depth, name, up, n, c): the expanded nodes of each batch of segments
    (first, names, c)."""
    def rows(trie):
        part = []
        for row in trie.expand():
            part.append(row)
            if len(part) == 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*part), NODES)], schema=NODES)
                part = []
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*part), NODES)], schema=NODES)

    def run(batches):
        trie = ZFastTrie()
        for batch in batches:
            for first, names, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                trie.insert(first, names, c)
                if trie.size >= size:
                    yield from rows(trie)
                    trie = ZFastTrie()
        yield from rows(trie)

    return segments.select("first", "names", "c").mapInArrow(run, "depth long, name string, up string, n long, c long")


def segments_of(prefixes: DataFrame, length: int = SEGMENT) -> DataFrame:
    """(first, names, c): each conversation's names in rows of ``length``
    depths, with the name before them in front."""
    part = F.floor((F.col("depth") - 1) / length)
    ends = prefixes.where(F.col("depth") % length == 0)        # the name before the next segment
    pieces = prefixes.select("c", part.alias("s"), "depth", "name").unionByName(
        ends.select("c", (part + 1).alias("s"), "depth", "name"))
    rows = pieces.groupBy("c", "s").agg(F.sort_array(F.collect_list(F.struct("depth", "name"))).alias("e"))
    names = F.when(F.col("s") == 0, F.concat(F.array(F.lit(ROOT)), F.col("e.name"))).otherwise(F.col("e.name"))
    return rows.select((F.col("s") * length).cast("long").alias("first"), names.alias("names"), "c").where(F.size("names") > 1)


def end_lists(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, name, ends): SHA-256 of the ascending ids of the conversations
    that end at a node, joined by commas.  Lists are joined by pieces of the
    ids' range, and the pieces of a node that has several are hashed in a
    stream, so no list is whole in memory."""
    ends = prefixes.where("last").select("depth", "name", "c").unionByName(
        convs.where("depth = 0").select("depth", F.lit(ROOT).alias("name"), "c"))
    n = convs.count() // ENDS + 1
    part = range_of(convs, "c", n)[0] if n > 1 else F.lit(0)
    lists = ends.groupBy("depth", "name", part.alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("c")).cast("array<string>"), ",").alias("ids"))
    if n == 1:
        return lists.select("depth", "name", F.sha2("ids", 256).alias("ends"))

    def run(batches):
        at, h = None, None
        for batch in batches:
            out = []
            for depth, name, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (depth, name) != at:
                    if at is not None:
                        out.append((*at, h.hexdigest()))
                    at, h = (depth, name), hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield _ends(out)
        if at is not None:
            yield _ends([(*at, h.hexdigest())])

    return lists.repartition("depth", "name").sortWithinPartitions("depth", "name", "part").mapInArrow(
        run, "depth long, name string, ends string")


def _ends(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                                      names=["depth", "name", "ends"])


def trie(prefixes: DataFrame, convs: DataFrame, segment: int = SEGMENT, batch: int = BATCH) -> DataFrame:
    """Every node: name, conv_id (its smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    nodes = batch_tries(segments_of(prefixes, segment), batch).groupBy("depth", "name").agg(
        F.first("up").alias("up"), F.sum("n").alias("n"), F.min("c").alias("c"))
    nodes = store(nodes, "nodes")
    total = convs.agg(F.count("*").alias("n"), F.min("c").alias("c")).first()
    if not total["n"]:
        spark = prefixes.sparkSession
        return spark.createDataFrame([], "name string, conv_id long, depth long, parent_conv_id long, n_convs long, "
                                         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("up").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = store(nodes.join(children, ["depth", "name"], "left").select(
        "depth", "name", "up", "n", "c", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children")), "counted")
    # values of a node at its smallest member; twice the saving, plus one for a leaf (of which a member owns one at most)
    own = nodes.select("c", "depth", (2 * (F.col("n") - 1)).alias("twice"), (F.col("n_children") == 0).cast("long").alias("leaf"))
    valued = prefixes.join(own, ["c", "depth"], "left").withColumn(
        "__v", F.coalesce(F.col("twice") * F.col("bytes") + F.col("leaf"), F.lit(0)).cast("decimal(38,0)")).withColumn("__back", -F.col("depth"))
    got = running(valued, ["c"], ["__back"], "__v", "sum", "__s", rows_per_chunk=PIECE).where("__s > 0")
    odd = F.col("__s") % 2
    sums = store(got.groupBy("depth", "name").agg(
        F.sum(odd).cast("long").alias("n_leaves"), F.sum((F.col("__s") - odd) / 2).cast("long").alias("saved_tokens")), "sums")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("name").alias("up"), F.col("c").alias("parent_conv_id"))
    below = nodes.where("depth > 1").join(parents, ["depth", "up"]).unionByName(
        nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(total["c"])))
    whole = nodes.where("depth = 1").agg(F.count("*").alias("n_children")).crossJoin(       # one row each
        nodes.agg(F.count_if(F.col("n_children") == 0).alias("n_leaves"))).crossJoin(
        valued.agg(F.sum("__v").alias("v"))).first()
    root = prefixes.sparkSession.createDataFrame(
        [(0, ROOT, total["n"], total["c"], whole["n_children"], max(whole["n_leaves"], 1),
          int((whole["v"] or 0) - whole["n_leaves"]) // 2)],
        "depth long, name string, n long, c long, n_children long, n_leaves long, saved_tokens long").withColumn(
        "parent_conv_id", F.lit(None).cast("long"))
    out = below.drop("up").join(sums, ["depth", "name"], "left").unionByName(root).join(
        end_lists(prefixes, convs), ["depth", "name"], "left")
    return out.select("name", F.col("c").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
                      F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
                      F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(chats: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    own = turns(chats)
    rebuilt, convs = with_shared_openings(own, F.col("c"), F.lit(0), 0)
    return trie(named(rebuilt), convs)
