"""Quality rules with robust multivariate outliers.

One scan of the texts counts, per document: words, code points in words,
symbols, lines, lines equal to an earlier one, and words in 8-word windows that
occur twice or more.  Documents that fail the two base rules go.  The others
become vectors -- log words, log mean word length, and the square roots of the
shares of symbols, repeated lines and repeated words -- and a vector far from
the rest of its language and source is rejected.

"Far" is the Mahalanobis distance under the minimum covariance determinant: the
mean and covariance of the ``CORE`` share of rows whose covariance has the
smallest determinant, so up to a quarter of a group may be junk without moving
the estimate.  Three deterministic starts (scales from quartiles; correlation of
squashed values; spatial signs) are improved by concentration steps -- keep the
nearest ``CORE`` share under the present estimate, estimate again -- until no
sum changes, the best determinant wins, and one reweighting step over all rows
within the 97.5 % ellipsoid gives the final estimate.

A step is one pass over the thin table of vectors: rows meet the estimates of
their group, and counts and sums go by (group, start, bin of distance), with
partial aggregates, so a group of any size is spread over all tasks and the
nearest share is a cut between bins (6 % wide).  Vectors are whole numbers of
1/``UNIT``, so all sums are exact and reruns agree.  Estimates are 5 x 5 matrices, one
row per group and start; they never pass through the driver.

A (language, source) of fewer than ``LEAST`` rows is pooled with the other small
ones of its language, and a small language's with all others; when even that is
smaller, its rows are not judged (kept).  A variance below its floor counts as
the floor: most documents have no symbol at all.

Edge cases: null and empty texts have no words and fail the base rule; null
languages and sources are groups like any other; repeated rows, and rows with
equal or null ids, each count and each get a row; ties in distance share a bin
and so a verdict; texts of any length are counted whole (one document at a time
in memory, about 60 bytes a byte); other columns are not read, so none clashes;
empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm._store import store
from rivulet.llm._text import Words, byte_strings, chunks, combine, covered, per_doc, separators, windows, U64

SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30     # words; percent of words
UNIT = 1024
#: smallest standard deviation of each part of the vector
FLOORS = (0.1, 0.05, 0.05, 0.15, 0.15)
P = len(FLOORS)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
CORE, NEAR = 0.75, 0.975
REJECT = 1e-6           # share of a normal sample beyond the cut
LEAST = 50
STEPS = 12              # concentration steps at most; three to eight are usual
BINS = 16               # bins of distance per factor e


def chi2(x: float, k: int) -> float:
    """Distribution function of chi squared with k degrees of freedom."""
    if x <= 0:
        return 0.0
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-17:
        n += 1
        term *= x / (a + n)
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi2_quantile(q: float, k: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2(mid, k) < q else (lo, mid)
    return lo


def consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` of a normal sample has to
    be multiplied by."""
    return share / chi2(chi2_quantile(share, P), P + 2)


COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def count_texts(texts: pa.Array):
    """Per chunk: first row and the six counts of each of its documents."""
    blank = separators("space")
    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    for a, b, data, off in chunks(texts):
        w = Words(data, off, blank)
        # lines with a word: from the start of a text or the byte after \n on
        begin = np.unique(np.concatenate([off[:-1][np.diff(off) > 0], np.flatnonzero(data == 10) + 1]))
        begin = begin[begin < len(data)]
        of_doc = np.searchsorted(off, begin, "right") - 1
        new_line = np.append(np.flatnonzero(data == 10), len(data))
        end = np.minimum(new_line[np.searchsorted(new_line, begin)], off[of_doc + 1])
        told = np.searchsorted(w.starts, begin) < np.searchsorted(w.starts, end)
        begin, end, of_doc = begin[told], end[told], of_doc[told]
        line = combine(byte_strings(data, begin, end), of_doc.astype(U64))
        n_lines = np.bincount(of_doc, minlength=b - a)
        own = np.unique(line, return_index=True)[1]
        n_own = np.bincount(of_doc[own], minlength=b - a)
        # words of windows that occur twice or more in their document
        at = w.fits(WINDOW)
        key = combine(windows(w.hash, WINDOW)[at], w.doc[at].astype(U64))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        repeated = covered(at[twice], WINDOW, len(w.starts))
        letters = ~blank[data] & ((data & 0xC0) != 0x80)
        yield a, (w.count, per_doc(letters, off), per_doc(symbol[data], off), n_lines, n_lines - n_own,
                  per_doc(repeated, w.first))


def document_counts(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of every row with the six counts of its whole text."""
    schema = docs.select(*keep).schema
    for part in COUNTS.split(", "):
        schema = schema.add(*part.split(" "))

    def run(batches):
        for batch in batches:
            out = np.zeros((6, batch.num_rows), np.int64)
            for a, counts in count_texts(batch.column(0)):
                out[:, a: a + len(counts[0])] = counts
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *[pa.array(x) for x in out]], names=schema.names)

    return docs.select(F.col(text_col).alias("__text"), *keep).mapInArrow(run, schema)


def vector() -> list[Column]:
    """The transformed statistics, in whole numbers of 1/UNIT."""
    n = F.col("n_words")
    parts = [F.log(n), F.log(F.col("word_chars") / n), F.sqrt(F.col("n_symbols") / n),
             F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))), F.sqrt(F.col("n_repeat_words") / n)]
    return [F.round(x * UNIT).cast("long").alias(f"x{i}") for i, x in enumerate(parts)]


def _groups(rows: DataFrame, least: int) -> DataFrame:
    """(lang, source, g, judged): the group of each pair; a key of 32 characters."""
    key = lambda *c: F.md5(F.to_json(F.struct(*c), {"ignoreNullFields": "false"}))
    pairs = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = pairs.where(F.col("n") < least)
    pooled = small.groupBy(F.col("lang").alias("__lang")).agg(F.sum("n").alias("m"))
    rest = pooled.where(F.col("m") < least).agg(F.coalesce(F.sum("m"), F.lit(0)).alias("r"))
    small = small.join(pooled, F.col("lang").eqNullSafe(F.col("__lang"))).crossJoin(rest)   # one row
    return pairs.where(F.col("n") >= least).select(
        "lang", "source", key(F.lit("pair").alias("kind"), "lang", "source").alias("g"), F.lit(True).alias("judged")).union(
        small.select("lang", "source", F.when(F.col("m") >= least, key(F.lit("lang").alias("kind"), "lang"))
                     .otherwise(F.md5(F.lit("rest"))).alias("g"),
                     (F.col("m") >= least) | (F.col("r") >= least)))


def quartile_scales(rows: DataFrame) -> DataFrame:
    """(g, mid, scale): per group, the median and the spread between quartiles
    of each part, from exact counts of its values in 1/64 (a long list of
    values is a few thousand counts)."""
    cells = rows.select("g", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col(f"x{i}") / (UNIT // 64)).alias("v"))
                                                 for i in range(P)])).alias("c"))
    cells = cells.groupBy("g", "c.i", "c.v").agg(F.count("*").alias("n"))
    one = Window.partitionBy("g", "i")
    cells = cells.withColumn("upto", F.sum("n").over(one.orderBy("v"))).withColumn("all", F.sum("n").over(one))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("v")))
    parts = cells.groupBy("g", "i").agg(*[((at(q) + 0.5) * (UNIT // 64)).alias(n) for q, n in ((0.25, "lo"), (0.5, "mid"), (0.75, "hi"))])
    floor = F.get(F.array(*[F.lit(f * UNIT) for f in FLOORS]), F.col("i"))
    parts = parts.withColumn("scale", F.greatest((F.col("hi") - F.col("lo")) / 1.349, floor))
    parts = parts.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("i", "mid", "scale"))).alias("p"))
    return parts.select("g", F.col("p.mid").alias("mid"), F.col("p.scale").alias("scale"))


ESTIMATE = "g string, start int, mu array<double>, inv array<double>, logdet double"


def estimates(sums: DataFrame, factor: float) -> DataFrame:
    """Estimates from rows (g, start, n, s: P sums, ss: sums of PAIRS)."""
    def run(batches):
        ij = tuple(np.array(PAIRS).T)
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("n").to_numpy(zero_copy_only=False).astype(float)[:, None]
            mu = batch.column("s").values.to_numpy(zero_copy_only=False).reshape(-1, P) / n
            ss = batch.column("ss").values.to_numpy(zero_copy_only=False).reshape(-1, len(PAIRS)) / n
            cov = (ss - mu[:, ij[0]] * mu[:, ij[1]]) * factor
            full = np.zeros((len(n), P, P))
            full[:, ij[0], ij[1]] = cov
            full[:, ij[1], ij[0]] = cov
            yield from _rows(batch, mu, full)

    return sums.mapInArrow(run, ESTIMATE)


def _rows(batch: pa.RecordBatch, mu: np.ndarray, full: np.ndarray):
    """Estimates as a batch: variances up to their floors, then the inverse."""
    ij = tuple(np.array(PAIRS).T)
    d = np.arange(P)
    full[:, d, d] = np.maximum(full[:, d, d], (np.array(FLOORS) * UNIT) ** 2)
    inv = np.linalg.inv(full)[:, ij[0], ij[1]]
    of = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1)))
    yield pa.RecordBatch.from_arrays(
        [batch.column("g"), batch.column("start"), of(mu), of(np.ascontiguousarray(inv)), pa.array(np.linalg.slogdet(full)[1])],
        names=["g", "start", "mu", "inv", "logdet"])


def _sums(x: list[Column]) -> list[Column]:
    return [F.count("*").alias("n"), *[F.sum(x[i]).alias(f"s{i}") for i in range(P)],
            *[F.sum(x[i] * x[j]).alias(f"s{i}{j}") for i, j in PAIRS]]


def _as_arrays(sums: DataFrame) -> DataFrame:
    d = lambda names: F.array(*[F.col(n).cast("double") for n in names])
    return sums.select("g", "start", "n", d([f"s{i}" for i in range(P)]).alias("s"),
                       d([f"s{i}{j}" for i, j in PAIRS]).alias("ss"))


def starts(rows: DataFrame) -> DataFrame:
    """The three initial estimates of each group."""
    scales = store(quartile_scales(rows), "scales")
    z = [(F.col(f"x{i}") - F.get("mid", F.lit(i))) / F.get("scale", F.lit(i)) for i in range(P)]
    size = F.sqrt(sum((c * c for c in z[1:]), z[0] * z[0]))
    whole = lambda c: F.round(c * UNIT).cast("long")
    squashed = F.array(*[whole(F.tanh(c)) for c in z])
    signs = F.array(*[whole(F.when(size > 0, c / size).otherwise(0.0)) for c in z])
    own = rows.join(scales.withColumnRenamed("g", "__g"), F.col("g") == F.col("__g"))
    own = own.select("g", F.explode(F.array(*[F.struct(F.lit(k).alias("start"), v.alias("v"))
                                              for k, v in ((1, squashed), (2, signs))])).alias("o")).select("g", "o.*")
    sums = own.groupBy("g", "start").agg(*_sums([F.get("v", F.lit(i)) for i in range(P)]))
    sums = _as_arrays(sums).join(scales, "g")

    def run(batches):
        ij = tuple(np.array(PAIRS).T)
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = lambda c, k: batch.column(c).values.to_numpy(zero_copy_only=False).reshape(-1, k)
            n, s, ss = batch.column("n").to_numpy(zero_copy_only=False)[:, None], flat("s", P), flat("ss", len(PAIRS))
            kind = batch.column("start").to_numpy(zero_copy_only=False)
            mid, scale = flat("mid", P), flat("scale", P)
            mean = np.where(kind[:, None] == 1, s / n, 0.0)     # signs are around the median
            cov = ss / n - mean[:, ij[0]] * mean[:, ij[1]]
            full = np.zeros((len(n), P, P))
            full[:, ij[0], ij[1]] = cov
            full[:, ij[1], ij[0]] = cov
            d = np.arange(P)
            sd = np.sqrt(np.maximum(full[:, d, d], 1e-9))
            full = full / (sd[:, :, None] * sd[:, None, :])
            full[:, d, d] = 1.0
            full = 0.9 * full + 0.1 * np.eye(P)                 # a start need not be exact, only regular
            full = full * scale[:, :, None] * scale[:, None, :]
            yield from _rows(batch, mid, full)

    turned = sums.mapInArrow(run, ESTIMATE)
    diagonal = scales.select(
        "g", F.lit(0).alias("start"), F.col("mid").alias("mu"),
        F.array(*[1 / F.pow(F.get("scale", F.lit(i)), F.lit(2)) if i == j else F.lit(0.0) for i, j in PAIRS]).alias("inv"),
        F.aggregate("scale", F.lit(0.0), lambda a, v: a + 2 * F.log(v)).alias("logdet"))
    return diagonal.unionByName(turned)


def distance() -> Column:
    """Squared Mahalanobis distance of x0.. under the row's ``mu`` and ``inv``."""
    d = [F.col(f"x{i}") - F.get("mu", F.lit(i)) for i in range(P)]
    parts = [F.get("inv", F.lit(k)) * (1.0 if i == j else 2.0) * d[i] * d[j] for k, (i, j) in enumerate(PAIRS)]
    return F.when(F.col("mu").isNotNull(), F.greatest(sum(parts[1:], parts[0]), F.lit(0.0)))


def _meet(rows: DataFrame, est: DataFrame) -> DataFrame:
    return rows.join(est.withColumnRenamed("g", "__g"), F.col("g") == F.col("__g")).drop("__g")


def concentrate(rows: DataFrame, est: DataFrame, share: float = CORE) -> DataFrame:
    """(g, start, n, s, ss) over the nearest ``share`` of each group's rows."""
    bin_ = F.floor(F.log(distance() + 1e-9) * BINS).alias("bin")
    x = [F.col(f"x{i}") for i in range(P)]
    cells = _meet(rows, est).groupBy("g", "start", bin_).agg(*_sums(x))
    one = Window.partitionBy("g", "start")
    cells = cells.withColumn("__before", F.coalesce(F.sum("n").over(one.orderBy("bin").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))).withColumn("__all", F.sum("n").over(one))
    cells = cells.where(F.col("__before") < share * F.col("__all"))
    names = ["n", *[f"s{i}" for i in range(P)], *[f"s{i}{j}" for i, j in PAIRS]]
    return _as_arrays(cells.groupBy("g", "start").agg(*[F.sum(F.col(n).cast("decimal(20,0)")).alias(n) for n in names]).withColumn(
        "n", F.col("n").cast("long")))


def robust_estimates(rows: DataFrame) -> DataFrame:
    """(g, mu, inv): the reweighted minimum covariance determinant estimate of
    every group of ``rows`` (g, x0..)."""
    est = store(starts(rows), "starts")
    told = None
    for _ in range(STEPS):
        est = store(estimates(concentrate(rows, est), consistency(CORE)), "step")
        now = est.agg(F.count("*"), F.sum(F.xxhash64("g", "start", "mu", "inv").cast("decimal(38,0)"))).first()
        if now == told:
            break
        told = now
    best = est.groupBy("g").agg(F.min(F.struct("logdet", "start", "mu", "inv")).alias("b")).select(
        "g", F.col("b.start").alias("start"), "b.mu", "b.inv")
    x = [F.col(f"x{i}") for i in range(P)]
    near = _meet(rows, best).where(distance() <= chi2_quantile(NEAR, P))
    return store(estimates(_as_arrays(near.groupBy("g", "start").agg(*_sums(x))), consistency(NEAR)), "estimates").select("g", "mu", "inv")


def judge(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), lang_col: str = "lang", source_col: str = "source",
          text_col: str = "text", least: int = LEAST, reject: float = REJECT) -> DataFrame:
    """Every row of ``docs``: its ``keep`` columns, the counts, ``base_failed``,
    ``distance`` (squared; null where it is not judged) and ``kept``."""
    own = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)], F.col(lang_col).cast("string").alias("lang"),
                      F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    names = [f"__k{i}" for i in range(len(keep))]
    rows = document_counts(own, [*names, "lang", "source"])
    n = F.col("n_words")
    rows = store(rows.withColumn("base_failed", (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n)), "counts")
    passed = rows.where("not base_failed")
    groups = _groups(passed, least).select(F.col("lang").alias("__l"), F.col("source").alias("__s"), "g", "judged")
    placed = store(passed.join(groups, F.col("lang").eqNullSafe(F.col("__l")) & F.col("source").eqNullSafe(F.col("__s")))
                   .drop("__l", "__s").select("*", *vector()), "vectors")
    final = robust_estimates(placed.where("judged").select("g", *[f"x{i}" for i in range(P)]))
    met = placed.join(final.withColumnRenamed("g", "__g"), F.col("g") == F.col("__g"), "left")
    counts = [c.split(" ")[0] for c in COUNTS.split(", ")]
    out = met.select(*names, *counts, "base_failed", distance().alias("distance")).unionByName(
        rows.where("base_failed").select(*names, *counts, "base_failed", F.lit(None).cast("double").alias("distance")))
    cut = chi2_quantile(1 - reject, P)
    return out.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], *counts, "base_failed", "distance",
                      (~F.col("base_failed") & (F.col("distance").isNull() | (F.col("distance") <= cut))).alias("kept"))
