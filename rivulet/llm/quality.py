"""Quality and toxicity by hierarchical empirical Bayes.

Evidence: a naive-Bayes classifier on which features a document has: folded
words, their first four bytes and word shapes, hashed to ``HASHED`` numbers,
and the ranges that its shares of odd words fall into (repeated neighbours,
odd endings, capitals, lone marks, exclamations, distinct words).  Features whose log ratio is small or not significant
weigh nothing; the sum is calibrated to a probability on the labelled
documents.  All labelled rows are counted, equal texts with equal labels once.

Sites: every document also belongs to a host and to a path of that host.  The
mean probability of a host is shrunk toward the global mean, that of a path
toward its host's posterior, each by a prior strength that is estimated from
how much hosts (or paths of a host) really differ, so a site with few
documents says little.  A document's own probability is left out of its
site's.  The posterior odds of a document are its own odds times how much its
path's posterior odds differ from the global ones.

Feature counts are summed per task and then by feature; sites are aggregates
(path, then host from its paths, then one global row), joined back by key.
Only the model (FEATURES rows at most) and single rows reach the driver.  Labels
meet ids and hashes of texts; the texts themselves are not shuffled for them
(beyond ``MOST_BROADCAST`` labelled texts, once).

Edge cases: null and empty texts have no features, so only prior and site
speak; null hosts or paths are sites of their own; labels without a document,
null labels and null ids are not learnt; repeated labels count each; without
labels of both kinds all probabilities are the prior 0.5; a very long text is
one document of one task; other columns are not read, so none clashes; empty
tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm._store import store
from rivulet.llm._text import FOLD, U64, Words, chunks, mix, per_doc, separators

HASHED, SHARES, RANGES = 1 << 18, 6, 16
FEATURES = HASHED + SHARES * RANGES
LEAST_RATIO, LEAST_Z = 1.0, 4.0
BIN, MOST = 0.25, 10.0     # calibration bins of the evidence
WEAKEST, STRONGEST = 1.0, 1e6   # prior strengths, in documents
MOST_BROADCAST = 2_000_000      # labelled texts whose ids and labels are broadcast


def _classes() -> np.ndarray:
    """Byte -> letter case, digit, or the byte itself."""
    t = np.arange(256, dtype=np.uint8)
    t[0x30:0x3A] = ord("0")
    t[0x41:0x5B] = ord("A")
    t[0x61:0x7B] = ord("a")
    t[0x80:] = ord("a")
    return t


def features(texts: pa.Array):
    """Per chunk: first row, last row + 1, feature numbers, and the document of
    each; every feature once per document."""
    blank, shape = separators("space"), _classes()
    plain = np.isin(np.arange(256), [ord(c) for c in "aA0.,;:?!"])
    for a, b, data, off in chunks(texts):
        w = Words(data, off, separators("alnum"), fold=True)
        folded = FOLD[data]
        head = np.zeros(len(w.starts), U64)
        for j in range(4):
            at = np.minimum(w.starts + j, w.ends - 1)
            head = head * U64(257) + folded[at].astype(U64) * (w.starts + j < w.ends)
        t = Words(data, off, blank)
        kind = shape[data]
        first, last = kind[t.starts], kind[t.ends - 1]
        second = kind[np.minimum(t.starts + 1, t.ends - 1)]
        form = (first.astype(U64) << U64(16)) | (second.astype(U64) << U64(8)) | last.astype(U64)
        doc = np.concatenate([w.doc, w.doc, t.doc]).astype(U64)
        value = np.concatenate([mix(w.hash, 20), mix(head, 21), mix(form, 22)]) >> U64(46)
        again = np.zeros(len(t.hash), bool)
        again[1:] = (t.hash[1:] == t.hash[:-1]) & (t.doc[1:] == t.doc[:-1])
        lone = (t.ends - t.starts == 1) & ~np.isin(first, [ord(c) for c in "aA0"])
        capital = (first == ord("A")) & (second == ord("A"))
        n = np.maximum(t.count, 1)
        share = [per_doc(x, t.first) / n for x in (again, ~plain[last], capital, lone, last == ord("!"))]
        own = np.unique((t.doc.astype(U64) << U64(40)) | (t.hash >> U64(24))) >> U64(40)
        share.append(np.bincount(own.astype(np.int64), minlength=b - a) / n)
        some = np.flatnonzero(t.count)
        ranges = [HASHED + i * RANGES + np.sqrt(x[some]) * (RANGES - 1) // 2 for i, x in enumerate(share)]
        doc = np.concatenate([doc, np.tile(some, SHARES).astype(U64)])
        value = np.concatenate([value, *[r.astype(U64) for r in ranges]])
        key = np.unique((doc << U64(20)) | value)
        yield a, b, (key & U64((1 << 20) - 1)).astype(np.int64), (key >> U64(20)).astype(np.int64)


def count_features(labelled: DataFrame) -> DataFrame:
    """(feature, n, good, toxic) over the rows (text, quality, toxic, share);
    a row counts as its ``share``, and the shares of one text add up to 1."""
    def run(batches):
        total = np.zeros((3, FEATURES))
        for batch in batches:
            marks = [batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)]
            share = batch.column(3).to_numpy(zero_copy_only=False)
            for a, _, f, doc in features(batch.column(0)):
                total[0] += np.bincount(f, weights=share[doc + a], minlength=FEATURES)
                for i, m in enumerate(marks):
                    total[i + 1] += np.bincount(f, weights=(m * share)[doc + a], minlength=FEATURES)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), *[pa.array(x) for x in total[:, at]]], names=["feature", "n", "good", "toxic"])

    return labelled.mapInArrow(run, "feature long, n double, good double, toxic double").groupBy("feature").agg(
        *[F.round(F.sum(c)).cast("long").alias(c) for c in ("n", "good", "toxic")])


def learnt_texts(rows: DataFrame, known: DataFrame) -> DataFrame:
    """One row (id, hash, quality, toxic, share) per labelled text and pair of
    labels, found on ids and hashes alone; ``share`` is one over how many rows
    hold that id and text.  Stored: a thin table."""
    thin = rows.select("id", F.xxhash64("text").alias("hash")).join(known.distinct(), F.col("id") == F.col("__id"))
    return store(thin.groupBy("hash", "quality", "toxic", "id").agg(F.count("*").alias("n"))
                 .groupBy("hash", "quality", "toxic").agg(F.min(F.struct("id", "n")).alias("one"))
                 .select("one.id", "hash", "quality", "toxic", (1 / F.col("one.n")).alias("share")), "learnt")


def _with_labels(rows: DataFrame, learnt: DataFrame) -> DataFrame:
    """Texts of ``learnt``: it is broadcast up to MOST_BROADCAST rows (of five
    numbers each); more are joined by one shuffle of texts, which the one scan
    of them then reads."""
    if learnt.count() <= MOST_BROADCAST:
        learnt = F.broadcast(learnt)
    learnt = learnt.withColumnRenamed("id", "__id")
    same = (F.col("id") == F.col("__id")) & (F.xxhash64("text") == F.col("hash"))
    return rows.select("id", "text").join(learnt, same).select("text", "quality", "toxic", "share")


def _weights(n: np.ndarray, yes: np.ndarray, total: int, total_yes: int) -> np.ndarray:
    no, total_no = n - yes, total - total_yes
    ratio = np.log((yes + 0.5) / (total_yes + 1)) - np.log((no + 0.5) / (total_no + 1))
    z = np.abs(ratio) / np.sqrt(1 / (yes + 0.5) + 1 / (no + 0.5))
    return np.where((np.abs(ratio) >= LEAST_RATIO) & (z >= LEAST_Z), ratio, 0.0)


def fit(rows: DataFrame, learnt: DataFrame) -> np.ndarray:
    """Weights (2 x FEATURES: quality, toxicity) from the texts of ``learnt``."""
    totals = learnt.agg(F.count("*"), F.sum("quality"), F.sum("toxic")).first()
    out = np.zeros((2, FEATURES))
    got = count_features(_with_labels(rows, learnt)).toArrow()
    at, n = got["feature"].to_numpy(), got["n"].to_numpy()
    for i, c in enumerate(("good", "toxic")):
        yes = totals[i + 1] or 0
        if 0 < yes < totals[0]:
            out[i, at] = _weights(n, got[c].to_numpy(), totals[0], yes)
    return out


def evidence(docs: DataFrame, weights: np.ndarray, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with ``s_quality`` and ``s_toxic``."""
    at = np.flatnonzero(weights.any(axis=0))
    sent = docs.sparkSession.sparkContext.broadcast((at, weights[:, at]))
    schema = docs.select(*keep).schema.add("s_quality", "double").add("s_toxic", "double")

    def run(batches):
        table = np.zeros((2, FEATURES))
        table[:, sent.value[0]] = sent.value[1]
        for batch in batches:
            s = np.zeros((2, batch.num_rows))
            for a, _, f, doc in features(batch.column(0)):
                for i in (0, 1):
                    part = np.bincount(doc, weights=table[i][f])
                    s[i, a: a + len(part)] += part
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(s[0]), pa.array(s[1])], names=[f.name for f in schema])

    return docs.select(F.col(text_col).alias("__text"), *keep).mapInArrow(run, schema)


def calibrate(scores: DataFrame, score: str, label: str) -> tuple[float, float]:
    """Slope and intercept that turn evidence into log odds: a logistic fit on
    binned evidence (at most 2 * MOST / BIN + 1 rows)."""
    bins = scores.groupBy(F.round(F.greatest(F.least(F.col(score), F.lit(MOST)), F.lit(-MOST)) / BIN).alias("bin")).agg(
        F.count("*").alias("n"), F.sum(label).alias("yes")).collect()
    x = np.array([r["bin"] * BIN for r in bins])
    n, yes = np.array([r["n"] for r in bins], float), np.array([r["yes"] for r in bins], float)
    a, b = 0.0, 0.0
    if n.sum() == 0 or not 0 < yes.sum() < n.sum():
        return a, b
    # half a document of either kind keeps the fit finite when classes separate
    x, n, yes = np.append(x, [-MOST, MOST]), np.append(n, [1, 1]), np.append(yes, [0.5, 0.5])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = n * p * (1 - p) + 1e-9
        g = np.array([((yes - n * p) * x).sum(), (yes - n * p).sum()])
        h = np.array([[(w * x * x).sum() + 1e-6, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def _strength(groups: DataFrame, mean: Column, prior: Column) -> float:
    """Prior strength of a level by moments: how much group means differ beyond
    what their sizes explain."""
    r = groups.where("n > 1").agg(
        F.sum(F.col("n") * F.pow(mean - prior, F.lit(2))).alias("spread"), F.sum("n").alias("n"), F.count("*").alias("k"),
        F.sum(F.col("n") * prior * (1 - prior)).alias("noise")).first()
    if not r["n"]:
        return STRONGEST
    noise = max(r["noise"] / r["n"], 1e-6)
    between = (r["spread"] - r["k"] * noise) / r["n"]
    return float(np.clip(noise / between if between > 0 else STRONGEST, WEAKEST, STRONGEST))


def _odds(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def shrink(scored: DataFrame, p: str, host: str, path: str, name: str) -> DataFrame:
    """Add ``<name>_host``, ``<name>_path`` (posteriors without the row itself)
    and ``name`` (the row's own posterior) to rows with probability ``p``."""
    paths = scored.groupBy(F.col(host).alias("__host"), F.col(path).alias("__path")).agg(
        F.count("*").alias("n"), F.sum(p).alias("s"))
    hosts = paths.groupBy(F.col("__host").alias("__h")).agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s")).first()
    mean = total["s"] / total["n"] if total["n"] else 0.5
    host_strength = _strength(hosts.withColumnsRenamed({"hn": "n", "hs": "s"}), F.col("s") / F.col("n"), F.lit(mean))
    sites = paths.join(hosts, F.col("__host").eqNullSafe(F.col("__h"))).drop("__h")
    host_mean = (F.col("hs") + mean * host_strength) / (F.col("hn") + host_strength)
    path_strength = _strength(sites, F.col("s") / F.col("n"), host_mean)
    rows = scored.join(sites, F.col(host).eqNullSafe(F.col("__host")) & F.col(path).eqNullSafe(F.col("__path")))
    at_host = (F.col("hs") - F.col(p) + mean * host_strength) / (F.col("hn") - 1 + host_strength)
    at_path = (F.col("s") - F.col(p) + F.col(f"{name}_host") * path_strength) / (F.col("n") - 1 + path_strength)
    odds = _odds(F.col(p)) + _odds(F.col(f"{name}_path")) - float(np.log(np.clip(mean, 1e-6, 1 - 1e-6) / (1 - np.clip(mean, 1e-6, 1 - 1e-6))))
    return (rows.withColumn(f"{name}_host", at_host).withColumn(f"{name}_path", at_path)
            .withColumn(name, 1 / (1 + F.exp(-odds))).drop("__host", "__path", "n", "s", "hn", "hs"))


def classify(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, host, path, quality and toxicity (probabilities), the
    posteriors of their sites, and kept (good and not toxic, at 0.5)."""
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    known = labels.where("doc_id is not null and quality is not null and toxic is not null").select(
        F.col("doc_id").alias("__id"), F.col("quality").cast("double").alias("quality"), F.col("toxic").cast("double").alias("toxic"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       host.cast("string").alias("host"), path.cast("string").alias("path"))
    # copies of a text say no more about its words than one
    weights = fit(rows, learnt_texts(rows, known))
    scored = store(evidence(rows, weights, "text", ["id", "host", "path"]), "evidence")
    marked = store(scored.join(known, F.col("id") == F.col("__id")), "marked")
    for score, label, p in (("s_quality", "quality", "p_quality"), ("s_toxic", "toxic", "p_toxic")):
        a, b = calibrate(marked, score, label)
        scored = scored.withColumn(p, 1 / (1 + F.exp(-(F.col(score) * a + b))))
    out = shrink(shrink(scored, "p_quality", "host", "path", "quality"), "p_toxic", "host", "path", "toxicity")
    return out.select(F.col("id").alias(id_col), "host", "path", "quality", "quality_host", "quality_path",
                      "toxicity", "toxicity_host", "toxicity_path").withColumn(
        "kept", (F.col("quality") >= 0.5) & (F.col("toxicity") < 0.5))
