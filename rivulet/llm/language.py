"""Language identification with error-correcting output codes.

Every language gets a codeword of bits.  Each bit is one binary classifier on
byte bigrams and hashed byte trigrams: naive-Bayes log ratios between the
languages whose codeword has the bit and those whose has not, every language
weighing the same.  A text's margins are decoded to the codeword of least
exponential loss, each bit weighted by how far apart its two sides lie; a
small gap between the best two codewords flags the text as ambiguous.

Fitting counts the n-grams of all learning documents in one pass: a task
sums its own counts first, and the shuffle carries at most (languages x
features) rows a task.  Up to ``DENSE`` languages the counts come to the
driver; beyond, they stay in the tasks as rows of (language, feature) and the
sums that the bits weigh are aggregated by feature.  The model that is sent
out has (features x bits) numbers, 15 log2(languages) bits.  Prediction is one
scan without a shuffle.

Edge cases: a null text or one without any letter is ``und`` with score 0 and
not ambiguous; with no learnable row every text is ``und``; with one
language it is always predicted, with score 1; null languages are not learnt;
repeated rows count as often as they occur; a very long text is one document of
one task, its n-grams whole in memory (about 12 bytes a byte and bit); other
columns are not read, and ``keep_identified`` keeps them whatever their names;
empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm._store import store
from rivulet.llm._text import chunks

UND = "und"
FEATURES = 2 << 16          # exact bigrams, then hashed trigrams
DENSE = 64                  # languages whose counts are one array in a task and on the driver
DRAWS_BELOW = 1000          # languages for which the best of 50 codes is looked for
SMOOTH = 0.5                # added to every n-gram count
GAP = 0.1                   # least loss between the best two codewords
SHARPNESS = 4.0             # of the softmax that turns losses into a score
PIECE = 1 << 18             # bytes of text whose n-grams are in memory at once
SHRINK = 8                  # n-grams of no evidence that every text carries


def _letters() -> np.ndarray:
    """Byte -> folded letter byte; ASCII that is no letter is a space."""
    t = np.full(256, 0x20, np.uint32)
    t[0x80:] = np.arange(0x80, 256)
    t[0x61:0x7B] = np.arange(0x61, 0x7B)
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    return t


def _grams(texts: pa.Array, piece: int = PIECE):
    """Per chunk: first row, last row + 1, feature of each n-gram, the offsets
    of the documents in it.  Texts are padded with a space at both ends."""
    padded = pc.binary_join_element_wise(pa.scalar(" "), pc.fill_null(texts.cast(pa.string()), ""),
                                         pa.scalar(" "), pa.scalar(""))
    table = _letters()
    for a, b, data, off in chunks(padded, piece):
        c = table[data]
        two = (c[:-1] << 8) | c[1:]
        three = (two[:-1] << 8) | c[2:]
        three = ((three * np.uint32(0x9E3779B1)) >> np.uint32(16)) + np.uint32(1 << 16)
        f = np.empty((len(c), 2), np.uint32)   # entries 2i, 2i + 1 begin at byte i
        f[:, 0] = f[:, 1] = 0x2020              # the blank feature, which weighs nothing
        f[:-1, 0] = two
        f[:-2, 1] = three
        end = off[1:] - 1
        f[end, 0] = 0x2020                      # no n-gram crosses documents
        f[end, 1] = 0x2020
        f[end - 1, 1] = 0x2020
        yield a, b, f.reshape(-1), off * 2


_BLANK = (0x2020, (((0x202020 * 0x9E3779B1) & 0xFFFFFFFF) >> 16) + (1 << 16))


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray        # languages x bits, +1 or -1
    weight: np.ndarray      # features x (bits + 1); the last column counts n-grams
    centre: np.ndarray      # of each bit's margin
    half: np.ndarray        # half the distance between its two sides


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Rows of +1/-1: exhaustive codes up to 5 languages, beyond that random
    balanced columns, the draw with the largest least distance of 50 (from
    ``DRAWS_BELOW`` languages on the first draw, whose distances are large)."""
    if n <= 5:
        m = np.arange(1, 1 << max(0, n - 1))
        code = [np.where((m >> i) & 1, 1, -1) for i in range(n - 1)]
        return np.array([*code, np.full(len(m), -1)]) if n else np.empty((0, 0))
    rng = np.random.RandomState(seed)
    bits = int(np.ceil(15 * np.log2(n)))
    half = np.where(np.arange(n) < n // 2, 1, -1)
    if n >= DRAWS_BELOW:
        return np.stack([rng.permutation(half.astype(np.int8)) for _ in range(bits)], axis=1)
    best, score = None, -1
    for _ in range(50):
        code = np.stack([rng.permutation(half) for _ in range(bits)], axis=1)
        distance = (bits - code @ code.T) // 2
        least = distance[~np.eye(n, dtype=bool)].min()
        if least > score:
            best, score = code, least
    return best


def count_grams(docs: DataFrame, languages: list[str], text_col: str, lang_col: str) -> DataFrame:
    """(lang index, feature, n) over whole texts of all rows."""
    number = {x: i for i, x in enumerate(languages)}

    def count_sparse(batches):
        for batch in batches:
            lang = np.array([number.get(x, 0) for x in batch.column(1).to_pylist()], np.int64)
            for a, b, f, off in _grams(batch.column(0)):
                key, n = np.unique(f + np.repeat(lang[a:b] * FEATURES, np.diff(off)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], names=["k", "n"])

    def count(batches):
        total = np.zeros(len(languages) * FEATURES, np.int64)
        for batch in batches:
            lang = np.array([number.get(x, 0) for x in batch.column(1).to_pylist()], np.int64)
            for a, b, f, off in _grams(batch.column(0)):
                key = f + np.repeat(lang[a:b] * FEATURES, np.diff(off))
                total += np.bincount(key, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["k", "n"])

    return (docs.select(text_col, lang_col).mapInArrow(count if len(languages) <= DENSE else count_sparse, "k long, n long")
            .groupBy("k").agg(F.sum("n").alias("n")))


def _sides(counts: DataFrame, n: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean n-gram shares of the languages on either side of each bit, two
    arrays of features x bits, without an array of languages x features."""
    counts = store(counts.where(~(F.col("k") % FEATURES).isin(*_BLANK)), "grams")
    totals = counts.groupBy(F.floor(F.col("k") / FEATURES).alias("lang")).agg(F.sum("n").alias("n")).toArrow()
    whole = np.full(n, SMOOTH * FEATURES)
    whole[totals["lang"].to_numpy()] += totals["n"].to_numpy()
    state = counts.sparkSession.sparkContext.broadcast((whole, code > 0))

    def add(batches):
        whole, plus = state.value
        for batch in batches:
            if not batch.num_rows:
                continue
            k, c = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lang, feature = k // FEATURES, k % FEATURES
            share = (c / whole[lang])[:, None]
            both = np.concatenate([plus[lang] * share, ~plus[lang] * share], axis=1)
            first = np.flatnonzero(np.diff(feature, prepend=-1))
            sums = np.add.reduceat(both, first, axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(feature[first], pa.int64()), pa.array([x.tobytes() for x in sums], pa.binary())], names=["feature", "sums"])

    at = F.col("k") % FEATURES
    got = (counts.repartition(at).sortWithinPartitions(at, "k").mapInArrow(add, "feature long, sums binary")).toArrow()
    plus = code > 0
    bits = code.shape[1]
    # what smoothing alone gives, then the counted n-grams
    base = np.concatenate([(SMOOTH / whole) @ plus, (SMOOTH / whole) @ ~plus])
    sums = np.tile(base, (FEATURES, 1))
    for batch in got.to_batches():
        for f, x in zip(batch.column(0).to_numpy(), batch.column(1)):
            sums[f] += np.frombuffer(x.as_buffer())
    return sums[:, :bits] / plus.sum(axis=0), sums[:, bits:] / (~plus).sum(axis=0)


def fit(docs: DataFrame, learn: Column | None = None, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the rows of ``docs`` where ``learn`` holds and the language
    is not null."""
    rows = docs.where(F.col(lang_col).isNotNull())
    rows = rows.where(learn) if learn is not None else rows
    languages = sorted(r[0] for r in rows.select(F.col(lang_col).alias("lang")).distinct().collect())
    n = len(languages)
    code = codewords(n)
    if n < 2:
        return Model(languages, code, np.zeros((FEATURES, 1), np.float32), np.empty(0), np.empty(0))
    grams = count_grams(rows, languages, text_col, lang_col)
    if n <= DENSE:
        got = grams.toArrow()
        counts = np.zeros(n * FEATURES)
        counts[got["k"].to_numpy()] = got["n"].to_numpy()
        counts = counts.reshape(n, FEATURES)
        counts[:, list(_BLANK)] = 0
        p = (counts + SMOOTH) / (counts + SMOOTH).sum(axis=1, keepdims=True)
        p[:, list(_BLANK)] = 0
    else:
        ones, zeros = _sides(grams, n, code)
        ones[list(_BLANK)] = zeros[list(_BLANK)] = 0
    weight = np.zeros((FEATURES, code.shape[1] + 1), np.float32)
    weight[:, -1] = 1
    weight[list(_BLANK), -1] = 0
    centre, half = np.empty(code.shape[1]), np.empty(code.shape[1])
    for b in range(code.shape[1]):
        if n <= DENSE:
            one, zero = p[code[:, b] > 0].mean(axis=0), p[code[:, b] < 0].mean(axis=0)
        else:
            one, zero = ones[:, b], zeros[:, b]
        w = np.clip(np.log(np.maximum(one, 1e-300) / np.maximum(zero, 1e-300)), -4, 4)
        w[list(_BLANK)] = 0
        weight[:, b] = w
        up, down = (one * w).sum(), (zero * w).sum()
        centre[b], half[b] = (up + down) / 2, max((up - down) / 2, 1e-6)
    return Model(languages, code, weight, centre, half)


def _decode(model: Model, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its score and whether the text is ambiguous."""
    n = sums[:, -1:]
    margin = (sums[:, :-1] + SHRINK * model.centre) / (n + SHRINK)
    z = np.clip((margin - model.centre) / model.half, -3, 3)
    share = model.half / model.half.sum()
    if len(model.languages) <= DENSE:
        loss = np.stack([(np.exp(-z * word) * share).sum(axis=1) for word in model.code], axis=1)
    else:
        plus = (model.code > 0).T.astype(np.float64)
        up, down = np.exp(-z) * share, np.exp(z) * share
        loss = up @ plus + down @ (1 - plus)
    order = np.argsort(loss, axis=1, kind="stable")
    first = np.take_along_axis(loss, order[:, :1], 1)
    second = np.take_along_axis(loss, order[:, 1:2], 1)
    score = 1 / np.exp(SHARPNESS * (first - loss)).sum(axis=1)
    return order[:, 0], score, (second - first)[:, 0] < GAP


def predict_batch(model: Model, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Language, score and ambiguity of each text."""
    rows = len(texts)
    letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    best, score = np.zeros(rows, np.int64), np.zeros(rows)
    vague = np.zeros(rows, bool)
    if len(model.languages) == 1:
        score[:] = 1
    elif len(model.languages) > 1:
        # a task holds about as much for any number of languages
        wide = max(1, len(model.code[0]) // 64)
        for a, b, f, off in _grams(texts, PIECE // wide):
            sums = np.add.reduceat(model.weight[f], off[:-1], axis=0, dtype=np.float64)
            step = max(1, (1 << 20) // len(model.languages))
            for i in range(a, b, step):
                j = min(b, i + step)
                best[i:j], score[i:j], vague[i:j] = _decode(model, sums[i - a: j - a])
    else:
        letters[:] = False
    names = np.array([*model.languages, UND], object)
    best[~letters] = len(model.languages)
    return pa.array(names[best], pa.string()), np.where(letters, score, 0.0), vague & letters


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, lang_pred, score (0 to 1), ambiguous."""
    state = docs.sparkSession.sparkContext.broadcast(vars(model))
    key = docs.select(id_col).schema[0].dataType.simpleString()

    def predict(batches):
        m = Model(**state.value)
        for batch in batches:
            lang, score, vague = predict_batch(m, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lang, pa.array(score, pa.float64()), pa.array(vague, pa.bool_())],
                names=[id_col, "lang_pred", "score", "ambiguous"])

    return docs.select(id_col, text_col).mapInArrow(
        predict, f"`{id_col}` {key}, lang_pred string, score double, ambiguous boolean")


def keep_identified(docs: DataFrame, model: Model, least_score: float = 0.0, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language: not
    ``und``, and with a score of ``least_score`` at least."""
    state = docs.sparkSession.sparkContext.broadcast(vars(model))
    at = docs.columns.index(text_col)

    def keep(batches):
        m = Model(**state.value)
        for batch in batches:
            lang, score, _ = predict_batch(m, batch.column(at))
            known = pc.not_equal(lang, UND).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(known & (score >= least_score), pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Is the row kept out of learning (crc32 of the id as text, mod 4, is 2)?"""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
