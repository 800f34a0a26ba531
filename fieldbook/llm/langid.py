"""Language identification: multinomial logistic regression on TF-IDF of character n-grams.

*Features.* Letters are lower-cased and everything else counts as a blank; n-grams of two and three
characters are hashed into ``DIMENSIONS`` slots. A slot's inverse document frequency is counted over
all texts to learn from. A text's features are its slots' shares, weighted so, scaled to unit sum.

*Training* follows the regularised leader: each weight's gradient sum and squared gradients are kept,
and the weight is the closed-form minimiser with an L1 and an L2 penalty, so that slots of little use
stay at exactly zero. The model is fitted to a bounded sample of the labelled texts: of each
language's distinct texts the ``per_language`` of least hash, however many copies they have.

*Calibration.* One part of the sample is not trained on; on it the temperature that divides the scores
is set to least log loss, so that a prediction's score can be read as its probability.

Prediction uses nothing but the text, and the whole of it. A text that is null or holds no letter is
``und`` with score 0, and so is every text where there is nothing to learn from. Ties go to the language
first in order. Repeated rows are predicted alike. An empty table gives no rows. More than ``MOST_LANGUAGES``
languages are an error. Only the text and, in training, the language are read; ``predict`` keeps all columns,
and earlier ones named as its own give way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import add_columns, map_batches, map_partitions

#: Slots for n-grams; sizes of the n-grams; texts of each language to fit to; a share of 1 / HELD is kept for calibration.
DIMENSIONS, SIZES, PER_LANGUAGE, HELD = 1 << 15, (2, 3), 800, 5

#: Follow-the-regularised-leader: step size, its smoothing, penalties, passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 20.0, 1.0, 0.02, 0.02, 4

UNKNOWN = "und"

#: How many times as many texts as are wanted are ordered; languages a model may have (the driver holds a column for each).
SPREAD, MOST_LANGUAGES = 4, 500

#: A text scored no further than so above chance (all languages alike) is in no language the model knows.
OVER_CHANCE = 0.05

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is none."""
    if not _letters:
        table = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                lower = char.lower()
                table[point] = ord(lower) if len(lower) == 1 else point
        _letters.append(table)
    return _letters[0]


def points(text: str) -> np.ndarray:
    """Lower-case letters of a text, with a blank (1) for each run of anything else and at both ends; empty if there is no letter."""
    found = letters()[np.frombuffer(text.encode("utf-32-le"), "<u4")]
    if not found.any():
        return found[:0]
    found = np.concatenate([[0], found, [0]]).astype(np.uint32)
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != 0) | (found[:-1] != 0)
    return np.maximum(found[keep], 1)


def slots(text: str) -> np.ndarray:
    """The slot of every n-gram, those of each size in turn."""
    p = points(text)
    out = []
    for size in SIZES:
        if len(p) >= size:
            h = np.full(len(p) - size + 1, size, np.uint32)
            for k in range(size):
                h = (h ^ p[k:len(p) - size + 1 + k]) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
            out.append(h & np.uint32(DIMENSIONS - 1))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights of unit sum) of a text; empty if it has no letter."""
    found = slots(text)
    if not len(found):
        return found, np.zeros(0)
    counts = np.bincount(found, minlength=DIMENSIONS)
    some = np.flatnonzero(counts)
    weights = counts[some] * idf[some]
    return some, weights / weights.sum()


@dataclass
class Model:
    """What prediction needs: languages, idf, weights with one column a language, biases, temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        both = np.column_stack([self.weights * self.idf[:, None], self.idf]) if self.languages else None
        for text in texts:
            found = slots(text) if text and self.languages else ()
            if not len(found):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            counts = np.bincount(found, minlength=DIMENSIONS)
            sums = counts @ both
            p = softmax((sums[:-1] / sums[-1] + self.bias) / self.temperature)
            best = int(p.argmax())
            names.append(self.languages[best])
            scores.append(float(p[best]))
        return names, scores


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequency(texts: DataFrame) -> tuple[int, np.ndarray]:
    """(texts with letters, how many of them have each slot), from rows of (text).

    Each partition counts into one array; arrays are added up by some hundred tasks before the driver
    adds theirs, one number a slot.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                found = slots(text.as_py() or "")
                if len(found):
                    seen = np.zeros(DIMENSIONS, bool)
                    seen[found] = True
                    df += seen
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([df.tobytes()], pa.binary())], ["n", "df"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            n += sum(batch.column(0).to_pylist())
            for x in batch.column(1).to_pylist():
                df += np.frombuffer(x, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([df.tobytes()], pa.binary())], ["n", "df"])

    shape = "n bigint, df binary"
    sums = map_partitions(map_partitions(texts, count, shape).repartition(100), add, shape).where("n > 0").collect()
    return sum(r.n for r in sums), sum((np.frombuffer(r.df, np.int64) for r in sums), np.zeros(DIMENSIONS, np.int64))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases for rows of (slots, weights, language), by proximal follow-the-regularised-leader."""
    z, n = np.zeros((DIMENSIONS + 1, k)), np.zeros((DIMENSIONS + 1, k))

    def solved(some: np.ndarray) -> np.ndarray:
        zs = z[some]
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(n[some])) / ALPHA + L2))

    for turn in range(PASSES):
        for at in np.random.default_rng(turn).permutation(len(rows)):
            some, x, y = rows[at]
            some, x = np.append(some, DIMENSIONS), np.append(x, 0.1)  # the last place is the bias
            w = solved(some)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None, :]
            z[some] += g - (np.sqrt(n[some] + g * g) - np.sqrt(n[some])) / ALPHA * w
            n[some] += g * g
    w = solved(np.arange(DIMENSIONS + 1))
    return w[:-1], w[-1] * 0.1


def calibrated(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 140))
    wrong = 1 / (len(y) + 2)  # as if one more text had been wrong: a sample without errors proves no certainty
    loss = []
    for t in grid:
        p = np.maximum(softmax(logits / t), 1e-12)
        right = p[np.arange(len(y)), y]
        loss.append(-((1 - wrong) * np.log(right) + wrong * np.log(np.maximum(1 - right, 1e-12))).mean())
    return float(grid[int(np.argmin(loss))])


def least_hashes(rows: DataFrame, n: int) -> dict[str, int]:
    """For each language the n-th least hash of its distinct texts, or the greatest if there are fewer.

    Hashes are even: of a language's texts, those in the first ``spread * n / texts`` of the range are some
    ``spread * n``, however many texts it has, and only these are ordered. Should n of them not be there, more of
    the range is taken.
    """
    hashed = rows.select("lang", F.xxhash64("text").alias("h"))
    texts = hashed.distinct().groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(texts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: pool the rare ones first")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    last: dict[str, int] = {}
    spread = SPREAD
    while missing := [r for r in texts if r.lang not in last]:
        upto = {r.lang: min((1 << 63) - 1, (spread * n << 64) // r.n - (1 << 63)) for r in missing}
        limits = F.create_map(*[F.lit(x) for pair in upto.items() for x in pair])
        some = hashed.where(F.col("h") <= F.element_at(limits, F.col("lang"))).distinct()
        found = some.withColumn("place", place).where(F.col("place") <= n).groupBy("lang").agg(F.max("h").alias("h"), F.count("*").alias("n"))
        there = {r.lang: r for r in found.collect()}
        last |= {r.lang: there[r.lang].h for r in missing if r.lang in there and there[r.lang].n >= min(n, r.n)}
        spread *= SPREAD
    return last


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from rows of (text, lang)."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    n, df = document_frequency(rows.select("text"))
    idf = np.log((1 + n) / (1 + df)) + 1
    # texts are made distinct by their hash first, so that copies count once and a language's sample has a hard bound
    last = least_hashes(rows, per_language)
    languages = sorted(last)
    if not n:
        return Model([], idf, np.zeros((DIMENSIONS, 0)), np.zeros(0), 1.0)
    number = {lang: k for k, lang in enumerate(languages)}
    up_to = F.element_at(F.create_map(*[F.lit(x) for lang in languages for x in (lang, last[lang])]), F.col("lang"))

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [features(t, idf) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s.astype("<i4").tobytes() for s, _ in found], pa.binary()),
             pa.array([w.astype("<f4").tobytes() for _, w in found], pa.binary()), batch.column(1), batch.column(2)],
            ["slots", "weights", "lang", "hash"])

    picked = rows.where(F.xxhash64("text") <= up_to).groupBy("lang", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))
    picked = picked.select("text", "lang", F.xxhash64("text", F.lit("held")).alias("hash"))
    sample = map_batches(picked, measure, "slots binary, weights binary, lang string, hash bigint").collect()
    sample = sorted(((r.hash, r.lang, r.slots, r.weights) for r in sample if len(r.slots)))
    known = [(np.frombuffer(s, "<i4"), np.frombuffer(w, "<f4").astype(float), number[lang]) for _, lang, s, w in sample]
    held = np.array([h % HELD == 0 for h, *_ in sample], bool)
    weights, bias = fit([r for r, h in zip(known, held) if not h], len(languages))
    logits = np.array([x @ weights[s] + bias for (s, x, _), h in zip(known, held) if h]).reshape(-1, len(languages))
    y = np.array([r[2] for r, h in zip(known, held) if h], int)
    return Model(languages, idf, weights, bias, calibrated(logits, y))


def predict(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    def run(texts: pa.Array) -> list[pa.Array]:
        names, scores = model.predict(texts.to_pylist())
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return add_columns(docs, [text_column], run, "lang_pred string, score double")


def with_letters(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows whose text holds a letter."""
    at = docs.columns.index(text_column)

    def keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array([len(points(t or "")) > 0 for t in batch.column(at).to_pylist()], pa.bool_()))

    return map_batches(docs, keep, docs.schema)


def least_score(model: Model) -> float:
    """The score from which a language counts as told: ``OVER_CHANCE`` of the way from chance to certainty."""
    chance = 1 / len(model.languages)
    return chance + OVER_CHANCE * (1 - chance)


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a document is never learnt from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))
