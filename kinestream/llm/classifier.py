"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A word is a run of letters, digits and underscores, or a run of other characters that are no white space.
_TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Features are numbered below 2 ** BITS; the first one is what a word makes with itself.
BITS = 18
#: Labelled documents of each quality that the fit sees at most, and rounds over them.
TRAIN_EACH, ROUNDS = 2000, 4
#: A document whose score is this or more is predicted to be of quality 1.
THRESHOLD = 0.3
#: Hashes of words of up to CACHED_CHARS characters are remembered, so many at most.
CACHED_WORDS, CACHED_CHARS = 100_000, 48
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """crc32 of each word, bounded in number and in length."""

    def __missing__(self, word: str) -> int:
        found = zlib.crc32(word.encode())
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = found
        return found


_hashes = _Hashes()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a text's word 1-grams and 2-grams in rising order, and their counts over the Euclidean norm of all.

    The whole text is read. Words are hashed as they are, with their case. A 2-gram of a word with itself is one feature for all words,
    so that repetition of words that no label shows can be learned. Null, empty and blank texts have no feature.
    """
    found = _TOKEN.findall(text or "")
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    h = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    two = (h[:-1] * _MIX + h[1:]) * _MIX
    two[h[:-1] == h[1:]] = 0
    index, n = np.unique(np.concatenate([(h * _MIX), two]) >> np.uint64(64 - BITS), return_counts=True)
    value = n.astype(np.float64)
    return index.astype(np.int64), value / np.sqrt(value @ value)


@dataclass(frozen=True)
class Regression:
    """Weights of the features, most of them zero, and the bias."""

    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        """Probability of quality 1: the sparse dot product through the logistic function."""
        index, value = features(text)
        return float(_logistic(self.bias + self.weights[index] @ value))


def _logistic(x: float) -> float:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], gold: np.ndarray, weigh: np.ndarray, rounds: int = ROUNDS, rate: float = 2.0, smooth: float = 1.0, lasso: float = 0.02, ridge: float = 0.02, seed: int = 3) -> Regression:
    """FTRL-proximal steps, one for each row, ``rounds`` times in an order drawn anew.

    For each feature z gathers gradients less what the step sizes so far moved it, n their squares; its weight is zero while z is within
    ``lasso`` and else the minimum of the linearised losses with the proximal and ``ridge`` terms. ``weigh``: importance of each row.
    """
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rng = np.random.default_rng(seed)

    def weights(at):
        zs = z[at]
        least = np.where(at == size, 0.0, lasso)  # the bias isn't drawn to zero
        return np.where(np.abs(zs) <= least, 0.0, -(zs - np.sign(zs) * least) / ((smooth + np.sqrt(n[at])) / rate + ridge))

    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            at, value = np.append(rows[i][0], size), np.append(rows[i][1], 1.0)
            w = weights(at)
            step = (_logistic(w @ value) - gold[i]) * weigh[i] * value
            z[at] += step - (np.sqrt(n[at] + step * step) - np.sqrt(n[at])) / rate * w
            n[at] += step * step
    all_weights = weights(np.arange(size + 1))
    return Regression(all_weights[:size].astype(np.float32), float(all_weights[size]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", each: int = TRAIN_EACH) -> Regression:
    """Fit on documents with a quality of 0 or 1 whose crc32(id) mod 5 is not 0.

    The sample is bounded: of each quality ``each`` documents, those whose ids hash least; only their features are gathered. Rows count as
    much as the labelled documents of their quality do among all, so scores are probabilities. A document with both labels is left out, one
    that ``docs`` holds more than once counts once. Without any labelled row every score is 0.5.
    """
    apart = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & apart).groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("r")).where("q = r")
    sizes = {r.q: r.n for r in known.groupBy("q").agg(F.count("*").alias("n")).collect()}
    picked = [known.where(F.col("q") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each) for q in (0, 1)]
    chosen = picked[0].union(picked[1]).select(F.col("doc_id").alias(id_col), F.col("q").cast("int").alias("q"))

    @F.pandas_udf("at array<int>, value array<float>")
    def of(texts: pd.Series) -> pd.DataFrame:
        found = [features(t) for t in texts]
        return pd.DataFrame({"at": [at for at, _ in found], "value": [v for _, v in found]})

    texts = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).groupBy(id_col, "q").agg(F.min(text_col).alias("t"))
    found = texts.select(F.col(id_col).alias("id"), "q", of("t").alias("x")).select("id", "q", "x.*").toPandas().sort_values("id")
    if not len(found):
        return Regression(np.zeros(1 << BITS, np.float32), 0.0)
    gold = found["q"].to_numpy().astype(float)
    used = {q: max(1, int((gold == q).sum())) for q in (0, 1)}
    weigh = np.array([sizes.get(int(q), 0) / used[int(q)] for q in gold])
    rows = [(np.asarray(a, np.int64), np.asarray(v, float)) for a, v in zip(found["at"], found["value"], strict=True)]
    return fit(rows, gold, weigh / weigh.mean())


def score(docs: DataFrame, model: Regression, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score, predicted.

    Only the text is looked at. Null, empty and blank texts have no feature; the bias alone gives their score. Equal texts score the same. A null id is not
    held out. Other columns of ``docs`` are not read.
    """

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))
    scored = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), of(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
