"""Language identification: a byte convolutional network over fixed-length windows."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinestream.llm.bpe import classes

#: Bytes of a window. Windows follow each other without a gap; the last is padded with zero bytes.
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS, EMBED = 8, 8
#: Training rows of each language at most, and windows of each row.
TRAIN_EACH, TRAIN_WINDOWS = 300, 4
#: The most frequent languages are learned, so many at most.
LANGUAGES = 1000
#: Windows that go through the network at a time.
BATCH = 128


@lru_cache(1)
def _letter() -> re.Pattern:
    """A character of Unicode's category L."""
    return re.compile(f"[{classes()['L']}]")



@dataclass(frozen=True)
class ByteCnn:
    """embed: 256 x EMBED; filters: a matrix for each width; bias, out and out_bias of all filters together."""

    languages: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def log_probs(self, windows: np.ndarray) -> np.ndarray:
        """Log probability of each language for each row of bytes."""
        pooled = []
        for at in range(0, len(windows), BATCH):
            pooled.append(_pooled(self.embed[windows[at : at + BATCH]], self._joint()))
        hidden = np.maximum(np.concatenate(pooled) + self.bias, 0)
        scores = hidden @ self.out + self.out_bias
        scores -= scores.max(1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(1, keepdims=True))

    def _joint(self) -> np.ndarray:
        """All filters as one matrix over the widest stretch; narrower ones have zeros behind."""
        most = max(WIDTHS) * EMBED
        return np.concatenate([np.vstack([f, np.zeros((most - len(f), FILTERS), f.dtype)]) for f in self.filters], axis=1)


def _stretches(x: np.ndarray, width: int) -> np.ndarray:
    """windows x places x (width * EMBED): what each filter place reads; zeros follow the last byte."""
    n, length, _ = x.shape
    padded = np.concatenate([x, np.zeros((n, width - 1, EMBED), x.dtype)], axis=1)
    flat = np.lib.stride_tricks.sliding_window_view(padded.reshape(n, -1), width * EMBED, axis=1)[:, ::EMBED]
    return flat[:, :length]


def _pooled(x: np.ndarray, filters: np.ndarray) -> np.ndarray:
    """The largest value of each filter over the places of a window."""
    width = len(filters) // EMBED
    read = np.ascontiguousarray(_stretches(x, width)).reshape(-1, width * EMBED)
    return (read @ filters).reshape(len(x), -1, filters.shape[1]).max(axis=1)


def fit(windows: np.ndarray, gold: np.ndarray, languages: list[str], epochs: int = 14, rate: float = 4e-3, seed: int = 5) -> ByteCnn:
    """Train by back-propagation and Adam on rows of bytes and their language numbers. Languages weigh the same."""
    rng = np.random.default_rng(seed)
    k = len(languages)
    params = [rng.normal(0, 0.5, (256, EMBED)), *[rng.normal(0, 1 / np.sqrt(w * EMBED), (w * EMBED, FILTERS)) for w in WIDTHS], np.zeros(FILTERS * len(WIDTHS)), rng.normal(0, 0.3, (FILTERS * len(WIDTHS), k)), np.zeros(k)]
    params = [p.astype(np.float32) for p in params]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    weigh = (len(gold) / (k * np.maximum(np.bincount(gold, minlength=k), 1)))[gold].astype(np.float32)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(gold))
        for at in range(0, len(order), 64):
            rows = order[at : at + 64]
            grads = _gradient(params, windows[rows], gold[rows], weigh[rows])
            step += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return ByteCnn(languages, params[0], params[1 : 1 + len(WIDTHS)], *params[1 + len(WIDTHS) :])


def _gradient(params: list[np.ndarray], rows: np.ndarray, gold: np.ndarray, weigh: np.ndarray) -> list[np.ndarray]:
    embed, filters, (bias, out, out_bias) = params[0], params[1 : 1 + len(WIDTHS)], params[1 + len(WIDTHS) :]
    n = len(rows)
    x = embed[rows]
    best, kept, pooled = [], [], []
    for w, f in zip(WIDTHS, filters, strict=True):
        read = _stretches(x, w)
        made = read @ f
        at = made.argmax(axis=1)
        best.append(at)
        kept.append(read)
        pooled.append(np.take_along_axis(made, at[:, None, :], 1)[:, 0])
    before = np.concatenate(pooled, axis=1) + bias
    hidden = np.maximum(before, 0)
    scores = hidden @ out + out_bias
    prob = np.exp(scores - scores.max(1, keepdims=True))
    prob /= prob.sum(1, keepdims=True)
    prob[np.arange(n), gold] -= 1
    d_scores = prob * (weigh / n)[:, None]
    d_hidden = (d_scores @ out.T) * (before > 0)
    d_embed, d_filters = np.zeros_like(embed), []
    for i, (w, f) in enumerate(zip(WIDTHS, filters, strict=True)):
        d = d_hidden[:, i * FILTERS : (i + 1) * FILTERS]
        at = best[i]
        read = kept[i][np.arange(n)[:, None], at]
        d_filters.append(np.einsum("nfd,nf->df", read, d))
        back = np.einsum("nf,df->nfd", d, f).reshape(n, FILTERS, w, EMBED)
        places = at[:, :, None] + np.arange(w)
        inside = places < rows.shape[1]
        letters = rows[np.arange(n)[:, None, None], np.minimum(places, rows.shape[1] - 1)]
        np.add.at(d_embed, letters[inside], back[inside])
    return [d_embed, *d_filters, d_hidden.sum(0), hidden.T @ d_scores, d_scores.sum(0)]


def cut(raw: bytes) -> np.ndarray:
    """All bytes of a text as windows; the last is filled up with zeros."""
    n = max(1, -(-len(raw) // WINDOW))
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), dtype=np.uint8).reshape(n, WINDOW)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", each: int = TRAIN_EACH, most_languages: int = LANGUAGES) -> ByteCnn:
    """Fit on rows with a language and a letter whose crc32(id) mod 3 is not 1.

    The sample is bounded: of each of the ``most_languages`` most frequent languages at most ``each`` rows, those of the least hash of id
    and text, and TRAIN_WINDOWS stretches of WINDOW characters of each, spread over the whole text. Equal rows count once. Languages
    are counted over all rows; a share of the hashes that holds some more than ``each`` rows is ranked, so no task ranks a whole language.
    """
    open_rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3, F.lit(0)) != 1)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 30)).alias("h")
    )
    sizes = open_rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages)
    share = sizes.select("lang", (F.lit(1.5 * each) / F.col("n") * (1 << 30)).cast("long").alias("most"))
    near = open_rows.join(F.broadcast(share), "lang").where("h < most").groupBy("lang", "h").agg(F.min("text").alias("text"))
    open_rows = near.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("place") <= each)
    length = F.length("text")
    starts = [F.greatest(F.lit(0), ((length - WINDOW) * (i / max(1, TRAIN_WINDOWS - 1))).cast("int")) + 1 for i in range(TRAIN_WINDOWS)]
    stretches = F.array_distinct(F.array(*[F.substring(F.col("text"), s, F.lit(WINDOW)) for s in starts]))
    rows = open_rows.select("lang", F.explode(stretches).alias("part")).collect()
    rows = sorted({(r.lang, r.part) for r in rows if _letter().search(r.part)})
    languages = sorted({lang for lang, _ in rows})
    if len(languages) < 2:
        return ByteCnn(languages, *[None] * 5)
    number = {lang: i for i, lang in enumerate(languages)}
    windows = [cut(part.encode()[: WINDOW]) for _, part in rows]
    return fit(np.concatenate(windows), np.array([number[lang] for lang, _ in rows]), languages)


def predict(docs: DataFrame, model: ByteCnn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, lang_pred, score.

    All windows of a text go through the network; the language with the largest mean log probability is predicted and
    its mean probability is the score. Null texts and texts without a letter are ``und`` with score 0, and all are
    if no language was learned. With one language learned every other text is in it, with score 1. A null id is not
    held out. Only the text is looked at.
    """

    @F.pandas_udf("lang_pred string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        out = [("und", 0.0)] * len(texts)
        real = [i for i, t in enumerate(texts) if t is not None and model.languages and _letter().search(t)]
        if len(model.languages) == 1:
            for i in real:
                out[i] = (model.languages[0], 1.0)
            real = []
        at = 0
        while at < len(real):
            group, windows, total = [], [], 0
            while at < len(real) and total < 8192:
                windows.append(cut(texts.iloc[real[at]].encode()))
                total += len(windows[-1])
                group.append(real[at])
                at += 1
            logs = model.log_probs(np.concatenate(windows))
            firsts = np.cumsum([0, *map(len, windows)])[:-1]
            sizes = np.array([len(w) for w in windows])[:, None]
            mean_log, mean_prob = np.add.reduceat(logs, firsts) / sizes, np.add.reduceat(np.exp(logs), firsts) / sizes
            for i, best, prob in zip(group, mean_log.argmax(1), mean_prob, strict=True):
                out[i] = (model.languages[best], float(min(1.0, prob[best])))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
    return docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), of(F.col(text_col)).alias("r")).select("doc_id", "held_out", "r.*")
