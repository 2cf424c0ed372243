"""Quality rules: a linear-chain conditional random field labels lines as content or boilerplate."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinestream.llm.common import WORD, free_name

_WORD = re.compile(WORD)
_BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
_SYMBOLS = "#*$%&|<>"
_ENDS = (".", "!", "?", ":", ";", "…", "。", ".”", '."')
WINDOW = 5
#: The classifier is fitted on so many labelled documents of each quality at most, and so many lines of each.
TRAIN_DOCS, TRAIN_LINES = 400, 40
#: A document whose words are in content lines by this share or more is kept.
CONTENT_SHARE = 0.5
_FEATURES = 9


def base_rules(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text; null has none."""
    text = text or ""
    found = _WORD.findall(text)
    seen: set[str] = set()
    copies = 0
    for line in text.split("\n"):
        if line in seen:
            copies += 1
        elif line.strip(_BLANK):
            seen.add(line)
    return len(found), sum(map(len, found)), sum(map(text.count, _SYMBOLS)), copies, repeated_words(found)


def repeated_words(found: list[str], size: int = WINDOW) -> int:
    """Words that are in a window of ``size`` words found twice or more, the first one included."""
    windows = [*zip(*(found[i:] for i in range(size)), strict=False)]
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    total, until = 0, 0
    for at, w in enumerate(windows):
        if w in often:
            total += at + size - max(at, until)
            until = at + size
    return total


def line_features(text: str | None) -> tuple[np.ndarray, list[int]]:
    """A row of features for each line with a word, and the words of each."""
    rows, sizes, seen = [], [], set()
    for line in (text or "").split("\n"):
        found = _WORD.findall(line)
        if not found:
            continue
        n, last = len(found), found[-1]
        symbols = sum(map(line.count, _SYMBOLS))
        upper = sum(w.isupper() for w in found)
        digits = sum(w.isdigit() for w in found)
        rows.append(
            (
                1.0,
                min(2.0, symbols / n),
                min(2.0, line.count("!") / n),
                upper / n,
                min(1.0, 2 * line.count("|") / n),
                digits / n,
                0.0 if last.endswith(_ENDS) else 1.0,
                1.0 if n < 4 else 0.0,
                1.0 if line in seen else 0.0,
            )
        )
        seen.add(line)
        sizes.append(n)
    return np.array(rows, dtype=np.float64).reshape(len(rows), _FEATURES), sizes


@dataclass(frozen=True)
class LineCrf:
    """Two labels, 0 content and 1 boilerplate. emit: features x 2; move: label x next label."""

    emit: np.ndarray
    move: np.ndarray

    def viterbi(self, rows: np.ndarray) -> list[int]:
        """The most probable labels of a sequence of lines; content wins ties."""
        (aa, ab), (ba, bb) = self.move.tolist()
        scores = (rows @ self.emit).tolist()
        if not scores:
            return []
        a, b = scores[0]
        came = []
        for x, y in scores[1:]:
            to_a, to_b = int(b + ba > a + aa), int(b + bb > a + ab)
            came.append((to_a, to_b))
            a, b = x + (b + ba if to_a else a + aa), y + (b + bb if to_b else a + ab)
        labels = [int(b > a)]
        for step in reversed(came):
            labels.append(step[labels[-1]])
        return labels[::-1]


def fit_crf(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 120, rate: float = 0.1, shrink: float = 1e-3) -> LineCrf:
    """Maximum likelihood with a quadratic penalty, by forward-backward and Adam steps on padded batches.

    A sequence is a document's lines and a label for each. Documents weigh the same, and so do those with and without
    boilerplate. Without both labels the model says content.
    """
    sequences = [s for s in sequences if len(s[0])]
    emit, move = np.zeros((_FEATURES, 2)), np.zeros((2, 2))
    if len({int(y) for _, labels in sequences for y in labels}) < 2:
        emit[0, 0] = 1.0
        return LineCrf(emit, move)
    n, longest = len(sequences), max(len(x) for x, _ in sequences)
    feats, gold = np.zeros((n, longest, _FEATURES)), np.zeros((n, longest, 2))
    for i, (x, labels) in enumerate(sequences):
        feats[i, : len(x)], gold[i, np.arange(len(x)), labels] = x, 1.0
    real = gold.any(2)
    kind = gold[:, :, 1].any(1).astype(int)
    weight = (0.5 / (np.bincount(kind, minlength=2) / n))[kind] / n / real.sum(1)
    each = weight[:, None, None] * real[:, :, None]
    seen_emit = np.einsum("ntf,ntc->fc", feats, gold * each)
    seen_move = np.einsum("nta,ntb->ab", gold[:, :-1], (gold * each)[:, 1:])
    params, first, second = np.concatenate([emit.ravel(), move.ravel()]), 0.0, 0.0
    for step in range(1, rounds + 1):
        emit, move = params[: 2 * _FEATURES].reshape(_FEATURES, 2), params[2 * _FEATURES :].reshape(2, 2)
        score = feats @ emit
        ahead, back = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            new = np.logaddexp(ahead[:, t - 1, :1] + move[0], ahead[:, t - 1, 1:] + move[1]) + score[:, t]
            ahead[:, t] = np.where(real[:, t, None], new, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            out = score[:, t + 1] + back[:, t + 1]
            back[:, t] = np.where(real[:, t + 1, None], np.logaddexp(out[:, :1] + move[:, 0], out[:, 1:] + move[:, 1]), 0.0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        one = np.exp(np.minimum(ahead + back - total[:, None, None], 0)) * each
        two = np.exp(np.minimum(ahead[:, :-1, :, None] + move + (score + back)[:, 1:, None, :] - total[:, None, None, None], 0)) * each[:, 1:, :, None]
        grad = np.concatenate([(np.einsum("ntf,ntc->fc", feats, one) - seen_emit).ravel(), (two.sum((0, 1)) - seen_move).ravel()]) + shrink * params
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        params = params - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return LineCrf(params[: 2 * _FEATURES].reshape(_FEATURES, 2), params[2 * _FEATURES :].reshape(2, 2))


def fit_documents(documents: list[tuple[np.ndarray, int]]) -> LineCrf:
    """Fit on the lines of documents of which only the whole has a label, 0 content or 1 boilerplate.

    A first field takes the document's label for all its lines. Lines of boilerplate documents that by themselves look like
    content to it are content for the second field, unless all of them do. So the second one learns where labels change.
    """
    first = fit_crf([(x, np.full(len(x), y)) for x, y in documents])
    relabelled = []
    for x, y in documents:
        scores = x @ first.emit
        own = (scores[:, 1] > scores[:, 0]).astype(int) if y else np.zeros(len(x), int)
        relabelled.append((x, own if own.any() or not y else np.full(len(x), y)))
    return fit_crf(relabelled)


def train_crf(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", docs_each: int = TRAIN_DOCS) -> LineCrf:
    """Fit on labelled documents: the lines of quality 1 as content, those of quality 0 as boilerplate.

    The sample is bounded: ``docs_each`` documents of each quality, those whose ids hash least, and TRAIN_LINES
    lines of each, spread evenly over the document. Only line features are gathered, no texts. A document with both
    labels, or none, is left out.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("r")).where("q = r")
    picked = [known.where(F.col("q") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(docs_each) for q in (0, 1)]
    chosen = picked[0].union(picked[1]).select(F.col("doc_id").alias(id_col), F.col("q").cast("int").alias("q"))

    @F.pandas_udf("array<array<double>>")
    def features(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            rows = line_features(t)[0]
            at = np.unique(np.linspace(0, max(len(rows) - 1, 0), TRAIN_LINES).round().astype(int)) if len(rows) > TRAIN_LINES else slice(None)
            out.append(rows[at].tolist())
        return pd.Series(out)

    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).groupBy(id_col, "q").agg(F.min(text_col).alias("t")).select("q", features("t").alias("x"), id_col).collect()
    rows.sort(key=lambda r: r[2])
    return fit_documents([(np.array(r.x, dtype=np.float64).reshape(-1, _FEATURES), 1 - r.q) for r in rows])


def assess(docs: DataFrame, crf: LineCrf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, the base counts, base_failed, kept and content_share.

    base_failed: fewer than 10 words, or over 20 of 100 words repeated. Else a document is kept if CONTENT_SHARE or more of
    its words are in lines that the field labels content. Null, empty and blank texts have no words and fail.
    Ids may be null and may repeat; other columns of ``docs`` are not read.
    """
    out = _verdicts(crf)(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), out.alias("r")).select("doc_id", "r.*")


def _verdicts(crf: LineCrf):
    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            n, chars, symbols, copies, repeated = base_rules(t)
            failed = n < 10 or 100 * repeated > 20 * n
            feats, sizes = line_features(t)
            content = sum(s for s, label in zip(sizes, crf.viterbi(feats), strict=True) if not label)
            share = content / n if n else 0.0
            rows.append((n, chars, symbols, copies, repeated, failed, not failed and share >= CONTENT_SHARE, share))
        return pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"])

    return of


def kept_documents(docs: DataFrame, crf: LineCrf, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``assess`` keeps, with all columns as they are."""
    mark = free_name(docs, "verdict")
    return docs.withColumn(mark, _verdicts(crf)(F.col(text_col))).where(F.col(mark)["kept"]).select(docs.columns)
