"""Token counts of texts of any length: overlapping chunks, spliced at stable common boundaries."""

from __future__ import annotations

import re
from bisect import bisect_left

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinestream.llm.bpe import SPACES, WordBPE, load

#: Characters of a chunk and of the first overlap of two chunks.
CHUNK, OVERLAP = 32_768, 256
_SPACE = re.compile(f"[{SPACES}]")
_RUN = re.compile(f"[^{SPACES}]+")


def _chunk(bpe: WordBPE, text: str, start: int, stop: int) -> tuple[list[int], list[int], list[int]]:
    """Encode text[start:stop]: where each run of tokens starts and ends in the text, and its number of tokens."""
    starts, ends, counts = [], [], []
    for m in _RUN.finditer(text, start, stop):
        starts.append(m.start())
        ends.append(m.end())
        counts.append(len(bpe.known.get(m[0]) or bpe.segment(m[0])))
    return starts, ends, counts


def count_tokens(bpe: WordBPE, text: str | None, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of a text, in memory that a chunk bounds.

    Two neighbouring chunks are spliced where both have a boundary of tokens with white space before it and
    agree on the run behind it. White space ends every pre-token, so what stands before such a place can't
    change the tokens after it: the boundary is proven stable. If the overlap has none (a run longer than the
    overlap), the left chunk is widened by twice as much until there is one or the text ends.
    """
    text = text or ""
    if len(text) <= chunk:
        return sum(map(len, bpe.pieces(text)))
    total, start = 0, 0
    stop = chunk
    while True:
        wide = overlap
        while True:
            end = min(len(text), stop + wide)
            starts, ends, counts = _chunk(bpe, text, start, end)
            if end == len(text):
                return total + sum(counts)
            right = _chunk(bpe, text, stop, min(len(text), end))
            agreed = {s: e for s, e in zip(right[0], right[1], strict=True) if s > stop and e < end and _SPACE.match(text, s - 1)}
            at = next((s for s, e in zip(starts, ends, strict=True) if agreed.get(s) == e), None)
            if at is not None:
                break
            wide *= 2
        total += sum(counts[: bisect_left(starts, at)])
        start, stop = at, at + chunk


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    Null texts count as empty: no bytes, no tokens. Ids may be null and may repeat; other columns are not read.
    """

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        bpe = load(path)
        return pd.Series([count_tokens(bpe, t) for t in texts], dtype="int64")

    text = F.col(text_col)
    counted = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), of(text).alias("n_tokens"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
