"""Secrets in texts: all rules as one minimal automaton, one pass over the bytes."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.llm.automaton import Scanner

#: The kinds in the order in which equal starts are listed, and their rules: what a match starts
#: with, and the set of one or more characters that it goes on with as long as it can.
RULES = {
    "assign": (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?", r"[A-Za-z0-9+/_.=-]"),
    "access": (r"AKIA", r"[A-Z0-9]"),
    "hex": (r"[0-9a-f]{31}", r"[0-9a-f]"),
    "github": (r"gh[pousr]_", r"[A-Za-z0-9]"),
    "slack": (r"xox[abpr]-", r"[A-Za-z0-9-]"),
    "jwt": (r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", r"[A-Za-z0-9_-]"),
    "google": (r"AIza", r"[A-Za-z0-9_-]"),
    "pem": (r"-----BEGIN(\x20[A-Z0-9]+)*\x20PRIVATE\x20KEY-----", r"[A-Za-z0-9+/=\x0A\x0D]"),
}
#: Characters that a match must have, checked after the scan. The automaton itself counts those of hex.
LEAST = {"access": 16, "github": 40, "slack": 15, "jwt": 36, "google": 39}
BASE = ("assign", "access", "hex")
_KINDS = list(RULES)
#: The value that an assignment must have: so many characters.
_VALUE = 8


@lru_cache(1)
def scanner() -> Scanner:
    """The compiled rules, once in each Python worker."""
    return Scanner(RULES)


def secret_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each secret, in code points, end exclusive, by start and then kind as listed.

    A match that is too short (an assignment: with a value of fewer than 8 characters) is dropped and not tried
    again. Kinds may overlap.
    """
    text = text or ""
    raw = text.encode()
    found = []
    for start, end, rule, first in scanner().spans(raw):
        kind = _KINDS[rule]
        if kind == "assign" and end - first < _VALUE:
            continue
        if end - start >= LEAST.get(kind, 0):
            found.append((start, end, kind))
    if len(raw) != len(text):
        places, at, seen = {}, 0, 0
        for p in sorted({x for s, e, _ in found for x in (s, e)}):
            seen += len(raw[at:p].decode())
            at = places[p] = p
            places[p] = seen
        found = [(places[s], places[e], k) for s, e, k in found]
    return [(k, s, e) for s, e, k in found]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Null texts count as empty and have no secrets: spans is the empty string and base_sha256 its digest. Ids may be
    null and may repeat; other columns of ``docs`` are not read.
    """

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            spans = secret_spans(t)
            base = [x for x in spans if x[0] in BASE]
            rows.append((*(sum(k == kind for k, _, _ in base) for kind in BASE), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col(id_col).alias("doc_id"), of(F.col(text_col)).alias("r")).select("doc_id", "r.*")


def redacted(text: Column) -> Column:
    """The text with each secret replaced by ``[kind]``; overlapping ones are replaced as one, by the first's kind.

    Null stays null; a text without secrets stays as it is.
    """

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            parts, at = [], 0
            until, kind = 0, None
            for k, s, e in secret_spans(t):
                if kind is not None and s < until:
                    until = max(until, e)
                    continue
                if kind is not None:
                    parts.append(f"[{kind}]")
                    at = until
                parts.append(t[at:s])
                until, kind = e, k
            if kind is None:
                out.append(t)
            else:
                out.append("".join([*parts, f"[{kind}]", t[until:]]))
        return pd.Series(out, dtype=object)

    return of(text)
