"""Source divergence audit against plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from kinestream.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, least):
    docs = [(t or "", lang or "", s or "") for t, lang, s in rows]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(low)) for t, _, _ in docs]
    held, groups = defaultdict(Counter), defaultdict(set)
    for (_, lang, s), found in zip(docs, terms, strict=True):
        held[lang].update(set(found))
        groups[lang].add(s)
    out = []
    for lang, sources in groups.items():
        kept = {t for t, n in held[lang].items() if n >= least}
        count = {s: Counter() for s in sources}
        for (_, at, s), found in zip(docs, terms, strict=True):
            if at == lang:
                count[s].update(t for t in found if t in kept)
        everywhere = sum(count.values(), Counter())

        def share(c, t):
            return 1 + 1_000_000_000 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))

        for s in sources:
            pairs = [(-sum(abs(share(count[s], t) - share(count[o], t)) for t in kept), o) for o in sources - {s}]
            over = [(share(everywhere, t) - share(count[s], t), t) for t in kept if count[s][t] and share(count[s], t) > share(everywhere, t)]
            for part, found, most in (("pair", pairs, None), ("term", over, 50)):
                out += [(lang, s, part, i, -v, k) for k, (v, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1].encode()))[:most], 1)]
    return sorted(out)


def of(spark, rows, **more):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    return sorted(tuple(r) for r in divergence.audit(df, **more).select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    vocabulary = ["Alpha", "beta", "ÄRGER", "ärger", "don't", "x9y", "naïve", "ZETA", "漢字", "İx", "a", "_b_"]
    sources = ["s1", "s2", "S10", "", None, "é"]
    rows = []
    for i in range(n):
        words = rng.choice(vocabulary, rng.integers(0, 12), p=rng.dirichlet(np.ones(len(vocabulary))))
        rows.append((" ".join(words) if i % 17 else None, ["en", "de", None][i % 3], sources[int(rng.integers(0, 2 + i % 5))]))
    return rows


@pytest.mark.parametrize("sources,terms", [(256, 256), (2, 3)])
def test_equals_plain_python(spark, monkeypatch, sources, terms):
    """Also with blocks of two sources and shards of three terms, so that all kinds of pairs of blocks occur."""
    monkeypatch.setattr(divergence, "SOURCES", sources)
    monkeypatch.setattr(divergence, "SHARD_TERMS", terms)
    rows = corpus(240, 1)
    assert of(spark, rows, least_docs=4) == brute(rows, 4)


def test_many_terms_have_ranks_to_fifty(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(130)]
    rows = [(" ".join(words[:120]), "en", "one"), (" ".join(words[10:]), "en", "two"), (None, "en", "three"), ("\x00\x07 12 --", "en", "four")]
    got = of(spark, rows, least_docs=1)
    assert got == brute(rows, 1) and max(r[5] for r in got if r[2] == "term") <= 50


def test_edges(spark):
    """No rows; only nulls; repeated rows; a language without kept terms; columns named like ours; a very long text."""
    assert of(spark, []) == []
    assert of(spark, [(None, None, None)] * 3) == []
    rows = [("word", "xx", "a"), ("word", "xx", "b"), (None, "xx", "c")] + [("One two two", "yy", "a")] * 40 + [("two", "yy", "b")]
    assert of(spark, rows) == brute(rows, 30)
    assert [r for r in of(spark, rows) if r[0] == "xx"] == [("xx", s, "pair", i, 0, k) for s in "abc" for k, i in enumerate([x for x in "abc" if x != s], 1)]
    long = [("ab CD, " * 400_000, "en", "s")] + [("cd", "en", "t")] * 2
    assert of(spark, long, least_docs=1) == brute(long, 1)
    df = spark.createDataFrame([(1, "a b", "en", "s", "x", 7, 8, 9), (2, "b", "en", "t", "y", 7, 8, 9)], SCHEMA + ", term string, n int, block int, kept int")
    assert sorted(tuple(r) for r in divergence.audit(df, least_docs=1).collect()) == brute([("a b", "en", "s"), ("b", "en", "t")], 1)


def test_shares_are_exact_beyond_64_bits():
    counts, sizes = np.array([[3, 4 * 10**12]]), np.array([10**13, 5 * 10**12])
    assert divergence.shares(counts, sizes, 7).tolist() == [[1 + 10**9 * 8 // (10**13 + 35), 1 + 10**9 * (4 * 10**12 + 5) // (5 * 10**12 + 35)]]


def test_tasks_hand_on_what_they_merge(monkeypatch):
    """Small limits: every slice is a text of its own and partial tables are handed on often; the sums stay the same."""
    import pyarrow as pa

    monkeypatch.setattr(divergence, "SLICE_BYTES", 1)
    monkeypatch.setattr(divergence, "MERGE_ROWS", 5)
    rows = [(t or "", lang or "", s or "") for t, lang, s in corpus(80, 2)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows]), pa.array([r[0] for r in rows])], names=["lang", "source", "text"])
    parts = [*divergence.partial_counts(iter([batch]))]
    assert len(parts) > 5
    total = Counter()
    for p in parts:
        for r in p.to_pylist():
            total[r["lang"], r["source"], r["term"]] += r["n"]
    want = Counter()
    for t, lang, s in rows:
        want.update((lang, s, w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)))
    assert +total == want
