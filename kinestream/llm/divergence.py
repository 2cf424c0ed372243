"""Source divergence audit: how the word use of each source differs from the other sources of its language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinestream.llm.common import written

#: What separates terms, once A-Z are lower case.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: A language keeps the terms of so many of its documents; so much is added to each count; shares are in units of 1 / SCALE.
LEAST_DOCS, PRIOR, SCALE = 30, 5, 1_000_000_000
#: Ranks of part ``term``.
TOP = 50
#: Bytes of text that are split at a time (a longer text goes alone), and partial rows that a task merges before it hands them on.
SLICE_BYTES, MERGE_ROWS = 8 << 20, 300_000
#: Terms of a shard, and sources of a block: a shard is a dense matrix of at most SHARD_TERMS x 2 * SOURCES counts.
SHARD_TERMS, SOURCES = 256, 256

_PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_MOST = (1 << 63) - 1


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term) in batches of (lang, source, text); a row without term for each (lang, source)."""
    held, rows = [], 0
    for batch in batches:
        for part in _slices(batch):
            held.append(_counted(part))
            rows += len(held[-1])
            if rows > MERGE_ROWS:
                held = [_merged(held)]
                rows = len(held[0])
                if rows > MERGE_ROWS // 2:
                    yield from held[0].to_batches(50_000)
                    held, rows = [], 0
    if held:
        yield from _merged(held).to_batches(50_000)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right")))
        yield batch.slice(at, until - at)
        at = until


def _counted(batch: pa.RecordBatch) -> pa.Table:
    lists = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), BETWEEN)
    terms, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.not_equal(terms, "")
    coded = pc.dictionary_encode(terms.filter(real))
    lang, source = (pc.dictionary_encode(batch.column(c)) for c in ("lang", "source"))
    group = pc.add(pc.multiply(lang.indices.cast("int64"), len(source.dictionary)), source.indices.cast("int64"))
    each = pa.table({"row": row.filter(real).cast("int64"), "term": coded.indices}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    each = pa.table({"g": group.take(each["row"]), "term": each["term"], "n": each["count_all"]}).group_by(["g", "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    seen = group.unique()

    def named(g):
        return [lang.dictionary.take(pc.divide(g, len(source.dictionary))), source.dictionary.take(pc.subtract(g, pc.multiply(pc.divide(g, len(source.dictionary)), len(source.dictionary))))]

    none = pa.array(np.zeros(len(seen), np.int64))
    marks = pa.table([*named(seen), pa.array([""] * len(seen)), none, none], schema=_PARTIAL)
    return pa.concat_tables([pa.table([*named(each["g"]), coded.dictionary.take(each["term"]), each["n_sum"], each["count_all"]], schema=_PARTIAL), marks])


def _merged(tables: list[pa.Table]) -> pa.Table:
    total = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return total.rename_columns(["lang", "source", "term", "n", "docs"])


def shares(counts: np.ndarray, sizes: np.ndarray, kept: int) -> np.ndarray:
    """p of each count of a group of ``sizes`` occurrences of ``kept`` terms, exact."""
    below = sizes + PRIOR * kept
    if counts.max(initial=0) > _MOST // SCALE - PRIOR or np.max(sizes, initial=0) > _MOST - PRIOR * kept:
        return 1 + (SCALE * (counts.astype(object) + PRIOR)) // (np.asarray(sizes).astype(object) + PRIOR * kept)
    return 1 + SCALE * (counts + PRIOR) // below


_SHARD = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def shard_divergences(key: tuple, counts: pa.Table, groups: pa.Table) -> pa.Table:
    """One shard of a language's terms: its part of the distance of each two sources, and the TOP terms of each source.

    counts: source, term, n, total of the language. groups: source, its block, size, the language's size and number of kept terms.
    Distances are of what the shard's terms differ by more than a term that neither source has; the first shard adds what all
    kept terms would differ by if neither had any.
    """
    lang, shard, left, right = (k.as_py() for k in key)
    names = groups["source"].to_pylist()
    block = groups["block"].to_numpy()
    sizes, size_all, kept = groups["size"].to_numpy(), groups["lang_size"][0].as_py(), groups["kept"][0].as_py()
    coded = pc.dictionary_encode(counts["term"]).combine_chunks()
    terms = coded.dictionary.to_pylist() if len(counts) else []
    dense, total = np.zeros((len(terms), len(names)), np.int64), np.zeros(len(terms), np.int64)
    if len(counts):
        at, col = coded.indices.to_numpy(), pc.index_in(counts["source"], groups["source"].combine_chunks()).to_numpy()
        dense[at, col] = counts["n"].to_numpy()
        total[at] = counts["total"].to_numpy()
    out: dict[str, list] = {name: [] for name in _SHARD.names}
    if kept:
        p, empty = shares(dense, sizes, kept), shares(np.zeros_like(sizes), sizes, kept)
    else:
        p, empty = dense, np.zeros_like(sizes)

    def add(source, part, items, values):
        out["source"] += [source] * len(items)
        out["part"] += [part] * len(items)
        out["item"] += items
        out["value"] += [int(v) for v in values]

    for a, name in enumerate(names):
        others = np.flatnonzero((block == right if block[a] == left else block == left) & (np.arange(len(names)) != a))
        apart = np.abs(empty[others] - empty[a])
        value = np.abs(p[:, others] - p[:, [a]]).sum(0) + (kept * (shard == 0) - len(terms)) * apart
        add(name, "pair", [names[b] for b in others], value)
    if left == right and terms:
        q = shares(total, np.array([size_all]), kept)
        for a, name in enumerate(names):
            more = np.flatnonzero((dense[:, a] > 0) & (p[:, a] > q))
            f = p[more, a] - q[more]
            best = sorted(zip((-f).tolist(), [terms[i].encode() for i in more], strict=True))[:TOP]
            add(name, "term", [t.decode() for _, t in best], [-f for f, _ in best])
    out["lang"] = [lang] * len(out["source"])
    return pa.table(out, schema=_SHARD)


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank: distances of sources (part ``pair``) and what each overuses (part ``term``).

    Null texts, languages and sources are read as ''. Equal rows count as often as they occur; ids and other columns are not
    read. A language without a kept term still has its pairs, with value 0. A table without rows gives none.

    Counting splits texts in Arrow batches and merges within the task; the shuffle deals (lang, source, term), so a source or a term with a
    third of all rows is spread or a single row. Distances are added over shards of terms, each a dense matrix of bounded size.
    """
    text = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    found = text.mapInArrow(partial_counts, "lang string, source string, term string, n long, docs long")
    merged = written(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    real = merged.where("term != ''")
    kept = real.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).where(F.col("docs") >= least_docs).select("lang", "term", "total")
    counts = written(real.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "kept-counts")
    per_lang = counts.select("lang", "term", "total").distinct().groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_size"))
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    zero = F.lit(0).cast("long")
    groups = (
        merged.where("term = ''")
        .select("lang", "source")
        .join(sizes, ["lang", "source"], "left")
        .join(per_lang, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("size", "lang_size", "kept")])
        .withColumn("block", F.floor((F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1) / SOURCES))
    )
    last = groups.groupBy("lang").agg(F.max("block").alias("last"), F.max(F.ceil(F.col("kept") / SHARD_TERMS)).alias("shards"))

    def dealt(df: DataFrame) -> DataFrame:
        """Each row once for each pair of blocks that its source's block is in."""
        pairs = F.transform(F.sequence(zero, F.col("last")), lambda o: F.struct(F.least(o, "block").alias("left_block"), F.greatest(o, "block").alias("right_block")))
        return df.withColumn("pair", F.explode(pairs)).select("*", "pair.*").drop("pair", "last", "shards")

    groups = written(groups.join(last, "lang"), "term-groups")
    apart = groups.toDF(*groups.columns)  # columns of their own, as both sides of the cogroup come from this table
    of_group = apart.withColumn("shard", F.explode(F.sequence(zero, F.greatest(F.col("shards") - 1, zero))))
    of_count = counts.join(groups.select("lang", "source", "block", "last", "shards"), ["lang", "source"]).withColumn("shard", F.pmod(F.xxhash64("term"), "shards"))
    keys = ["lang", "shard", "left_block", "right_block"]
    parts = dealt(of_count).groupBy(keys).cogroup(dealt(of_group).groupBy(keys)).applyInArrow(shard_divergences, "lang string, source string, part string, item string, value long")
    parts = written(parts, "shard-divergences")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", rank)
    return pairs.union(parts.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= TOP))  # Spark cuts each task's part of a source to TOP before it shuffles


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
z AS (SELECT lang, source, sum(n) AS size FROM c GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + {PRIOR})) // (coalesce(z.size, 0) + {PRIOR} * v.v) AS p,
             1 + ({SCALE}::HUGEINT * (k.total + {PRIOR})) // (v.n + {PRIOR} * v.v) AS q
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN z USING (lang, source)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM o)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {TOP}
"""
