"""Near-duplicates by SimHash fingerprints: pigeonhole blocks, a join on blocks, a Hamming check."""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.llm.common import WORD, written
from kinestream.llm.components import connected_components
from kinestream.llm.near_copies import least_rows, row_order

_WORD = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Hashes whose bits are counted at a time: bounds the memory that a very long text takes.
_PART = 65_536


def fingerprint(text: str | None, size: int = 3) -> int:
    """The 64-bit SimHash of the word shingles of a text, unsigned; 0 without words.

    A bit is set if it is set in over half of the shingles' XXH64 (seed 42), repeats included.
    """
    found = _WORD.findall((text or "").translate(_LOWER))
    if not found:
        return 0
    shingles = map(" ".join, zip(*(found[i:] for i in range(size)), strict=False)) if len(found) >= size else [" ".join(found)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s.encode(), 42) for s in shingles), dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _PART):
        part = hashes[at : at + _PART]
        ones += np.unpackbits(part.view(np.uint8)).reshape(len(part), 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprint_column(text: Column, size: int = 3) -> Column:
    """``fingerprint`` as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, size) for t in texts], dtype=np.uint64).view(np.int64))

    return of(text)


def _keyed(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(key, rest, fp) for each choice of blocks - radius blocks of a print.

    Two prints that differ in ``radius`` bits or fewer agree on all blocks of some choice, and so share a
    key. rest: the print with the bits of the key set to zero.
    """
    edges = [64 * i // blocks for i in range(blocks + 1)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    masks = [sum((1 << edges[b + 1]) - (1 << edges[b]) for b in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    fp = F.col("fp")
    keys = [F.struct(F.struct(F.lit(i).alias("table"), fp.bitwiseAND(F.lit(signed(m))).alias("bits")).alias("key"), fp.bitwiseAND(F.lit(signed(~m & (1 << 64) - 1))).alias("rest"), F.lit(signed(~m & (1 << 64) - 1)).alias("free")) for i, m in enumerate(masks)]
    return prints.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.key", "k.rest", "k.free", "fp")


def close_pairs(prints: DataFrame, radius: int = 2, blocks: int = 4, hot: int = 24) -> DataFrame:
    """Edges (a, b) that connect all distinct prints (column fp) within ``radius`` differing bits.

    Blocks with up to ``hot`` prints are joined with themselves and verified by ``bit_count``. A block with
    more would give pairs by the square. There each print is listed under itself and under every print that
    differs from it in one free bit: two prints within two bits meet in such a list, and all that meet are
    within two bits, so a link to the least of each list connects the same prints. It holds for a radius of 2
    only; other radii join every block. Nothing is capped or dropped.
    """
    keyed = _keyed(prints, radius, blocks)
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = keyed.join(sizes, "key")
    few = shared if radius != 2 else shared.where(F.col("n") <= hot)
    left, right = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    pairs = left.join(right, "key").where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b")
    if radius != 2:
        return pairs.distinct()
    bits = F.array(F.lit(0).cast("long"), *[F.lit(x - (1 << 64) if x >> 63 else x) for x in (1 << i for i in range(64))])
    flips = F.filter(bits, lambda b: b.bitwiseAND(F.col("free")) == b)
    near = shared.where(F.col("n") > hot).select("key", "fp", F.explode(F.transform(flips, lambda b: F.col("rest").bitwiseXOR(b))).alias("as"))
    least = near.groupBy("key", "as").agg(F.min("fp").alias("b"), F.count("*").alias("m")).where("m > 1").select("key", "as", "b")
    stars = near.join(least, ["key", "as"]).where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2) -> DataFrame:
    """One row for each row of ``docs``: its id, its fingerprint and the component that it belongs to.

    component_id is the least id that is reached over links between fingerprints that differ in ``radius`` bits
    or fewer. Equal prints are one node, so copies are never paired. Null, empty and blank texts have the
    fingerprint zero and link like any other. Rows with a null id keep their row and count for no minimum:
    their component_id is null only if no row of the component has an id. Repeated rows give repeated rows.
    Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    rows = written(docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(F.col(text_col), size).alias("fp")), "prints")
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-prints")
    links = close_pairs(prints.select("fp"), radius)
    roots = connected_components(links).select(F.col("node").alias("fp"), "root")
    labelled = prints.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = labelled.join(ids, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component one row stays.

    It is the row with the least id, nulls last, then with the least hash of the text and of all columns. So two texts
    under one id are two rows, and rows with a null id are compared like others. All columns are returned as they are.
    """
    rows = docs.select(row_order(docs, id_col, text_col).alias("first"), fingerprint_column(F.col(text_col), size).alias("node"))
    nodes = written(rows.groupBy("node").agg(F.min("first").alias("first")), "distinct-prints")
    roots = connected_components(close_pairs(nodes.select(F.col("node").alias("fp")), radius))
    return least_rows(docs, nodes, roots)
