"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks that lose no match, exact verification.

DataFrame functions only. Words are in lower case; a shingle is five words, or the whole item if it has fewer. Texts that
are equal are looked through once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.llm.common import differing, free_name, words, written

SHINGLE, SIMILARITY = 5, 0.8
#: Up to so many shingles of all items, what is looked up is broadcast (2 rows of some 100 bytes for nine shingles); a larger benchmark is shuffled.
BROADCAST_SHINGLES = 200_000
#: Of a document's shingles each STRIDE-th is looked up. See ``_positions``.
STRIDE = 4


def _hash(w: Column, at: Column, size: int) -> Column:
    """The hash of the shingle of ``size`` words from place ``at`` on."""
    return F.xxhash64(*[F.get(w, at + i) for i in range(size)])


def _hashes(w: Column, first: Column, last: Column, size: int) -> Column:
    """The hashes of the shingles from place ``first`` to ``last``."""
    return F.when(last >= first, F.transform(F.sequence(first, last), lambda p: _hash(w, p, size))).otherwise(F.array().cast("array<long>"))


def simhash(hashes: Column, planes: int) -> Column:
    """A long whose bits are set where over half of the hashes have them set.

    All 64 counts are kept at once, as binary digits: plane i holds digit i of each count, and a hash is added to the
    planes with carries. ``planes`` digits count to 2 ** planes - 1 hashes.
    """
    zero = F.lit(0).cast("long")
    start = F.struct(*[zero.alias(f"p{i}") for i in range(planes)])

    def add(state: Column, h: Column) -> Column:
        made, carry = [], h
        for i in range(planes):
            made.append(state[f"p{i}"].bitwiseXOR(carry).alias(f"p{i}"))
            carry = state[f"p{i}"].bitwiseAND(carry)
        return F.struct(*made)

    def over_half(state: Column) -> Column:
        half = F.floor(F.size(hashes) / 2).cast("long")
        more, same = zero, F.lit(-1).cast("long")
        for i in reversed(range(planes)):
            digit = state[f"p{i}"]
            want = F.negate(F.shiftright(half, i).bitwiseAND(F.lit(1)))
            more = more.bitwiseOR(same.bitwiseAND(digit).bitwiseAND(F.bitwise_not(want)))
            same = same.bitwiseAND(F.bitwise_not(digit.bitwiseXOR(want)))
        return more

    return F.aggregate(hashes, start, add, over_half)


def classes(m: Column) -> Column:
    """The number of classes for items of ``m`` shingles: one more than the classes in which a window that matches can differ.

    At a similarity of 0.8 sets of a and m shingles, repeats counted, have 4 (a + m) / 9 in common, so (a + m) / 9 are in one of
    them only. A window has no more shingles than its item, which makes 2 m / 9 at most.
    """
    return F.floor(m * 2 / 9).cast("int") + 1


def prints(hashes: Column, planes: int, m: Column | None = None) -> Column:
    """The print as an array of longs: a SimHash of each class of the hashes, which are dealt to ``classes`` by their remainder.

    m: the number of shingles of the item that a window is compared with; for items their own.
    """
    count = classes(F.size(hashes) if m is None else m)
    # A class is bound to a lambda's variable, else it would be filtered anew for each plane.
    own = F.transform(F.sequence(F.lit(0), count - 1), lambda c: F.filter(hashes, lambda h: F.pmod(h, count) == c))
    return F.transform(own, lambda x: simhash(x, planes))


def _blocks(print_: Column) -> Column:
    """All blocks of a print, number and bits: each class is one. Prints that match agree on a block, as they differ in fewer than there are."""
    return F.transform(print_, lambda word, i: F.struct(i.alias("block"), word.alias("bits")))


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, n (words), size (words of a shingle) and hashes of each item that has a word."""
    w = benchmark.select(F.col(id_col).alias("item_id"), words(F.lower(text_col)).alias("w")).withColumn("n", F.size("w")).where("n > 0")
    by_size = F.when(F.col("n") >= SHINGLE, _hashes(F.col("w"), F.lit(0), F.col("n") - SHINGLE, SHINGLE))
    for size in range(1, SHINGLE):
        by_size = by_size.when(F.col("n") == size, F.array(_hash(F.col("w"), F.lit(0), size)))
    return w.select("item_id", "n", F.least("n", F.lit(SHINGLE)).alias("size"), by_size.alias("hashes")).distinct()


def _positions(n: Column, size: int, stride: int) -> Column:
    """The places whose shingles are looked up.

    A window that reaches the similarity with m shingles of its own has at most m / 9 that the item lacks. Of any m >= 4
    places in a row each fourth is more than that (m // 4 > m // 9), so a place is looked up whose shingle the
    item has. Shorter documents, and benchmarks with items of fewer shingles, are looked up at every place.
    """
    step = F.when(n < SHINGLE + 7, 1).otherwise(stride)
    return F.when(n >= size, F.sequence(F.lit(0), n - size, step)).otherwise(F.array().cast("array<int>"))


def text_marks(text: Column) -> list[Column]:
    """Two independent hashes that stand for a text."""
    return [F.xxhash64(text).alias("mark"), F.xxhash64(F.lit(1), text).alias("mark2")]


MARK = ["mark", "mark2"]


def _looked_up(docs: DataFrame, items: DataFrame, size: int, stride: int, small: bool, text_col: str) -> DataFrame:
    """mark, mark2, n, ps: the places of each text whose shingle an item of n words has."""
    # The words are bound to a lambda's variable, else the text would be split for each place.
    look_up = lambda w: F.transform(_positions(F.size(w), size, stride), lambda p: F.struct(p.alias("p"), _hash(w, p, size).alias("h")))
    places = docs.select(*text_marks(F.col(text_col)), F.inline(F.transform(F.array(words(F.lower(text_col))), look_up)[0]))
    sizes = items.where(F.col("size") == size).select("n", F.explode("hashes").alias("h")).distinct()
    return places.join(F.broadcast(sizes) if small else sizes, "h").groupBy(*MARK, "n").agg(F.collect_set("p").alias("ps"))


def _windows(met: DataFrame, texts: DataFrame, size: int, stride: int) -> DataFrame:
    """Item-sized windows that hold a looked-up shingle of an item of their size: mark, mark2, n, start, hashes."""
    both = texts.select(*MARK, words(F.lower("text")).alias("w")).join(met, MARK)
    m = F.col("n") - size + 1
    last = F.greatest(F.size("w") - F.col("n"), F.lit(0))
    starts = F.array_distinct(F.flatten(F.transform("ps", lambda p: F.sequence(F.greatest(p - m + 1, F.lit(0)), F.least(F.greatest(p, F.lit(0)), last)))))
    # A window that can match has as many of the looked-up places as this.
    least = F.when(F.size("w") >= F.col("n"), F.greatest(F.floor(m / stride) - F.floor(m / 9), F.lit(1))).otherwise(1)
    starts = F.filter(starts, lambda s: F.size(F.filter("ps", lambda p: (p >= s) & (p < s + m))) >= least)
    # p may be past the last window's start: such a window starts at ``last``.
    spread = both.select(*MARK, "n", "w", F.explode(starts).alias("start"))
    end = F.least(F.col("start") + m - 1, F.size("w") - size)
    return spread.select(*MARK, "n", "start", _hashes(F.col("w"), F.col("start"), end, size).alias("hashes"))


def _common(a: Column, b: Column) -> Column:
    """The number of elements that two arrays have in common, repeats included."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    counted = F.aggregate(F.array_distinct(b), F.lit(0), lambda n, x: n + F.least(F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(counted)


def matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(mark, mark2, item_id, similarity, start, n_words) of each distinct text of ``docs`` and item that some window matches.

    A window has as many words as the item, or all words of a shorter text. It matches if the weighted Jaccard similarity of its
    shingles with the item's (repeats counted) is 0.8 or more. Windows without any of the item's shingles can't match and are passed
    over; all others get a print, and items of their size with which they share a block of it and from which they differ in no more blocks than a match can
    are compared exactly. No match is lost: see ``classes``. similarity and start are the best window's, the first of equals. mark and mark2 are ``text_marks``.
    Null, empty and blank texts and items match nothing.

    The benchmark is the stated query set: what is looked up of it is broadcast if it is small (BROADCAST_SHINGLES, counted first), else shuffled.
    """
    spark = docs.sparkSession
    items = benchmark_items(benchmark, item_id, item_text)
    sums = items.select("size", "n", F.size("hashes").alias("m")).groupBy("size").agg(F.min("m").alias("least"), F.max("m").alias("most"), F.sum("m").alias("all")).collect()
    if not sums:
        return spark.createDataFrame([], f"mark long, mark2 long, item_id {benchmark.select(item_id).dtypes[0][1]}, similarity double, start int, n_words int")
    small = sum(r["all"] for r in sums) <= BROADCAST_SHINGLES
    found = []
    for row in sorted(sums):
        stride = STRIDE if row["size"] == SHINGLE and row["least"] >= STRIDE else 1
        met = written(_looked_up(docs, items, row["size"], stride, small, text_col), "looked-up")
        own = docs.select(*text_marks(F.col(text_col)), F.col(text_col).alias("text")).join(met.select(*MARK).distinct(), MARK, "left_semi")
        found.append(_windows(met, own.groupBy(*MARK).agg(F.first("text").alias("text")), row["size"], stride))
    planes = max(r["most"] for r in sums).bit_length()
    m = F.col("n") - F.least("n", F.lit(SHINGLE)) + 1
    windows = written(reduce(DataFrame.union, found).withColumn("print", prints(F.col("hashes"), planes, m)), "windows")
    index = written(items.select("item_id", "n", F.col("hashes").alias("of"), F.xxhash64("hashes").alias("item"), prints(F.col("hashes"), planes).alias("item_print")), "item-prints")
    slim = index.select("item", "n", F.size("of").alias("m"), "item_print", F.inline(_blocks(F.col("item_print")))).distinct()
    window = [*MARK, "n", "start"]
    keyed = windows.select(*window, F.size("hashes").alias("a"), "print", F.inline(_blocks(F.col("print"))))
    met = keyed.join(F.broadcast(slim) if small else slim, ["n", "block", "bits"]).where(differing(F.col("print"), F.col("item_print")) * 9 <= F.col("a") + F.col("m"))
    pairs = met.select(*window, "item").distinct()
    near = pairs.join(windows.select(*window, "hashes"), window).join(F.broadcast(index) if small else index, ["n", "item"])
    both = _common(F.col("hashes"), F.col("of"))
    scored = near.select(*MARK, "item_id", "start", F.col("n").alias("n_words"), F.size("hashes").alias("a"), F.size("of").alias("b"), both.alias("both"))
    similar = scored.select(*MARK, "item_id", "start", "n_words", (F.col("both") / (F.col("a") + F.col("b") - F.col("both"))).alias("similarity")).where(F.col("similarity") >= SIMILARITY)
    best = F.min_by(F.struct("similarity", "start", "n_words"), F.struct(-F.col("similarity"), F.col("start"))).alias("best")
    return similar.groupBy(*MARK, "item_id").agg(best).select(*MARK, "item_id", "best.*")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns: str) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words), one row for each id and item that matches; clean documents have none.

    Of several texts of an id the best match counts; null ids count as one id. See ``matches`` for the rest.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), *text_marks(F.col(text_col)))
    best = F.min_by(F.struct("similarity", "start", "n_words"), F.struct(-F.col("similarity"), F.col("start"), F.col("mark"))).alias("best")
    found = own.join(written(matches(docs, benchmark, text_col, **columns), "matches"), MARK).groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", F.round("best.similarity", 6).alias("similarity"), F.col("best.start").alias("start"), F.col("best.n_words").alias("n_words"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of which no window matches an item, with all columns as they are."""
    names, others = [free_name(docs, c) for c in MARK], [free_name(docs, f"{c}_gone") for c in MARK]
    gone = written(matches(docs, benchmark, text_col).select(*MARK).distinct().toDF(*others), "matches")
    marked = docs.withColumns(dict(zip(names, text_marks(F.col(text_col)), strict=True)))
    same = [F.col(c) == F.col(o) for c, o in zip(names, others, strict=True)]
    return marked.join(gone, same[0] & same[1], "left_anti").select(docs.columns)
