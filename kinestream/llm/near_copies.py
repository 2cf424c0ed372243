"""Near copies by SimHash of word shingles: blocks that no similar pair can avoid, a join on blocks, a Hamming check, the exact Jaccard similarity."""

from __future__ import annotations

import math
import re
from bisect import bisect_right

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinestream.llm.common import WORD, differing, free_name, sorted_side, written
from kinestream.llm.components import connected_components

_WORD = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SIZE = 5
#: The sizes of sets at which a level begins. Each is 1.5 times the one before or more, so sets that can be similar are of one level or of neighbouring ones.
_BORDERS = [1]
while _BORDERS[-1] < 1 << 40:
    _BORDERS.append(_BORDERS[-1] * 3 // 2 + 1)
#: Classes whose bits are counted at a time: bounds the memory that a very long text takes.
_PART = 4_096
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads each bit over all (SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int = SIZE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles; one of all words if there are fewer; none without words."""
    found = _WORD.findall((text or "").translate(_LOWER))
    if not found:
        return np.zeros(0, dtype=np.uint64)
    digest, known = xxhash.xxh64_intdigest, {}
    for w in found:
        if w not in known:
            known[w] = digest(w.encode("utf-8", "surrogatepass"), 42)
    one = np.fromiter((known[w] for w in found), dtype=np.uint64, count=len(found))
    width = min(size, len(one))
    n = len(one) - width + 1
    total = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        total = _mixed(total * _STEP + one[i : i + n])
    return np.unique(total)


def level(n: int) -> int:
    """The level of a set of ``n`` elements."""
    return bisect_right(_BORDERS, n) - 1


def classes(at: int) -> int:
    """The number of classes of a level's prints: over an eighth more than the classes in which two similar sets of the level can differ.

    At a similarity of 0.8 sets of n and m elements have 4 (n + m) / 9 in common, so (n + m) / 9 are in one of them only.
    """
    return 2 * (_BORDERS[at + 1] - 1) // 9 * 9 // 8 + 1


def simhashes(hashes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """A SimHash of each of ``count`` classes of the hashes, dealt by their remainder, and the classes' sizes. A bit is set if it is in over half of a class."""
    own = (hashes % np.uint64(count)).astype(np.int64)
    dealt, sizes = hashes[np.argsort(own, kind="stable")].astype(">u8"), np.bincount(own, minlength=count)
    filled, ends = np.flatnonzero(sizes), np.cumsum(sizes)
    out = np.zeros(count, dtype=np.uint64)
    for at in range(0, len(filled), _PART):
        part = filled[at : at + _PART]
        starts = ends[part] - sizes[part]
        bits = np.unpackbits(dealt[starts[0] : ends[part[-1]]].view(np.uint8)).reshape(-1, 64)
        ones = np.add.reduceat(bits, starts - starts[0], axis=0, dtype=np.int64)
        out[part] = np.packbits(ones * 2 > sizes[part, None], axis=1).view(">u8").ravel()
    return out, sizes


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The parities of the numbers of hashes with equal last bits, two of them or more for each hash, as 64-bit words.

    Each hash that only one of two sets has turns one parity, so sketches of one length differ in no more bits than their sets in hashes.
    The halves of a sketch, xored, are the sketch of half the length.
    """
    width = max(64, 1 << (2 * _BORDERS[level(max(len(hashes), 1)) + 1] - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def levels(n: int) -> list[int]:
    """The levels at which a set meets others: its own, and the next one if a set of that can be similar."""
    own = level(n)
    return [own, own + 1] if n * 5 // 4 >= _BORDERS[own + 1] else [own]


def blocks(hashes: np.ndarray, at: int) -> tuple[np.ndarray, int]:
    """The keys of a print's blocks at a level, of which two similar sets share one, and how many of them a set shares with a similar one at least.

    The sets differ in fewer classes than there are, so some class is the same in both. A set with more filled classes than its
    partners can differ in has such classes among the filled ones, and gives keys for these only; the few others give all.
    A key's last bit is the level's.
    """
    n = len(hashes)
    print_, sizes = simhashes(hashes, classes(at))
    filled = np.flatnonzero(sizes)
    least = len(filled) - (n + min(n * 5 // 4, _BORDERS[at + 1] - 1)) // 9
    if least <= 0:
        filled = np.arange(len(sizes))
    mixed = _mixed(print_[filled] ^ _mixed(filled.astype(np.uint64) * _STEP + np.uint64(at)))
    return mixed & ~np.uint64(1) | np.uint64(at & 1), max(least, 1)


def keyed_blocks(hashes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The keys of all blocks of a set, at all levels at which it meets others, and ``least`` by the level's last bit."""
    all_, least = [hashes[:0]], [1, 1]
    for at in levels(len(hashes)) if len(hashes) else []:
        own, least[at & 1] = blocks(hashes, at)
        all_.append(own)
    return np.concatenate(all_), least


def keys(hashes: np.ndarray) -> np.ndarray:
    """The keys of all blocks of a set."""
    return keyed_blocks(hashes)[0]


def _printed(text: Column) -> Column:
    """node (a hash of the shingle set), n (its size), blocks (its keys) and least."""

    @F.pandas_udf("node long, n int, blocks array<long>, least array<int>")
    def of(texts: pd.Series) -> pd.DataFrame:
        sets = [shingles(t) for t in texts]
        node = np.array([xxhash.xxh64_intdigest(s.tobytes(), 42) for s in sets], dtype=np.uint64).view(np.int64)
        made = [keyed_blocks(s) for s in sets]
        return pd.DataFrame({"node": node, "n": np.array([len(s) for s in sets], dtype=np.int32), "blocks": [k.view(np.int64) for k, _ in made], "least": [least for _, least in made]})

    return of(text)


def _listed(text: Column) -> Column:
    """list (the shingle set), its sketch, level, own (the print at its level) and above (the print at the next one, if it meets sets of that)."""

    @F.pandas_udf("list array<long>, sketch array<long>, level int, own array<long>, above array<long>")
    def of(texts: pd.Series) -> pd.DataFrame:
        sets = [shingles(t) for t in texts]
        prints = [[simhashes(s, classes(at))[0].view(np.int64) for at in levels(len(s))] if len(s) else [] for s in sets]
        none = np.zeros(0, dtype=np.int64)
        own, above = ([p[k] if len(p) > k else none for p in prints] for k in range(2))
        return pd.DataFrame({"list": [s.view(np.int64) for s in sets], "sketch": [sketch(s) for s in sets], "level": np.array([level(len(s)) for s in sets], dtype=np.int32), "own": own, "above": above})

    return of(text)


def row_mark(docs: DataFrame) -> Column:
    """A hash of all columns of a row. Nulls count, as xxhash64 alone passes over them; columns with maps, which have no hash, count as their JSON text."""
    shown = [F.to_json(F.struct(_named(f.name))) if "map<" in f.dataType.simpleString() else _named(f.name) for f in docs.schema.fields]
    return F.xxhash64(*[x for f, c in zip(docs.schema.fields, shown, strict=True) for x in (c, _named(f.name).isNull())])


def _named(column: str) -> Column:
    return F.col(f"`{column.replace('`', '``')}`")


def row_order(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """What rows are ordered by, for a minimum: the id, nulls last, then the text's hash, then the row's."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col), F.col(text_col).isNull()).alias("text"), row_mark(docs).alias("mark"))


def least_rows(docs: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the least of their component; of equal rows one.

    nodes: node and first, the least ``row_order`` of the node's rows. roots: node and root, for nodes that have links.
    """
    rooted = nodes.select("node", "first").join(sorted_side(roots.select("node", "root")), "node", "left")
    least = rooted.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    mark = free_name(docs, "mark")
    stays = written(least.select(F.col("first.mark").alias(mark)), "stays")
    marked = docs.withColumn(mark, row_mark(docs))
    twice = marked.groupBy(mark).agg(F.count("*").alias("n")).where("n > 1").select(mark).join(sorted_side(stays), mark, "left_semi")
    twice = written(twice, "stays-twice")
    if twice.isEmpty():
        return marked.join(sorted_side(stays), mark, "left_semi").select(*map(_named, docs.columns))
    once = stays.join(sorted_side(twice), mark, "left_anti")
    repeated = marked.join(twice, mark, "left_semi").dropDuplicates([mark])
    return marked.join(sorted_side(once), mark, "left_semi").union(repeated).select(*map(_named, docs.columns))


def _similar(common: Column, n: Column, m: Column) -> Column:
    """Whether sets of n and m elements with so many in common reach a Jaccard similarity of 0.8, in whole numbers."""
    return common * 9 >= (n + m) * 4


def _near(x: str, y: str) -> Column:
    """Whether the sketches of two sets, columns n and sketch of ``x`` and ``y``, and their sizes allow a similarity of 0.8. Such sets' sketches have one length or differ by half."""
    n, m, p, q = (F.col(f"{t}.{c}") for c in ("n", "sketch") for t in (x, y))

    def half(s: Column) -> Column:
        size = F.greatest((F.size(s) / 2).cast("int"), F.lit(1))
        return F.zip_with(F.slice(s, F.lit(1), size), F.slice(s, size + 1, size), lambda a, b: a.bitwiseXOR(b))

    p, q = F.when(F.size(p) > F.size(q), half(p)).otherwise(p), F.when(F.size(q) > F.size(p), half(q)).otherwise(q)
    bits = F.aggregate(F.zip_with(p, q, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, b: total + b)
    return (F.least(n, m) * 5 >= F.greatest(n, m) * 4) & (bits * 9 <= n + m)


def _rarest(met: DataFrame) -> DataFrame:
    """Of each set's keys (key, node, m: the key's sets, least) those by which it must meet its similar ones.

    Similar sets share ``least`` keys of a level or more. The rarest key that they share has so many others behind it, in any order that all sets have in common, so
    it is not among either set's last ``least`` - 1 keys. A set with fewer keys than ``least`` has no similar one.
    """
    even = F.col("key").bitwiseAND(F.lit(1)).cast("int")
    rank = F.row_number().over(Window.partitionBy("node", "even").orderBy(F.desc("m"), "key"))
    return met.withColumn("even", even).withColumn("rank", rank).where(F.col("rank") >= F.get("least", F.col("even")))


def _pairs(buckets: DataFrame) -> DataFrame:
    """Pairs a < b of one bucket (key, node, n, root) and different components whose sizes allow a similarity of 0.8."""
    x, y = buckets.alias("x"), buckets.alias("y")
    sized = F.least("x.n", "y.n") * 5 >= F.greatest("x.n", "y.n") * 4
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
    return x.join(sorted_side(y), apart & sized).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _with_sets(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` (a, b and other columns) with columns of the sets, p of a and q of b."""
    left, right = (sets.select(F.col("node").alias(node), F.struct(*columns).alias(to)) for node, to in (("a", "p"), ("b", "q")))
    return pairs.join(sorted_side(left), "a").join(sorted_side(right), "b")


def _near_pairs(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs whose sizes and sketches allow a similarity of 0.8."""
    return _with_sets(pairs, sketches, "n", "sketch").where(_near("p", "q")).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose prints differ in as many classes as their sizes allow or fewer, with a Jaccard similarity of 0.8 or more."""
    wanted = pairs.select("a").union(pairs.select("b")).distinct().toDF("node")
    both = _with_sets(pairs, written(sets.join(wanted, "node", "left_semi"), "verified"), "list", "level", "own", "above")
    # The prints are compared at the larger set's level.
    p, q = (F.when(F.col(f"{x}.level") >= F.col(f"{y}.level"), F.col(f"{x}.own")).otherwise(F.col(f"{x}.above")) for x, y in ("pq", "qp"))
    n, m = F.size("p.list"), F.size("q.list")
    near = both.where(differing(p, q) * 9 <= n + m)
    return near.where(_similar(F.size(F.array_intersect("p.list", "q.list")), n, m)).select("a", "b")


def _pivots(buckets: DataFrame) -> DataFrame:
    """key and pivot (wide, copies, node) of each bucket: the set whose buckets are largest, which is the one that most others resemble."""
    wide = buckets.groupBy("node").agg(F.sum("m").alias("wide"))
    return buckets.join(sorted_side(wide), "node").groupBy("key").agg(F.max(F.struct("wide", "copies", "node")).alias("pivot"))


def _far_pivots(buckets: DataFrame) -> DataFrame:
    """(a, b) for each set b of a bucket (key, node, pivot) and a set a, one for all of the bucket and itself among the b: the widest pivot that the bucket's pivot meets.

    So a set of a large group has few of them, however many of its buckets the group's own pivot misses.
    """
    far = buckets.groupBy("node").agg(F.max("pivot").alias("far")).select("node", F.col("far.node").alias("a"))
    found = buckets.select(F.col("node").alias("b"), F.col("pivot.node").alias("node")).distinct().join(sorted_side(far), "node").select("a", "b")
    return found.union(found.select("a", F.col("a").alias("b"))).distinct()


def _across(stars: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs a < b of sets of one pivot in different components that can be similar.

    ``stars``: pivot, node, n, common (elements that the node has of the pivot) and rest (those that it alone has, in order, as far as the
    prefix filter looks). Two similar sets of n and m elements have 4 (n + m) / 9 in common. Either their first common element that is not the
    pivot's stands early enough in both rests, or all that they have in common is the pivot's, and then both have as many of it.
    Other pairs can't be similar, so none is lost; those in the pivot's component need no comparison with each other.
    """
    rooted = stars.join(sorted_side(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    own = rooted.where("node = pivot").select("pivot", F.col("root").alias("main"))
    split = rooted.groupBy("pivot").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("pivot")
    rows = written(rooted.join(sorted_side(split), "pivot").join(sorted_side(own), "pivot"), "across")
    row = [c for c in ("pivot", "node", "n", "root", "main", "sketch") if c in rows.columns]
    tokens = rows.select(*row, F.posexplode("rest").alias("i", "token"))
    telling = tokens.groupBy("pivot", "token").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("pivot", "token")
    tokens = written(tokens.join(sorted_side(telling), ["pivot", "token"]), "tokens")

    by_rest = _sized_pairs(tokens.withColumn("most", F.expr("(5 * n - 9 * i) / 4")), ["pivot", "token"])
    by_pivot = _sized_pairs(rows.select(*row, F.expr("(9 * common - 4 * n) / 4").alias("most")), ["pivot"])
    return by_rest.union(by_pivot).distinct()


def _size_step(n: Column) -> Column:
    """Sizes in steps of two parts in a hundred."""
    return F.floor(F.log(n) / math.log(1.02)).cast("int")


def _sized_pairs(table: DataFrame, key: list[str]) -> DataFrame:
    """Pairs a < b of rows of one key and different roots, one of them not in its pivot's component, of which each allows the other's size.

    A row's partner has ``most`` elements at most, and 0.8 of its own at least; a row that allows none of these is left out at once. The join is on key and step of
    sizes, so rows meet only those of sizes that they allow: texts that share a template but are less similar don't meet at all. Where rows have sketches, these must be near.
    """
    able = table.where(F.col("most") >= 0.8 * F.col("n"))
    x = able.where("root <> main").withColumn("step", F.explode(F.sequence(_size_step(0.8 * F.col("n")) - 1, _size_step(F.least(F.col("most"), 1.25 * F.col("n"))) + 1))).alias("x")
    y = able.withColumn("step", _size_step(F.col("n"))).alias("y")
    same = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in [*key, "step"]]
    fits = (F.col("x.root") != F.col("y.root")) & (F.col("y.n") <= F.col("x.most")) & (F.col("x.n") <= F.col("y.most"))
    near = [_near("x", "y")] if "sketch" in table.columns else []
    return x.join(sorted_side(y), [*same, fits, *near]).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = 24) -> tuple[DataFrame, DataFrame]:
    """(nodes, roots): the distinct shingle sets with their least rows, and the component of each set that has links.

    Sets are linked whose Jaccard similarity is 0.8 or more. Each such pair shares a block of its prints (``blocks``), and each pair that shares one is verified
    by its prints and on the whole sets, or proven to be less similar.
    The sets of a bucket are first compared with the bucket's pivot. Only pairs that this leaves in two components are looked at then, in buckets of over ``hot``
    only those that what they share with a far pivot doesn't rule out; no other can change the components. Nothing is capped or dropped.
    """
    first = row_order(docs, id_col, text_col)
    rows = written(docs.select(first.alias("first"), _printed(F.col(text_col)).alias("p")).select("first", "p.*"), "prints")
    nodes = written(rows.groupBy("node").agg(F.min("first").alias("first"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("least").alias("least")), "sets")
    # Of each set's rows one gives its blocks: a single shuffle of (key, node), of which only keys of several sets are kept.
    one = written(nodes.select(F.col("first.mark").alias("mark")), "marks")
    keyed = rows.withColumn("mark", F.col("first.mark")).join(sorted_side(one), "mark", "left_semi").select("node", F.explode("blocks").alias("key"))
    counted = keyed.repartition("key").withColumn("m", F.count("*").over(Window.partitionBy("key"))).where("m > 1").select("key", "node", "m").distinct()
    able = _rarest(counted.join(sorted_side(nodes.select("node", "n", "copies", "least")), "node"))
    shared = able.select("key", "node", "n", "copies").withColumn("m", F.count("*").over(Window.partitionBy("key"))).where("m > 1")
    shared = written(shared, "buckets")
    heads = written(_pivots(shared), "pivots")
    pairs = shared.join(sorted_side(heads), "key").select(F.least("pivot.node", "node").alias("a"), F.greatest("pivot.node", "node").alias("b")).distinct()

    wanted = shared.select("node").distinct()
    where = nodes.join(sorted_side(wanted), "node", "left_semi").select("node", F.col("first.mark").alias("mark"))
    texts = docs.select(row_mark(docs).alias("mark"), F.col(text_col).alias("text")).join(sorted_side(where), "mark").dropDuplicates(["node"])
    sets = written(texts.select("node", _listed(F.col("text")).alias("s")).select("node", "s.*"), "lists")
    sketches = written(sets.select("node", F.size("list").alias("n"), "sketch"), "sketches")

    p, q = F.col("p.list"), F.col("q.list")
    n, common = F.size(q), F.size(F.array_intersect(p, q))
    near = written(_near_pairs(pairs.where("a <> b"), sketches), "near")
    links = written(_with_sets(near, sets, "list").where(_similar(common, F.size(p), n)).select("a", "b"), "links")
    roots = connected_components(links)

    rooted = shared.join(sorted_side(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = rooted.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("key")
    rooted = written(rooted.join(sorted_side(split), "key").join(sorted_side(heads), "key"), "split")
    apart = _near_pairs(_pairs(rooted.where(F.col("m") <= hot)), sketches)
    pivots = written(_far_pivots(rooted.where(F.col("m") > hot)), "pivots")
    if not pivots.isEmpty():
        rest = F.slice(F.array_except(q, p), 1, (n / 5).cast("int") + 1)
        compared = _with_sets(pivots, sets, "list", "sketch").select(F.col("a").alias("pivot"), F.col("b").alias("node"), n.alias("n"), F.col("q.sketch").alias("sketch"), common.alias("common"), rest.alias("rest"))
        apart = apart.union(_across(written(compared, "stars"), roots)).distinct()
    more = written(_verified(written(apart.join(sorted_side(near), ["a", "b"], "left_anti"), "apart"), sets), "links")
    return nodes, roots if more.isEmpty() else connected_components(links.union(more))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the least id stays, nulls last, then the least text's hash.

    Texts without words are one component. Ids may be null and may repeat: a row is told by all its columns.
    """
    return least_rows(docs, *groups(docs, id_col, text_col))
