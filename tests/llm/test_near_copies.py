"""The pipeline's near-duplicate stage against brute force."""

import random
import re

import numpy as np

from kinestream.llm import near_copies, queries

SCHEMA = "doc_id long, text string"


def plain_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])


def plain_kept(rows):
    """The ids that stay: the least of each component of the sets at 0.8 or more. Ids are unique."""
    sets = {i: plain_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and (sets[a] == sets[b] or 5 * both >= 4 * len(sets[a] | sets[b])):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i for i in sets if find(i) == i}


def near_texts():
    rng = random.Random(11)
    words = [f"w{i}É" for i in range(900)]
    out = [None, "", " \n", "One", "ONE", "one two"]
    for _ in range(5):
        base = [rng.choice(words) for _ in range(200)]
        for changes in (0, 0, 1, 2, 3, 4, 5, 8, 20):
            t = list(base)
            for at in rng.sample(range(200), changes):
                t[at] = rng.choice(words)
            out.append(" ".join(t))
    base = [rng.choice(words) for _ in range(150)]
    for _ in range(60):  # one hot group, many of whose members are under 0.8 to each other
        t = list(base)
        for at in rng.sample(range(150), rng.randrange(1, 7)):
            t[at] = rng.choice(words)
        out.append(" ".join(t))
    return out


def test_stage_keeps_what_brute_force_keeps(spark):
    rows = list(enumerate(near_texts()))
    random.Random(2).shuffle(rows)
    got = queries.near_duplicate_stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted(r.doc_id for r in got) == sorted(plain_kept(rows))
    assert {(r.doc_id, r.text) for r in got} <= set(rows)


def test_hot_buckets_give_the_same_groups(spark):
    rows = list(enumerate(near_texts()))
    docs = spark.createDataFrame(rows, SCHEMA)
    for hot in (2, 10_000):
        nodes, roots = near_copies.groups(docs, hot=hot)
        assert {r.doc_id for r in near_copies.least_rows(docs, nodes, roots).collect()} == plain_kept(rows)


def at_the_threshold(sizes, times, seed):
    """Pairs of sets that just reach a similarity of 0.8: those of n and m hashes have 4 (n + m) / 9 in common, rounded up."""
    rng = np.random.default_rng(seed)
    for n in sizes:
        for m in sorted({n, n + 1, n * 9 // 8, n * 5 // 4}):
            common = -(-4 * (n + m) // 9)
            for _ in range(times if common <= n else 0):
                own = rng.integers(0, 1 << 64, n + m - common, dtype=np.uint64)
                yield np.sort(own[:n]), np.sort(np.concatenate([own[:common], own[n:]]))


def test_similar_sets_always_share_a_block():
    """No pair at 0.8 is left to chance, at any size or across levels, also where classes are empty."""
    pairs = [*at_the_threshold(range(1, 100), 20, 3), *at_the_threshold((160, 400, 1000, 9000), 3, 4)]
    for a, b in pairs:
        both = np.intersect1d(near_copies.keys(a), near_copies.keys(b))
        at = max(near_copies.level(len(a)), near_copies.level(len(b))) & 1
        met = np.count_nonzero(both & np.uint64(1) == at)
        assert met >= max(near_copies.keyed_blocks(x)[1][at] for x in (a, b))
    assert len(pairs) > 6000


def test_sketches_differ_in_no_more_bits_than_sets():
    """So no pair at 0.8 is left out by them, also where one sketch is twice as long."""
    widths = set()
    for a, b in at_the_threshold((1, 2, 3, 7, 10, 16, 50, 60, 100, 170, 400, 1000), 20, 6):
        p, q = sorted((near_copies.sketch(x) for x in (a, b)), key=len)
        widths.add((len(p), len(q)))
        if len(p) < len(q):
            q = q[: len(p)] ^ q[len(p) :]
        assert np.bitwise_count((p ^ q).view(np.uint64)).sum() <= len(np.setxor1d(a, b))
    assert {long // short for short, long in widths} == {1, 2}


def test_rarest_keys_still_meet(spark):
    """Sets that share ``least`` keys keep one of them in common, whatever other keys they have."""
    rng = random.Random(4)
    rows = [(key, node) for node in range(80) for key in rng.sample(range(0, 120, 2), 8) + rng.sample(range(1, 41, 2), 6)]
    sizes = {k: sum(key == k for key, _ in rows) for k in range(120)}
    table = [(k, n, sizes[k], [4, 3]) for k, n in rows]
    kept = {(r.key, r.node) for r in near_copies._rarest(spark.createDataFrame(table, "key long, node long, m long, least array<int>")).collect()}
    own, left = ([{k for k, n in pairs if n == node} for node in range(80)] for pairs in (rows, kept))
    met = [(a, b, even) for a in range(80) for b in range(a) for even in (0, 1) if sum(k & 1 == even for k in own[a] & own[b]) >= (4, 3)[even]]
    assert len(met) > 30 and len(kept) < 0.75 * len(rows)
    assert all(any(k & 1 == even for k in left[a] & left[b]) for a, b, even in met)


def _groups_of(size, number, changes, words=200):
    """``number`` groups of ``size`` texts, each a group's text with up to ``changes`` words changed."""
    rng = random.Random(size)
    out = []
    for g in range(number):
        base = [f"g{g}w{i}" for i in range(words)]
        for _ in range(size):
            t = list(base)
            for at in rng.sample(range(words), rng.randrange(changes)):
                t[at] = f"x{rng.randrange(10**9)}"
            out.append(" ".join(t))
    return list(enumerate(out))


def _fetched(spark, monkeypatch, rows):
    """The rows that the stage keeps, the pairs for which it fetches two whole sets, and the rests that it takes apart."""
    seen = {"pairs": 0, "tokens": 0}
    with_sets, across = near_copies._with_sets, near_copies._across

    def counted(pairs, sets, *columns):
        seen["pairs"] += pairs.count() if "list" in columns else 0
        return with_sets(pairs, sets, *columns)

    def counted_rests(stars, roots):
        seen["tokens"] += sum(len(r.rest) for r in stars.select("rest").collect())
        return across(stars, roots)

    monkeypatch.setattr(near_copies, "_with_sets", counted)
    monkeypatch.setattr(near_copies, "_across", counted_rests)
    kept = {r.doc_id for r in near_copies.deduplicated(spark.createDataFrame(rows, SCHEMA)).collect()}
    monkeypatch.undo()
    return kept, seen["pairs"], seen["tokens"]


def test_small_groups_are_not_all_pairs(spark, monkeypatch):
    """Whole sets are fetched in proportion to the texts of groups that no bucket of which is hot."""
    rows = _groups_of(20, 4, 5)
    kept, pairs, _ = _fetched(spark, monkeypatch, rows)
    assert kept == plain_kept(rows)
    assert pairs <= 4 * len(rows)  # all pairs: 4 * 190


def test_large_groups_take_few_rests_apart(spark, monkeypatch):
    """A group whose texts are partly under 0.8 to each other is taken apart by few of its texts."""
    rows = _groups_of(120, 1, 24)
    kept, pairs, tokens = _fetched(spark, monkeypatch, rows)
    assert kept == plain_kept(rows) and len(kept) > 1
    assert pairs <= 6 * len(rows) and 0 < tokens <= 60 * len(rows)


def test_pairs_that_min_hashes_lost_are_one(spark):
    """9 shingles of which one differs, a similarity of 0.8: pairs without a common key in the MinHash bands that this stage had."""
    rows = []
    for i in (9982, 21029, 25073):
        w = [f"{i}w{k}" for k in range(13)]
        rows += [(i, " ".join(w)), (100_000 + i, " ".join([*w[:-1], "end"]))]
    got = queries.near_duplicate_stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted(r.doc_id for r in got) == [9982, 21029, 25073]


def test_blocks_are_simhashes_of_classes():
    hashes = np.unique(np.random.default_rng(5).integers(0, 1 << 64, 300, dtype=np.uint64))
    got, sizes = near_copies.simhashes(hashes, 70)
    for c in range(70):
        own = [int(h) for h in hashes if h % 70 == c]
        assert sizes[c] == len(own) and int(got[c]) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in own) > len(own))


def test_simhash_blocks_decide(spark, monkeypatch):
    """The stage's pairs come from its SimHash blocks alone: without them only equal sets are one."""
    rows = list(enumerate(near_texts()))
    monkeypatch.setattr(near_copies, "_printed", _unblocked(near_copies._printed))
    got = {r.doc_id for r in near_copies.deduplicated(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len({plain_set(t) for _, t in rows}) > len(plain_kept(rows))


def _unblocked(printed):
    from pyspark.sql import functions as F

    return lambda text: printed(text).withField("blocks", F.array().cast("array<long>"))


def test_repeated_and_null_ids(spark):
    same = "a b c d e f g h"
    rows = [(5, same), (3, same), (3, same), (9, "other words stand here now"), (None, same), (None, "z"), (None, "z"), (3, "quite another text under a used id")]
    want = [(3, same), (3, "quite another text under a used id"), (9, "other words stand here now"), (None, "z")]
    got = near_copies.deduplicated(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert near_copies.deduplicated(spark.createDataFrame([], SCHEMA)).collect() == []


def test_columns_named_like_ours_and_maps(spark):
    """Maps in a row, also inside of other types, and columns named as the stage's own: rows come back as they are, repeated ones once."""
    same = "a b c d e f g h"
    schema = SCHEMA + ", _stays long, mark string, node int, m map<string,int>, s struct<x:map<string,string>>, `a.b` int"
    rows = [(5, same, 1, "p", 0, {"k": 1}, ({"y": "z"},), 4), (3, same, 2, "q", 0, {"k": 2}, None, 4), (3, same, 2, "q", 0, {"k": 2}, None, 4), (9, "other words stand here now", 3, None, 1, None, None, None)]
    got = near_copies.deduplicated(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(3, same, 2, "q", 0, {"k": 2}, None, 4), rows[3]], key=repr)
    from kinestream.llm import simhash

    got = simhash.deduplicated(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(3, same, 2, "q", 0, {"k": 2}, None, 4), rows[3]], key=repr)


def _star_rows(n, seed=0, shared=160, least=24, most=38):
    """n sets of one pivot that share a template but no two of which reach 0.8: a unique rest of an eighth to a quarter of the template."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        own = rng.randrange(least, most)
        out.append((0, i + 1, shared + own, shared, [(i + 1) * 1000 + k for k in range((shared + own) // 5 + 1)][:own]))
    return [(0, 0, 3 * shared, 3 * shared, []), *out]


def test_texts_of_one_template_are_not_all_pairs(spark):
    """Rows of one pivot that are less similar than 0.8 meet in proportion to their number, and pairs that do reach it are found."""
    kind = "pivot long, node long, n int, common int, rest array<long>"
    roots = spark.createDataFrame([], "node long, root long")

    def made(rows):
        return {(r.a, r.b) for r in near_copies._across(spark.createDataFrame(rows, kind), roots).collect()}

    sizes = {n: len(made(_star_rows(n))) for n in (200, 400, 800)}
    assert sizes[800] <= 5 * max(1, sizes[200]) and sizes[800] < 800
    rows = _star_rows(100)
    rows += [(0, 5000 + k, 180, 170, [7_000_000 + k]) for k in range(4)]
    assert {(5000 + a, 5000 + b) for a in range(4) for b in range(a + 1, 4)} <= made(rows)


def test_no_pair_of_sizes_is_lost(spark):
    """The joined pairs are exactly those that the sizes allow, by brute force."""
    rng = random.Random(5)
    rows = []
    for i in range(150):
        n = rng.choice([1, 2, 5, 40, 41, 50, 64, 80, 100, 101, 125])
        rows.append((rng.randrange(2), i, n, rng.randrange(4), 0, float(rng.choice([n, n * 1.25, n * 0.9, n * 0.8, n * 0.79, n * 2.0]))))
    got = near_copies._sized_pairs(spark.createDataFrame(rows, "pivot int, node int, n int, root int, main int, most double"), ["pivot"]).collect()
    want = set()
    for p, a, n, r, m, most in rows:
        for q, b, k, s, _, other in rows:
            if p == q and r != s and r != m and k <= most and n <= other and 0.8 * n <= k <= 1.25 * n and most >= 0.8 * n and other >= 0.8 * k:
                want.add((min(a, b), max(a, b)))
    assert want <= {(r.a, r.b) for r in got}
    allowed = {(min(a, b), max(a, b)) for p, a, n, r, m, most in rows for q, b, k, s, _, other in rows if p == q and r != s and r != m and k <= most and n <= other}
    assert {(r.a, r.b) for r in got} <= allowed


def test_no_step_sends_several_tables_through_the_driver(spark, monkeypatch):
    """Small enough for Spark's broadcasts, a step still has one at most: the driver would hold all of them at once."""
    from kinestream.llm import components

    sent, keep = {}, near_copies.written

    def seen(df, name):
        sent[name] = max(sent.get(name, 0), df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange"))
        return keep(df, name)

    monkeypatch.setattr(near_copies, "written", seen)
    monkeypatch.setattr(components, "written", seen)
    docs = spark.createDataFrame(list(enumerate(near_texts())), SCHEMA)
    seen(near_copies.least_rows(docs, *near_copies.groups(docs, hot=2)), "rows")
    assert {"buckets", "near", "links", "edges", "across", "tokens", "apart", "stays", "rows"} <= set(sent)
    assert {name: n for name, n in sent.items() if n > 1} == {}
