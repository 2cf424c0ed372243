"""Benchmark matches against brute force over all windows."""

import random
import re
from collections import Counter

from kinestream.llm import decontaminate
from kinestream.llm.common import differing


def shingles(w, size):
    return [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]


def brute(docs, items):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    found = {}
    for item, text in items:
        iw = words(text)
        if not iw:
            continue
        size = min(5, len(iw))
        want = Counter(shingles(iw, size))
        for doc, t in docs:
            own = shingles(words(t), size)
            for start in range(max(1, len(words(t)) - len(iw) + 1) if own else 0):
                win = Counter(own[start : start + len(iw) - size + 1])
                both = (win & want).total()
                score = both / (win.total() + want.total() - both)
                if score >= 0.8 and score > found.get((doc, item), (0, 0))[0]:
                    found[doc, item] = (score, start)
    return {k: (round(s, 6), at) for k, (s, at) in found.items()}


def corpus(rng, items, n):
    docs = []
    for k in range(n):
        own = (rng.choice(items)[1] or "").split()
        for _ in range(rng.randint(0, 2)):
            if own:
                own[rng.randrange(len(own))] = rng.choice("abcdefk")
        noise = [[rng.choice("abcdef") for _ in range(rng.randint(0, 20))] for _ in range(2)]
        docs.append((k, " ".join(noise[0] + own + noise[1])))
    return [*docs, (900, None), (901, ""), (902, "\n \t")]


def run(spark, docs, items):
    d = spark.createDataFrame([(*x, "s", "t") for x in docs], "doc_id long, text string, digest string, w string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): (r.similarity, r.start) for r in decontaminate.contaminated(d, b).collect()}


def test_matches_are_brute_force(spark):
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice("abcdef") for _ in range(rng.choice([8, 9, 12, 20, 30])))) for i in range(10)]
    docs = corpus(rng, items, 120)
    want = brute(docs, items)
    assert len(want) > 20 and run(spark, docs, items) == want


def test_no_broadcast_changes_nothing(spark, monkeypatch):
    rng = random.Random(4)
    items = [(i, " ".join(rng.choice("abcdef") for _ in range(rng.choice([8, 9, 12, 20])))) for i in range(5)]
    docs = corpus(rng, items, 40)
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    assert run(spark, docs, items) == brute(docs, items)


def edited_pairs(rng, n, words=50):
    """Items of one length, and texts that are items with one word changed, which leaves 41 of 46 shingles: a similarity of 0.804."""
    items, docs = [], []
    for i in range(n):
        own = [f"i{i}w{k}" for k in range(words)]
        items.append((i, " ".join(own)))
        at = rng.randrange(4, words - 4)
        docs.append((i, " ".join([*own[:at], f"x{i}", *own[at + 1 :]])))
    return docs, items


def test_recall_at_the_threshold(spark):
    docs, items = edited_pairs(random.Random(6), 400)
    found = run(spark, docs, items)
    assert {s for s, _ in found.values()} == {round(41 / 51, 6)} and all(d == i for d, i in found)
    assert len(found) >= 0.99 * len(docs)


def test_no_match_is_lost_however_words_repeat(spark):
    """Two shingles that change places in the majority turn the whole print of a window, though nearly all shingles are in both."""
    turns = lambda a, b, n: " ".join((a, b)[i % 2] for i in range(n))
    items = [(n, turns("a", "b", n)) for n in (13, 15, 17, 41)] + [(50, turns("x", "y", 30) + " q r s t u v w"), (60, "k " * 40 + "l " * 9)]
    docs = [(n, turns("b", "a", n)) for n in (13, 15, 17, 41)] + [(50, turns("y", "x", 31) + " q r s t u"), (60, "k " * 37 + "l " * 12), (70, turns("b", "a", 12))]
    want = brute(docs, items)
    assert {(n, n) for n in (13, 15, 17, 41, 50, 60)} <= set(want) and run(spark, docs, items) == want


def test_matches_differ_in_fewer_blocks_than_there_are(spark):
    """Windows that just reach 0.8, of all lengths: each agrees with its item on a block, whatever the hashes."""
    from pyspark.sql import functions as F

    rng, rows = random.Random(9), []
    for m in [*range(1, 40), 46, 99, 300]:
        for _ in range(20):
            own = [rng.getrandbits(63) for _ in range(m)]
            rows.append((own, [rng.getrandbits(63) for _ in range(m // 9)] + own[m // 9 :]))
    a, b = (decontaminate.prints(F.col(c), 9) for c in "ab")
    got = spark.createDataFrame(rows, "a array<long>, b array<long>").select(differing(a, b).alias("d"), F.size("a").alias("m"), F.size(a).alias("all")).collect()
    assert all(r.d <= 2 * (r.m // 9) < r.all for r in got) and any(r.d for r in got)


def test_blocks_decide(spark, monkeypatch):
    """Without blocks there is no candidate, and few pairs that have nothing in common share one."""
    from pyspark.sql import functions as F

    docs, items = edited_pairs(random.Random(7), 60)
    hashed = decontaminate.benchmark_items(spark.createDataFrame(items, "item_id long, text string"))
    printed = hashed.select("item_id", F.inline(decontaminate._blocks(decontaminate.prints(F.col("hashes"), 6))))
    met = printed.alias("x").join(printed.alias("y"), ["block", "bits"]).where("x.item_id < y.item_id").select("x.item_id", "y.item_id").distinct().count()
    assert met < 0.08 * 60 * 59 / 2
    monkeypatch.setattr(decontaminate, "_blocks", lambda p: F.filter(F.array(F.struct(F.lit(0).alias("block"), F.lit(0).alias("bits"))), lambda x: x["block"] > 0))
    assert run(spark, docs, items) == {}


def test_long_texts_and_clashing_names(spark):
    rng = random.Random(8)
    items = [(i, " ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(20))) for i in range(3)] + [(None, "n u l l i d e n t i f i e r")]
    long = " ".join([*(items[0][1] for _ in range(300)), *("filler%d" % i for i in range(5000)), items[1][1]])
    docs = [(0, long), (1, long), (None, items[2][1]), (3, "x " + items[3][1]), (4, "clean")]
    assert {k for k in run(spark, docs, items)} == {(0, 0), (0, 1), (1, 0), (1, 1), (None, 2), (3, None)}
    d = spark.createDataFrame([(*x, 1, 2, "g") for x in docs], "doc_id long, text string, mark int, mark2_gone int, mark_gone string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert [tuple(r) for r in decontaminate.decontaminated(d, b).collect()] == [(4, "clean", 1, 2, "g")]


def test_short_null_and_blank_items(spark):
    rng = random.Random(2)
    items = [(1, "a b c d e f"), (2, "q r s"), (3, None), (4, " "), (5, "z"), (5, "z")]
    docs = [*corpus(rng, items, 40), (800, "Q R s"), (801, "q r"), (802, "z z")]
    assert run(spark, docs, items) == brute(docs, items)


def test_flagged_texts_go(spark):
    text = "one two three four five six seven eight nine ten"
    d = spark.createDataFrame([(1, f"start {text} end", "x"), (1, "clean text under the same id", "y"), (None, text, None), (3, None, "z")], "doc_id long, text string, digest string")
    b = spark.createDataFrame([(7, text)], "item_id long, text string")
    assert sorted(tuple(r) for r in decontaminate.decontaminated(d, b).collect()) == [(1, "clean text under the same id", "y"), (3, None, "z")]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminated(d, none).count() == 4
    assert decontaminate.contaminated(d.limit(0), b).collect() == []


def test_simhash_counts_bits(spark):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    for n in (0, 1, 2, 7, 31):
        hashes = [rng.getrandbits(64) - (1 << 63) for _ in range(n)]
        got = spark.createDataFrame([(hashes,)], "h array<long>").select(decontaminate.simhash(F.col("h"), 5).alias("p")).first().p
        assert got & (1 << 64) - 1 == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)
