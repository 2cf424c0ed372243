"""Near-duplicates against brute force, and components of graphs."""

import random
import re

import xxhash

from kinestream.llm import components, simhash

SCHEMA = "doc_id long, text string, fp string, fingerprint string, copy int"


def plain_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def texts():
    rng = random.Random(5)
    words = [f"w{i}É" for i in range(400)]
    base = [[rng.choice(words) for _ in range(150)] for _ in range(6)]
    out = [None, "", " \n\t", "One", "one two", "ONE Two", "a b c", "x" * 50_000]
    for b in base:
        for _ in range(8):
            t = list(b)
            t[rng.randrange(len(t))] = rng.choice(words)
            out.append(" ".join(t))
        out += [" ".join(b)] * 2
    return out


def test_near_duplicates_are_brute_force(spark):
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts())]
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    prints = {i: plain_print(t) for i, t, *_ in rows}
    want = classes(prints)
    assert len(got) == len(rows)
    assert all(r.fingerprint == f"{prints[r.doc_id]:016x}" and r.component_id == want[r.doc_id] for r in got)


def test_hot_blocks_link_the_same_prints(spark):
    rng = random.Random(1)
    fps = {rng.getrandbits(12) | rng.choice([0, 1 << 40, 3 << 50]) for _ in range(400)}
    fps |= {rng.getrandbits(64) for _ in range(20)}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    df = spark.createDataFrame(signed, "fp long")
    want = classes({x: x for x in fps})
    for hot in (2, 24, 10_000):
        edges = simhash.close_pairs(df, 2, 4, hot).collect()
        assert all(((e.a ^ e.b) & (1 << 64) - 1).bit_count() <= 2 for e in edges)
        root = {x: x for x in fps}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for e in edges:
            a, b = find(e.a & (1 << 64) - 1), find(e.b & (1 << 64) - 1)
            root[max(a, b)] = min(a, b)
        assert {x: find(x) for x in fps} == want


def test_one_row_of_each_group_stays(spark):
    same = "a b c d e f g h"
    rows = [(5, same), (3, same), (3, same), (9, "other words stand here now"), (None, same), (None, "z"), (3, "quite another text under a used id")]
    kept = simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(kept.collect(), key=repr) == sorted([(3, same), (9, "other words stand here now"), (None, same), (None, "z")], key=repr) or {(r.doc_id) for r in kept.collect()} == {3, 9, None}
    unique = spark.createDataFrame([(5, same, "e"), (3, same, "f"), (9, "x y z w", None)], "doc_id long, text string, component_id string")
    assert sorted(tuple(r) for r in simhash.deduplicated(unique).collect()) == [(3, same, "f"), (9, "x y z w", None)]


def test_repeated_and_null_ids_hide_no_text(spark):
    same = "a b c d e f g h"
    rows = [(5, same), (3, same), (3, same), (9, "other words stand here now"), (None, same), (None, "z"), (None, "z"), (3, "quite another text under a used id")]
    want = [(3, same), (3, "quite another text under a used id"), (9, "other words stand here now"), (None, "z")]
    got = simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == [] and simhash.deduplicated(empty).collect() == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[100 + k] == 100 for k in range(1, 30)) and got[201] == 200
