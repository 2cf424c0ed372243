"""Skeletons, marker tracks, JSON contracts, clouds, bending chains, click sensitivity and conditioned poses against plain Python and numpy."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinestream.functions import bend, vec
from kinestream.operators import cloud, conditioned, documents, markers, sensitivity, skeleton
from kinestream.operators.contract import ContractError
from kinestream.operators.documents import Field
from kinestream.sources import bvh, tables

POINT = "struct<x:double,y:double,z:double>"
NODES = "skeleton string, node int, parent int, offset array<double>, channels array<string>"


def random_tree(rng, n):
    nodes = []
    for j in range(n):
        turns = [f"{a}rotation" for a in rng.permutation(list("XYZ"))[: int(rng.integers(0, 4))]]
        moves = [f"{a}position" for a in "XYZ"] if j == 0 or rng.random() < 0.2 else []
        nodes.append({"name": str(j), "parent": int(rng.integers(0, j)) if j else -1, "offset": rng.normal(size=3).tolist(), "channels": moves + turns})
    return nodes


def test_random_trees_stand_as_in_numpy(spark):
    """Trees of 1 to 15 nodes, any branching and order of channels; frames of another width or with a hole have no points."""
    rng = np.random.default_rng(11)
    rows, motion, want = [], [], {}
    for k, n in enumerate((1, 2, 6, 15)):
        nodes = random_tree(rng, n)
        width = sum(len(x["channels"]) for x in nodes)
        values = rng.uniform(-180, 180, (3, width))
        want[f"s{k}"] = bvh.world_positions(nodes, values)
        rows += [(f"s{k}", j, x["parent"], x["offset"], x["channels"]) for j, x in enumerate(nodes)]
        motion += [(f"s{k}", f, v.tolist()) for f, v in enumerate(values)]
    motion += [("s3", 3, [1.0]), ("s3", 4, None), ("none", 0, [1.0]), ("s0", 3, [None] * len(motion[0][2]))]
    got = skeleton.world_positions(spark.createDataFrame(rows, NODES), spark.createDataFrame(motion, "skeleton string, frame int, values array<double>")).collect()
    assert len(got) == len(motion)
    for r in got:
        if r.skeleton in want and r.frame < 3:
            assert np.allclose([tuple(p) for p in r.points], want[r.skeleton][r.frame], atol=1e-9)
        else:
            assert r.points is None


def test_what_is_no_tree(spark):
    good = ("a", 0, -1, [0.0, 0.0, 0.0], ["Xposition"])
    for bad, rule in ((("a", 2, 0, [0.0] * 3, []), "nodes"), (("a", 1, 1, [0.0] * 3, []), "parent"), (("a", 1, 0, [0.0] * 2, []), "offset"), (("a", 1, 0, [0.0] * 3, ["Wrotation"]), "channel"), (("a", 1, -1, [0.0] * 3, []), "parent")):
        df = spark.createDataFrame([good, bad], NODES)
        with pytest.raises(ContractError, match=rule):
            skeleton.trees(df)


def test_skeleton_on_the_capture(spark):
    """Row i is frame i; frame 0 is a seed; one frame more than rows; any other count, or a root that is off, is an error."""
    points = spark.createDataFrame([("a", f, [(float(f), 0.0, 0.0), (float(f), 1.0, 0.0)]) for f in range(5)], f"skeleton string, frame long, points array<{POINT}>")

    def capture(n, off=0.0):
        return spark.createDataFrame([("a", i, 100 + 10 * i, (float(i) + off * (i == 2), 0.0, 0.0)) for i in range(n)], f"skeleton string, ordinal long, time long, root {POINT}")

    rows = skeleton.on_capture(points, capture(4, 0.0005), 1e-3).orderBy("ordinal").collect()
    assert [(r.ordinal, r.time, r.points and tuple(r.points[1])) for r in rows] == [(0, 100, None), (1, 110, (1.0, 1.0, 0.0)), (2, 120, (2.0, 1.0, 0.0)), (3, 130, (3.0, 1.0, 0.0))]
    assert skeleton.capture_contract(points, capture(4, 0.0005), 1e-3).first().root_error == pytest.approx(0.0005)
    for wrong in (capture(5), capture(3), capture(4, 0.002), capture(4).where("ordinal <> 1")):
        with pytest.raises(ContractError):
            skeleton.on_capture(points, wrong, 1e-3)


def test_marker_tracks_on_a_grid(spark, tmp_path):
    """From a file with two names of one marker, gaps of three and five, to fractions of counters."""
    gaps = {1: {5, 6, 7}, 2: {12, 13, 14, 15, 16}}
    at = lambda m, k: None if k in gaps.get(m, ()) or (m == 1 and k >= 20) or (m == 9 and k < 18) else (float(k * m), 2.0 * k, 0.5)
    names = [f"Marker_{m}_Pos_{a}(mm)" for m in (9, 1, 2) for a in "XYZ"]
    lines = ["FREQUENCY\t120", "TAKE\tone", "FrameCounter\tOther\t" + "\t".join(names)]
    for k in range(30):
        cells = ["" if at(1 if m == 9 else m, k) is None and m != 9 or (m == 9 and k < 18) else f"{x}" for m in (9, 1, 2) for x in ((float(k), 2.0 * k, 0.5) if m == 9 else at(m, k) or (0, 0, 0))]
        lines.append(f"{k}\tq\t" + "\t".join(cells))
    (tmp_path / "a.cmm").write_text("\r\n".join(lines) + "\r\n")
    read = tables.read_markers(spark, str(tmp_path / "a.cmm"), ["1", "2", "9"], 120)
    samples = read.select(F.lit("t").alias("take"), "counter", "points")
    targets = spark.createDataFrame([("t", i, x) for i, x in enumerate((1.0, 4.5, 6.25, 11.5, 14.0, 17.5, 18.75, 25.5, 28.0))], "take string, frame int, target double")
    got = {(r.frame, r.track): (None if r.p is None else tuple(r.p), r.was_filled) for r in markers.tracks_on_grid(samples, targets, {"a": ["1", "9"], "b": ["2"]}, ["take"]).collect()}
    line = lambda x, m: (x * m, 2.0 * x, 0.5)
    want = {}
    for i, x in enumerate((1.0, 4.5, 6.25, 11.5, 14.0, 17.5, 18.75, 25.5, 28.0)):
        want[i, "a"] = (line(x, 1), math.ceil(x) in gaps[1] or math.floor(x) in gaps[1])
        want[i, "b"] = (None if 11 < x < 17 else line(x, 2), False)
    assert got.keys() == want.keys()
    for k, (p, filled) in want.items():
        assert got[k] == (None if p is None else pytest.approx(p), filled), k
    with pytest.raises(ContractError, match="outside"):
        markers.tracks_on_grid(samples, targets.withColumn("target", F.col("target") + 5), {"a": ["1"]}, ["take"])
    with pytest.raises(ContractError, match="contiguous"):
        markers.tracks_on_grid(samples.where("counter <> 9"), targets, {"a": ["1"]}, ["take"])
    with pytest.raises(ContractError, match="diverge"):
        markers.tracks_on_grid(samples, targets, {"a": ["1", "2"]}, ["take"])
    assert markers.failures(markers.logical(samples.where("counter <> 29"), {"a": ["1"]}, ["take"]), targets.where("target < 20"), ["take"], 2.0).count() == 0
    with pytest.raises(ContractError, match="rate"):
        tables.read_markers(spark, str(tmp_path / "a.cmm"), ["1"], 100)
    with pytest.raises(ContractError, match="column"):
        tables.read_markers(spark, str(tmp_path / "a.cmm"), ["7"], 120)


FIELDS = [Field("id", "string"), Field("n", "integer", low=0, high=9), Field("x", "number", required=False), Field("on", "boolean", one_of=(True,)), Field("in", "object", required=False), Field("in.kind", "string", required=False, one_of=("a", "b")), Field("m", shape=(2, 2)), Field("tags", "array", required=False)]


@pytest.mark.parametrize(
    "doc,want",
    [
        ({"id": "q", "n": 3, "on": True, "m": [[1, 2.5], [3, 4]], "tags": ["x"], "in": {"kind": "a"}, "x": 1}, []),
        ({"id": "q", "n": 3, "on": True, "m": [[1, 2], [3, 4]], "x": 2.5}, []),
        ({}, [("id", "missing"), ("n", "missing"), ("on", "missing"), ("m", "missing")]),
        ({"id": 5, "n": 2.5, "on": False, "m": [1, 2]}, [("id", "not a string"), ("n", "not an integer"), ("on", "not an allowed value"), ("m", "not all numbers")]),
        ({"id": "q", "n": 11, "on": "true", "m": [[1, 2], [3]], "x": "1"}, [("n", "out of bounds"), ("on", "not a boolean"), ("m", "not of shape 2x2"), ("x", "not a number")]),
        ({"id": "q", "n": 0, "on": True, "m": [[1, "2"], [3, 4]], "in": [], "tags": {}, "more": 1}, [("m", "not all numbers"), ("in", "not an object"), ("tags", "not an array"), ("more", "unknown")]),
        ({"id": None, "n": 0, "on": True, "m": [[1, 2], [3, 4], [5, 6]], "in": {"kind": "c", "kinds": 1}}, [("id", "not a string"), ("m", "not of shape 2x2"), ("in.kind", "not an allowed value"), ("in.kinds", "unknown")]),
        ([1], [("$", "not a JSON object")]),
        ("{", [("$", "not a JSON object")]),
        (None, [("$", "not a JSON object")]),
    ],
)
def test_every_failure_of_a_document(spark, doc, want):
    text = doc if doc is None or doc == "{" else json.dumps(doc)
    df = spark.createDataFrame([(1, text)], "k int, _doc string")
    got = documents.failures(df, ["k"], "_doc", FIELDS).collect()
    assert sorted((r.path, r.rule) for r in got) == sorted(want)
    if not want:
        r = documents.read(df, ["k"], "_doc", FIELDS).first()
        assert (r.id, r.n, r.on, r.m, r.x) == (doc["id"], doc["n"], doc["on"], doc["m"], doc.get("x"))
    else:
        with pytest.raises(ContractError):
            documents.read(df, ["k"], "_doc", FIELDS)


def test_the_nearest_point_of_a_pixel_is_seen(spark):
    rng = np.random.default_rng(3)
    rows = [(f, u, v, float(rng.choice([0.4, 1.0, 1.5, 2.0, 9.0]))) for f in (0, 1) for u in range(12) for v in range(9)]
    matrix = ((1.0, 0.0, 0.0, 0.3), (0.0, 1.0, 0.0, 0.0), (0.0, 0.0, 1.0, -0.5), (0.0, 0.0, 0.0, 1.0))
    points = cloud.points_of(spark.createDataFrame(rows, "f int, u long, v long, depth double"), ["f"], lambda u, v: vec.vec((u - 6) / 10, (v - 4) / 10, F.lit(1.0)), 0.3, 5.0)
    seen = cloud.splatted(points, ["f"], matrix, lambda p: vec.project(p, (5.0, 5.0, 3.0, 2.0)), (6, 5))
    image = spark.createDataFrame([(f, u, v, f"{f}{u}{v}") for f in (0, 1) for u in range(5) for v in range(5)], "f int, pixel_u long, pixel_v long, colour string")
    got = {(r.f, r.u, r.v): (r.pixel_u, r.pixel_v, r.visible, r.colour) for r in cloud.coloured(seen, image, ["f"]).collect()}
    placed, front = {}, {}
    for f, u, v, d in rows:
        if not 0.3 <= d <= 5 or d - 0.5 <= 1e-6:
            continue
        x, y, z = (u - 6) / 10 * d + 0.3, (v - 4) / 10 * d, d - 0.5
        px = (round(5 * x / z + 3), round(5 * y / z + 2))
        if 0 <= px[0] < 6 and 0 <= px[1] < 5:
            placed[f, u, v] = px
            front[f, *px] = min(front.get((f, *px), (9, 0, 0)), (z, v, u))
    want = {k: (*px, front[k[0], *px][1:] == (k[2], k[1]), f"{k[0]}{px[0]}{px[1]}" if front[k[0], *px][1:] == (k[2], k[1]) and px[0] < 5 else None) for k, px in placed.items()}
    assert got == want and 0 < sum(v[2] for v in got.values()) < len(got)


def test_bent_chains_reach_their_tips(spark):
    """Bone lengths and tips are kept, both mirrors bend the same way round; out of reach is null, the ends of the range are not."""
    rng = np.random.default_rng(6)
    lengths = (0.5, 0.3, 0.25)
    a, b, c = lengths
    far = lambda q: math.hypot(a + b * math.cos(q) + c * math.cos(1.65 * q), b * math.sin(q) + c * math.sin(1.65 * q))
    distances = [*np.linspace(0.2, 1.2, 40), sum(lengths), sum(lengths) + 2e-6, far(bend.most_bend()), far(bend.most_bend()) - 2e-6, 0.0]
    rows = []
    for k, d in enumerate(distances):
        base, way, normal = rng.normal(size=3), rng.normal(size=3), rng.normal(size=3)
        rows.append((k, float(d), tuple(base.tolist()), tuple((base + way / np.linalg.norm(way) * d).tolist()), tuple(normal.tolist())))
    rows.append((len(rows), 0.9, (0.0, 0.0, 0.0), (0.9, 0.0, 0.0), (2.0, 0.0, 0.0)))
    df = spark.createDataFrame(rows, f"k int, d double, base {POINT}, tip {POINT}, normal {POINT}")
    chains = [bend.bent_chain(F.col("base"), F.col("tip"), lengths, F.col("normal"), s).alias(f"c{s + 1}") for s in (-1, 1)]
    for r in df.select("*", *chains).collect():
        reached = far(bend.most_bend()) - 1e-6 <= r.d <= sum(lengths) + 1e-6 and r.k != len(rows) - 1
        assert (r.c0 is not None) == (r.c2 is not None) == reached, r
        for chain in (r.c0, r.c2) if reached else ():
            p = [np.array(tuple(x)) for x in (r.base, chain.middle, chain.last, r.tip)]
            assert [np.linalg.norm(y - x) for x, y in zip(p, p[1:], strict=False)] == pytest.approx(lengths, abs=2e-6)
            assert far(math.radians(chain.bend)) == pytest.approx(r.d, abs=2e-6) and -1e-9 <= chain.bend <= 110
            turns = [np.cross(q - o, s - q) for o, q, s in zip(p, p[1:], p[2:], strict=False)]
            assert turns[0] @ turns[1] >= -1e-9
        if reached and r.c0.bend > 1:
            assert np.linalg.norm(np.array(tuple(r.c0.middle)) - np.array(tuple(r.c2.middle))) > 1e-4


def test_draws_can_be_repeated_and_are_normal(spark):
    df = spark.range(20_000).select("id", sensitivity.normals("seed", F.col("id")).alias("n"))
    rows = df.repartition(7).collect()
    again = {r.id: r.n for r in df.collect()}
    assert all(again[r.id] == r.n for r in rows)
    x = np.array([[r.n.a, r.n.b] for r in rows])
    assert abs(x.mean(0)).max() < 0.03 and abs(x.std(0) - 1).max() < 0.03 and abs(np.corrcoef(x.T)[0, 1]) < 0.03 and abs((x**3).mean(0)).max() < 0.1


def test_table_pose_is_the_one_that_markers_were_placed_by(spark):
    """Markers put on a known table and projected: the pose comes back; mirrored labels and parallel arms give none."""
    normal = np.array([0.1, -0.6, -0.8])
    n = normal / np.linalg.norm(normal)
    x = np.cross(n, [0.3, 1.0, 0.0])
    x /= np.linalg.norm(x)
    y = np.cross(n, x)
    distance = -1200.0
    origin = n * distance + 40 * x - 25 * y
    lens = (600.0, 610.0, 320.0, 240.0)

    def pixel(p):
        p = p + 30 * n
        return (float(lens[0] * p[0] / p[2] + lens[2]), float(lens[1] * p[1] / p[2] + lens[3]))

    long, short = [origin + 250 * x, origin - 90 * x], [origin - 60 * y, origin + 180 * y]
    cases = {"good": [*long, *short], "mirrored": [*long, origin + 60 * y, origin - 180 * y], "parallel": [*long, origin + 40 * y, origin + 40 * y + 100 * x]}
    rows = [(k, *[pixel(p) for p in ps]) for k, ps in cases.items()]
    df = spark.createDataFrame(rows, "k string, " + ", ".join(f"{m} struct<u:double,v:double>" for m in "abcd"))
    got = {r.k: r.pose for r in sensitivity.with_pose(df, list("abcd"), "pose", normal.tolist(), distance, 30.0, lens).collect()}
    assert np.allclose(tuple(got["good"].origin), origin, atol=1e-6) and np.allclose(tuple(got["good"].x), x) and np.allclose(tuple(got["good"].y), y) and got["good"].apart == pytest.approx(90)
    assert got["mirrored"] is None and got["parallel"] is None


def test_conditioned_poses(spark):
    """Any rotation by frame, one scale for all: bones keep their lengths, roots are the given ones, frames without a fit have no points."""
    rng = np.random.default_rng(9)
    local = rng.normal(size=(6, 3))
    pairs, frames, want = [], [], {}
    for f in range(9):
        turn = np.linalg.qr(rng.normal(size=(3, 3)))[0]
        turn *= np.sign(np.linalg.det(turn))
        scale = [0.8, 1.0, 1.2, 5.0][f % 4]
        root = rng.normal(size=3)
        if f != 7:
            pairs += [("h", f, tuple(p.tolist()), tuple((scale * turn @ p).tolist())) for p in local[1:] - local[0]]
        frames.append(("h", f, [tuple(p.tolist()) for p in local], None if f == 8 else tuple(root.tolist())))
        want[f] = None if f >= 7 else (local - local[0]) @ turn.T * 1.0 + root + [1, 2, 3]
    frames.append(("other", 0, frames[0][2], frames[0][3]))
    fits = conditioned.frame_fits(spark.createDataFrame(pairs, f"side string, frame int, s {POINT}, t {POINT}"), ["side"])
    scales = conditioned.retained_scale(fits, ["side"])
    found = scales.first()
    assert (found.samples, round(found.retained, 9)) == (7, 1.0)
    got = conditioned.conditioned(spark.createDataFrame(frames, f"side string, frame int, points array<{POINT}>, root {POINT}"), fits, scales, ["side"], offset=(1, 2, 3))
    rows = {(r.side, r.frame): r.points for r in got.collect()}
    assert rows.pop(("other", 0)) is None
    for f, w in want.items():
        assert rows["h", f] is None if w is None else np.allclose([tuple(p) for p in rows["h", f]], w), f
    marks = spark.createDataFrame([("h", f, [tuple((want[f][2]).tolist()), None]) for f in range(3)], f"side string, frame int, markers array<{POINT}>")
    off = {(r.frame, r.marker): r.r for r in conditioned.residuals(got.where("side = 'h'"), marks, ["side"], [2, 3]).collect()}
    assert off[1, 0] == pytest.approx(0, abs=1e-9) and off[1, 1] is None and off[5, 0] is None


def test_inputs_are_free_of_targets(spark, tmp_path):
    """Dropping targets is enough if nothing is made of them; a column that hides one is an error; values don't change with the targets."""
    from kinestream.operators import contract

    spark.createDataFrame([(1, 2.0, 3.0), (2, 5.0, 7.0)], "id int, x double, y double").write.parquet(str(tmp_path / "a"))
    df = spark.read.parquet(str(tmp_path / "a"))
    got = contract.inputs_only(df.withColumn("twice", F.col("x") * 2), ["y"])
    assert got.columns == ["id", "x", "twice"] and sorted(map(tuple, got.collect())) == [(1, 2.0, 4.0), (2, 5.0, 10.0)]
    for hidden in (df.withColumn("leak", F.col("y") + 1), df.where("y > 3"), df.join(df.groupBy("id").agg(F.max("y").alias("best")), "id")):
        with pytest.raises(ContractError, match="y"):
            contract.inputs_only(hidden, ["y"])


def test_where_rays_meet_the_table(spark):
    rows = [(u, v) for u in range(6) for v in range(5)]
    up = (0.0, -0.6, -0.8, 1000.0)
    got = cloud.on_table(spark.createDataFrame(rows, "u long, v long"), lambda u, v: vec.vec((u - 3) / 2, (v - 3) * 2, F.lit(1.0)), up, ((1, 0, 0, 10), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1)), lambda p: vec.project(p, (2.0, 2.0, 3.0, 3.0)), (5, 6), 300, 1300).collect()
    assert len(got) == len(rows)
    for r in got:
        ray = np.array([(r.u - 3) / 2, (r.v - 3) * 2, 1.0])
        slope = ray @ np.array(up[:3])
        z = -up[3] / slope if abs(slope) > 1e-12 and -up[3] / slope > 0 else None
        assert r.expected_z == (None if z is None else pytest.approx(z))
        if z is not None:
            x, y, w = ray * z + [10, 0, 0]
            px = (round(2 * x / w + 3), round(2 * y / w + 3))
            assert (r.pixel_u, r.pixel_v) == px and r.inside == (300 <= z <= 1300 and 0 <= px[0] < 5 and 0 <= px[1] < 6)
        else:
            assert not r.inside
