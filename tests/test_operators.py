"""Filters, statistics, contracts, geometry and fits on small stated inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinestream.functions import vec
from kinestream.operators import contract, fit, seqwin, smooth, stats


def stream(spark, values):
    return spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(values)], "stream long, i long, value double")


@pytest.mark.parametrize(("edge", "mode"), [("reflect", "reflect"), ("edge", "edge")])
@pytest.mark.parametrize("block", [3, 4096])
def test_filters_equal_padded_sums(spark, edge, mode, block):
    x = np.random.default_rng(1).normal(size=17)
    w = seqwin.gaussian_weights()
    want = np.convolve(np.pad(x, 4, mode=mode), w, "valid")
    got = [r.smooth for r in seqwin.filtered(stream(spark, x), w, edge, block=block).orderBy("i").collect()]
    assert np.allclose(got, want, atol=1e-12)


def test_short_streams_have_no_filter(spark):
    assert [r.smooth for r in seqwin.filtered(stream(spark, [1, 2]), seqwin.BINOMIAL).collect()] == [None, None]


def test_gradient_is_numpy(spark):
    x = np.random.default_rng(2).normal(size=9)
    got = [r.gradient for r in seqwin.gradient(stream(spark, x), 0.5).orderBy("i").collect()]
    assert np.allclose(got, np.gradient(x, 0.5))


def test_signs_restart_after_a_zero_product(spark):
    q = [1.0, -1.0, -2.0, 0.0, 3.0, -3.0]
    for block in (2, 4096):
        w = seqwin.neighbours(stream(spark, q), "value", [-1], block=block)
        w = w.withColumn("dot", F.col("value") * F.col("value_-1"))
        assert [r.sign for r in seqwin.continuous_signs(w, "dot", block=block).orderBy("i").collect()] == [1, -1, -1, 1, 1, -1]


def test_distribution_ignores_what_is_not_finite(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", float("nan")), ("a", float("inf")), ("b", None)], "k string, v double")
    rows = {r.k: r for r in stats.distribution(df, ["k"], "v", {"median": 0.5}, ("max", "rmse")).collect()}
    assert (rows["a"]["count"], rows["a"].median, rows["a"].max) == (2, 2.0, 3.0) and math.isclose(rows["a"].rmse, math.sqrt(5))
    assert rows["b"]["count"] == 0 and rows["b"].median is None


def test_denominators(spark):
    df = spark.createDataFrame([(10.0, True), (60.0, True), (None, False), (None, False)], "r double, f boolean")
    r = stats.threshold_fractions(df, [], "r", "f", (50,)).first()
    assert (r.requested, r.in_frame, r.local, r.within_50, r.within_50_of_requested, r.within_50_of_local) == (4, 2, 2, 1, 0.25, 0.5)


def test_contracts(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("b", 3), ("b", 5), ("c", 1), ("c", 1)], "s string, i long")
    v = {r.s: (r.increasing, r.contiguous, r.from_zero) for r in contract.sequence_verdict(df, ["s"], "i").collect()}
    assert v == {"a": (True, True, True), "b": (True, False, False), "c": (False, False, False)}
    with pytest.raises(contract.ContractError):
        contract.enforce(contract.split_leakage(spark.createDataFrame([("g", 1), ("g", 2)], "k string, split long"), "k", "split"), "leak")
    a, b = (spark.createDataFrame([(x,) for x in k], "f string") for k in (["x", "y"], ["y", "z"]))
    assert {tuple(r) for r in contract.closure(a, b, "f").collect()} == {("x", "missing"), ("z", "extra")}


def test_one_to_one(spark):
    t = lambda x: spark.createDataFrame([(1, v) for v in x], "s long, t long")
    assert contract.one_to_one(t([100, 300]), t([100, 300]), "t", ["s"]).first().exact
    r = contract.one_to_one(t([100, 300, 300]), t([100, 300]), "t", ["s"]).first()
    assert not r.exact and r.left_repeats == 1


def test_lens_round_trip(spark):
    k = (0.08, -0.05, 0.01, 0.02, 0.01, 0.003, 0.001, -0.002)
    x, y = vec.distort(F.lit(0.3), F.lit(-0.2), k)
    r = spark.range(1).select(vec.undistort(x, y, k).alias("p")).first().p
    assert abs(r.x - 0.3) < 1e-9 and abs(r.y + 0.2) < 1e-9


def test_rotations_agree(spark):
    q = vec.quat(math.cos(0.3), 0.0, 0.0, math.sin(0.3))
    r = spark.range(1).select(vec.rotate(vec.quat_matrix(q), vec.vec(1, 0, 0)).alias("a"), vec.rodrigues(vec.vec(1, 0, 0), vec.vec(0, 0, 1), F.lit(0.6)).alias("b"), vec.quat_matrix(vec.quat(0, 0, 0, 0)).alias("none")).first()
    assert np.allclose([r.a.x, r.a.y], [math.cos(0.6), math.sin(0.6)]) and np.allclose([r.a.x, r.a.y], [r.b.x, r.b.y]) and r.none is None


def test_sphere_maps_are_inverse(spark):
    a, b = vec.vec(1, 0, 0), vec.unit(vec.vec(1.0, 2.0, -0.5))
    r = spark.range(1).select(vec.sphere_exp(a, vec.sphere_log(a, b)).alias("c"), b.alias("b")).first()
    assert np.allclose(list(r.c), list(r.b))


def test_similarity_recovers_turn_and_scale(spark):
    rng = np.random.default_rng(0)
    c, s = math.cos(math.radians(23)), math.sin(math.radians(23))
    turn = np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]])
    rows = []
    for f in range(20):
        for p in rng.normal(size=(4, 3)) * 50:
            t = 0.91 * turn @ p + (500 if f == 3 else 0)
            rows.append(("k", f, tuple(map(float, p)), tuple(map(float, t))))
    df = spark.createDataFrame(rows, "k string, frame long, s struct<x:double,y:double,z:double>, t struct<x:double,y:double,z:double>")
    r = fit.similarity(df, ["k"]).first()
    assert abs(r.scale - 0.91) < 1e-12 and np.allclose(np.array(r.rotation).reshape(3, 3), turn, atol=1e-12) and 15 <= r.frames <= 19


def test_plane(spark):
    rng = np.random.default_rng(3)
    p = [(1, float(x), float(y), 2.0 + float(e)) for x, y, e in rng.normal(size=(200, 3)) * (10, 10, 0.01)] + [(1, float(x), 0.0, float(z)) for x, z in rng.normal(size=(40, 2)) * 30]
    r = fit.plane(spark.createDataFrame(p, "k long, x double, y double, z double"), ["k"], 0.1).first()
    assert abs(abs(r.nz) - 1) < 1e-3 and abs(abs(r.d) - 2) < 0.01 and r.inliers >= 200


def test_smoother_is_the_conditional_mean():
    """The joint normal distribution of all states, conditioned on all measurements."""
    rng, n, dt = np.random.default_rng(3), 14, 1 / 30
    z = np.cumsum(rng.normal(0, 20, (n, 2)), axis=0)
    move, push = np.array([[1, dt], [0, 1]]), np.array([dt * dt / 2, dt])
    cov = np.zeros((2 * n, 2 * n))
    cov[:2, :2] = np.diag([16.0, 1e4])
    for k in range(1, n):
        cov[2 * k : 2 * k + 2, : 2 * k] = move @ cov[2 * k - 2 : 2 * k, : 2 * k]
        cov[: 2 * k, 2 * k : 2 * k + 2] = cov[2 * k : 2 * k + 2, : 2 * k].T
        cov[2 * k : 2 * k + 2, 2 * k : 2 * k + 2] = move @ cov[2 * k - 2 : 2 * k, 2 * k - 2 : 2 * k] @ move.T + np.outer(push, push) * 900.0**2
    seen = np.arange(2, 2 * n, 2)
    shift = cov[np.ix_(np.arange(0, 2 * n, 2), seen)] @ np.linalg.solve(cov[np.ix_(seen, seen)] + 16 * np.eye(n - 1), z[1:] - z[0])
    assert np.allclose(smooth.constant_velocity(z, 30.0), z[0] + shift, atol=1e-6)
    assert np.array_equal(smooth.constant_velocity(z[:1], 30.0), z[:1])


def test_guided_directions_are_their_definition(spark):
    rng = np.random.default_rng(5)
    raw, guide = rng.normal(size=(12, 2, 3)), rng.normal(size=(12, 2, 3))
    rows = [(1, i, raw[i].ravel().tolist(), guide[i].ravel().tolist()) for i in range(12)] + [(2, i, [1.0, 0.0, 0.0] * 2, [0.0, 1.0, 0.0] * 2) for i in range(4)]
    out = smooth.posterior(spark.createDataFrame(rows, "take int, f long, r array<double>, g array<double>"), ["take"], "f", "r", "g", 0.5).collect()
    r, g = (v / np.linalg.norm(v, axis=2, keepdims=True) for v in (raw, guide))
    turn = np.arccos(np.clip((r * g).sum(2), -1, 1))[..., None]
    flat = r - (r * g).sum(2, keepdims=True) * g
    step = flat / np.linalg.norm(flat, axis=2, keepdims=True) * turn
    wide = np.concatenate([step[4:0:-1], step, step[-2:-6:-1]])
    step = sum(w * wide[k : k + 12] for k, w in enumerate(seqwin.gaussian_weights()))
    step -= (step * g).sum(2, keepdims=True) * g
    size = np.linalg.norm(step, axis=2, keepdims=True)
    by = 0.5 * np.minimum(size, np.pi / 3)
    want = np.cos(by) * g + np.sin(by) * step / size
    got = {(x.take, x.f): x.direction for x in out}
    assert np.allclose([got[1, i] for i in range(12)], want.reshape(12, 6), atol=1e-9) and [got[2, i] for i in range(4)] == [None] * 4


def test_kernel_ridge_is_the_kernel_times_weights():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(30, 5)), rng.normal(size=(30, 2))
    far = np.linalg.norm(x[:, None] - x[None], axis=2)
    width = np.median(np.sort(far, axis=1)[:, 1])
    kernel = np.exp(-(far**2) / (2 * width**2))
    assert np.allclose(smooth.kernel_ridge(x, y, 0.1), kernel @ np.linalg.inv(kernel + 0.1 * np.eye(30)) @ y)


@pytest.mark.parametrize("parts", [1, 7])
def test_split_percentiles(spark, parts):
    rng = np.random.default_rng(4)
    rows = [("a", float(x)) for x in rng.integers(0, 30, 400)] + [("b", float(x)) for x in rng.normal(size=301)] + [(None, 2.0), (None, 4.0), ("c", None), ("d", float("nan")), ("d", 1.5)]
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = {r.k: (r.p0, r.p33, r.p95, r.p100) for r in stats.split_percentiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", {"p0": 0, "p33": 0.33, "p95": 0.95, "p100": 1}).collect()}
        whole = stats.split_percentiles(spark.createDataFrame(rows, "k string, v double").where("k = 'a'"), [], "v", {"m": 0.5}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    for k in ("a", "b"):
        assert np.allclose(got[k], np.percentile([v for x, v in rows if x == k], [0, 33, 95, 100]))
    assert np.allclose(got[None], [2, 2.66, 3.9, 4]) and got["d"] == (1.5,) * 4 and "c" not in got
    assert whole[0].m == np.median([v for x, v in rows if x == "a"])


def test_planes_that_nothing_fixes(spark):
    rows = [("one", 0.0, 0.0, 0.0), ("line", 0.0, 0.0, 0.0), ("line", 1.0, 0.0, 0.0), ("line", 2.0, 0.0, 0.0), ("none", None, 1.0, 2.0)]
    got = {r.k: r for r in fit.plane(spark.createDataFrame(rows, "k string, x double, y double, z double"), ["k"], 0.1).collect()}
    assert {k: (r.nx, r.inliers, r.points) for k, r in got.items()} == {"one": (None, 0, 1), "line": (None, 0, 3), "none": (None, 0, 1)}


def test_filters_keep_rows_without_an_index(spark):
    rows = [(1, i, float(i)) for i in range(6)] + [(1, None, 9.0)] + [(2, i, 1.0) for i in (0, 1, 2, 2, 4, 5)] + [(None, i, 2.0) for i in range(6)]
    df = spark.createDataFrame(rows, "stream long, i long, value double")
    got = seqwin.filtered(df, [0.25, 0.5, 0.25]).collect()
    assert len(got) == len(rows)
    assert [r.smooth for r in sorted((r for r in got if r.stream is None), key=lambda r: r.i)] == [2.0] * 6
    assert all(r.smooth is None for r in got if r.stream == 1), "a row without an index makes the counts differ"
    assert sorted(r.i for r in got if r.stream == 2 and r.smooth is None) == [2, 2, 4]
    near = seqwin.neighbours(df, "value", [-1]).collect()
    assert len(near) == len(rows) and [r["value_-1"] for r in near if r.i is None] == [None]


def test_chains_are_products_of_turns(spark):
    """Twenty joints whose axes turn along their fingers, against matrix products."""
    rng = np.random.default_rng(6)
    turns, offsets = rng.normal(0, 0.7, (20, 3)), rng.normal(size=(20, 3))
    turns[3] = [1e-5, 0, -2e-5]

    def matrix(v):
        k = np.array([[0, -v[2], v[1]], [v[2], 0, -v[0]], [-v[1], v[0], 0]])
        term, total = np.eye(3), np.eye(3)
        for i in range(1, 30):
            term = term @ k / i
            total = total + term
        return total

    places, axes = [np.zeros(3)], [matrix(turns[0])]
    for j, p in enumerate(vec.PARENTS[1:], 1):
        places.append(places[p] + axes[p] @ offsets[j])
        axes.append(axes[p] @ matrix(turns[j]))
    chain = vec.chain_frames([vec.turn_exp(vec.vec(*v)) for v in turns], [vec.vec(*v) for v in offsets])
    got = spark.range(1).select(chain.alias("c")).first().c
    assert np.allclose([tuple(x) for x in got], places, atol=1e-9)


def test_lines_and_planes_without_a_point(spark):
    x, y = vec.vec(1, 0, 0), vec.vec(0, 1, 0)
    none = [vec.lines_midpoint(vec.vec(0, 0, 0), x, y, vec.add(x, y)), vec.square_axes(x, x), vec.on_plane(x, y, 1.0), vec.square_axes(vec.vec(0, 0, 0), y)]
    met = vec.lines_midpoint(vec.vec(0, 0, 0), x, vec.vec(3, 4, 2), vec.vec(3, 5, 2))
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate([*none, met])]).first()
    assert list(row[:4]) == [None] * 4 and tuple(row.c4) == (3.0, 0.0, 1.0)


def test_contracts_between_tables(spark):
    a = spark.createDataFrame([(1, 5.0, "x"), (2, 6.0, "y"), (3, None, "z"), (None, 1.0, "n")], "k long, v double, h string")
    b = spark.createDataFrame([(1, 5.0, "x"), (2, 6.5, "q"), (None, 1.0, "n")], "k long, v double, h string")
    got = {r.k: (r.found, r.differing, r.digest_holds) for r in contract.provenance(a, b, ["k"], ["v"], "h").collect()}
    assert got == {1: (True, [], True), 2: (True, ["v"], False), 3: (False, [], False), None: (True, [], True)}
    assert {r.k: r.status for r in contract.manifest_status(a.where("k is not null"), b.where("k = 1 or k = 2"), "k", "h").collect()} == {1: "same", 2: "changed", 3: "missing"}
    assert {r.k: r.agrees for r in contract.agreement(a.where("k is not null"), b.where("k is not null"), ["k"], ["v"], 0.1).collect()} == {1: True, 2: False, 3: False}
    assert [r.failures for r in contract.failures(a, {"v": F.col("v") > 5, "k": F.col("k") > 1}).orderBy("h").collect()] == [["v", "k"], ["v", "k"], [], ["v"]]
    assert contract.accepted(a, [], {"most": F.max("v") < 9, "none": F.max(F.lit(None).cast("int")) > 1}).first().asDict() == {"most": True, "none": False, "pass": False}
