"""Registrations frozen on one take, and the motion lag between two streams, against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinestream.operators import holdout, motion
from kinestream.operators.contract import ContractError

POINT = "struct<x:double,y:double,z:double>"
PAIRS = f"side string, take int, frame int, s {POINT}, t {POINT}"


def turn_about(axis, angle):
    x, y, z = np.array(axis) / np.linalg.norm(axis)
    k = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
    return np.eye(3) + math.sin(angle) * k + (1 - math.cos(angle)) * k @ k


def pairs_of(spark, turns, frames=20, noise=0.0, bad=()):
    """turns: (side, take) -> (scale, rotation)."""
    rng = np.random.default_rng(4)
    rows = []
    for (side, take), (scale, turn) in turns.items():
        for f in range(frames):
            for _ in range(5):
                s = rng.normal(size=3)
                t = scale * turn @ s + rng.normal(size=3) * noise + (50.0 if (side, take, f) in bad else 0.0)
                rows.append((side, take, f, tuple(map(float, s)), tuple(map(float, t))))
    return spark.createDataFrame(rows, PAIRS)


@pytest.mark.parametrize("axis", [(0, 0, 1), (1, -2, 0.5)])
def test_turns_about_any_axis(spark, axis):
    turn = turn_about(axis, 2.4)
    got = holdout.turn_fit(pairs_of(spark, {("l", 0): (0.93, turn)}), ["side"], axis).first()
    assert got.scale == pytest.approx(0.93) and got.angle == pytest.approx(2.4) and np.allclose(np.array(got.rotation).reshape(3, 3), turn) and got.points == 100


def test_turn_is_the_least_square(spark):
    """No other angle and scale has a smaller sum, noise or not."""
    df = pairs_of(spark, {("l", 0): (0.9, turn_about((0, 0, 1), 0.4))}, noise=0.5)
    got = holdout.turn_fit(df, ["side"]).first()
    s, t = (np.array([tuple(r[c]) for r in df.select("s", "t").collect()]) for c in (0, 1))

    def off(scale, angle):
        return ((scale * s @ turn_about((0, 0, 1), angle).T - t) ** 2).sum()

    best = off(got.scale, got.angle)
    assert all(best <= off(got.scale + a, got.angle + b) for a in (-1e-3, 0, 1e-3) for b in (-1e-3, 0, 1e-3))


def test_models_are_frozen(spark, tmp_path):
    """Rows of other takes never change the model; what they would fit by themselves is another one; held-out rows are marked."""
    base, other = turn_about((0, 0, 1), 0.3), turn_about((0, 0, 1), 1.2)
    turns = {("l", 0): (0.9, base), ("r", 0): (1.1, base), ("l", 1): (0.5, other), ("r", 2): (2.0, other)}
    df = pairs_of(spark, turns, bad={("l", 0, 3), ("l", 0, 7)})
    models = holdout.frozen(df, ["side"], "take", 0)
    alone = holdout.frozen(df.where("take = 0"), ["side"], "take", 0)
    assert sorted(map(tuple, models.collect())) == sorted(map(tuple, alone.collect()))
    by = {r.side: r for r in models.collect()}
    assert by["l"].scale == pytest.approx(0.9) and by["l"].frames == 18 and by["l"].refined and by["l"].source_take == 0 and by["l"].residual_p95 == pytest.approx(0, abs=1e-9)
    rows = holdout.applied(df, models, ["side"], "take")
    assert rows.count() == df.count()
    found = {(r.side, r.take): r for r in holdout.protocol(rows, ["side"], "take").collect()}
    assert {k: v.held_out for k, v in found.items()} == {("l", 0): False, ("r", 0): False, ("l", 1): True, ("r", 2): True}
    assert found["r", 0].median == pytest.approx(0, abs=1e-9) and found["l", 1].median > 0.1 and found["l", 1].requested == found["l", 1].measured == 100
    holdout.save(models, ["side"], str(tmp_path / "models"))
    again = holdout.load(spark, ["side"], str(tmp_path / "models"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, models.collect()))
    with pytest.raises(Exception, match="(?i)exist"):
        holdout.save(models, ["side"], str(tmp_path / "models"))


def test_models_that_are_none(spark, tmp_path):
    df = pairs_of(spark, {("l", 0): (0.9, np.eye(3))})
    models = holdout.frozen(df, ["side"], "take", 0)
    with pytest.raises(ValueError, match="two models"):
        holdout.save(models.union(models), ["side"], str(tmp_path / "twice"))
    with pytest.raises(ValueError, match="source take"):
        holdout.save(models.withColumn("source_take", F.lit(None).cast("int")), ["side"], str(tmp_path / "none"))
    models.withColumn("more", F.lit(1)).drop("scale").write.parquet(str(tmp_path / "odd"))
    with pytest.raises(ValueError, match="scale, more"):
        holdout.load(spark, ["side"], str(tmp_path / "odd"))


def test_groups_without_a_model(spark):
    """On the axis, without a source row, with null points and null sides: rows stay, residuals are null."""
    rows = [("axis", 0, i, (0.0, 0.0, 1.0), (0.0, 0.0, 2.0)) for i in range(12)] + [("late", 1, 0, (1.0, 0.0, 0.0), (1.0, 0.0, 0.0)), ("axis", 1, 0, None, (1.0, 0.0, 0.0)), (None, 0, 0, (1.0, 2.0, 0.0), (2.0, 4.0, 0.0)), (None, 3, 0, (1.0, 0.0, 0.0), (2.0, 0.0, 1.0))]
    df = spark.createDataFrame(rows, PAIRS)
    models = holdout.frozen(df, ["side"], "take", 0)
    got = holdout.applied(df, models, ["side"], "take").collect()
    assert len(got) == len(rows)
    assert {r.r for r in got if r.side is not None} == {None}
    assert {(r.take, round(r.r, 9), r.held_out) for r in got if r.side is None} == {(0, 0.0, False), (3, 1.0, True)}


def lag_by_numpy(frames, source, lags, pixel, max_gap, width, least):
    """frames: (t, energy); source: (t, points)."""
    at = np.array([t for t, _ in source])
    points = np.array([p for _, p in source])
    energy = np.array([e for _, e in frames], float)
    out = {}
    for lag in lags:
        px = []
        for t, _ in frames:
            x = t + lag
            low, high = np.searchsorted(at, x, "right") - 1, np.searchsorted(at, x, "left")
            if low >= 0 and at[low] == x:
                px.append(pixel(points[low]))
            elif low >= 0 and high < len(at) and at[high] - at[low] <= max_gap:
                a = (x - at[low]) / (at[high] - at[low])
                px.append(pixel(points[low] + (points[high] - points[low]) * a))
            else:
                px.append(None)
        speed = np.array([np.nan] + [np.nan if a is None or b is None else np.median(np.linalg.norm(b - a, axis=-1)) for a, b in zip(px, px[1:], strict=False)])
        half = width // 2
        pairs = []
        for i in range(half, len(frames) - half):
            s, e = speed[i - half : i + half + 1], energy[i - half : i + half + 1]
            if np.isfinite(s).all() and np.isfinite(e).all():
                pairs.append((s.mean(), e.mean()))
        good = len(pairs) >= least and np.std([a for a, _ in pairs]) > 1e-12
        out[lag] = (np.corrcoef(np.array(pairs).T)[0, 1] if good else None, len(pairs))
    return out


@pytest.mark.parametrize("block", [512, 9])
def test_motion_lag_is_numpy_and_finds_the_shift(spark, block):
    """Also with blocks of nine frames, a gap in the source and a hole in the energy."""
    rng = np.random.default_rng(8)
    n, joints = 90, 4
    path = np.cumsum(rng.normal(size=(2 * n, joints, 3)) * (1 + np.sin(np.arange(2 * n) / 5))[:, None, None] ** 2, axis=0) * 0.01
    source = [(20_000 * i + int(rng.integers(0, 3000)), path[i]) for i in range(2 * n) if i not in (60, 61, 62)]
    shift, lags = 30_000, [-30_000, 0, 15_000, 30_000, 60_000]
    truth = lag_by_numpy([(40_000 * i, 0.0) for i in range(n)], source, [shift], lambda p: 100 * p[..., :2], 50_000, 1, 0)
    assert truth
    at, points = np.array([t for t, _ in source]), np.array([p for _, p in source])

    def place(t):
        return np.stack([np.interp(t, at, points[:, j, k]) for j in range(joints) for k in range(2)])

    energy = [None] + [float(np.abs(place(40_000 * i + shift) - place(40_000 * (i - 1) + shift)).mean()) for i in range(1, n)]
    energy[40] = None
    frames = [(40_000 * i, energy[i]) for i in range(n)]
    want = lag_by_numpy([(t, np.nan if e is None else e) for t, e in frames], source, lags, lambda p: 100 * p[..., :2], 50_000, 7, 30)
    f = spark.createDataFrame([("s", i, t, e) for i, (t, e) in enumerate(frames)] + [(None, 0, 0, 1.0), ("s", None, 5, 1.0)], "stream string, i long, t long, energy double")
    s = spark.createDataFrame([("s", t, k, [tuple(map(float, x)) for x in p]) for k, (t, p) in enumerate(source)], f"stream string, t long, sample_id long, value array<{POINT}>")
    table = motion.lag_table(f, s, lags, lambda p: F.struct((100 * p["x"]).alias("u"), (100 * p["y"]).alias("v")), 50_000, block=block)
    got = {r.lag: (r.correlation, r.steps) for r in table.where("stream is not null").collect()}
    assert {k: n for k, (_, n) in got.items()} == {k: n for k, (_, n) in want.items()}
    for k, (c, _) in want.items():
        assert got[k][0] == (None if c is None else pytest.approx(c))
    best = {r.stream: r.lag for r in motion.best_lag(table).collect()}
    assert best == {"s": shift, None: None}


def test_lags_need_no_shuffle_each(spark):
    def shuffles(lags):
        f = spark.createDataFrame([("s", 0, 0, 1.0)], "stream string, i long, t long, energy double")
        s = spark.createDataFrame([("s", 0, 0, [(0.0, 0.0, 1.0)])], f"stream string, t long, sample_id long, value array<{POINT}>")
        plan = motion.lag_table(f, s, lags, lambda p: F.struct(p["x"].alias("u"), p["y"].alias("v")), 10)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        return plan.count("Exchange hash")

    assert shuffles(range(2)) == shuffles(range(50))


def test_medians_of_arrays(spark):
    rows = [([3.0, 1.0, 2.0], 2.0), ([4.0, 1.0], 2.5), ([5.0], 5.0), ([], None), (None, None)]
    got = spark.createDataFrame(rows, "v array<double>, want double").select(motion.middle(F.col("v")).alias("m"), "want").collect()
    assert all(r.m == r.want for r in got)


def test_ranges_that_are_none(spark, tmp_path):
    from kinestream.sources import rosbag

    with pytest.raises(ContractError):
        rosbag.read_range(spark, str(tmp_path), "/cam", 5, 4)
