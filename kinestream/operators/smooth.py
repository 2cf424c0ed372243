"""Smoothers of whole sequences: constant velocity with hindsight, guided directions, kernel ridge regression.

Guided directions are column expressions and a filter over blocks, for sequences of any length. The other two
carry state or compare all frames of a sequence, so a bounded recording (a take) is one pandas group and many are
many tasks; longer ones than stated are refused, not cut: split them at their gaps first (``temporal.islands``).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinestream.functions import vec
from kinestream.operators import seqwin
from kinestream.operators.temporal import joined, numbered

MAX_FRAMES = 1_000_000


def gain_table(frames: int, dt: float, measured: float, pushed: float) -> np.ndarray:
    """For each frame but the first: a, b, c (variance of the predicted place, its covariance with speed, variance of speed) before the frame's
    measurement. The data don't matter, so one table serves all coordinates.

    Between frames the place moves by speed * dt and an acceleration of deviation ``pushed``; a measurement has deviation ``measured``. The
    first frame is taken as measured, with a speed of zero whose variance is 10,000.
    """
    q, out = pushed * pushed, np.empty((max(frames - 1, 0), 3))
    a, b, c = measured * measured, 0.0, 1e4
    for k in range(frames - 1):
        a, b, c = a + dt * (2 * b + dt * c) + q * dt**4 / 4, b + dt * c + q * dt**3 / 2, c + q * dt * dt
        out[k] = a, b, c
        keep = measured * measured / (a + measured * measured)
        a, b, c = keep * a, keep * b, c - b * b / (a + measured * measured)
    return out


def constant_velocity(values: np.ndarray, fps: float, measured: float = 4.0, pushed: float = 900.0) -> np.ndarray:
    """The places (frames x coordinates) that are most probable given all frames, under the model of ``gain_table``.

    The adjoint form (Bryson and Frazier): forward, predictions and what each measurement adds to them; backward, the pull of all
    later measurements on a frame, which its variances turn into a shift. No matrix is inverted.
    """
    dt, table, noise = 1.0 / fps, gain_table(len(values), 1.0 / fps, measured, pushed), measured * measured
    place, speed = values[0].copy(), np.zeros(values.shape[1])
    ahead, news = np.zeros_like(values), np.zeros_like(values)
    for k, (a, b, _) in enumerate(table, 1):
        place = place + dt * speed
        ahead[k], news[k] = place, (values[k] - place) / (a + noise)
        place, speed = place + a * news[k], speed + b * news[k]
    on_place, on_speed = np.zeros(values.shape[1]), np.zeros(values.shape[1])
    out = np.empty_like(values)
    for k in range(len(values) - 1, 0, -1):
        a, b, _ = table[k - 1]
        # The pull before the measurement is its own news and what the gains leave of the pull behind it.
        on_place = news[k] + on_place - (a * on_place + b * on_speed) / (a + noise)
        out[k] = ahead[k] + a * on_place + b * on_speed
        on_speed = on_speed + dt * on_place
    out[0] = values[0] + noise * on_place
    return out


def _by_sequence(df: DataFrame, keys: list[str], order: str, columns: list[str], out: str, most: int, made: Callable[..., np.ndarray]) -> DataFrame:
    """keys, order and ``out``: what ``made`` gives for the stacked array columns of each sequence in order."""
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*keys, order]) + f", `{out}` array<double>"

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        if len(frame) > most:
            raise ValueError(f"a sequence of {len(frame)} frames, of {most} at most; split it at its gaps")
        frame = frame.sort_values(order, kind="stable")
        return frame[[*keys, order]].assign(**{out: list(made(*[np.stack(frame[c]).astype(float) for c in columns]))})

    return df.select(*keys, order, *columns).groupBy(*keys).applyInPandas(run, schema)


def rts(df: DataFrame, keys: list[str], order: str, values: str, fps: float, out: str = "smooth") -> DataFrame:
    """``constant_velocity`` of an array column per sequence: keys, order, ``out``."""
    return _by_sequence(df, keys, order, [values], out, MAX_FRAMES, lambda v: constant_velocity(v, fps))


def posterior(df: DataFrame, keys: list[str], order: str, raw: str, guide: str, gain: float, out: str = "direction", limit: float = np.pi / 3) -> DataFrame:
    """The guide's directions, turned by ``gain`` of the smoothed angle to the raw ones, of which ``limit`` at most counts.

    ``raw`` and ``guide`` are flat arrays of vectors, as many in all rows. The step from guide to raw is taken in the guide's tangent plane, filtered
    along the sequence by nine Gaussian taps, and brought back into the plane of its frame. Directions that are opposite or
    have no length give no step. A sequence of four frames or fewer has no filter: its directions are null.
    """
    dense = numbered(df.select(*keys, order, raw, guide), keys, [F.col(order)], order, "i", 4096)
    vectors = F.sequence(F.lit(0), (F.size(guide) / 3).cast("int") - 1)
    of = lambda c, j: vec.unit(vec.vec(*[F.get(F.col(c), 3 * j + k).cast("double") for k in range(3)]))
    each = dense.select(*keys, order, "i", F.inline(F.transform(vectors, lambda j: F.struct(j.alias("j"), of(raw, j).alias("r"), of(guide, j).alias("g")))))
    step = F.coalesce(vec.sphere_log(F.col("g"), F.col("r")), vec.vec(0, 0, 0))
    rows = each.select(*keys, order, "i", "j", "g", F.struct(*keys, "j").alias("stream"), step.alias("t")).select("*", *[F.col(f"t.{a}").alias(f"t{a}") for a in "xyz"])
    smooth = seqwin.filtered(rows, seqwin.gaussian_weights(), value=["tx", "ty", "tz"], name=["sx", "sy", "sz"])
    flat = lambda s, g: vec.sub(s, vec.scale(g, vec.dot(s, g)))
    turned = lambda t, g: vec.let(vec.norm(t), lambda n: vec.sphere_exp(g, vec.scale(t, F.when(n > limit, limit / n).otherwise(1.0) * gain)))
    made = smooth.withColumn("t", flat(F.struct(*[F.col(f"s{a}").alias(a) for a in "xyz"]), F.col("g"))).withColumn("d", F.when(F.col("sx").isNotNull(), turned(F.col("t"), F.coalesce("g", vec.vec(0, 0, 0)))))
    listed = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("j", "d"))), lambda x: F.array(*[F.coalesce(x["d"][a], F.lit(0.0)) for a in "xyz"])))
    grouped = made.groupBy(*keys, order, "i").agg(F.when(F.count("sx") > 0, listed).alias(out))
    return joined(df.select(*keys, order), grouped.select(*keys, order, out), [*keys, order])


def kernel_ridge(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """The values at ``x`` of Gaussian kernel ridge regression of ``y`` on ``x``.

    The dual form (Saunders, Gammerman and Vovk 1998): weights w = (K + ridge I)^-1 y, so that K w = y - ridge w. The kernel's width is the median
    distance of a frame to the nearest other one.
    """
    far = np.square(x[:, None, :] - x[None, :, :]).sum(-1) if x.size < 1_000_000 else np.maximum((x * x).sum(1)[:, None] + (x * x).sum(1) - 2 * x @ x.T, 0)
    near = np.sort(far, axis=1)[:, min(1, len(x) - 1)]
    near = np.sqrt(near[near > 1e-12])
    kernel = np.exp(far / (-2 * np.median(near) ** 2 if len(near) else -2.0))
    return y - ridge * np.linalg.solve(kernel + ridge * np.eye(len(x)), y)


def kernel_fit(df: DataFrame, keys: list[str], order: str, raw: str, target: str, fps: float, ridge: float = 1e-8, out: str = "fitted", most: int = 4000) -> DataFrame:
    """``kernel_ridge`` of ``target`` on ``raw`` and its gradient, fitted and applied to the same sequence.

    Features without spread are left out, the others have deviation 1 and are divided by the root of their number. All frames of a sequence are compared
    with each other, so one of more than ``most`` frames is refused.
    """

    def made(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        wide = np.hstack([x, np.gradient(x, 1 / fps, axis=0)]) if len(x) > 1 else x
        spread = wide.std(0)
        used = spread > 1e-9
        return kernel_ridge((wide - wide.mean(0))[:, used] / spread[used] / max(used.sum(), 1) ** 0.5, y, ridge)

    return _by_sequence(df, keys, order, [raw, target], out, most, made)
