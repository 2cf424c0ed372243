"""Poses turned to markers frame by frame, with one retained scale and a root of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinestream.functions import vec
from kinestream.operators import fit, holdout, stats
from kinestream.operators.temporal import joined

#: Scales of a frame that count for the retained one.
BOUNDS = (0.25, 2.5)


def frame_fits(pairs: DataFrame, keys: list[str], frame: str = "frame", axis: Sequence[float] | None = None) -> DataFrame:
    """keys, frame, scale, rotation of each frame: the rotation that brings s nearest to t (about ``axis``, if given) and the scale that is best with it."""
    found = fit.frame_alignment(pairs, [*keys, frame]) if axis is None else holdout.turn_fit(pairs, [*keys, frame], axis)
    return found.select(*keys, frame, "scale", "rotation")


def retained_scale(fits: DataFrame, keys: list[str], bounds: tuple[float, float] = BOUNDS) -> DataFrame:
    """keys, retained (the median of the frames' scales within ``bounds``), p05, p95 and samples; a group without such a frame has no row."""
    good = fits.where(F.col("scale").between(*bounds))
    order = stats.split_percentiles(good, keys, "scale", {"retained": 0.5, "p05": 0.05, "p95": 0.95})
    return joined(order, good.groupBy(*keys).agg(F.count("*").alias("samples")), keys)


def conditioned(local: DataFrame, fits: DataFrame, scales: DataFrame, keys: list[str], frame: str = "frame", offset: Sequence[float] = (0.0, 0.0, 0.0)) -> DataFrame:
    """keys, frame and points in the world: each frame's own rotation times the group's retained scale, from its own root, plus ``offset``.

    local: keys, frame, points (array of structs x, y, z, as seen from the first one) and root (where the first one is to be: a corrected root, not the fit's). A frame without a fit, without a root or
    of a group without a scale has null points: none is borrowed from a neighbour. The frame's own scale is not used, so bones keep their lengths over time.
    """
    rows = joined(joined(local, fits.select(*keys, frame, "rotation"), [*keys, frame]), scales.select(*keys, "retained"), keys)
    r = lambda i, j: F.get("rotation", F.lit(3 * i + j)) * F.col("retained")
    shift = vec.vec(*[F.lit(float(x)) for x in offset])

    def placed(p):
        q = vec.sub(p, F.get("points", F.lit(0)))
        turned = vec.let(q, lambda s: vec.vec(*[r(i, 0) * s["x"] + r(i, 1) * s["y"] + r(i, 2) * s["z"] for i in range(3)]))
        return vec.add(vec.add(turned, F.col("root")), shift)

    whole = F.col("rotation").isNotNull() & F.col("retained").isNotNull() & F.col("root").isNotNull()
    return rows.select(*keys, frame, F.when(whole, F.transform("points", placed)).alias("points"))


def residuals(poses: DataFrame, markers: DataFrame, keys: list[str], at: Sequence[int], frame: str = "frame") -> DataFrame:
    """keys, frame, marker, r: how far the pose's points ``at`` are from the frame's markers (an array in the same order); null where either is missing."""
    both = joined(poses, markers.select(*keys, frame, "markers"), [*keys, frame])
    each = F.array(*[F.struct(F.lit(i).alias("marker"), vec.norm(vec.sub(F.get("points", F.lit(j)), F.get("markers", F.lit(i)))).alias("r")) for i, j in enumerate(at)])
    return both.select(*keys, frame, F.inline(each))
