"""Lag between two streams from how much moves in both: projected speed of moving points against a signal at frames."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinestream.functions import vec
from kinestream.operators import stats, temporal

#: Frames of a block; a block takes the few frames beside it as copies.
BLOCK = 512


def middle(values: Column) -> Column:
    """The median of an array of numbers: the mean of the two in the middle if there is an even number; null for none."""
    in_order = F.array_sort(values)
    n = F.size(values)
    low, high = (F.get(in_order, F.floor((n + d) / 2).cast("int")) for d in (-1, 0))
    return F.when(n > 0, low + (high - low) / 2)


def step_median(now: Column, before: Column) -> Column:
    """The median over all points of how far each pixel moved, from two arrays of (u, v) structs in the same order.

    Points may come from several bodies, put one after the other. Null if any pixel is missing or the arrays differ in length.
    """
    far = F.zip_with(now, before, lambda a, b: F.hypot(a["u"] - b["u"], a["v"] - b["v"]))
    return F.when((F.size(now) == F.size(before)) & F.forall(far, lambda d: d.isNotNull()), middle(far))


def points_at(source: DataFrame, targets: DataFrame, max_gap: int, stream: str = "stream", bucket: int = temporal.BUCKET) -> DataFrame:
    """Arrays of points, interpolated by their places in the array at each target's time; null over gaps above ``max_gap`` and outside.

    source: stream, t, sample_id, value (array of structs x, y, z). targets: stream, t, query_id. Returns stream, query_id, t, points.
    """
    both = temporal.bracket(source, targets, stream, bucket)
    exact, span = F.col("low.t") == F.col("t"), F.col("high.t") - F.col("low.t")
    alpha = (F.col("t") - F.col("low.t")) / span
    between = F.zip_with("low.value", "high.value", lambda a, b: vec.add(a, vec.scale(vec.sub(b, a), F.col("_alpha"))))
    rows = both.withColumn("_alpha", F.when(span > 0, alpha))
    points = F.when(exact, F.col("low.value")).when(span <= max_gap, between)
    return rows.select(stream, "query_id", "t", points.alias("points"))


def lag_table(frames: DataFrame, source: DataFrame, lags: Sequence[int], project: Callable[[Column], Column], max_gap: int, width: int = 7, least: int = 30, stream: str = "stream", block: int = BLOCK) -> DataFrame:
    """The correlation of a signal at frames with the projected speed of points at frame time + lag, for each lag.

    frames: stream, i (0, 1, 2, ...), t, energy (of the step from i - 1 to i). source: as in ``points_at``, on a clock that may be off. ``project`` makes a pixel
    (u, v; null behind the camera) of a point. A step's speed is ``step_median`` of the pixels at both its ends. Both series are smoothed by a mean of
    ``width`` steps; only steps with all of them around count, so edges are trimmed and a gap takes out the steps near it. Returns stream, lag, correlation (null with fewer than ``least``
    steps or without spread) and steps.

    The lags are rows of one join on time, and one more shuffle by stream, lag and block serves differences and both filters; work grows by frames times lags. A frame that has no index or time counts
    for nothing.
    """
    half = width // 2
    known = frames.where("i is not null and t is not null").select(stream, "i", "t", F.col("energy").cast("double").alias("energy"))
    asked = known.withColumn("lag", F.explode(F.array(*[F.lit(x).cast("long") for x in lags])))
    targets = asked.select(stream, (F.col("t") + F.col("lag")).alias("t"), F.struct("lag", "i", "energy").alias("query_id"))
    at = points_at(source, targets, max_gap, stream)
    rows = at.select(stream, "query_id.*", F.transform("points", project).alias("pixels"))
    blocks = F.sequence(F.floor((F.col("i") - half) / block), F.floor((F.col("i") + half + 1) / block))
    spread = rows.withColumn("block", F.explode(blocks))
    w = Window.partitionBy(stream, "lag", "block").orderBy("i")
    before = F.lag(F.struct("i", "pixels")).over(w)
    steps = spread.withColumn("_before", before).withColumn("speed", F.when(F.col("_before.i") + 1 == F.col("i"), step_median(F.col("pixels"), F.col("_before.pixels"))))
    steps = steps.withColumn("_both", F.when(F.col("speed").isNotNull() & stats.finite(F.col("energy")).isNotNull(), F.lit(1))).drop("_before", "pixels")
    around = w.rowsBetween(-half, half)
    whole = (F.sum("_both").over(around) == width) & (F.max("i").over(around) - F.min("i").over(around) == width - 1)
    smooth = steps.select(stream, "lag", "i", "block", *[F.when(whole, F.avg(c).over(around)).alias(c) for c in ("speed", "energy")])
    own = smooth.where(F.floor(F.col("i") / block) == F.col("block"))
    return own.groupBy(stream, "lag").agg(stats.guarded_correlation(F.col("speed"), F.col("energy"), least).alias("correlation"), F.count(F.col("speed") + F.col("energy")).alias("steps"))


def best_lag(table: DataFrame, stream: str = "stream") -> DataFrame:
    """The lag with the largest correlation of each stream, the smallest of equals; null where no lag has one."""
    found = table.groupBy(stream).agg(F.min_by(F.struct("lag", "correlation", "steps"), F.when(F.col("correlation").isNotNull(), F.struct(-F.col("correlation"), "lag"))).alias("b"))
    return found.select(stream, "b.lag", "b.correlation", "b.steps")
