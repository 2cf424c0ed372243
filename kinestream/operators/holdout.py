"""Registrations that are fitted on one take, kept as a table of models, and applied to takes that the fit never saw."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.functions import vec
from kinestream.operators import stats
from kinestream.operators.fit import residual
from kinestream.operators.temporal import joined
from kinestream.shared import written

_MODEL = {"source_take": None, "scale": "double", "angle": "double", "rotation": "array<double>", "points": "bigint", "frames": "bigint", "refined": "boolean", "residual_median": "double", "residual_p95": "double"}


def _axis(axis: Sequence[float]) -> Column:
    size = math.sqrt(sum(a * a for a in axis))
    return vec.vec(*[F.lit(a / size) for a in axis])


def turn_fit(pairs: DataFrame, keys: list[str], axis: Sequence[float] = (0.0, 0.0, 1.0)) -> DataFrame:
    """scale, angle, rotation (nine numbers, row by row) and points of target = scale * turn about ``axis`` * source, per group.

    The least squares have a closed form in three sums, so a group of any size is one aggregate. A group whose points lie on the axis, or whose best
    scale isn't above zero, has nulls. pairs: keys, s and t (structs x, y, z; rows with a null count for nothing).
    """
    n, s, t = _axis(axis), F.col("s"), F.col("t")
    along = vec.dot(n, s) * vec.dot(n, t)
    sums = pairs.where("s is not null and t is not null").groupBy(*keys).agg(
        F.sum(vec.dot(s, t) - along).alias("_a"), F.sum(vec.dot(n, vec.cross(s, t))).alias("_b"), F.sum(along).alias("_c"), F.sum(vec.dot(s, s)).alias("_e"), F.count("*").alias("points")
    )
    reach = F.hypot("_a", "_b")
    scale = (reach + F.col("_c")) / F.col("_e")
    good = (F.col("_e") > 1e-12) & (reach > F.col("_e") * 1e-9) & (scale > 0)
    angle = F.atan2("_b", "_a")
    turned = [vec.rodrigues(vec.vec(*[F.lit(float(i == j)) for i in range(3)]), n, F.col("angle")) for j in range(3)]
    rows = sums.select(*keys, F.when(good, scale).alias("scale"), F.when(good, angle).alias("angle"), "points")
    return rows.select(*keys, "scale", "angle", F.when(F.col("angle").isNotNull(), F.array(*[c[a] for a in "xyz" for c in turned])).alias("rotation"), "points")


def frozen(pairs: DataFrame, keys: list[str], take: str, source, axis: Sequence[float] = (0.0, 0.0, 1.0), frame: str = "frame", least: float = 3.0, min_frames: int = 10) -> DataFrame:
    """A model for each group, fitted on the rows of take ``source`` alone and once more without its outlying frames.

    A frame's residual is the median over its points; frames above median + max(3 * 1.4826 * MAD, ``least``) go if ``min_frames`` and half of them stay.
    Returns keys, source_take, scale, angle, rotation, points, frames, refined, residual_median and residual_p95 of the fit's own rows: a table that
    ``save`` keeps and ``applied`` uses. No row of another take has a part in it.
    """
    own = written(pairs.where((F.col(take) == F.lit(source)) & F.col("s").isNotNull() & F.col("t").isNotNull()).select(*keys, frame, "s", "t"), "holdout-pairs")
    first = turn_fit(own, keys, axis).where("scale is not null")
    frames = written(joined(own, first.select(*keys, "scale", "rotation"), keys).withColumn("r", residual()).groupBy(*keys, frame).agg(F.median("r").alias("frame_residual")), "holdout-frames")
    trimmed = written(stats.mad_trimmed(frames, keys, "frame_residual", least, min_frames), "holdout-trimmed")
    stay = joined(own, trimmed.select(*keys, frame, "kept"), [*keys, frame]).where("kept").drop("kept")
    counted = trimmed.groupBy(*keys).agg(F.count_if("kept").alias("frames"), F.bool_or("refined").alias("refined"))
    final = written(turn_fit(stay, keys, axis), "holdout-fit")
    measured = joined(stay, final.select(*keys, "scale", "rotation"), keys).withColumn("r", residual())
    quality = stats.split_percentiles(measured, keys, "r", {"residual_median": 0.5, "residual_p95": 0.95})
    models = joined(joined(final, counted, keys), quality, keys).withColumn("source_take", F.lit(source))
    return written(models.select(*keys, *_MODEL), "holdout-models")


def applied(pairs: DataFrame, models: DataFrame, keys: list[str], take: str) -> DataFrame:
    """Each pair with its group's model: r (the distance of the mapped source from the target) and held_out.

    Models aren't changed, whatever the take. Rows of a group without a model, or with a null point, stay and have a null r.
    """
    rows = joined(pairs, models.select(*keys, "source_take", "scale", "rotation"), keys)
    return rows.withColumn("r", residual()).withColumn("held_out", ~F.col(take).eqNullSafe(F.col("source_take"))).drop("scale", "rotation", "source_take")


def protocol(applied_rows: DataFrame, keys: list[str], take: str) -> DataFrame:
    """Residuals by group and take: held_out, requested and measured pairs, mean, rmse, median and p95."""
    rows = written(applied_rows.select(*keys, take, "held_out", "r"), "holdout-residuals")
    found = stats.distribution(rows, [*keys, take, "held_out"], "r", {"median": 0.5, "p95": 0.95}, ("rmse",)).withColumnRenamed("count", "measured")
    asked = rows.groupBy(*keys, take, "held_out").agg(F.count("*").alias("requested"))
    return joined(asked, found, [*keys, take, "held_out"]).select(*keys, take, "held_out", "requested", "measured", "mean", "rmse", "median", "p95")


def save(models: DataFrame, keys: list[str], path: str) -> None:
    """Write models once: an existing table isn't replaced. A group with two models, or one without a source take, is an error."""
    _checked(models, keys)
    models.select(*keys, *_MODEL).write.mode("error").parquet(path)


def load(spark: SparkSession, keys: list[str], path: str) -> DataFrame:
    """Models that ``save`` wrote. Missing or other columns, two models of a group or none's source are errors; nothing is repaired."""
    models = spark.read.parquet(path)
    kinds = dict(models.dtypes)
    wrong = [c for c in [*keys, *_MODEL] if c not in kinds] + [f"{c}: {kinds[c]}" for c, kind in _MODEL.items() if kind and c in kinds and kinds[c] != kind] + sorted(set(kinds) - {*keys, *_MODEL})
    if wrong:
        raise ValueError(f"not a table of registrations: {', '.join(wrong)}")
    _checked(models, keys)
    return models


def _checked(models: DataFrame, keys: list[str]) -> None:
    bad = models.groupBy(*keys).agg(F.count("*").alias("_n"), F.count("source_take").alias("_s")).where("_n > 1 or _s < 1").select(*keys).head()
    if bad:
        raise ValueError(f"two models, or one without a source take: {bad.asDict()}")
