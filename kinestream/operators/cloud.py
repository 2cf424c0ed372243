"""Depth pixels as a cloud with colours, as a second camera sees it: the nearest point of each pixel hides the others."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.functions import vec


def points_of(depth: DataFrame, keys: list[str], ray: Callable[[Column, Column], Column], nearest: float, farthest: float) -> DataFrame:
    """keys, u, v and p of each depth pixel (keys, u, v, depth) within [nearest, farthest]: the pixel's ray (z = 1) times its depth."""
    known = depth.where(F.col("depth").between(nearest, farthest))
    return known.select(*keys, "u", "v", vec.scale(ray(F.col("u").cast("double"), F.col("v").cast("double")), F.col("depth").cast("double")).alias("p"))


def splatted(points: DataFrame, keys: list[str], matrix: Sequence[Sequence[float]], project: Callable[[Column], Column], size: tuple[int, int]) -> DataFrame:
    """``points`` with pixel_u, pixel_v and seen_z in the other camera, and visible: no other point of the same pixel is nearer.

    ``matrix`` brings a point to that camera, ``project`` gives its pixel (u, v), which is rounded half to even. Points behind it or outside of ``size`` (width, height) are left
    out. Of points at one depth the one of the least (v, u) is seen. The z-buffer is one aggregate by pixel, with a partial one before the shuffle, so a pixel that a third of all points fall
    on is no hot task; its winners are joined back.
    """
    seen = points.withColumn("_q", vec.transform(matrix, F.col("p"))).withColumn("_px", project(F.col("_q")))
    placed = seen.select(*points.columns, F.rint("_px.u").cast("long").alias("pixel_u"), F.rint("_px.v").cast("long").alias("pixel_v"), F.col("_q.z").alias("seen_z"))
    inside = placed.where((F.col("seen_z") > 0) & F.col("pixel_u").between(0, size[0] - 1) & F.col("pixel_v").between(0, size[1] - 1))
    pixel = [*keys, "pixel_u", "pixel_v"]
    front = inside.groupBy(*pixel).agg(F.min(F.struct("seen_z", "v", "u")).alias("_front"))
    marked = inside.join(front, pixel)
    return marked.select(*points.columns, "pixel_u", "pixel_v", "seen_z", ((F.col("_front.v") == F.col("v")) & (F.col("_front.u") == F.col("u"))).alias("visible"))


def coloured(splats: DataFrame, image: DataFrame, keys: list[str]) -> DataFrame:
    """``splats`` with the colour of their pixels of ``image`` (keys, pixel_u, pixel_v, colour); occluded points, and pixels that the image lacks, have none."""
    found = splats.join(image.select(*keys, "pixel_u", "pixel_v", F.col("colour").alias("_colour")), [*keys, "pixel_u", "pixel_v"], "left")
    return found.withColumn("colour", F.when(F.col("visible"), F.col("_colour"))).drop("_colour")


def on_table(pixels: DataFrame, ray: Callable[[Column, Column], Column], up: Sequence[float], matrix: Sequence[Sequence[float]], project: Callable[[Column], Column], size: tuple[int, int], nearest: float, farthest: float) -> DataFrame:
    """``pixels`` (u, v and any others) with expected_z, pixel_u, pixel_v and inside: where each pixel's ray would meet a table, as the depth camera and the colour camera see it.

    up: a, b, c, d of the plane a x + b y + c z + d = 0 in depth camera coordinates (the row of a world's height). expected_z is the depth of the meeting point, null for a ray along the table or away from
    it; ``matrix`` and ``project`` are the colour camera's, whose pixel is rounded half to even. inside: the point is within [nearest, farthest] and on the colour image of ``size``.
    """
    a, b, c, d = map(float, up)
    rays = pixels.withColumn("_ray", ray(F.col("u").cast("double"), F.col("v").cast("double")))
    slope = a * F.col("_ray.x") + b * F.col("_ray.y") + c * F.col("_ray.z")
    met = rays.withColumn("_z", F.when(F.abs(slope) > 1e-12, -d / slope)).withColumn("expected_z", F.when(F.col("_z") > 0, F.col("_z")))
    seen = met.withColumn("_px", project(vec.transform(matrix, vec.scale(F.col("_ray"), F.col("expected_z")))))
    placed = seen.select(*pixels.columns, "expected_z", F.rint("_px.u").cast("long").alias("pixel_u"), F.rint("_px.v").cast("long").alias("pixel_v"))
    inside = F.col("expected_z").between(nearest, farthest) & F.col("pixel_u").between(0, size[0] - 1) & F.col("pixel_v").between(0, size[1] - 1)
    return placed.withColumn("inside", F.coalesce(inside, F.lit(False)))
