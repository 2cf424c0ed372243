"""Nearest neighbours in a plane and in a palette."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nearest_within(points: DataFrame, pixels: DataFrame, radius: float, point_id: str = "point_id") -> DataFrame:
    """For each point the nearest pixel within ``radius`` and its depth; of equal distances the least (v, u).

    points: point_id, u, v. pixels: u, v, z, of which those with z null or 0 hold no measurement. The plane is cut into squares of the
    radius; a point looks into its own and the eight around it, so the join is on squares and each pair is within reach or nearly.
    Points without a pixel have nulls.
    """
    cell = lambda c: F.floor(F.col(c) / radius)
    seen = pixels.where("z is not null and z <> 0").select(F.col("u").alias("pu"), F.col("v").alias("pv"), "z", cell("u").alias("cu"), cell("v").alias("cv"))
    around = F.array(*[F.struct((cell("u") + i).alias("cu"), (cell("v") + j).alias("cv")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    asked = points.select(point_id, "u", "v", F.inline(around))
    d2 = (F.col("u") - F.col("pu")) ** 2 + (F.col("v") - F.col("pv")) ** 2
    near = asked.join(seen, ["cu", "cv"]).withColumn("d2", d2).where(F.col("d2") <= radius * radius)
    best = near.groupBy(point_id).agg(F.min_by(F.struct("z", "d2"), F.struct("d2", "pv", "pu")).alias("b"))
    return points.join(best, point_id, "left").select(point_id, F.col("b.z").alias("z"), F.sqrt("b.d2").alias("distance"))


def nearest_colour(colour: list[Column], palette: list[tuple[float, ...]]) -> Column:
    """The index of the palette entry of least squared distance, the first of equals. The palette is a parameter of up to 256 entries."""
    entries = F.array(*[F.struct(sum(((c - float(p)) ** 2 for c, p in zip(colour, entry, strict=True)), F.lit(0.0)).alias("d"), F.lit(i).alias("i")) for i, entry in enumerate(palette)])
    return F.array_min(entries)["i"]
