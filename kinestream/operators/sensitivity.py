"""How much a result moves when its inputs are off: trials with normal draws that anyone can repeat."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.functions import vec


def normals(*key: Column | str | int) -> Column:
    """Two independent standard normal draws (struct a, b) that follow from the key's text alone: Box and Muller's transform of 64 bits of its MD5.

    No generator's state: the same key gives the same draws in any task, order or engine; other keys other ones.
    """
    parts = [k if isinstance(k, Column) else F.lit(k) for k in key]
    h = F.md5(F.concat_ws("/", *[p.cast("string") for p in parts]).cast("binary"))
    uniform = lambda m, first: (F.conv(F.substring(m, first, 8), 16, 10).cast("double") + 0.5) / 4294967296.0

    def pair(m: Column) -> Column:
        size, turn = F.sqrt(-2 * F.log(uniform(m, 1))), 2 * math.pi * uniform(m, 9)
        return F.struct((size * F.cos(turn)).alias("a"), (size * F.sin(turn)).alias("b"))

    return vec.let(h, pair)


def trials(df: DataFrame, count: int, sigmas: Sequence[float]) -> DataFrame:
    """Each row once for each sigma and trial from 0."""
    each = F.array(*[F.lit(float(s)) for s in sigmas])
    return df.withColumn("sigma", F.explode(each)).withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))


def clicked(pixel: Column, sigma: Column, *key: Column | str | int) -> Column:
    """A pixel (u, v) off by normal draws of ``sigma`` in both directions."""
    return vec.let(normals(*key), lambda n: F.struct((pixel["u"] + sigma * n["a"]).alias("u"), (pixel["v"] + sigma * n["b"]).alias("v")))


def with_pose(df: DataFrame, markers: Sequence[str], name: str, normal: Sequence[float], distance: float, height: float, intrinsics: Sequence[float]) -> DataFrame:
    """``df`` with ``name``: the pose (struct origin, x, y, z, apart) of a table from the pixels (columns of u and v) of four markers that stand ``height`` above the plane normal . p = distance.

    markers: far and near end of the long arm, near and far end of the short one. A marker's ray meets the raised plane; its foot is straight below. The origin is where the arms' lines are nearest, x
    points to the middle of the long arm and y to that of the short one, both in the plane; what they lack to a right angle is shared by both, and ``apart`` is the angle between them in degrees. Null for
    lines that are parallel, rays along the plane, or labels that imply a mirrored table.

    Each step is a projection over plain columns, so that Spark compiles them: nested functions of one large expression would be interpreted.
    """
    fx, fy, cx, cy = map(float, intrinsics)
    size = math.sqrt(sum(x * x for x in normal))
    up = [x / size for x in normal]
    n = vec.vec(*[F.lit(x) for x in up])
    col = lambda c: F.col(f"_{name}_{c}")
    ends = ("lf", "ln", "sn", "sf")

    def step(rows: DataFrame, **made: Column) -> DataFrame:
        return rows.select("*", *[c.alias(f"_{name}_{k}") for k, c in made.items()])

    def unit(v: Column) -> Column:
        return F.when(vec.norm(v) > 1e-9, vec.scale(v, 1 / vec.norm(v)))

    def flat(v: Column) -> Column:
        return vec.sub(v, vec.scale(n, vec.dot(n, v)))

    rows = step(df, **{f"r{e}": vec.vec((F.col(m)["u"] - cx) / fx, (F.col(m)["v"] - cy) / fy, F.lit(1.0)) for e, m in zip(ends, markers, strict=True)})
    rows = step(rows, **{f"k{e}": vec.dot(n, col(f"r{e}")) for e in ends})
    rows = step(rows, **{e: F.when(F.abs(col(f"k{e}")) > 1e-12, vec.sub(vec.scale(col(f"r{e}"), (distance + height) / col(f"k{e}")), vec.scale(n, height))) for e in ends})
    rows = step(rows, long=vec.sub(col("ln"), col("lf")), short=vec.sub(col("sf"), col("sn")), w=vec.sub(col("sn"), col("lf")))
    rows = step(rows, d=unit(col("long")), e=unit(col("short")))
    rows = step(rows, al=vec.dot(col("d"), col("e")), wd=vec.dot(col("w"), col("d")), we=vec.dot(col("w"), col("e")))
    least = 1 - col("al") * col("al")
    rows = step(rows, t=F.when(least > 1e-12, (col("wd") - col("we") * col("al")) / least), s=F.when(least > 1e-12, (col("wd") * col("al") - col("we")) / least))
    both = vec.add(vec.add(col("lf"), vec.scale(col("d"), col("t"))), vec.add(col("sn"), vec.scale(col("e"), col("s"))))
    rows = step(rows, o=F.when(col("t").isNotNull(), vec.scale(both, 0.5)))
    rows = step(rows, g=flat(vec.sub(vec.scale(vec.add(col("lf"), col("ln")), 0.5), col("o"))), h=flat(vec.sub(vec.scale(vec.add(col("sn"), col("sf")), 0.5), col("o"))))
    rows = step(rows, x0=unit(col("g")), y0=unit(col("h")))
    rows = step(rows, across=vec.cross(n, col("x0")))
    rows = step(rows, along=vec.dot(col("across"), col("y0")), off=vec.dot(n, vec.cross(col("across"), col("y0"))), lean=vec.dot(col("x0"), col("y0")))
    rows = step(rows, half=F.atan2(col("off"), col("along")) / 2)
    rows = step(rows, x=vec.add(vec.scale(col("x0"), F.cos(col("half"))), vec.scale(col("across"), F.sin(col("half")))))
    made = F.struct(col("o").alias("origin"), col("x").alias("x"), vec.cross(n, col("x")).alias("y"), n.alias("z"), F.degrees(F.acos(vec.clip(col("lean"), -1.0, 1.0))).alias("apart"))
    return rows.select(*df.columns, F.when(col("along") >= 0, made).alias(name))


def pose_distance(a: Column, b: Column) -> Column:
    """struct moved (distance of the origins) and turned (degrees between the axes); null if either pose is."""
    trace = sum((vec.dot(a[k], b[k]) for k in "xyz"), F.lit(0.0))
    return F.when(a.isNotNull() & b.isNotNull(), F.struct(vec.norm(vec.sub(a["origin"], b["origin"])).alias("moved"), F.degrees(F.acos(vec.clip((trace - 1) / 2, -1.0, 1.0))).alias("turned")))
