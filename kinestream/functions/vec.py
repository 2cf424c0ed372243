"""Vectors, rotations, cameras and joint trees as column expressions.

A vector is a struct (x, y, z), a quaternion a struct (w, x, y, z) that turns local into world, a matrix an array of
rows. Everything is built-in functions. What a function names more than once is bound by ``let``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The parent of each of the 20 joints; the fingers are chains of four from the root.
PARENTS = (-1, 0, 1, 2, 0, 4, 5, 6, 0, 8, 9, 10, 0, 12, 13, 14, 0, 16, 17, 18)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once. An expression that names a value often would hold as many copies of it,
    and nested ones would grow by the power of their depth."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def vec(x, y, z) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return F.struct(lit(x).alias("x"), lit(y).alias("y"), lit(z).alias("z"))


def at(flat: Column, joint: int) -> Column:
    """Joint ``joint`` of a flat array x0, y0, z0, x1 ..."""
    return vec(*[F.get(flat, F.lit(3 * joint + k)).cast("double") for k in range(3)])


def add(a: Column, b: Column) -> Column:
    return vec(a["x"] + b["x"], a["y"] + b["y"], a["z"] + b["z"])


def sub(a: Column, b: Column) -> Column:
    return vec(a["x"] - b["x"], a["y"] - b["y"], a["z"] - b["z"])


def scale(a: Column, k) -> Column:
    return vec(a["x"] * k, a["y"] * k, a["z"] * k)


def dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def cross(a: Column, b: Column) -> Column:
    return vec(a["y"] * b["z"] - a["z"] * b["y"], a["z"] * b["x"] - a["x"] * b["z"], a["x"] * b["y"] - a["y"] * b["x"])


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column, least: float = 1e-9) -> Column:
    """The direction; null for a vector shorter than ``least``."""
    return let(a, lambda v: let(norm(v), lambda n: F.when(n > least, scale(v, 1 / n))))


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def angle(a: Column, b: Column) -> Column:
    """Radians between two directions."""
    return F.acos(clip(dot(a, b), -1.0, 1.0))


def slerp(a: Column, b: Column, t: Column) -> Column:
    """Between two directions on the sphere; linear where they are the same; null where they are opposite."""

    def between(p: Column) -> Column:
        d, theta = p["d"], F.acos(p["d"])
        same, s = d > 1.0 - 1e-8, F.sin(theta)
        left = F.when(same, 1 - p["t"]).otherwise(F.sin((1 - p["t"]) * theta) / s)
        right = F.when(same, p["t"]).otherwise(F.sin(p["t"] * theta) / s)
        return F.when(d >= -1.0 + 1e-8, unit(add(scale(p["a"], left), scale(p["b"], right))))

    ends = F.struct(a.alias("a"), b.alias("b"), t.alias("t"))
    return let(ends, lambda p: let(F.struct(p["a"].alias("a"), p["b"].alias("b"), p["t"].alias("t"), clip(dot(p["a"], p["b"]), -1.0, 1.0).alias("d")), between))


def sphere_log(base: Column, end: Column) -> Column:
    """The tangent at ``base`` whose length is the angle to ``end``; null for opposite directions."""

    def tangent(p: Column) -> Column:
        return let(sub(p["b"], scale(p["a"], p["d"])), lambda v: let(norm(v), lambda n: F.when(n > 1e-9, scale(v, F.acos(p["d"]) / n)).when(p["d"] > 0, vec(0, 0, 0))))

    ends = F.struct(base.alias("a"), end.alias("b"))
    return let(ends, lambda p: let(F.struct(p["a"].alias("a"), p["b"].alias("b"), clip(dot(p["a"], p["b"]), -1.0, 1.0).alias("d")), tangent))


def sphere_exp(base: Column, tangent: Column) -> Column:
    """Where ``tangent`` leads from ``base``."""

    def reached(p: Column) -> Column:
        return let(norm(p["t"]), lambda n: F.when(n <= 1e-9, p["a"]).otherwise(unit(add(scale(p["a"], F.cos(n)), scale(p["t"], F.sin(n) / n)))))

    return let(F.struct(base.alias("a"), tangent.alias("t")), reached)


def quat(w, x, y, z) -> Column:
    return F.struct(*[(v if isinstance(v, Column) else F.lit(float(v))).alias(n) for v, n in zip((w, x, y, z), "wxyz", strict=True)])


def quat_dot(a: Column, b: Column) -> Column:
    return a["w"] * b["w"] + dot(a, b)


def quat_unit(q: Column, least: float = 1e-12) -> Column:
    return let(q, lambda v: let(F.sqrt(quat_dot(v, v)), lambda n: F.when(n > least, quat(*[v[c] / n for c in "wxyz"]))))


def quat_product(a: Column, b: Column) -> Column:
    """a * b: the turn ``b`` in the axes that ``a`` makes."""
    w = a["w"] * b["w"] - a["x"] * b["x"] - a["y"] * b["y"] - a["z"] * b["z"]
    x = a["w"] * b["x"] + a["x"] * b["w"] + a["y"] * b["z"] - a["z"] * b["y"]
    y = a["w"] * b["y"] - a["x"] * b["z"] + a["y"] * b["w"] + a["z"] * b["x"]
    z = a["w"] * b["z"] + a["x"] * b["y"] - a["y"] * b["x"] + a["z"] * b["w"]
    return quat(w, x, y, z)


def quat_rotate(q: Column, v: Column) -> Column:
    """``v`` turned by a unit quaternion."""
    return let(scale(cross(q, v), 2.0), lambda t: add(add(v, scale(t, q["w"])), cross(q, t)))


def quat_slerp(a: Column, b: Column, t: Column) -> Column:
    """Along the shorter arc between unit quaternions; linear weights where the sine of the angle is under 1e-8."""

    def between(p: Column) -> Column:
        turn = F.when(p["d"] < 0, -1.0).otherwise(1.0)
        theta = F.acos(clip(F.abs(p["d"]), 0.0, 1.0))
        s = F.sin(theta)
        left = F.when(s < 1e-8, 1 - p["t"]).otherwise(F.sin((1 - p["t"]) * theta) / s)
        right = F.when(s < 1e-8, p["t"]).otherwise(F.sin(p["t"] * theta) / s) * turn
        return let(F.struct(left.alias("l"), right.alias("r")), lambda w: quat_unit(quat(*[w["l"] * p["a"][c] + w["r"] * p["b"][c] for c in "wxyz"])))

    ends = F.struct(a.alias("a"), b.alias("b"), t.alias("t"))
    return let(ends, lambda p: let(F.struct(p["a"].alias("a"), p["b"].alias("b"), p["t"].alias("t"), quat_dot(p["a"], p["b"]).alias("d")), between))


def quat_matrix(q: Column) -> Column:
    """The rotation matrix of a quaternion of any length; null for one of no length."""

    def matrix(u: Column) -> Column:
        w, x, y, z = u["w"], u["x"], u["y"], u["z"]
        rows = ((1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)), (2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)), (2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)))
        return F.when(u.isNotNull(), F.array(*[F.array(*r) for r in rows]))

    return let(quat_unit(q), matrix)


def transform(matrix: Sequence[Sequence[float]], p: Column) -> Column:
    """A point through the first three rows of a 4 x 4 matrix."""
    return vec(*[p["x"] * float(r[0]) + p["y"] * float(r[1]) + p["z"] * float(r[2]) + float(r[3]) for r in matrix[:3]])


def rotate(matrix: Column, p: Column) -> Column:
    """A vector through a matrix column."""
    return vec(*[sum((F.get(F.get(matrix, F.lit(i)), F.lit(j)) * p[c] for j, c in enumerate("xyz")), F.lit(0.0)) for i in range(3)])


def rodrigues(v: Column, axis: Column, theta: Column) -> Column:
    """A vector turned about a unit axis."""
    c, s = F.cos(theta), F.sin(theta)
    return add(add(scale(v, c), scale(cross(axis, v), s)), scale(axis, dot(axis, v) * (1 - c)))


def distort(x: Column, y: Column, k: Sequence[float]) -> tuple[Column, Column]:
    """The rational lens model with coefficients in the order k1 to k6, p1, p2."""
    k1, k2, k3, k4, k5, k6, p1, p2 = map(float, k)
    r2 = x * x + y * y
    radial = (1 + r2 * (k1 + r2 * (k2 + r2 * k3))) / (1 + r2 * (k4 + r2 * (k5 + r2 * k6)))
    return x * radial + 2 * p1 * x * y + p2 * (r2 + 2 * x * x), y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y


def undistort(x: Column, y: Column, k: Sequence[float], rounds: int = 20) -> Column:
    """The inverse by fixed-point steps, as a struct (x, y)."""
    k1, k2, k3, k4, k5, k6, p1, p2 = map(float, k)

    def step(s: Column, _: Column) -> Column:
        r2 = s["x"] * s["x"] + s["y"] * s["y"]
        radial = (1 + r2 * (k1 + r2 * (k2 + r2 * k3))) / (1 + r2 * (k4 + r2 * (k5 + r2 * k6)))
        dx, dy = 2 * p1 * s["x"] * s["y"] + p2 * (r2 + 2 * s["x"] * s["x"]), p1 * (r2 + 2 * s["y"] * s["y"]) + 2 * p2 * s["x"] * s["y"]
        return F.struct(((x - dx) / radial).alias("x"), ((y - dy) / radial).alias("y"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.struct(x.alias("x"), y.alias("y")), step)


def project(p: Column, intrinsics: Sequence[float], k: Sequence[float] = (0,) * 8, least: float = 1e-6) -> Column:
    """Pixel (u, v) of a point in camera coordinates; null at a depth of ``least`` or less."""
    fx, fy, cx, cy = map(float, intrinsics)

    def pixel(n: Column) -> Column:
        x, y = distort(n["x"], n["y"], k)
        return F.struct((fx * x + cx).alias("u"), (fy * y + cy).alias("v"))

    return let(p, lambda q: F.when(q["z"] > least, let(F.struct((q["x"] / q["z"]).alias("x"), (q["y"] / q["z"]).alias("y")), pixel)))


def in_frame(pixel: Column, width: int, height: int) -> Column:
    """Whether a pixel is inside the image; a missing one isn't."""
    return F.coalesce((pixel["u"] >= 0) & (pixel["u"] < width) & (pixel["v"] >= 0) & (pixel["v"] < height), F.lit(False))


def bones(flat: Column, parents: Sequence[int] = PARENTS) -> list[Column]:
    """The vector from its parent to each joint but the root."""
    return [sub(at(flat, j), at(flat, p)) for j, p in enumerate(parents) if p >= 0]


def chain_positions(root: Column, directions: Sequence[Column], lengths: Sequence[Column], parents: Sequence[int] = PARENTS) -> list[Column]:
    """Joint positions from a root, a direction and a length for each joint but the root, along the tree."""
    out = [root]
    for j, p in enumerate(parents):
        if p >= 0:
            out.append(add(out[p], scale(directions[j - 1], lengths[j - 1])))
    return out


def total(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def turn_exp(v: Column) -> Column:
    """The rotation matrix of a rotation vector (its axis times the angle); series where the squared angle is under 1e-6."""

    def matrix(p: Column) -> Column:
        v, q = p["v"], p["q"]
        angle_ = F.sqrt(q)
        a = F.when(q < 1e-6, 1 - q / 6 + q * q / 120).otherwise(F.sin(angle_) / angle_)
        b = F.when(q < 1e-6, 0.5 - q / 24 + q * q / 720).otherwise((1 - F.cos(angle_)) / q)
        return let(F.struct(v.alias("v"), q.alias("q"), a.alias("a"), b.alias("b")), rows)

    def rows(p: Column) -> Column:
        x, y, z = (p["v"][c] for c in "xyz")
        a, b, keep = p["a"], p["b"], 1 - p["b"] * p["q"]
        return F.array(
            F.array(keep + b * x * x, b * x * y - a * z, b * x * z + a * y),
            F.array(b * x * y + a * z, keep + b * y * y, b * y * z - a * x),
            F.array(b * x * z - a * y, b * y * z + a * x, keep + b * z * z),
        )

    return let(v, lambda u: let(F.struct(u.alias("v"), dot(u, u).alias("q")), matrix))


def turn_between(a: Column, b: Column) -> Column:
    """Radians between two rotation matrices; 1e-7 of the cosine's range is left out at both ends."""
    both = F.struct(a.alias("a"), b.alias("b"))
    trace = lambda m: sum((F.get(F.get(m["a"], F.lit(i)), F.lit(j)) * F.get(F.get(m["b"], F.lit(i)), F.lit(j)) for i in range(3) for j in range(3)), F.lit(0.0))
    return let(both, lambda m: F.acos(clip((trace(m) - 1) / 2, -1.0 + 1e-7, 1.0 - 1e-7)))


def square_axes(first: Column, second: Column) -> Column:
    """Three axes at right angles, as a struct (u, v, w): the first as it points, the second brought square to it, and their product; null where they are
    parallel or have no length."""

    def made(p: Column) -> Column:
        v = unit(sub(p["b"], scale(p["u"], dot(p["b"], p["u"]))))
        return let(F.struct(p["u"].alias("u"), v.alias("v")), lambda q: F.when(q["u"].isNotNull() & q["v"].isNotNull(), F.struct(q["u"].alias("u"), q["v"].alias("v"), cross(q["u"], q["v"]).alias("w"))))

    return let(F.struct(unit(first).alias("u"), second.alias("b")), made)


def lines_midpoint(p: Column, p_to: Column, q: Column, q_to: Column) -> Column:
    """The point halfway between two lines where they are nearest, each through two points; null for parallel ones."""

    def solved(s: Column) -> Column:
        along, across = dot(s["d"], s["e"]), sub(s["q"], s["p"])
        least = 1 - along * along
        t = (dot(across, s["d"]) - dot(across, s["e"]) * along) / least
        r = (dot(across, s["d"]) * along - dot(across, s["e"])) / least
        return F.when(least > 1e-12, scale(add(add(s["p"], scale(s["d"], t)), add(s["q"], scale(s["e"], r))), 0.5))

    return let(F.struct(p.alias("p"), q.alias("q"), unit(sub(p_to, p)).alias("d"), unit(sub(q_to, q)).alias("e")), solved)


def pixel_ray(u: Column, v: Column, intrinsics: Sequence[float], k: Sequence[float]) -> Column:
    """The direction (x, y, 1) in camera coordinates that a pixel shows."""
    fx, fy, cx, cy = map(float, intrinsics)
    return let(undistort((u - cx) / fx, (v - cy) / fy, k), lambda s: vec(s["x"], s["y"], 1))


def on_plane(ray: Column, normal: Column, distance: float) -> Column:
    """Where a ray from the origin meets the plane normal . p = distance; null if it is parallel to it."""
    return let(F.struct(ray.alias("r"), normal.alias("n")), lambda s: let(dot(s["r"], s["n"]), lambda d: F.when(F.abs(d) > 1e-12, scale(s["r"], F.lit(float(distance)) / d))))


def project_clamped(p: Column, intrinsics: Sequence[float], least: float = 1e-3) -> Column:
    """Pixel (u, v) without a lens, of a depth of ``least`` at least, and whether the point's own depth is over that."""
    fx, fy, cx, cy = map(float, intrinsics)
    return let(p, lambda q: let(F.greatest(q["z"], F.lit(least)), lambda z: F.struct(((fx * q["x"] + cx * q["z"]) / z).alias("u"), ((fy * q["y"] + cy * q["z"]) / z).alias("v"), (q["z"] > least).alias("positive"))))


def project_five(p: Column, intrinsics: Sequence[float], k: Sequence[float]) -> Column:
    """Pixel (u, v) by the five-coefficient lens model, coefficients in the order k1, k2, p1, p2, k3; null at no depth."""
    k1, k2, p1, p2, k3 = map(float, k)
    return project(p, intrinsics, (k1, k2, k3, 0, 0, 0, p1, p2), 0.0)


def chain_frames(turns: Sequence[Column], offsets: Sequence[Column], parents: Sequence[int] = PARENTS) -> Column:
    """Joint positions seen from the root as an array, given each joint's own turn (a matrix) and its offset in its parent's axes.

    A joint stands where its parent's axes put its offset; its axes are the parent's, turned. Joints are worked out one after the other, each once.
    """

    def product(a: Column, b: Column) -> Column:
        cell = lambda m, i, j: F.get(F.get(m, F.lit(i)), F.lit(j))
        return let(F.struct(a.alias("a"), b.alias("b")), lambda m: F.array(*[F.array(*[sum((cell(m["a"], i, k) * cell(m["b"], k, j) for k in range(3)), F.lit(0.0)) for j in range(3)]) for i in range(3)]))

    def folded(given: Column) -> Column:
        def step(s: Column, j: Column) -> Column:
            p = F.get(F.array(*[F.lit(x) for x in parents]), j)
            own = F.struct(F.get(s["places"], p).alias("place"), F.get(s["axes"], p).alias("axes"), F.get(given["offsets"], j).alias("offset"), F.get(given["turns"], j).alias("turn"))
            made = let(own, lambda q: F.struct(add(q["place"], rotate(q["axes"], q["offset"])).alias("place"), product(q["axes"], q["turn"]).alias("axes")))
            return let(made, lambda m: F.struct(F.concat(s["places"], F.array(m["place"])).alias("places"), F.concat(s["axes"], F.array(m["axes"])).alias("axes")))

        start = F.struct(F.array(vec(0, 0, 0)).alias("places"), F.slice(given["turns"], 1, 1).alias("axes"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(len(parents) - 1)), start, step, lambda s: s["places"])

    return let(F.struct(F.array(*turns).alias("turns"), F.array(*offsets).alias("offsets")), folded)
