"""Queries of rotations, lines, rays and lenses over poses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.functions import vec
from kinestream.plans.poses import CAMERA, LENS, _r, poses
from kinestream.plans.registry import query

FIVE = (0.1, -0.05, 0.001, -0.002, 0.01)


def _cte(*joints: int) -> str:
    """p: vec_id and the coordinates of some joints, x5, y5, z5 ..."""
    return "WITH p AS (SELECT vec_id, " + ", ".join(f"embedding[{3 * j + k + 1}]::DOUBLE AS {a}{j}" for j in joints for k, a in enumerate("xyz")) + " FROM embeddings)"


def _turn_cte(name: str, joint: int) -> str:
    """name: vec_id and the nine numbers of the rotation that a joint's vector is."""
    x, y, z = (f"{a}{joint}" for a in "xyz")
    cells = {"00": (x, x, None), "01": (x, y, f"- a * {z}"), "02": (x, z, f"+ a * {y}"), "10": (x, y, f"+ a * {z}"), "11": (y, y, None), "12": (y, z, f"- a * {x}"), "20": (x, z, f"- a * {y}"), "21": (y, z, f"+ a * {x}"), "22": (z, z, None)}
    text = ", ".join(f"b * {u} * {v} " + (rest if rest else "+ 1 - b * q") + f" AS r{ij}" for ij, (u, v, rest) in cells.items())
    return f""", {name}q AS (SELECT *, {x} * {x} + {y} * {y} + {z} * {z} AS q FROM p),
{name}s AS (SELECT *, CASE WHEN q < 1e-6 THEN 1 - q / 6 + q * q / 120 ELSE sin(sqrt(q)) / sqrt(q) END AS a, CASE WHEN q < 1e-6 THEN 0.5 - q / 24 + q * q / 720 ELSE (1 - cos(sqrt(q))) / q END AS b FROM {name}q),
{name} AS (SELECT vec_id, {text} FROM {name}s)"""


_CELLS = [f"r{i}{j}" for i in range(3) for j in range(3)]


def _cells(m: Column) -> list[Column]:
    return [_r(F.get(F.get(m, F.lit(i)), F.lit(j))).alias(f"r{i}{j}") for i in range(3) for j in range(3)]


@query(_cte(5) + _turn_cte("t", 5) + " SELECT vec_id, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _CELLS) + " FROM t")
def rotation_exp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rotation that a joint's vector means."""
    d = poses(spark, sf_dir).select("vec_id", vec.turn_exp(vec.at(F.col("e"), 5)).alias("m"))
    return d.select("vec_id", *_cells(F.col("m")))


@query(_cte(5, 6) + _turn_cte("t", 5) + _turn_cte("w", 6) + " SELECT vec_id, round(acos(greatest(least((" + " + ".join(f"t.{c} * w.{c}" for c in _CELLS) + " - 1) / 2, 1 - 1e-7), -1 + 1e-7)), 6) AS angle FROM t JOIN w USING (vec_id)")
def rotation_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The angle between two rotations."""
    e = F.col("e")
    return poses(spark, sf_dir).select("vec_id", _r(vec.turn_between(vec.turn_exp(vec.at(e, 5)), vec.turn_exp(vec.at(e, 6)))).alias("angle"))


@query(
    _cte(1, 2)
    + """, u AS (SELECT *, sqrt(x1**2 + y1**2 + z1**2) AS n FROM p), d AS (SELECT *, (x2 * x1 + y2 * y1 + z2 * z1) / n / n AS k FROM u),
v AS (SELECT *, x2 - k * x1 AS vx, y2 - k * y1 AS vy, z2 - k * z1 AS vz FROM d), w AS (SELECT *, sqrt(vx**2 + vy**2 + vz**2) AS m FROM v)
SELECT vec_id, round(vx / m, 6) + 0.0 AS vx, round(vy / m, 6) + 0.0 AS vy, round(vz / m, 6) + 0.0 AS vz, round((y1 * vz - z1 * vy) / n / m, 6) + 0.0 AS wx, round((z1 * vx - x1 * vz) / n / m, 6) + 0.0 AS wy, round((x1 * vy - y1 * vx) / n / m, 6) + 0.0 AS wz FROM w"""
)
def square_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two joints' directions made square, and the third axis."""
    d = poses(spark, sf_dir).select("vec_id", vec.square_axes(vec.at(F.col("e"), 1), vec.at(F.col("e"), 2)).alias("a"))
    return d.select("vec_id", *[_r(F.col(f"a.{n}.{a}")).alias(f"{n}{a}") for n in "vw" for a in "xyz"])


def _unit_sql(name: str, a: int, b: int) -> str:
    n = f"sqrt((x{b} - x{a})**2 + (y{b} - y{a})**2 + (z{b} - z{a})**2)"
    return ", ".join(f"({c}{b} - {c}{a}) / {n} AS {name}{c}" for c in "xyz")


@query(
    _cte(1, 2, 5, 6)
    + f""", d AS (SELECT *, {_unit_sql("d", 1, 2)}, {_unit_sql("f", 5, 6)}, x5 - x1 AS wx, y5 - y1 AS wy, z5 - z1 AS wz FROM p),
k AS (SELECT *, dx * fx + dy * fy + dz * fz AS al, wx * dx + wy * dy + wz * dz AS wd, wx * fx + wy * fy + wz * fz AS wf FROM d),
s AS (SELECT *, (wd - wf * al) / (1 - al * al) AS t, (wd * al - wf) / (1 - al * al) AS r FROM k)
SELECT vec_id, """
    + ", ".join(f"round(({c}1 + t * d{c} + {c}5 + r * f{c}) / 2, 5) + 0.0 AS {c}" for c in "xyz")
    + " FROM s WHERE 1 - al * al > 1e-3"
)
def line_midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where two bones' lines are nearest, for lines that are not nearly parallel."""
    e = F.col("e")
    d1, d2 = vec.unit(vec.sub(vec.at(e, 2), vec.at(e, 1))), vec.unit(vec.sub(vec.at(e, 6), vec.at(e, 5)))
    d = poses(spark, sf_dir).select("vec_id", vec.dot(d1, d2).alias("al"), vec.lines_midpoint(vec.at(e, 1), vec.at(e, 2), vec.at(e, 5), vec.at(e, 6)).alias("m"))
    return d.where("1 - al * al > 1e-3").select("vec_id", *[_r(F.col(f"m.{a}"), 5).alias(a) for a in "xyz"])


def _undistorted_sql(rounds: int = 20) -> str:
    """x and y after each of the fixed-point steps, as a chain of tables from u0 (vec_id, x0, y0, x, y)."""
    k1, k2, k3, k4, k5, k6, p1, p2 = LENS
    text = ""
    for i in range(rounds):
        text += f""", q{i} AS (SELECT *, x * x + y * y AS r FROM u{i}), g{i} AS (SELECT *, (1 + r * ({k1} + r * ({k2} + r * {k3}))) / (1 + r * ({k4} + r * ({k5} + r * {k6}))) AS g FROM q{i}),
u{i + 1} AS (SELECT vec_id, x0, y0, (x0 - (2 * {p1} * x * y + {p2} * (r + 2 * x * x))) / g AS x, (y0 - ({p1} * (r + 2 * y * y) + 2 * {p2} * x * y)) / g AS y FROM g{i})"""
    return text


_PIXEL = f"u0 AS (SELECT vec_id, (320 + 40 * x8 - {CAMERA[2]}) / {CAMERA[0]} AS x0, (240 + 40 * y8 - {CAMERA[3]}) / {CAMERA[1]} AS y0, (320 + 40 * x8 - {CAMERA[2]}) / {CAMERA[0]} AS x, (240 + 40 * y8 - {CAMERA[3]}) / {CAMERA[1]} AS y FROM p)"


def _pixel() -> tuple[Column, Column]:
    p = vec.at(F.col("e"), 8)
    return 320 + 40 * p["x"], 240 + 40 * p["y"]


@query(_cte(8) + ", " + _PIXEL + _undistorted_sql() + " SELECT vec_id, round(x, 9) + 0.0 AS x, round(y, 9) + 0.0 AS y FROM u20")
def pixel_rays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The directions that pixels show, by twenty steps against the lens."""
    d = poses(spark, sf_dir).select("vec_id", vec.pixel_ray(*_pixel(), CAMERA, LENS).alias("r"))
    return d.select("vec_id", _r(F.col("r.x"), 9).alias("x"), _r(F.col("r.y"), 9).alias("y"))


@query(
    _cte(8) + ", " + _PIXEL + _undistorted_sql() + ", m AS (SELECT vec_id, x, y, (0.02 - 1.4) / (0.1 * x - 0.2 * y - 0.9746794344808963) AS k FROM u20)"
    " SELECT vec_id, round(k * x, 6) + 0.0 AS x, round(k * y, 6) + 0.0 AS y, round(k, 6) + 0.0 AS z, round(k * x - 0.02 * 0.1, 6) + 0.0 AS foot_x, round(k + 0.02 * 0.9746794344808963, 6) + 0.0 AS foot_z FROM m"
)
def marker_on_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markers that stand two centimetres over a table, from their pixels: the marker and two coordinates of its foot."""
    normal = vec.vec(0.1, -0.2, -0.9746794344808963)
    d = poses(spark, sf_dir).select("vec_id", vec.on_plane(vec.pixel_ray(*_pixel(), CAMERA, LENS), normal, 0.02 - 1.4).alias("c"))
    foot = vec.sub(F.col("c"), vec.scale(normal, 0.02))
    return d.select("vec_id", *[_r(F.col(f"c.{a}")).alias(a) for a in "xyz"], _r(foot["x"]).alias("foot_x"), _r(foot["z"]).alias("foot_z"))


@query(_cte(8) + f" SELECT vec_id, round(({CAMERA[0]} * x8 + {CAMERA[2]} * z8) / greatest(z8, 0.001), 3) + 0.0 AS u, round(({CAMERA[1]} * y8 + {CAMERA[3]} * z8) / greatest(z8, 0.001), 3) + 0.0 AS v, z8 > 0.001 AS positive FROM p")
def project_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels without a lens, with a least depth, and which points are before the camera."""
    d = poses(spark, sf_dir).select("vec_id", vec.project_clamped(vec.at(F.col("e"), 8), CAMERA).alias("q"))
    return d.select("vec_id", _r(F.col("q.u"), 3).alias("u"), _r(F.col("q.v"), 3).alias("v"), "q.positive")


@query(
    _cte(8)
    + f""", n AS (SELECT vec_id, x8 / (z8 + 4) AS x, y8 / (z8 + 4) AS y FROM p WHERE z8 + 4 > 0), q AS (SELECT *, x * x + y * y AS r FROM n), g AS (SELECT *, 1 + r * ({FIVE[0]} + r * ({FIVE[1]} + r * {FIVE[4]})) AS g FROM q)
SELECT vec_id, round({CAMERA[0]} * (x * g + 2 * {FIVE[2]} * x * y + {FIVE[3]} * (r + 2 * x * x)) + {CAMERA[2]}, 6) AS u, round({CAMERA[1]} * (y * g + {FIVE[2]} * (r + 2 * y * y) + 2 * {FIVE[3]} * x * y) + {CAMERA[3]}, 6) AS v FROM g"""
)
def project_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels by the five-coefficient lens of points moved four metres before the camera."""
    p = vec.add(vec.at(F.col("e"), 8), vec.vec(0, 0, 4))
    d = poses(spark, sf_dir).select("vec_id", vec.project_five(p, CAMERA, FIVE).alias("q")).where("q is not null")
    return d.select("vec_id", F.round("q.u", 6).alias("u"), F.round("q.v", 6).alias("v"))


@query(
    _cte(1, 2)
    + """, u AS (SELECT vec_id, x1, y1, z1, sqrt(x2**2 + y2**2 + z2**2) AS n, x2 / sqrt(x2**2 + y2**2 + z2**2) AS ax, y2 / sqrt(x2**2 + y2**2 + z2**2) AS ay, z2 / sqrt(x2**2 + y2**2 + z2**2) AS az FROM p),
d AS (SELECT *, ax * x1 + ay * y1 + az * z1 AS k, cos(n) AS c, sin(n) AS s FROM u)
SELECT vec_id, round(x1 * c + (ay * z1 - az * y1) * s + ax * k * (1 - c), 6) + 0.0 AS x, round(y1 * c + (az * x1 - ax * z1) * s + ay * k * (1 - c), 6) + 0.0 AS y, round(z1 * c + (ax * y1 - ay * x1) * s + az * k * (1 - c), 6) + 0.0 AS z FROM d"""
)
def axis_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A joint turned about another's direction by that one's length as the angle."""
    e = F.col("e")
    d = poses(spark, sf_dir).select("vec_id", vec.at(e, 1).alias("p"), vec.at(e, 2).alias("a"))
    t = d.select("vec_id", vec.rodrigues(F.col("p"), vec.unit(F.col("a")), vec.norm(F.col("a"))).alias("t"))
    return t.select("vec_id", *[_r(F.col(f"t.{a}")).alias(a) for a in "xyz"])


@query(
    _cte(1, 2)
    + """, n AS (SELECT vec_id, sqrt(x1**2 + y1**2 + z1**2) AS n1, sqrt(x2**2 + y2**2 + z2**2) AS n2, * EXCLUDE vec_id FROM p), u AS (SELECT vec_id, x1 / n1 AS ax, y1 / n1 AS ay, z1 / n1 AS az, x2 / n2 AS gx, y2 / n2 AS gy, z2 / n2 AS gz FROM n),
d AS (SELECT *, greatest(least(ax * gx + ay * gy + az * gz, 1), -1) AS d FROM u), t AS (SELECT *, gx - ax * d AS px, gy - ay * d AS py, gz - az * d AS pz FROM d), m AS (SELECT *, sqrt(px**2 + py**2 + pz**2) AS m FROM t)
SELECT vec_id, round(px * acos(d) / m, 6) + 0.0 AS x, round(py * acos(d) / m, 6) + 0.0 AS y, round(pz * acos(d) / m, 6) + 0.0 AS z, round(gx, 6) + 0.0 AS back FROM m"""
)
def sphere_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tangent from one direction to another, and where it leads."""
    e = F.col("e")
    d = poses(spark, sf_dir).select("vec_id", vec.unit(vec.at(e, 1)).alias("a"), vec.unit(vec.at(e, 2)).alias("b"))
    t = d.withColumn("t", vec.sphere_log(F.col("a"), F.col("b")))
    return t.select("vec_id", *[_r(F.col(f"t.{a}")).alias(a) for a in "xyz"], _r(vec.sphere_exp(F.col("a"), F.col("t"))["x"]).alias("back"))


def _chain_sql() -> str:
    """The tip of the first finger: three offsets, each in the axes that the turns before it make."""
    text = _cte(0, 1, 2, 3, 4, 5, 6) + _turn_cte("ta", 0) + _turn_cte("tb", 1) + _turn_cte("tc", 2)
    prod = ", ".join(f"{' + '.join(f'ta.r{i}{k} * tb.r{k}{j}' for k in range(3))} AS r{i}{j}" for i in range(3) for j in range(3))
    prod2 = ", ".join(f"{' + '.join(f'tab.r{i}{k} * tc.r{k}{j}' for k in range(3))} AS r{i}{j}" for i in range(3) for j in range(3))
    text += f", tab AS (SELECT vec_id, {prod} FROM ta JOIN tb USING (vec_id)), tabc AS (SELECT vec_id, {prod2} FROM tab JOIN tc USING (vec_id))"
    cell = lambda i: " + ".join(f"{m}.r{i}{k} * {'xyz'[k]}{j}" for m, j in (("ta", 4), ("tab", 5), ("tabc", 6)) for k in range(3))
    return text + " SELECT vec_id, " + ", ".join(f"round({cell(i)}, 5) + 0.0 AS {'xyz'[i]}" for i in range(3)) + " FROM p JOIN ta USING (vec_id) JOIN tab USING (vec_id) JOIN tabc USING (vec_id)"


@query(_chain_sql())
def chain_tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end of a chain of three bones by its joints' turns."""
    e = F.col("e")
    turns = [vec.turn_exp(vec.at(e, j)) for j in range(4)]
    offsets = [vec.vec(0, 0, 0), *[vec.at(e, j) for j in (4, 5, 6)]]
    d = poses(spark, sf_dir).select("vec_id", F.get(vec.chain_frames(turns, offsets, (-1, 0, 1, 2)), F.lit(3)).alias("p"))
    return d.select("vec_id", *[_r(F.col(f"p.{a}"), 5).alias(a) for a in "xyz"])


@query(
    _cte(0, 1, 2, 3)
    + """, n AS (SELECT *, sqrt((x1 - x0)**2 + (y1 - y0)**2 + (z1 - z0)**2) AS n1, sqrt((x2 - x1)**2 + (y2 - y1)**2 + (z2 - z1)**2) AS n2, sqrt((x3 - x2)**2 + (y3 - y2)**2 + (z3 - z2)**2) AS n3 FROM p)
SELECT vec_id, """
    + ", ".join(f"round({c}0 + ({c}1 - {c}0) / n1 * 0.4 + ({c}2 - {c}1) / n2 * 0.3 + ({c}3 - {c}2) / n3 * 0.2 + {k}, 6) + 0.0 AS {c}" for c, k in zip("xyz", (0.01, -0.02, 0.03), strict=True))
    + " FROM n"
)
def rebuilt_pose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fingertip from its bones' directions and fixed lengths, moved by an operator's translation."""
    e, parents = F.col("e"), (-1, 0, 1, 2)
    chain = vec.chain_positions(vec.at(e, 0), [vec.unit(b) for b in vec.bones(e, parents)], [F.lit(0.4), F.lit(0.3), F.lit(0.2)], parents)
    d = poses(spark, sf_dir).select("vec_id", vec.add(chain[3], vec.vec(0.01, -0.02, 0.03)).alias("p"))
    return d.select("vec_id", *[_r(F.col(f"p.{a}")).alias(a) for a in "xyz"])


@query(
    """WITH k AS (SELECT p_partkey, p_size * 5.0::DOUBLE AS jet, (p_retailprice::BIGINT % 50)::DOUBLE AS err FROM part), d AS (SELECT *, (jet - 12.5) / 0.06 AS mm FROM k)
SELECT p_partkey, err < 35 AND jet > 2 AND jet < 250 AND mm BETWEEN 400 AND 4500 AS valid, round(CASE WHEN err < 35 AND jet > 2 AND jet < 250 AND mm BETWEEN 400 AND 4500 THEN mm ELSE 0 END, 6) AS depth FROM d"""
)
def preview_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depths of colour indices by a line, zero where the colour, the index or the depth is out of bounds."""
    d = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", (F.col("p_size") * 5.0).alias("jet"), (F.rint("p_retailprice").cast("long") % 50).cast("double").alias("err"))
    d = d.withColumn("mm", (F.col("jet") - 12.5) / 0.06).withColumn("valid", F.expr("err < 35 and jet > 2 and jet < 250 and mm between 400 and 4500"))
    return d.select("p_partkey", "valid", F.round(F.when(F.col("valid"), F.col("mm")).otherwise(0.0), 6).alias("depth"))
