"""Queries of geometry: the first 63 numbers of an embedding are 21 joints of a pose."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.functions import vec
from kinestream.operators import fit, smooth, stats
from kinestream.plans.registry import query
from kinestream.shared import written

#: A camera: intrinsics, lens coefficients in the order k1 to k6, p1, p2, and the world's place before it.
CAMERA = (600.0, 610.0, 320.0, 240.0)
LENS = (0.08, -0.05, 0.01, 0.02, 0.01, 0.003, 0.001, -0.002)
WORLD = ((0.0, -1.0, 0.0, 0.1), (1.0, 0.0, 0.0, -0.2), (0.0, 0.0, 1.0, 4.0), (0.0, 0.0, 0.0, 1.0))


def poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, e (the flat numbers)."""
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", F.col("embedding").alias("e"))


def joints(df: DataFrame, keep: range = range(21)) -> DataFrame:
    """One row for each joint: joint, p."""
    each = F.transform(F.array(*[F.lit(j) for j in keep]), lambda j: F.struct(j.alias("joint"), F.struct(*[F.get("e", 3 * j + k).cast("double").alias(a) for k, a in enumerate("xyz")]).alias("p")))
    return df.select("vec_id", "label", F.inline(each))


_J = """WITH j AS (SELECT vec_id, label, g::INT AS joint, embedding[3 * g + 1]::DOUBLE AS x, embedding[3 * g + 2]::DOUBLE AS y, embedding[3 * g + 3]::DOUBLE AS z FROM embeddings CROSS JOIN range(21) r(g))
"""


def _r(x: Column, digits: int = 6) -> Column:
    # adding zero takes the sign off a rounded zero
    return F.round(x, digits) + 0.0


def _xyz(p: str) -> list[Column]:
    return [_r(F.col(f"{p}.{a}")).alias(a) for a in "xyz"]


_SQL_XYZ = "round({x}, 6) + 0.0 AS x, round({y}, 6) + 0.0 AS y, round({z}, 6) + 0.0 AS z"


@query(_J + "SELECT j.vec_id, j.joint, " + _SQL_XYZ.format(x="j.x - r.x", y="j.y - r.y", z="j.z - r.z") + " FROM j JOIN j r ON r.vec_id = j.vec_id AND r.joint = 0")
def root_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joints as seen from the root."""
    df = poses(spark, sf_dir)
    each = [F.struct(F.lit(j).alias("joint"), vec.sub(vec.at(F.col("e"), j), vec.at(F.col("e"), 0)).alias("p")) for j in range(21)]
    return df.select("vec_id", F.inline(F.array(*each))).select("vec_id", "joint", *_xyz("p"))


_PARENT21 = [-1, *[0 if j % 4 == 1 else j - 1 for j in range(1, 21)]]
_BONES = _J + ", b AS (SELECT j.vec_id, j.label, j.joint, sqrt((j.x - p.x)**2 + (j.y - p.y)**2 + (j.z - p.z)**2) AS len FROM j JOIN j p ON p.vec_id = j.vec_id AND p.joint = CASE WHEN j.joint % 4 = 1 THEN 0 ELSE j.joint - 1 END WHERE j.joint > 0)\n"


def _bones(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = [F.struct(F.lit(j + 1).alias("joint"), vec.norm(b).alias("len")) for j, b in enumerate(vec.bones(F.col("e"), _PARENT21))]
    return poses(spark, sf_dir).select("vec_id", "label", F.inline(F.array(*lengths)))


@query(_BONES + "SELECT vec_id, joint, round(len, 6) AS len FROM b")
def bone_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length of each bone."""
    return _bones(spark, sf_dir).select("vec_id", "joint", _r(F.col("len")).alias("len"))


@query(_BONES + ", c AS (SELECT label, joint, CASE WHEN avg(len) > 1e-9 THEN stddev_pop(len) / avg(len) ELSE 0 END AS cv FROM b GROUP BY ALL) SELECT label, round(max(cv), 6) AS max_cv, round(quantile_cont(cv, 0.5), 6) AS median_cv FROM c GROUP BY label")
def bone_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per label the largest and the median variation of bone lengths."""
    c = _bones(spark, sf_dir).groupBy("label", "joint").agg(F.when(F.avg("len") > 1e-9, F.stddev_pop("len") / F.avg("len")).otherwise(0.0).alias("cv"))
    return c.groupBy("label").agg(_r(F.max("cv")).alias("max_cv"), _r(F.median("cv")).alias("median_cv"))


_GUIDE = ", g AS (SELECT label, joint, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM j GROUP BY ALL)\n"


def _against_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each joint with its label's mean joint."""
    j = joints(poses(spark, sf_dir))
    g = j.groupBy("label", "joint").agg(*[F.avg(f"p.{a}").alias(f"g{a}") for a in "xyz"])
    return j.join(g, ["label", "joint"])


@query(
    _J + _GUIDE + ", d AS (SELECT j.label, j.joint, sqrt((j.x - g.x)**2 + (j.y - g.y)**2 + (j.z - g.z)**2) AS epe FROM j JOIN g USING (label, joint) WHERE joint >= 5) "
    "SELECT label, joint, count(*) AS n, round(avg(epe), 6) AS mean, round(quantile_cont(epe, 0.5), 6) AS median, round(quantile_cont(epe, 0.95), 6) AS p95 FROM d GROUP BY GROUPING SETS ((label), (label, joint))"
)
def joint_map_epe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sixteen mapped joints from their label's mean pose, pooled and by joint."""
    far = F.sqrt(sum(((F.col(f"p.{a}") - F.col(f"g{a}")) ** 2 for a in "xyz"), F.lit(0.0)))
    d = _against_mean(spark, sf_dir).where("joint >= 5").select("label", "joint", far.alias("epe"))
    grains = d.select("label", F.explode(F.array(F.lit(None).cast("int"), F.col("joint"))).alias("joint"), "epe")
    a = stats.distribution(written(grains, "joint-errors"), ["label", "joint"], "epe", {"median": 0.5, "p95": 0.95})
    return a.select("label", "joint", F.col("count").alias("n"), *[_r(F.col(c)).alias(c) for c in ("mean", "median", "p95")])


@query(
    _J + f", c AS (SELECT vec_id, joint, -y + 0.1 AS cx, x - 0.2 AS cy, z + 4.0 AS cz FROM j) SELECT vec_id, joint, CASE WHEN cz > 1e-6 THEN round({CAMERA[0]} * cx / cz + {CAMERA[2]}, 5) END AS u, CASE WHEN cz > 1e-6 THEN round({CAMERA[1]} * cy / cz + {CAMERA[3]}, 5) END AS v, "
    f"coalesce(cz > 1e-6 AND {CAMERA[0]} * cx / cz + {CAMERA[2]} >= 0 AND {CAMERA[0]} * cx / cz + {CAMERA[2]} < 640 AND {CAMERA[1]} * cy / cz + {CAMERA[3]} >= 0 AND {CAMERA[1]} * cy / cz + {CAMERA[3]} < 480, false) AS inside FROM c"
)
def project_pinhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of all joints without a lens, and whether they are in the image."""
    p = joints(poses(spark, sf_dir)).withColumn("px", vec.project(vec.transform(WORLD, F.col("p")), CAMERA))
    return p.select("vec_id", "joint", F.round("px.u", 5).alias("u"), F.round("px.v", 5).alias("v"), vec.in_frame(F.col("px"), 640, 480).alias("inside"))


def _lens_sql() -> str:
    k1, k2, k3, k4, k5, k6, p1, p2 = LENS
    return f""", c AS (SELECT vec_id, joint, (-y + 0.1) / (z + 4.0) AS a, (x - 0.2) / (z + 4.0) AS b, z + 4.0 AS cz FROM j), r AS (SELECT *, a * a + b * b AS r2 FROM c),
l AS (SELECT *, (1 + {k1} * r2 + {k2} * r2**2 + {k3} * r2**3) / (1 + {k4} * r2 + {k5} * r2**2 + {k6} * r2**3) AS k FROM r)
SELECT vec_id, joint, CASE WHEN cz > 1e-6 THEN round({CAMERA[0]} * (a * k + 2 * {p1} * a * b + {p2} * (r2 + 2 * a * a)) + {CAMERA[2]}, 5) END AS u,
  CASE WHEN cz > 1e-6 THEN round({CAMERA[1]} * (b * k + {p1} * (r2 + 2 * b * b) + 2 * {p2} * a * b) + {CAMERA[3]}, 5) END AS v FROM l"""


@query(_J + _lens_sql())
def project_distorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of all joints through the rational lens."""
    p = joints(poses(spark, sf_dir)).withColumn("px", vec.project(vec.transform(WORLD, F.col("p")), CAMERA, LENS))
    return p.select("vec_id", "joint", F.round("px.u", 5).alias("u"), F.round("px.v", 5).alias("v"))


_Q = """WITH q AS (SELECT vec_id, label, embedding[1]::DOUBLE AS w, embedding[2]::DOUBLE AS x, embedding[3]::DOUBLE AS y, embedding[4]::DOUBLE AS z, sqrt(embedding[1]::DOUBLE**2 + embedding[2]::DOUBLE**2 + embedding[3]::DOUBLE**2 + embedding[4]::DOUBLE**2) AS n FROM embeddings),
u AS (SELECT vec_id, label, w / n AS w, x / n AS x, y / n AS y, z / n AS z FROM q WHERE n > 1e-12)
"""


def _quat(first: int = 0) -> Column:
    return vec.quat(*[F.get("e", F.lit(first + k)).cast("double") for k in range(4)])


@query(_Q + "SELECT vec_id, round(1 - 2 * (y * y + z * z), 6) + 0.0 AS m00, round(2 * (x * y - w * z), 6) + 0.0 AS m01, round(2 * (x * z + w * y), 6) + 0.0 AS m02, round(2 * (y * z + w * x), 6) + 0.0 AS m21, round(1 - 2 * (x * x + y * y), 6) + 0.0 AS m22 FROM u")
def quat_to_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rotation matrices of the first four numbers as quaternions."""
    m = poses(spark, sf_dir).select("vec_id", vec.quat_matrix(_quat()).alias("m")).where("m is not null")
    return m.select("vec_id", *[_r(F.get(F.get("m", F.lit(i)), F.lit(j))).alias(f"m{i}{j}") for i, j in ((0, 0), (0, 1), (0, 2), (2, 1), (2, 2))])


@query(
    _Q + """, v AS (SELECT vec_id, label, embedding[5]::DOUBLE AS w, embedding[6]::DOUBLE AS x, embedding[7]::DOUBLE AS y, embedding[8]::DOUBLE AS z FROM embeddings),
k AS (SELECT vec_id, w / m AS w, x / m AS x, y / m AS y, z / m AS z FROM (SELECT *, sqrt(w * w + x * x + y * y + z * z) AS m FROM v)),
d AS (SELECT u.vec_id, u.w, u.x, u.y, u.z, k.w AS kw, k.x AS kx, k.y AS ky, k.z AS kz, u.w * k.w + u.x * k.x + u.y * k.y + u.z * k.z AS dot FROM u JOIN k USING (vec_id)),
t AS (SELECT *, acos(least(abs(dot), 1)) AS th, CASE WHEN dot < 0 THEN -1 ELSE 1 END AS s FROM d),
r AS (SELECT vec_id, (sin(0.7 * th) * w + s * sin(0.3 * th) * kw) / sin(th) AS w, (sin(0.7 * th) * x + s * sin(0.3 * th) * kx) / sin(th) AS x, (sin(0.7 * th) * y + s * sin(0.3 * th) * ky) / sin(th) AS y, (sin(0.7 * th) * z + s * sin(0.3 * th) * kz) / sin(th) AS z FROM t WHERE sin(th) >= 1e-8)
SELECT vec_id, round(w / sqrt(w * w + x * x + y * y + z * z), 6) + 0.0 AS w, round(x / sqrt(w * w + x * x + y * y + z * z), 6) + 0.0 AS x, round(y / sqrt(w * w + x * x + y * y + z * z), 6) + 0.0 AS y, round(z / sqrt(w * w + x * x + y * y + z * z), 6) + 0.0 AS z FROM r"""
)
def slerp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tenths of the way between two quaternions of each row."""
    two = poses(spark, sf_dir).select("vec_id", vec.quat_unit(_quat()).alias("a"), vec.quat_unit(_quat(4)).alias("b"))
    q = two.select("vec_id", vec.quat_slerp(F.col("a"), F.col("b"), F.lit(0.3)).alias("q"))
    return q.select("vec_id", *[_r(F.col(f"q.{c}")).alias(c) for c in "wxyz"])


@query(
    _J + """, d AS (SELECT j.vec_id, j.joint, (j.x - r.x) AS x, (j.y - r.y) AS y, (j.z - r.z) AS z FROM j JOIN j r ON r.vec_id = j.vec_id AND r.joint = 0 WHERE j.joint IN (5, 9)),
n AS (SELECT vec_id, joint, x / sqrt(x * x + y * y + z * z) AS x, y / sqrt(x * x + y * y + z * z) AS y, z / sqrt(x * x + y * y + z * z) AS z FROM d),
p AS (SELECT a.vec_id, a.x AS ax, a.y AS ay, a.z AS az, b.x AS bx, b.y AS by_, b.z AS bz, acos(greatest(least(a.x * b.x + a.y * b.y + a.z * b.z, 1), -1)) AS th FROM n a JOIN n b ON b.vec_id = a.vec_id AND b.joint = 9 WHERE a.joint = 5),
r AS (SELECT vec_id, th, (sin(0.6 * th) * ax + sin(0.4 * th) * bx) / sin(th) AS x, (sin(0.6 * th) * ay + sin(0.4 * th) * by_) / sin(th) AS y, (sin(0.6 * th) * az + sin(0.4 * th) * bz) / sin(th) AS z FROM p)
SELECT vec_id, round(x / sqrt(x * x + y * y + z * z), 6) + 0.0 AS x, round(y / sqrt(x * x + y * y + z * z), 6) + 0.0 AS y, round(z / sqrt(x * x + y * y + z * z), 6) + 0.0 AS z, round(degrees(th), 5) AS angle FROM r"""
)
def s2_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fifths of the way between two bone directions, on the sphere."""
    e = F.col("e")
    two = poses(spark, sf_dir).select("vec_id", *[vec.unit(vec.sub(vec.at(e, j), vec.at(e, 0))).alias(n) for n, j in (("a", 5), ("b", 9))])
    s = two.select("vec_id", vec.slerp(F.col("a"), F.col("b"), F.lit(0.4)).alias("p"), vec.angle(F.col("a"), F.col("b")).alias("th"))
    return s.select("vec_id", *_xyz("p"), F.round(F.degrees("th"), 5).alias("angle"))


@query(_J + "SELECT vec_id, joint, " + _SQL_XYZ.format(x="-y + 0.1", y="x - 0.2", z="z + 4.0") + " FROM j")
def transform4x4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All joints in the camera's frame."""
    return joints(poses(spark, sf_dir)).select("vec_id", "joint", vec.transform(WORLD, F.col("p")).alias("p")).select("vec_id", "joint", *_xyz("p"))


@query(
    _J + """, w AS (SELECT vec_id, x, y, z FROM j WHERE joint = 0), m AS (SELECT vec_id, x, y, z FROM j WHERE joint = 9), d AS (SELECT w.vec_id, w.x AS wx, w.y AS wy, w.z AS wz, m.x - w.x AS x, m.y - w.y AS y, m.z - w.z AS z FROM w JOIN m USING (vec_id))
SELECT vec_id, """ + _SQL_XYZ.format(x="wx - 0.2 * x / sqrt(x * x + y * y + z * z)", y="wy - 0.2 * y / sqrt(x * x + y * y + z * z)", z="wz - 0.2 * z / sqrt(x * x + y * y + z * z)") + " FROM d"
)
def virtual_wrist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point behind the root, away from the middle of the palm."""
    e = F.col("e")
    back = vec.sub(vec.at(e, 0), vec.scale(vec.unit(vec.sub(vec.at(e, 9), vec.at(e, 0))), 0.2))
    return poses(spark, sf_dir).select("vec_id", back.alias("p")).select("vec_id", *_xyz("p"))


@query(_J + "SELECT w.vec_id, " + _SQL_XYZ.format(x="w.x - 0.8 * (m.x - w.x)", y="w.y - 0.8 * (m.y - w.y)", z="w.z - 0.8 * (m.z - w.z)") + " FROM j w JOIN j m ON m.vec_id = w.vec_id AND m.joint = 9 WHERE w.joint = 0")
def rear_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The root moved back by four fifths of its way to the middle."""
    e = F.col("e")
    p = vec.sub(vec.at(e, 0), vec.scale(vec.sub(vec.at(e, 9), vec.at(e, 0)), 0.8))
    return poses(spark, sf_dir).select("vec_id", p.alias("p")).select("vec_id", *_xyz("p"))


@query(
    _J + _GUIDE + "SELECT label, " + ", ".join(f"round(sum(j.{a} * g.{b}), 5) + 0.0 AS c{a}{b}" for a in "xyz" for b in "xyz") + ", count(*) AS points FROM j JOIN g USING (label, joint) GROUP BY label"
)
def cross_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sums that a registration of poses to their label's mean is solved from."""
    d = _against_mean(spark, sf_dir)
    return d.groupBy("label").agg(*[_r(F.sum(F.col(f"p.{a}") * F.col(f"g{b}")), 5).alias(f"c{a}{b}") for a in "xyz" for b in "xyz"], F.count("*").alias("points"))


@query(
    _J + ", a AS (SELECT j.vec_id, j.joint, j.x - p.x AS x, j.y - p.y AS y, j.z - p.z AS z FROM j JOIN j p ON p.vec_id = j.vec_id AND p.joint = CASE WHEN j.joint % 4 = 1 THEN 0 ELSE j.joint - 1 END WHERE j.joint > 0) "
    "SELECT b.vec_id, b.joint, round(degrees(acos(greatest(least((a.x * b.x + a.y * b.y + a.z * b.z) / (sqrt(a.x**2 + a.y**2 + a.z**2) * sqrt(b.x**2 + b.y**2 + b.z**2)), 1), -1))), 4) AS flexion FROM a b JOIN a ON a.vec_id = b.vec_id AND a.joint = b.joint - 1 WHERE b.joint % 4 <> 1"
)
def joint_flexion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The angle between each bone and the one before it in its finger."""
    b = poses(spark, sf_dir).select("vec_id", F.array(*vec.bones(F.col("e"), _PARENT21)).alias("b"))
    units = b.select("vec_id", F.transform("b", lambda x: vec.unit(x)).alias("u"))
    inner = F.array(*[F.lit(j) for j in range(1, 21) if j % 4 != 1])
    each = F.transform(inner, lambda j: F.struct(j.alias("joint"), F.round(F.degrees(vec.angle(F.get("u", j - 2), F.get("u", j - 1))), 4).alias("flexion")))
    return units.select("vec_id", F.inline(each))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _against_mean(spark, sf_dir)
    return d.select("label", F.col("vec_id").alias("frame"), F.col("p").alias("s"), F.struct(*[F.col(f"g{a}").alias(a) for a in "xyz"]).alias("t"))


@query()
def similarity_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale and rotation of each label's poses to their mean, without outlying frames."""
    return fit.similarity(_pairs(spark, sf_dir), ["label"])


@query()
def frame_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale and rotation of each pose by itself."""
    return fit.frame_alignment(_pairs(spark, sf_dir), ["label", "frame"])


@query()
def plane_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plane that most joints of a label are near to."""
    p = joints(poses(spark, sf_dir)).select("label", "p.x", "p.y", "p.z")
    return fit.plane(p, ["label"], 0.3)


def _takes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poses as sequences of a label: at most 256 frames each, in order of id."""
    take = F.floor(F.col("vec_id") / 2560)
    return poses(spark, sf_dir).select("label", take.alias("take"), "vec_id", F.transform(F.slice("e", 1, 63), lambda x: x.cast("double")).alias("v"))


@query()
def rts_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poses under the constant-velocity smoother."""
    return smooth.rts(_takes(spark, sf_dir), ["label", "take"], "vec_id", "v", 30.0)


@query()
def kernel_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pose mapped to the one rotated by a joint, by kernel ridge regression on the same sequence."""
    t = _takes(spark, sf_dir).withColumn("target", F.concat(F.slice("v", 4, 60), F.slice("v", 1, 3)))
    return smooth.kernel_fit(t, ["label", "take"], "vec_id", "v", "target", 30.0, 1e-6)


@query()
def guided_posterior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directions guided by the pose rotated by a joint; null in sequences of four frames or fewer, which have no filter."""
    t = _takes(spark, sf_dir).withColumn("target", F.concat(F.slice("v", 4, 60), F.slice("v", 1, 3)))
    return smooth.posterior(t, ["label", "take"], "vec_id", "v", "target", 0.5)


@query(_J + f"SELECT vec_id, round(atan2(y, x), 6) + 0.0 AS heading, round(log10(1 + x * x + y * y + z * z) * 10, 6) + 0.0 AS level, round({math.pi} - acos(z / sqrt(x * x + y * y + z * z)), 6) + 0.0 AS tilt FROM j WHERE joint = 8")
def heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heading, level and tilt of a fingertip."""
    p = vec.at(F.col("e"), 8)
    d = poses(spark, sf_dir).select("vec_id", p.alias("p"))
    p = F.col("p")
    return d.select("vec_id", _r(F.atan2(p["y"], p["x"])).alias("heading"), _r(F.log10(1 + vec.dot(p, p)) * 10.0).alias("level"), _r(F.lit(math.pi) - F.acos(p["z"] / vec.norm(p))).alias("tilt"))
