"""Queries of places: pixels, palettes, joint trees, rays, links, hashes and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.functions import vec
from kinestream.operators import spatial, temporal
from kinestream.plans.poses import _J, _SQL_XYZ, _r, _xyz, joints, poses
from kinestream.plans.registry import query

#: A palette of sixteen entries, by rule: the corners and the middle greys of a cube around zero.
PALETTE = [(x * 0.2, y * 0.2, z * 0.2) for x in (-1, 1) for y in (-1, 1) for z in (-1, 1)] + [(k * 0.05, k * 0.05, k * 0.05) for k in range(-4, 4)]


@query(
    """WITH pix AS (SELECT (p_partkey * 13 % 200)::DOUBLE AS u, (p_size * 4)::DOUBLE AS v, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_retailprice END AS z FROM part),
pts AS (SELECT c_custkey AS point_id, (c_custkey * 7 % 200) + 0.25 AS u, (c_custkey * 11 % 200) + 0.5 AS v FROM customer),
n AS (SELECT point_id, z, (pts.u - pix.u)**2 + (pts.v - pix.v)**2 AS d2, pix.v AS pv, pix.u AS pu FROM pts JOIN pix ON abs(pts.u - pix.u) <= 5 AND abs(pts.v - pix.v) <= 5 WHERE z <> 0),
b AS (SELECT point_id, z, d2 FROM n WHERE d2 <= 25 QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY d2, pv, pu, z) = 1)
SELECT pts.point_id, round(z, 4) AS z, round(sqrt(d2), 6) AS distance FROM pts LEFT JOIN b USING (point_id)"""
)
def nearest_pixel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest measured pixel of each point within five pixels."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    pix = parts.select((F.col("p_partkey") * 13 % 200).cast("double").alias("u"), (F.col("p_size") * 4).cast("double").alias("v"), F.when(F.col("p_partkey") % 5 == 0, 0.0).otherwise(F.col("p_retailprice")).alias("z"))
    pix = pix.where("z <> 0").groupBy("u", "v").agg(F.min("z").alias("z"))
    pts = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("point_id"), (F.col("c_custkey") * 7 % 200 + 0.25).alias("u"), (F.col("c_custkey") * 11 % 200 + 0.5).alias("v"))
    n = spatial.nearest_within(pts, pix, 5.0)
    return n.select("point_id", F.round("z", 4).alias("z"), F.round("distance", 6).alias("distance"))


@query(
    "WITH p(i, x, y, z) AS (VALUES " + ", ".join(f"({i}, {x!r}::DOUBLE, {y!r}::DOUBLE, {z!r}::DOUBLE)" for i, (x, y, z) in enumerate(PALETTE)) + ") "
    "SELECT vec_id, i::INT AS entry FROM embeddings CROSS JOIN p QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY (embedding[1]::DOUBLE - x)**2 + (embedding[2]::DOUBLE - y)**2 + (embedding[3]::DOUBLE - z)**2, i) = 1"
)
def nearest_palette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The palette entry nearest to each colour."""
    colour = [F.get("e", F.lit(k)).cast("double") for k in range(3)]
    return poses(spark, sf_dir).select("vec_id", spatial.nearest_colour(colour, PALETTE).alias("entry"))


@query(
    _J + """, b AS (SELECT j.vec_id, j.joint, (j.x - p.x)**2 + (j.y - p.y)**2 + (j.z - p.z)**2 AS v FROM j JOIN j p ON p.vec_id = j.vec_id AND p.joint = CASE WHEN j.joint % 4 = 1 THEN 0 ELSE j.joint - 1 END WHERE j.joint > 0)
SELECT a.vec_id, a.joint, round(sum(b.v), 6) AS variance FROM b a JOIN b ON b.vec_id = a.vec_id AND (b.joint - 1) // 4 = (a.joint - 1) // 4 AND b.joint <= a.joint GROUP BY ALL"""
)
def joint_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What adds up along each joint's ancestors: the tree's closure is a small table that is joined."""
    parents = [-1, *[0 if j % 4 == 1 else j - 1 for j in range(1, 21)]]
    closure = []
    for j in range(1, 21):
        a = j
        while a > 0:
            closure.append((j, a))
            a = parents[a]
    tree = spark.createDataFrame(closure, "joint int, ancestor int")
    lengths = [F.struct(F.lit(j + 1).alias("ancestor"), vec.dot(b, b).alias("v")) for j, b in enumerate(vec.bones(F.col("e"), parents))]
    own = poses(spark, sf_dir).select("vec_id", F.inline(F.array(*lengths)))
    return own.join(F.broadcast(tree), "ancestor").groupBy("vec_id", "joint").agg(_r(F.sum("v")).alias("variance"))


@query(_J + ", m(marker, joint, dx) AS (VALUES (1, 4, 0.01), (2, 8, 0.02), (3, 12, 0.03), (4, 8, -0.01)) SELECT vec_id, marker::INT AS marker, " + _SQL_XYZ.format(x="x + dx", y="y", z="z - dx") + " FROM j JOIN m USING (joint)")
def marker_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markers at an offset from their joints."""
    m = spark.createDataFrame([(1, 4, 0.01), (2, 8, 0.02), (3, 12, 0.03), (4, 8, -0.01)], "marker int, joint int, dx double")
    rows = joints(poses(spark, sf_dir)).join(F.broadcast(m), "joint")
    p = vec.add(F.col("p"), vec.vec(F.col("dx"), F.lit(0.0), -F.col("dx")))
    return rows.select("vec_id", "marker", p.alias("q")).select("vec_id", "marker", *_xyz("q"))


@query(
    _J + """, a AS (SELECT vec_id, x, y, z FROM j WHERE joint = 1), n AS (SELECT vec_id, x, y, z FROM j WHERE joint = 2), k AS (SELECT a.vec_id, a.x, a.y, a.z + 2 AS z, 1 / ((a.z + 2) * (n.z + 2) + a.x * n.x + a.y * n.y) AS k, (a.z + 2) * (n.z + 2) + a.x * n.x + a.y * n.y AS d FROM a JOIN n USING (vec_id))
SELECT vec_id, """ + _SQL_XYZ.format(x="1.5 * x * k", y="1.5 * y * k", z="1.5 * z * k") + " FROM k WHERE abs(d) > 1e-9"
)
def ray_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the ray through a joint meets the plane n . p = 1.5; parallel rays are left out."""
    e = F.col("e")
    shift = vec.vec(0, 0, 2)
    two = poses(spark, sf_dir).select("vec_id", vec.add(vec.at(e, 1), shift).alias("ray"), vec.add(vec.at(e, 2), shift).alias("n"))
    met = two.withColumn("d", vec.dot(F.col("ray"), F.col("n"))).where(F.abs("d") > 1e-9)
    return met.select("vec_id", vec.scale(F.col("ray"), 1.5 / F.col("d")).alias("q")).select("vec_id", *_xyz("q"))


_LINK = 0.3


def _middle(a: Column, b: Column, guide: Column) -> Column:
    """The joint between two links of equal length: on the circle that both allow, on the guide's side; straight where they are too short."""

    def placed(p: Column) -> Column:
        half, axis = p["d"] / 2, vec.scale(vec.sub(p["b"], p["a"]), 1 / p["d"])
        mid = vec.scale(vec.add(p["a"], p["b"]), 0.5)
        side = vec.let(F.struct(axis.alias("x"), vec.sub(p["g"], mid).alias("g")), lambda q: vec.sub(q["g"], vec.scale(q["x"], vec.dot(q["g"], q["x"]))))
        high = F.sqrt(F.greatest(F.lit(0.0), F.lit(_LINK * _LINK) - half * half))
        return vec.add(mid, vec.scale(vec.unit(side), high))

    ends = F.struct(a.alias("a"), b.alias("b"), guide.alias("g"))
    return vec.let(ends, lambda p: vec.let(F.struct(p["a"].alias("a"), p["b"].alias("b"), p["g"].alias("g"), vec.norm(vec.sub(p["b"], p["a"])).alias("d")), placed))


@query(
    _J + f""", p AS (SELECT a.vec_id, a.x AS ax, a.y AS ay, a.z AS az, b.x - a.x AS dx, b.y - a.y AS dy, b.z - a.z AS dz, g.x - (a.x + b.x) / 2 AS gx, g.y - (a.y + b.y) / 2 AS gy, g.z - (a.z + b.z) / 2 AS gz FROM j a JOIN j b ON b.vec_id = a.vec_id AND b.joint = 7 JOIN j g ON g.vec_id = a.vec_id AND g.joint = 6 WHERE a.joint = 5),
d AS (SELECT *, sqrt(dx * dx + dy * dy + dz * dz) AS d FROM p), s AS (SELECT *, (gx * dx + gy * dy + gz * dz) / (d * d) AS k, sqrt(greatest(0, {_LINK * _LINK!r} - d * d / 4)) AS h FROM d),
q AS (SELECT *, gx - k * dx AS sx, gy - k * dy AS sy, gz - k * dz AS sz FROM s), u AS (SELECT *, sqrt(sx * sx + sy * sy + sz * sz) AS n FROM q)
SELECT vec_id, """ + _SQL_XYZ.format(x="ax + dx / 2 + h * sx / n", y="ay + dy / 2 + h * sy / n", z="az + dz / 2 + h * sz / n") + " FROM u"
)
def two_link_ik(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle joint of two links of fixed length between two joints, nearest to where the pose has it."""
    e = F.col("e")
    q = poses(spark, sf_dir).select("vec_id", _middle(vec.at(e, 5), vec.at(e, 7), vec.at(e, 6)).alias("q"))
    return q.select("vec_id", *_xyz("q"))


@query(
    """WITH h AS (SELECT vec_id, label, list_transform(range(1, 64), lambda i: embedding[i] > embedding[i + 1]) AS b FROM embeddings),
p AS (SELECT vec_id, b, lag(b) OVER (PARTITION BY label ORDER BY vec_id) AS c FROM h)
SELECT vec_id, len(list_filter(range(1, 64), lambda i: b[i] <> c[i]))::INT AS differing FROM p WHERE c IS NOT NULL"""
)
def difference_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many of 63 comparisons of neighbouring numbers a row differs from the one before of its label."""
    bits = F.aggregate(F.sequence(F.lit(0), F.lit(62)), F.lit(0).cast("long"), lambda h, i: F.shiftleft(h, 1).bitwiseOR((F.get("e", i) > F.get("e", i + 1)).cast("long")))
    h = poses(spark, sf_dir).select("vec_id", "label", bits.alias("h"))
    seen = temporal.running_extreme(h, ["label"], [F.col("vec_id")], "vec_id", F.struct("vec_id", "h"), "before", exclude_current=True, bucket=100_000)
    return seen.select("vec_id", F.bit_count(F.col("h").bitwiseXOR(F.col("before.h"))).alias("differing")).where("differing is not null")


@query("SELECT doc_id FROM documents ORDER BY sha256('20260831:' || doc_id), doc_id LIMIT 50")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty documents at random without replacement, by a seeded hash of the id: the same ones wherever it runs."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").orderBy(F.sha2(F.concat(F.lit("20260831:"), F.col("doc_id").cast("string")), 256), "doc_id").limit(50)
