"""Queries of coloured depth clouds, bending chains, click sensitivity and conditioned poses, over embeddings as images, fingers and rigs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.functions import bend, vec
from kinestream.operators import cloud, conditioned, sensitivity, seqwin, stats, temporal
from kinestream.plans.poses import poses
from kinestream.plans.registrations import _HELD, _pairs
from kinestream.plans.registry import query
from kinestream.shared import written

# A frame is a depth image of 8 x 8 pixels, depth 2 + the number; the colour camera has 6 x 6, is beside it and turned a little.
DEPTH, COLOUR, NEAR, FAR = (8.0, 8.0, 3.5, 3.5), (6.0, 6.0, 2.5, 2.5), 1.6, 2.4
BESIDE = ((0.96, 0.0, 0.28, -0.35), (0.0, 1.0, 0.0, 0.1), (-0.28, 0.0, 0.96, 0.2), (0.0, 0.0, 0.0, 1.0))

_CLOUD = f"""WITH d AS (SELECT vec_id, g % 8 AS u, g // 8 AS v, 2 + embedding[g + 1]::DOUBLE AS depth FROM embeddings CROSS JOIN range(64) r(g)),
p AS (SELECT vec_id, u, v, (u - {DEPTH[2]}) / {DEPTH[0]} * depth AS x, (v - {DEPTH[3]}) / {DEPTH[1]} * depth AS y, depth AS z FROM d WHERE depth BETWEEN {NEAR} AND {FAR}),
q AS (SELECT *, {", ".join(f"{m[0]} * x + {m[1]} * y + {m[2]} * z + {m[3]} AS q{a}" for m, a in zip(BESIDE, "xyz", strict=False))} FROM p),
s AS (SELECT *, round_even({COLOUR[0]} * qx / qz + {COLOUR[2]}, 0)::BIGINT AS pixel_u, round_even({COLOUR[1]} * qy / qz + {COLOUR[3]}, 0)::BIGINT AS pixel_v FROM q WHERE qz > 0),
f AS (SELECT *, row_number() OVER (PARTITION BY vec_id, pixel_u, pixel_v ORDER BY qz, v, u) = 1 AS visible FROM s WHERE pixel_u BETWEEN 0 AND 5 AND pixel_v BETWEEN 0 AND 5)
SELECT f.vec_id, u, v, pixel_u, pixel_v, round(qz, 6) AS seen_z, visible, CASE WHEN visible THEN round_even(embedding[(pixel_v * 6 + pixel_u + 1)::INT]::DOUBLE * 1000, 0)::BIGINT END AS colour FROM f JOIN embeddings e ON e.vec_id = f.vec_id"""


@query(_CLOUD)
def coloured_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each frame's depth pixels as the colour camera sees them: pixel, depth, whether another one hides it, and the colour if not."""
    p = poses(spark, sf_dir)
    depth = p.select("vec_id", F.posexplode("e").alias("i", "d")).select("vec_id", (F.col("i") % 8).cast("long").alias("u"), F.floor(F.col("i") / 8).alias("v"), (2 + F.col("d").cast("double")).alias("depth"))
    image = p.select("vec_id", F.posexplode(F.slice("e", 1, 36)).alias("i", "c")).select("vec_id", (F.col("i") % 6).cast("long").alias("pixel_u"), F.floor(F.col("i") / 6).alias("pixel_v"), F.rint(F.col("c").cast("double") * 1000).cast("long").alias("colour"))
    points = cloud.points_of(depth, ["vec_id"], lambda u, v: vec.vec((u - DEPTH[2]) / DEPTH[0], (v - DEPTH[3]) / DEPTH[1], F.lit(1.0)), NEAR, FAR)
    seen = cloud.splatted(points, ["vec_id"], BESIDE, lambda q: vec.project(q, COLOUR), (6, 6))
    return cloud.coloured(seen, image, ["vec_id"]).select("vec_id", "u", "v", "pixel_u", "pixel_v", F.round("seen_z", 6).alias("seen_z"), "visible", "colour")


LENGTHS, NORMAL = (0.14, 0.09, 0.07), (0.2, -0.3, 1.0)


def _bend_sql() -> str:
    a, b, c = LENGTHS
    far = lambda q: f"sqrt(({a} + {b} * cos({q}) + {c} * cos({1 + bend.RATIO} * {q}))**2 + ({b} * sin({q}) + {c} * sin({1 + bend.RATIO} * {q}))**2)"
    nx, ny, nz = NORMAL
    most = repr(bend.most_bend())
    return f"""WITH RECURSIVE p AS (SELECT vec_id, {", ".join(f"embedding[{3 * 5 + k + 1}]::DOUBLE AS s{x}, embedding[{3 * 6 + k + 1}]::DOUBLE - embedding[{3 * 5 + k + 1}]::DOUBLE AS c{x}" for k, x in enumerate("xyz"))} FROM embeddings),
d AS (SELECT *, sqrt(cx**2 + cy**2 + cz**2) AS d FROM p),
h AS (SELECT vec_id, d, 0 AS i, 0.0::DOUBLE AS low, {most}::DOUBLE AS high FROM d WHERE d <= {sum(LENGTHS)} + {bend.SLACK} AND d >= {far(most)} - {bend.SLACK}
  UNION ALL SELECT vec_id, d, i + 1, CASE WHEN {far("((low + high) * 0.5)")} > d THEN (low + high) * 0.5 ELSE low END, CASE WHEN {far("((low + high) * 0.5)")} > d THEN high ELSE (low + high) * 0.5 END FROM h WHERE i < {bend.STEPS}),
q AS (SELECT vec_id, CASE WHEN d >= {sum(LENGTHS)} - {bend.SLACK} THEN 0 ELSE (low + high) * 0.5 END AS q FROM h WHERE i = {bend.STEPS}),
a AS (SELECT d.*, q, cx / d AS ax, cy / d AS ay, cz / d AS az FROM d LEFT JOIN q USING (vec_id)),
n AS (SELECT *, {nx} - (ax * {nx} + ay * {ny} + az * {nz}) * ax AS ux, {ny} - (ax * {nx} + ay * {ny} + az * {nz}) * ay AS uy, {nz} - (ax * {nx} + ay * {ny} + az * {nz}) * az AS uz FROM a),
o AS (SELECT *, (uy * az - uz * ay) / sqrt(ux**2 + uy**2 + uz**2) AS ox, (uz * ax - ux * az) / sqrt(ux**2 + uy**2 + uz**2) AS oy, (ux * ay - uy * ax) / sqrt(ux**2 + uy**2 + uz**2) AS oz,
  -atan2({b} * sin(q) + {c} * sin({1 + bend.RATIO} * q), {a} + {b} * cos(q) + {c} * cos({1 + bend.RATIO} * q)) AS f FROM n)
SELECT vec_id, round(degrees(q), 6) AS bend, {", ".join(f"round(s{x} + {a} * (cos(f) * a{x} + sin(f) * o{x}), 6) + 0.0 AS middle_{x}, round(s{x} + {a} * (cos(f) * a{x} + sin(f) * o{x}) + {b} * (cos(f + q) * a{x} + sin(f + q) * o{x}), 6) + 0.0 AS last_{x}" for x in "xyz")} FROM o"""


@query(_bend_sql())
def bent_finger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evenly bent chain of three bones between two joints of each pose; null where they are out of its reach."""
    e = F.col("e")
    d = poses(spark, sf_dir).select("vec_id", bend.bent_chain(vec.at(e, 5), vec.at(e, 6), LENGTHS, vec.vec(*[F.lit(x) for x in NORMAL])).alias("c"))
    return d.select("vec_id", F.round("c.bend", 6).alias("bend"), *[(F.round(f"c.{n}.{a}", 6) + 0.0).alias(f"{n}_{a}") for n in ("middle", "last") for a in "xyz"])


# A rig is a table seen from above: four markers' pixels, off by the frame's numbers.
TRIALS, SIGMAS, LENS, PLANE, DISTANCE, HEIGHT = 8, (0.5, 1.0, 2.0), (600.0, 610.0, 320.0, 240.0), (0.0, -0.6, -0.8), -1200.0, 30.0
MARKERS = {"lf": (330, 110), "ln": (310, 400), "sn": (470, 260), "sf": (150, 240)}


def _rig(e: Column) -> list[Column]:
    return [F.struct(*[(F.lit(float(m[k])) + 20 * F.get(e, F.lit(2 * i + k)).cast("double")).alias("uv"[k]) for k in range(2)]) for i, m in enumerate(MARKERS.values())]


def _pose_sql(name: str, source: str, keys: str) -> str:
    """CTEs up to ``name``: keys, origin o, axes x, y of the pose that ``source`` (keys, u and v of each marker) shows."""
    n, (fx, fy, cx, cy) = dict(zip("xyz", PLANE, strict=True)), LENS
    dot = lambda a, b: " + ".join(f"{a}{c} * {b}{c}" for c in "xyz")
    ndot = lambda a: " + ".join(f"({n[c]}) * {a}{c}" for c in "xyz")
    cross = lambda a, b: {"x": f"{a}y * {b}z - {a}z * {b}y", "y": f"{a}z * {b}x - {a}x * {b}z", "z": f"{a}x * {b}y - {a}y * {b}x"}
    ncross = lambda b: {"x": f"({n['y']}) * {b}z - ({n['z']}) * {b}y", "y": f"({n['z']}) * {b}x - ({n['x']}) * {b}z", "z": f"({n['x']}) * {b}y - ({n['y']}) * {b}x"}
    ray = lambda m: {"x": f"(u{m} - {cx}) / {fx}", "y": f"(v{m} - {cy}) / {fy}", "z": "1"}
    feet = ", ".join(f"{DISTANCE + HEIGHT} / ({' + '.join(f'({n[k]}) * {ray(m)[k]}' for k in 'xyz')}) * {ray(m)[c]} - ({n[c]}) * {HEIGHT} AS {m}{c}" for m in MARKERS for c in "xyz")
    unit = lambda a, b, p: ", ".join(f"({b}{c} - {a}{c}) / sqrt({' + '.join(f'({b}{k} - {a}{k})**2' for k in 'xyz')}) AS {p}{c}" for c in "xyz")
    return f"""{name}1 AS (SELECT {keys}, {feet} FROM {source}),
{name}2 AS (SELECT *, {unit("lf", "ln", "d")}, {unit("sn", "sf", "e")}, {", ".join(f"sn{c} - lf{c} AS w{c}" for c in "xyz")} FROM {name}1),
{name}3 AS (SELECT *, {dot("d", "e")} AS al, {dot("w", "d")} AS wd, {dot("w", "e")} AS we FROM {name}2),
{name}4 AS (SELECT *, {", ".join(f"(lf{c} + (wd - we * al) / (1 - al * al) * d{c} + sn{c} + (wd * al - we) / (1 - al * al) * e{c}) / 2 AS o{c}" for c in "xyz")} FROM {name}3),
{name}5 AS (SELECT *, {", ".join(f"(lf{c} + ln{c}) / 2 - o{c} AS g{c}, (sn{c} + sf{c}) / 2 - o{c} AS h{c}" for c in "xyz")} FROM {name}4),
{name}6 AS (SELECT *, {", ".join(f"g{c} - ({n[c]}) * ({ndot('g')}) AS i{c}, h{c} - ({n[c]}) * ({ndot('h')}) AS j{c}" for c in "xyz")} FROM {name}5),
{name}7 AS (SELECT *, {", ".join(f"i{c} / sqrt({dot('i', 'i')}) AS k{c}, j{c} / sqrt({dot('j', 'j')}) AS l{c}" for c in "xyz")} FROM {name}6),
{name}8 AS (SELECT *, {", ".join(f"{ncross('k')[c]} AS m{c}" for c in "xyz")} FROM {name}7),
{name}9 AS (SELECT *, {", ".join(f"{cross('m', 'l')[c]} AS q{c}" for c in "xyz")} FROM {name}8),
{name}0 AS (SELECT *, atan2({ndot("q")}, {dot("m", "l")}) / 2 AS half FROM {name}9 WHERE {dot("m", "l")} >= 0),
{name}x AS (SELECT {keys}, ox, oy, oz, {", ".join(f"k{c} * cos(half) + m{c} * sin(half) AS x{c}" for c in "xyz")} FROM {name}0),
{name} AS (SELECT *, {", ".join(f"{ncross('x')[c]} AS y{c}" for c in "xyz")} FROM {name}x)"""


def _draw_sql(first: str, which: str) -> str:
    bits = lambda at: f"((('0x' || substr({first}, {at}, 8))::BIGINT + 0.5) / 4294967296.0)"
    return f"sqrt(-2 * ln({bits(1)})) * {which}({2 * math.pi!r} * {bits(9)})"


_CLICKS = (
    "WITH r AS (SELECT vec_id, "
    + ", ".join(f"{m[k]} + 20 * embedding[{2 * i + k + 1}]::DOUBLE AS {'uv'[k]}{name}" for i, (name, m) in enumerate(MARKERS.items()) for k in range(2))
    + " FROM embeddings),\nt AS (SELECT r.*, sigma, trial, "
    + ", ".join(f"md5(concat_ws('/', 'click', vec_id, trial, '{name}')) AS h{name}" for name in MARKERS)
    + f" FROM r, (SELECT unnest([{', '.join(f'{s}::DOUBLE' for s in SIGMAS)}]) AS sigma), range({TRIALS}) b(trial)),\nc AS (SELECT vec_id, sigma, trial, "
    + ", ".join(f"{'uv'[k]}{name} + sigma * {_draw_sql(f'h{name}', ('cos', 'sin')[k])} AS {'uv'[k]}{name}" for name in MARKERS for k in range(2))
    + " FROM t),\n"
    + _pose_sql("a", "r", "vec_id")
    + ",\n"
    + _pose_sql("b", "c", "vec_id, sigma, trial")
    + """,
z AS (SELECT b.sigma, sqrt((a.ox - b.ox)**2 + (a.oy - b.oy)**2 + (a.oz - b.oz)**2) AS moved, degrees(acos(greatest(least((a.xx * b.xx + a.xy * b.xy + a.xz * b.xz + a.yx * b.yx + a.yy * b.yy + a.yz * b.yz + 1 - 1) / 2, 1), -1))) AS turned FROM a JOIN b USING (vec_id)),
y AS (SELECT sigma, 'moved' AS what, moved AS x FROM z UNION ALL SELECT sigma, 'turned', turned FROM z)
SELECT sigma, what, count(*) AS count, round(avg(x), 4) AS mean, round(quantile_cont(x, 0.5), 4) AS median, round(quantile_cont(x, 0.95), 4) AS p95, round(max(x), 4) AS max FROM y GROUP BY ALL"""
)


@query(_CLICKS)
def click_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far a table's origin moves and its axes turn if the clicks on its markers are off, by the clicks' sigma."""
    rigs = poses(spark, sf_dir).select("vec_id", *[p.alias(m) for m, p in zip(MARKERS, _rig(F.col("e")), strict=True)])
    plain = sensitivity.with_pose(rigs, list(MARKERS), "pose", PLANE, DISTANCE, HEIGHT, LENS)
    tried = sensitivity.trials(plain, TRIALS, SIGMAS)
    off = [sensitivity.clicked(F.col(m), F.col("sigma"), "click", F.col("vec_id"), F.col("trial"), m).alias(m) for m in MARKERS]
    again = sensitivity.with_pose(tried.select("sigma", "pose", *off), list(MARKERS), "clicked", PLANE, DISTANCE, HEIGHT, LENS)
    moved = again.select("sigma", sensitivity.pose_distance(F.col("pose"), F.col("clicked")).alias("d"))
    each = F.array(*[F.struct(F.lit(n).alias("what"), F.col(f"d.{n}").alias("x")) for n in ("moved", "turned")])
    long = written(moved.select("sigma", F.inline(each)), "clicks")
    found = stats.distribution(long, ["sigma", "what"], "x", {"median": 0.5, "p95": 0.95}, ("max",))
    return found.select("sigma", "what", "count", *[F.round(c, 4).alias(c) for c in ("mean", "median", "p95", "max")])


SHIFT = (0.05, -0.02, 0.1)
_SIDE = ["label", "take"]


@query(
    _HELD.split("own AS")[0]
    + f"""m AS (SELECT label, take, frame, sum(sx * tx + sy * ty) AS a, sum(sx * ty - sy * tx) AS b, sum(sz * tz) AS c, sum(sx * sx + sy * sy + sz * sz) AS e FROM p GROUP BY ALL),
k AS (SELECT label, take, frame, atan2(b, a) AS angle, (sqrt(a * a + b * b) + c) / e AS scale FROM m WHERE (sqrt(a * a + b * b) + c) / e > 0),
r AS (SELECT label, take, quantile_cont(scale, 0.5) AS retained FROM k WHERE scale BETWEEN 0.25 AND 2.5 GROUP BY ALL),
o AS (SELECT label, (vec_id % 4)::INT AS take, vec_id AS frame, g AS joint, {", ".join(f"embedding[3 * g + {i + 1}]::DOUBLE - embedding[{i + 1}]::DOUBLE AS {x}, embedding[{61 + i}]::DOUBLE + {SHIFT[i]} AS r{x}" for i, x in enumerate("xyz"))} FROM embeddings CROSS JOIN range(20) j(g))
SELECT label, take, frame, joint, round(retained * (cos(angle) * x - sin(angle) * y) + rx, 6) + 0.0 AS x, round(retained * (sin(angle) * x + cos(angle) * y) + ry, 6) + 0.0 AS y, round(retained * z + rz, 6) + 0.0 AS z
FROM o LEFT JOIN k USING (label, take, frame) LEFT JOIN r USING (label, take)"""
)
def conditioned_pose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poses turned frame by frame about one axis, with the retained scale of their take, from a root of their own."""
    fits = conditioned.frame_fits(_pairs(spark, sf_dir), _SIDE, axis=(0.0, 0.0, 1.0))
    scales = conditioned.retained_scale(fits, _SIDE)
    e = F.col("e")
    points = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda j: F.struct(*[F.get("e", 3 * j + k).cast("double").alias(a) for k, a in enumerate("xyz")]))
    local = poses(spark, sf_dir).select("label", F.pmod("vec_id", F.lit(4)).cast("int").alias("take"), F.col("vec_id").alias("frame"), points.alias("points"), vec.at(e, 20).alias("root"))
    found = conditioned.conditioned(local, fits, scales, _SIDE, offset=SHIFT).select(*_SIDE, "frame", F.posexplode_outer("points").alias("joint", "p"))
    return found.select(*_SIDE, "frame", "joint", *[(F.round(f"p.{a}", 6) + 0.0).alias(a) for a in "xyz"])


_FITS = _HELD.split("own AS")[0] + """m AS (SELECT label, take, frame, sum(sx * tx + sy * ty) AS a, sum(sx * ty - sy * tx) AS b, sum(sz * tz) AS c, sum(sx * sx + sy * sy + sz * sz) AS e FROM p GROUP BY ALL),
k AS (SELECT label, take, frame, (sqrt(a * a + b * b) + c) / e AS scale FROM m)
"""


@query(_FITS + "SELECT label, take, round(quantile_cont(scale, 0.5), 9) AS retained, round(quantile_cont(scale, 0.05), 9) AS p05, round(quantile_cont(scale, 0.95), 9) AS p95, count(*) AS samples FROM k WHERE scale BETWEEN 0.25 AND 2.5 GROUP BY ALL")
def retained_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scale that each take retains: the median of its frames' similarity scales that are within bounds, with their spread."""
    fits = conditioned.frame_fits(_pairs(spark, sf_dir), _SIDE, axis=(0.0, 0.0, 1.0))
    found = conditioned.retained_scale(fits, _SIDE)
    return found.select(*_SIDE, *[F.round(c, 9).alias(c) for c in ("retained", "p05", "p95")], "samples")


def _normal_sql(n: int) -> str:
    a, b = ([f"embedding[{3 * (n + k) + i + 1}]::DOUBLE - embedding[{3 * (n + k - 1) + i + 1}]::DOUBLE" for i in range(3)] for k in (1, 2))
    return ", ".join(f"({a[(i + 1) % 3]}) * ({b[(i + 2) % 3]}) - ({a[(i + 2) % 3]}) * ({b[(i + 1) % 3]}) AS {x}" for i, x in enumerate("xyz"))


@query(
    f"""WITH n AS (SELECT label AS stream, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, {_normal_sql(5)} FROM embeddings),
u AS (SELECT stream, i, CASE WHEN sqrt(x * x + y * y + z * z) > 1e-4 THEN [x / sqrt(x * x + y * y + z * z), y / sqrt(x * x + y * y + z * z), z / sqrt(x * x + y * y + z * z)] END AS n FROM n),
d AS (SELECT stream, i, n, lag(n) OVER (PARTITION BY stream ORDER BY i) AS b FROM u)
SELECT stream, i, CASE WHEN n IS NOT NULL AND b IS NOT NULL THEN round(degrees(acos(greatest(-1, least(1, n[1] * b[1] + n[2] * b[2] + n[3] * b[3])))), 4) END AS turned FROM d"""
)
def bend_plane_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By how many degrees the plane of a finger's bend turns from frame to frame; null for the first frame and beside one without a bend."""
    rows = poses(spark, sf_dir).select(F.col("label").alias("stream"), "vec_id", vec.unit(vec.cross(vec.sub(vec.at(F.col("e"), 6), vec.at(F.col("e"), 5)), vec.sub(vec.at(F.col("e"), 7), vec.at(F.col("e"), 6))), 1e-4).alias("normal"))
    placed = temporal.numbered(rows, ["stream"], [F.col("vec_id")], "vec_id", bucket=100_000)
    return seqwin.turned(placed, "normal").select("stream", "i", F.round("turned", 4).alias("turned"))


#: The table's plane in depth camera coordinates, and the depths that count.
TABLE, TABLE_NEAR, TABLE_FAR = (0.1, -0.5, -0.8, 1.7), 1.7, 2.5


@query(
    f"""WITH d AS (SELECT vec_id, g % 8 AS u, g // 8 AS v, 2 + embedding[g + 1]::DOUBLE AS depth FROM embeddings CROSS JOIN range(64) r(g)),
r AS (SELECT *, (u - {DEPTH[2]}) / {DEPTH[0]} AS rx, (v - {DEPTH[3]}) / {DEPTH[1]} AS ry FROM d), s AS (SELECT *, {TABLE[0]} * rx + {TABLE[1]} * ry + {TABLE[2]} AS slope FROM r),
z AS (SELECT *, CASE WHEN abs(slope) > 1e-12 AND -{TABLE[3]} / slope > 0 THEN -{TABLE[3]} / slope END AS z FROM s),
q AS (SELECT *, {", ".join(f"{m[0]} * rx * z + {m[1]} * ry * z + {m[2]} * z + {m[3]} AS q{a}" for m, a in zip(BESIDE, "xyz", strict=False))} FROM z),
p AS (SELECT *, CASE WHEN qz > 1e-6 THEN round_even({COLOUR[0]} * qx / qz + {COLOUR[2]}, 0)::BIGINT END AS pixel_u, CASE WHEN qz > 1e-6 THEN round_even({COLOUR[1]} * qy / qz + {COLOUR[3]}, 0)::BIGINT END AS pixel_v FROM q)
SELECT vec_id, count(*) AS pixels, count_if(coalesce(z BETWEEN {TABLE_NEAR} AND {TABLE_FAR} AND pixel_u BETWEEN 0 AND 5 AND pixel_v BETWEEN 0 AND 5, false))::BIGINT AS inside,
  round(avg(CASE WHEN z BETWEEN {TABLE_NEAR} AND {TABLE_FAR} AND pixel_u BETWEEN 0 AND 5 AND pixel_v BETWEEN 0 AND 5 THEN abs(depth - z) END), 6) AS off FROM p GROUP BY vec_id"""
)
def table_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pixels of each frame look at the table, as both cameras see it, and how far measured depths are from the table's."""
    p = poses(spark, sf_dir)
    pixels = p.select("vec_id", F.posexplode("e").alias("i", "d")).select("vec_id", (F.col("i") % 8).cast("long").alias("u"), F.floor(F.col("i") / 8).alias("v"), (2 + F.col("d").cast("double")).alias("depth"))
    seen = cloud.on_table(pixels, lambda u, v: vec.vec((u - DEPTH[2]) / DEPTH[0], (v - DEPTH[3]) / DEPTH[1], F.lit(1.0)), TABLE, BESIDE, lambda q: vec.project(q, COLOUR), (6, 6), TABLE_NEAR, TABLE_FAR)
    off = F.avg(F.when(F.col("inside"), F.abs(F.col("depth") - F.col("expected_z"))))
    return seen.groupBy("vec_id").agg(F.count("*").alias("pixels"), F.count_if("inside").alias("inside"), F.round(off, 6).alias("off"))
