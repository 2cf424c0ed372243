"""Queries of marker tracks on a grid and of skeletons on a capture's ordinals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.functions import vec
from kinestream.operators import markers, skeleton, temporal
from kinestream.plans.poses import poses
from kinestream.plans.registry import query
from kinestream.plans.timelines import stream_events
from kinestream.shared import written

# Takes are groups of streams; the sensors' events are samples in order of time, of markers that are known now and then.
TAKES, MOST_APART, MOST_GAP, EVERY = 16, 2.0, 4, 3.7
TRACKS = {"hand": ["m1", "m2"], "wrist": ["m3"]}


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = stream_events(spark, sf_dir).withColumn("take", F.col("stream") % TAKES)
    n = temporal.numbered(e, ["take"], [F.col("t"), F.col("event_id")], "t", "counter")
    at = lambda shift: F.struct((F.col("value") + shift).alias("x"), (F.col("event_id") % 100).cast("double").alias("y"), (F.col("value") * 0.5 - shift).alias("z"))
    known = {"m1": (F.col("event_id") % 5 > 1, at(0.0)), "m2": (F.col("event_id") % 3 == 0, at(0.25)), "m3": ((F.col("event_id") % 11 > 5) | (F.col("event_type") == "view"), at(1.5))}
    points = [x for m, (when, p) in known.items() for x in (F.lit(m), F.when(when, p))]
    return n.select("take", "counter", F.create_map(*points).alias("points"))


_S = f"""WITH e AS (SELECT user_id % {TAKES} AS take, event_id, event_type, value, row_number() OVER (PARTITION BY user_id % {TAKES} ORDER BY ts, event_id) - 1 AS counter FROM events),
s AS (SELECT take, counter, 'hand' AS track, CASE WHEN event_id % 5 > 1 THEN value WHEN event_id % 3 = 0 THEN value + 0.25 END AS x, CASE WHEN event_id % 5 > 1 OR event_id % 3 = 0 THEN (event_id % 100)::DOUBLE END AS y,
  CASE WHEN event_id % 5 > 1 THEN value * 0.5 WHEN event_id % 3 = 0 THEN value * 0.5 - 0.25 END AS z FROM e
  UNION ALL SELECT take, counter, 'wrist', CASE WHEN event_id % 11 > 5 OR event_type = 'view' THEN value + 1.5 END, CASE WHEN event_id % 11 > 5 OR event_type = 'view' THEN (event_id % 100)::DOUBLE END,
  CASE WHEN event_id % 11 > 5 OR event_type = 'view' THEN value * 0.5 - 1.5 END FROM e),
k AS (SELECT *, CASE WHEN x IS NOT NULL THEN struct_pack(i := counter, x := x, y := y, z := z) END AS v FROM s),
b AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY take, track ORDER BY counter ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS low,
  first_value(v IGNORE NULLS) OVER (PARTITION BY take, track ORDER BY counter ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS high FROM k),
f AS (SELECT take, counter, track, v IS NULL AND high.i - low.i - 1 <= {MOST_GAP} AS was, {", ".join(f"CASE WHEN v IS NOT NULL THEN {a} WHEN high.i - low.i - 1 <= {MOST_GAP} THEN low.{a} + (high.{a} - low.{a}) * (counter - low.i) / (high.i - low.i) END AS {a}" for a in "xyz")} FROM b),
n AS (SELECT take, max(counter) AS last FROM e GROUP BY take),
t AS (SELECT take, g AS frame, 1 + g * {EVERY}::DOUBLE AS target FROM n, range(0, 1000000) r(g) WHERE 1 + g * {EVERY}::DOUBLE <= last)
"""


@query(
    _S
    + f"""SELECT t.take, t.frame, l.track, {", ".join(f"round(CASE WHEN target = floor(target) THEN l.{a} ELSE l.{a} * (1 - (target - floor(target))) + h.{a} * (target - floor(target)) END, 6) AS {a}" for a in "xyz")},
  coalesce(l.was OR (target > floor(target) AND h.was), false) AS was_filled
FROM t JOIN f l ON l.take = t.take AND l.counter = floor(target) LEFT JOIN f h ON h.take = t.take AND h.track = l.track AND h.counter = floor(target) + 1"""
)
def marker_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks of two markers, one of them under two names, on a grid of frames: aliases, contracts, short gaps, interpolation."""
    samples = _samples(spark, sf_dir)
    last = samples.groupBy("take").agg(F.max("counter").alias("last"))
    frames = F.sequence(F.lit(0).cast("long"), F.floor((F.col("last") - 1) / EVERY))
    targets = last.where("last >= 1").select("take", F.explode(frames).alias("frame")).withColumn("target", 1 + F.col("frame") * EVERY)
    found = markers.tracks_on_grid(samples, targets, TRACKS, ["take"], MOST_APART, MOST_GAP)
    return found.select("take", "frame", "track", *[F.round(f"p.{a}", 6).alias(a) for a in "xyz"], "was_filled")


# A tree of 21 nodes for each label, channels in one of three orders; a frame's 64 numbers are its values, the root's first one moves it.
_ORDERS = ("ZXY", "XYZ", "YZX")


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = poses(spark, sf_dir).select(F.col("label").alias("skeleton")).distinct()
    n = labels.withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(20))))
    turns = F.element_at(F.array(*[F.array(*[F.lit(f"{a}rotation") for a in o]) for o in _ORDERS]), F.col("node") % 3 + 1)
    parent = F.when(F.col("node") == 0, -1).otherwise(F.try_mod(F.col("skeleton") * 7 + F.col("node") * 3, F.greatest("node", F.lit(1))))
    offset = F.array((F.col("node") * 0.01 + 0.1), F.col("skeleton") * 0.02, (F.col("node") % 4) * -0.03)
    return n.select("skeleton", "node", parent.cast("int").alias("parent"), offset.alias("offset"), F.when(F.col("node") == 0, F.concat(F.array(F.lit("Xposition")), turns)).otherwise(turns).alias("channels"))


def _motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = poses(spark, sf_dir).select(F.col("label").alias("skeleton"), "vec_id", "e")
    n = temporal.numbered(rows, ["skeleton"], [F.col("vec_id")], "vec_id", "frame", 100_000)
    return n.select("skeleton", "vec_id", "frame", F.transform("e", lambda x, i: F.when(i == 0, x.cast("double")).otherwise(x.cast("double") * 90)).alias("values"))


def _kinematics() -> str:
    """CTEs: loc (each node's own turn and shift), and w, the nodes level by level."""

    def product(a: list[list[str]], b: list[list[str]]) -> list[list[str]]:
        def cell(i: int, j: int) -> str:
            terms = [f"{a[i][k]} * {b[k][j]}" if "1" not in (a[i][k], b[k][j]) else (b[k][j] if a[i][k] == "1" else a[i][k]) for k in range(3) if "0" not in (a[i][k], b[k][j])]
            return f"({' + '.join(terms)})" if terms else "0"

        return [[cell(i, j) for j in range(3)] for i in range(3)]

    def about(axis: str, n: int) -> list[list[str]]:
        c, s, m = f"c{n}", f"s{n}", f"(-s{n})"
        return {"X": [["1", "0", "0"], ["0", c, m], ["0", s, c]], "Y": [[c, "0", s], ["0", "1", "0"], [m, "0", c]], "Z": [[c, m, "0"], [s, c, "0"], ["0", "0", "1"]]}[axis]

    turns = [product(product(about(o[0], 0), about(o[1], 1)), about(o[2], 2)) for o in _ORDERS]
    cells = ", ".join(f"CASE node % 3 {' '.join(f'WHEN {k} THEN {turns[k][i][j]}' for k in range(3))} END AS r{i}{j}" for i in range(3) for j in range(3))
    down = ", ".join(f"{' + '.join(f'w.r{i}{k} * l.r{k}{j}' for k in range(3))} AS r{i}{j}" for i in range(3) for j in range(3))
    return f"""WITH RECURSIVE a AS (SELECT vec_id, label, g::INT AS node, CASE WHEN g > 0 THEN (label * 7 + g * 3) % g ELSE -1 END AS parent, {", ".join(f"cos(radians(embedding[2 + 3 * g + {k}]::DOUBLE * 90)) AS c{k}, sin(radians(embedding[2 + 3 * g + {k}]::DOUBLE * 90)) AS s{k}" for k in range(3))},
  g * 0.01 + 0.1 + CASE WHEN g = 0 THEN embedding[1]::DOUBLE ELSE 0 END AS ox, label * 0.02 AS oy, (g % 4) * -0.03 AS oz FROM embeddings CROSS JOIN range(21) r(g)),
loc AS (SELECT vec_id, node, parent, ox::DOUBLE AS ox, oy::DOUBLE AS oy, oz::DOUBLE AS oz, {cells} FROM a),
w AS (SELECT vec_id, node, ox AS x, oy AS y, oz AS z, {", ".join(f"r{i}{j}" for i in range(3) for j in range(3))} FROM loc WHERE node = 0
  UNION ALL SELECT l.vec_id, l.node, {", ".join(f"w.{a} + w.r{i}0 * l.ox + w.r{i}1 * l.oy + w.r{i}2 * l.oz" for i, a in enumerate("xyz"))}, {down} FROM w JOIN loc l ON l.vec_id = w.vec_id AND l.parent = w.node)
"""


@query(_kinematics() + "SELECT vec_id, node, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y, round(z, 6) + 0.0 AS z FROM w")
def tree_kinematics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """World positions of all nodes of every pose, by trees that are rows of a table."""
    motion = _motion(spark, sf_dir)
    points = skeleton.world_positions(_nodes(spark, sf_dir), motion)
    rows = points.join(motion.select("skeleton", "frame", "vec_id"), ["skeleton", "frame"]).select("vec_id", F.posexplode("points").alias("node", "p"))
    return rows.select("vec_id", "node", *[(F.round(f"p.{a}", 6) + 0.0).alias(a) for a in "xyz"])


@query(
    _kinematics()
    + """, f AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS ordinal, count(*) OVER (PARTITION BY label) AS n FROM embeddings)
SELECT label AS skeleton, ordinal, vec_id, CASE WHEN ordinal > 0 THEN round(x, 6) + 0.0 END AS x, CASE WHEN ordinal > 0 THEN round(y, 6) + 0.0 END AS y, CASE WHEN ordinal > 0 THEN round(z, 6) + 0.0 END AS z
FROM f JOIN w USING (vec_id) WHERE node = 20 AND ordinal < n - 1"""
)
def skeleton_on_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last node of each frame's skeleton on the capture's rows, whose roots prove that ordinals agree; the first frame is a seed, the last has no row."""
    motion = _motion(spark, sf_dir)
    points = written(skeleton.world_positions(_nodes(spark, sf_dir), motion), "skeleton-points")
    last = motion.groupBy("skeleton").agg(F.max("frame").alias("_last"))
    root = vec.vec(0.1 + F.get("values", F.lit(0)), F.col("skeleton") * 0.02, F.lit(0.0))
    capture = motion.join(last, "skeleton").where("frame < _last").select("skeleton", F.col("frame").alias("ordinal"), "vec_id", root.alias("root"))
    found = skeleton.on_capture(points, capture, 1e-4)
    return found.select("skeleton", "ordinal", "vec_id", *[(F.round(F.get("points", F.lit(20))[a], 6) + 0.0).alias(a) for a in "xyz"])
