"""Queries of models that are fitted once and applied elsewhere, and of lags between streams, over poses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.functions import vec
from kinestream.operators import holdout, motion, temporal
from kinestream.operators.seqwin import neighbours
from kinestream.plans.poses import CAMERA, WORLD, poses
from kinestream.plans.registry import query

#: Takes of a label, the one that models are fitted on, and the trimming's least bound.
TAKES, SOURCE, LEAST = 4, 0, 0.05

# A joint's target: the joint turned by 0.35 about z and scaled by 0.92, off by a fifth of the next joint.
_TURN = (0.9393727, 0.3428978)
_TARGET = [(f"0.92 * ({_TURN[0]} * s.x - {_TURN[1]} * s.y) + 0.2 * n.x", "x"), (f"0.92 * ({_TURN[1]} * s.x + {_TURN[0]} * s.y) + 0.2 * n.y", "y"), ("0.92 * s.z + 0.2 * n.z", "z")]


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda j: F.struct(j.alias("joint"), F.struct(*[F.get("e", 3 * j + 3 + k).cast("double").alias(a) for k, a in enumerate("xyz")]).alias("n"), F.struct(*[F.get("e", 3 * j + k).cast("double").alias(a) for k, a in enumerate("xyz")]).alias("s")))
    rows = poses(spark, sf_dir).select("label", F.pmod("vec_id", F.lit(TAKES)).cast("int").alias("take"), F.col("vec_id").alias("frame"), F.inline(each))
    return rows.select("label", "take", "frame", "joint", "s", F.struct(*[F.expr(x).alias(a) for x, a in _TARGET]).alias("t"))


_HELD = f"""WITH j AS (SELECT label, (vec_id % {TAKES})::INT AS take, vec_id AS frame, g AS joint, {", ".join(f"embedding[3 * g + {k + 1}]::DOUBLE AS s{a}, embedding[3 * g + {k + 4}]::DOUBLE AS n{a}" for k, a in enumerate("xyz"))} FROM embeddings CROSS JOIN range(20) r(g)),
p AS (SELECT *, {", ".join(f"{x.replace('s.', 's').replace('n.', 'n')} AS t{a}" for x, a in _TARGET)} FROM j),
own AS (SELECT * FROM p WHERE take = {SOURCE}),
m1 AS (SELECT label, sum(sx * tx + sy * ty) AS a, sum(sx * ty - sy * tx) AS b, sum(sz * tz) AS c, sum(sx * sx + sy * sy + sz * sz) AS e FROM own GROUP BY label),
f AS (SELECT label, frame, median(sqrt(((sqrt(a * a + b * b) + c) / e * (cos(atan2(b, a)) * sx - sin(atan2(b, a)) * sy) - tx)**2 + ((sqrt(a * a + b * b) + c) / e * (sin(atan2(b, a)) * sx + cos(atan2(b, a)) * sy) - ty)**2
  + ((sqrt(a * a + b * b) + c) / e * sz - tz)**2)) AS r FROM own JOIN m1 USING (label) GROUP BY ALL),
d AS (SELECT label, median(r) AS mid FROM f GROUP BY label), h AS (SELECT label, median(abs(r - mid)) AS mad FROM f JOIN d USING (label) GROUP BY label),
k AS (SELECT label, frame, r <= mid + greatest(3 * 1.4826 * mad, {LEAST}) AS near FROM f JOIN d USING (label) JOIN h USING (label)),
n AS (SELECT label, count_if(near) >= greatest(10, count(*) // 2) AS refined FROM k GROUP BY label),
u AS (SELECT label, frame, refined FROM k JOIN n USING (label) WHERE near OR NOT refined),
m2 AS (SELECT label, sum(sx * tx + sy * ty) AS a, sum(sx * ty - sy * tx) AS b, sum(sz * tz) AS c, sum(sx * sx + sy * sy + sz * sz) AS e, count(*) AS points, count(DISTINCT frame) AS frames, bool_or(refined) AS refined FROM own JOIN u USING (label, frame) GROUP BY label),
m AS (SELECT label, (sqrt(a * a + b * b) + c) / e AS scale, atan2(b, a) AS angle, points, frames, refined FROM m2),
o AS (SELECT p.label, take, frame, sqrt((scale * (cos(angle) * sx - sin(angle) * sy) - tx)**2 + (scale * (sin(angle) * sx + cos(angle) * sy) - ty)**2 + (scale * sz - tz)**2) AS r FROM p JOIN m USING (label))
"""


@query(_HELD + f", q AS (SELECT label, quantile_cont(r, 0.5) AS residual_median, quantile_cont(r, 0.95) AS residual_p95 FROM o JOIN u USING (label, frame) WHERE take = {SOURCE} GROUP BY label) SELECT label, {SOURCE} AS source_take, round(scale, 9) AS scale, round(angle, 9) AS angle, points, frames, refined, round(residual_median, 9) AS residual_median, round(residual_p95, 9) AS residual_p95 FROM m JOIN q USING (label)")
def frozen_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model of each label, fitted on its first take alone, without outlying frames."""
    models = holdout.frozen(_pairs(spark, sf_dir), ["label"], "take", SOURCE, least=LEAST)
    return models.drop("rotation").withColumns({c: F.round(c, 9) for c in ("scale", "angle", "residual_median", "residual_p95")})


@query(_HELD + f"SELECT label, take, take <> {SOURCE} AS held_out, count(*) AS requested, count(r) AS measured, round(avg(r), 9) AS mean, round(sqrt(avg(r * r)), 9) AS rmse, round(quantile_cont(r, 0.5), 9) AS median, round(quantile_cont(r, 0.95), 9) AS p95 FROM o GROUP BY ALL")
def heldout_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residuals of each label's frozen model on its own take and on those that the fit never saw."""
    pairs = _pairs(spark, sf_dir)
    models = holdout.frozen(pairs, ["label"], "take", SOURCE, least=LEAST)
    found = holdout.protocol(holdout.applied(pairs, models, ["label"], "take"), ["label"], "take")
    return found.withColumns({c: F.round(c, 9) for c in ("mean", "rmse", "median", "p95")})


#: Lags in microseconds, the gap that points are interpolated over, and by how much the two clocks differ.
LAGS, MAX_GAP, SHIFT, STEP = range(-60_000, 60_001, 5_000), 50_000, 15_000, 33_333


def _motion(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Frames with the energy of each step, and the poses that move, on a clock that is off and not even."""
    rows = poses(spark, sf_dir).select(F.col("label").alias("stream"), "vec_id", "e")
    placed = temporal.numbered(rows, ["stream"], [F.col("vec_id")], "vec_id", bucket=100_000)
    near = neighbours(placed, "e", [-1])
    apart = F.zip_with("e", "e_-1", lambda a, b: F.abs(a.cast("double") - b.cast("double")))
    energy = F.aggregate(F.slice(apart, 1, 63), F.lit(0.0), lambda s, x: s + x) / 63
    frames = near.select("stream", "i", (F.col("i") * STEP).alias("t"), energy.alias("energy"))
    jitter = F.col("vec_id") * 7919 % 5000
    body = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda j: F.struct(*[F.get("e", 3 * j + k).cast("double").alias(a) for k, a in enumerate("xyz")]))
    source = placed.select("stream", (F.col("i") * STEP + SHIFT + jitter).alias("t"), F.col("vec_id").alias("sample_id"), body.alias("value"))
    return frames, source


def _lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames, source = _motion(spark, sf_dir)
    return motion.lag_table(frames, source, LAGS, lambda p: vec.project(vec.transform(WORLD, p), CAMERA), MAX_GAP)


_LAG = f"""WITH o AS (SELECT label AS stream, vec_id, embedding AS e, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i FROM embeddings),
g AS (SELECT stream, i, i * {STEP} AS t, list_sum([abs(e[k]::DOUBLE - b[k]::DOUBLE) FOR k IN range(1, 64)]) / 63 AS energy FROM (SELECT *, lag(e) OVER (PARTITION BY stream ORDER BY i) AS b FROM o)),
s AS (SELECT stream, i * {STEP} + {SHIFT} + vec_id * 7919 % 5000 AS t, vec_id FROM o),
q AS (SELECT stream, i, g.t + l.lag AS t, l.lag FROM g CROSS JOIN (SELECT unnest(range({LAGS.start}, {LAGS.stop}, {LAGS.step})) AS lag) l),
b AS (SELECT q.stream, q.i, q.lag, q.t, max(struct_pack(t := s.t, id := vec_id)) FILTER (WHERE s.t <= q.t) AS low, min(struct_pack(t := s.t, id := vec_id)) FILTER (WHERE s.t >= q.t) AS high
  FROM q JOIN s ON s.stream = q.stream AND s.t BETWEEN q.t - 500000 AND q.t + 500000 GROUP BY ALL),
v AS (SELECT b.*, CASE WHEN low.t = t THEN 0 WHEN high.t - low.t <= {MAX_GAP} THEN (t - low.t)::DOUBLE / (high.t - low.t) END AS alpha FROM b),
p AS (SELECT v.stream, v.i, v.lag, j, {", ".join(f"x.embedding[3 * j + {k + 1}]::DOUBLE + (y.embedding[3 * j + {k + 1}]::DOUBLE - x.embedding[3 * j + {k + 1}]::DOUBLE) * alpha AS {a}" for k, a in enumerate("xyz"))}
  FROM v JOIN embeddings x ON x.vec_id = v.low.id JOIN embeddings y ON y.vec_id = coalesce(v.high.id, v.low.id) CROSS JOIN range(21) r(j) WHERE alpha IS NOT NULL),
c AS (SELECT stream, i, lag, j, {CAMERA[0]} * (-y + 0.1) / (z + 4.0) AS u, {CAMERA[1]} * (x - 0.2) / (z + 4.0) AS w, z + 4.0 > 1e-6 AS front FROM p),
d AS (SELECT n.stream, n.i, n.lag, CASE WHEN bool_and(n.front AND m.front) THEN quantile_cont(sqrt((n.u - m.u)**2 + (n.w - m.w)**2), 0.5) END AS speed FROM c n JOIN c m ON m.stream = n.stream AND m.lag = n.lag AND m.i = n.i - 1 AND m.j = n.j GROUP BY ALL),
z AS (SELECT q.stream, q.i, q.lag, CASE WHEN energy IS NOT NULL THEN speed END AS speed, CASE WHEN speed IS NOT NULL THEN energy END AS energy FROM q JOIN g USING (stream, i) LEFT JOIN d USING (stream, i, lag)),
a AS (SELECT stream, lag, CASE WHEN count(speed) OVER r = 7 THEN avg(speed) OVER r END AS speed, CASE WHEN count(speed) OVER r = 7 THEN avg(energy) OVER r END AS energy FROM z WINDOW r AS (PARTITION BY stream, lag ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
t AS (SELECT stream, lag, CASE WHEN count(speed) >= 30 THEN corr(speed, energy) END AS correlation, count(speed) AS steps FROM a GROUP BY ALL)
"""


@query(_LAG + "SELECT stream, lag, round(correlation, 6) AS correlation, steps FROM t")
def motion_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the projected speed of each label's poses agrees with the frames' energy, at each lag."""
    return _lags(spark, sf_dir).withColumn("correlation", F.round("correlation", 6))


@query(_LAG + "SELECT stream, arg_min(lag, struct_pack(c := -round(correlation, 9), lag := lag)) AS lag, round(max(correlation), 6) AS correlation, arg_min(steps, struct_pack(c := -round(correlation, 9), lag := lag)) AS steps FROM t WHERE correlation IS NOT NULL GROUP BY stream")
def motion_best_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lag at which both agree best, by label."""
    found = motion.best_lag(_lags(spark, sf_dir).withColumn("correlation", F.round("correlation", 9)))
    return found.where("lag is not null").withColumn("correlation", F.round("correlation", 6))
