"""Queries over samples in order: filters, differences, gaps, contracts of sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.operators import contract, seqwin, stats, temporal
from kinestream.plans.registry import query
from kinestream.plans.timelines import stream_events


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stream, i (0, 1, 2 ... in time), t, value, event_type."""
    return temporal.numbered(stream_events(spark, sf_dir), ["stream"], [F.col("t"), F.col("event_id")], "t")


_S = """WITH s AS (SELECT user_id AS stream, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, epoch_us(ts) AS t, value, event_type FROM events),
n AS (SELECT stream, max(i) AS last FROM s GROUP BY stream)
"""


def _filter_sql(weights: list[float], edge: str) -> str:
    r = len(weights) // 2
    taps = ", ".join(f"({k}, {w!r}::DOUBLE)" for k, w in zip(range(-r, r + 1), weights, strict=True))
    place = "CASE WHEN s.i + k < 0 THEN -(s.i + k) WHEN s.i + k > last THEN 2 * last - (s.i + k) ELSE s.i + k END" if edge == "reflect" else "least(greatest(s.i + k, 0), last)"
    return f"""{_S}, taps(k, w) AS (VALUES {taps}),
f AS (SELECT s.stream, s.i, CASE WHEN max(last) + 1 > {r} THEN sum(w * o.value) END AS smooth
  FROM s JOIN n USING (stream) CROSS JOIN taps LEFT JOIN s o ON o.stream = s.stream AND o.i = {place} GROUP BY ALL)
"""


@query(_filter_sql(seqwin.gaussian_weights(), "reflect") + "SELECT stream, i, round(smooth, 6) AS smooth FROM f")
def fir_reflect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values under the nine-tap Gaussian filter, mirrored at the ends."""
    return seqwin.filtered(samples(spark, sf_dir), seqwin.gaussian_weights()).select("stream", "i", F.round("smooth", 6).alias("smooth"))


@query(_filter_sql([1 / 7] * 7, "edge") + "SELECT stream, i, round(smooth, 6) AS smooth FROM f")
def centered_mean_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values under the seven-sample mean, the end samples repeated."""
    return seqwin.centered_mean(samples(spark, sf_dir)).select("stream", "i", F.round("smooth", 6).alias("smooth"))


@query(_filter_sql(seqwin.BINOMIAL, "reflect") + "SELECT f.stream, count(*) AS n, round(avg(abs(value - smooth)), 9) AS mean, round(quantile_cont(abs(value - smooth), 0.95), 9) AS p95 FROM f JOIN s USING (stream, i) GROUP BY f.stream")
def hf_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stream what the binomial filter takes away."""
    r = seqwin.filtered(samples(spark, sf_dir), seqwin.BINOMIAL).withColumn("r", F.abs(F.col("value") - F.col("smooth")))
    counts = r.groupBy("stream").agg(F.count("*").alias("n"), F.round(F.avg("r"), 9).alias("mean"))
    return temporal.joined(counts, stats.split_percentiles(r, ["stream"], "r", {"p95": 0.95}), ["stream"]).withColumn("p95", F.round("p95", 9))


@query(
    _S
    + """, d AS (SELECT stream, i, value - 3 * lag(value, 1) OVER w + 3 * lag(value, 2) OVER w - lag(value, 3) OVER w AS jerk FROM s WINDOW w AS (PARTITION BY stream ORDER BY i))
SELECT stream, i, round(jerk * 27000, 4) AS jerk FROM d WHERE jerk IS NOT NULL"""
)
def jerk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third differences at 30 samples a second."""
    d = seqwin.third_difference(samples(spark, sf_dir))
    return d.where("jerk is not null").select("stream", "i", F.round(F.col("jerk") * 27000, 4).alias("jerk"))


@query(
    _S
    + """SELECT stream, i, round(CASE WHEN lag(value) OVER w IS NULL THEN (lead(value) OVER w - value) * 30 WHEN lead(value) OVER w IS NULL THEN (value - lag(value) OVER w) * 30
  ELSE (lead(value) OVER w - lag(value) OVER w) * 15 END, 5) AS gradient FROM s WINDOW w AS (PARTITION BY stream ORDER BY i)"""
)
def gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Central differences at 30 samples a second, one-sided at the ends."""
    return seqwin.gradient(samples(spark, sf_dir), 1 / 30).select("stream", "i", F.round("gradient", 5).alias("gradient"))


@query(_S + "SELECT stream, i, coalesce(t - lag(t) OVER w, lead(t) OVER w - t) AS dt FROM s WINDOW w AS (PARTITION BY stream ORDER BY i)")
def dt_repeat_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals between samples, the first one repeated."""
    return seqwin.intervals(samples(spark, sf_dir)).select("stream", "i", "dt")


@query(
    _S
    + """, d AS (SELECT stream, i, CASE WHEN lag(t) OVER w IS NULL THEN 0 ELSE greatest(1.0, round_even((t - lag(t) OVER w) / 3.6e9, 0)) END AS step FROM s WINDOW w AS (PARTITION BY stream ORDER BY i))
SELECT stream, i, (sum(step) OVER (PARTITION BY stream ORDER BY i))::BIGINT AS dense FROM d"""
)
def cumstep_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense hour index of each sample: rounded steps of at least one, added up."""
    return seqwin.cumulative_index(samples(spark, sf_dir), "t", 3.6e9).select("stream", "i", "dense")


@query(
    _S
    + """, m AS (SELECT stream, i, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM s),
b AS (SELECT m.*, max(CASE WHEN value IS NOT NULL THEN i END) OVER (PARTITION BY stream ORDER BY i) AS lo, min(CASE WHEN value IS NOT NULL THEN i END) OVER (PARTITION BY stream ORDER BY i DESC) AS hi FROM m)
SELECT b.stream, b.i, round(CASE WHEN b.value IS NULL AND hi - lo - 1 <= 2 THEN l.value + (h.value - l.value) * (b.i - lo) / (hi - lo) ELSE b.value END, 6) AS filled, coalesce(b.value IS NULL AND hi - lo - 1 <= 2, false) AS was_filled
FROM b LEFT JOIN m l ON l.stream = b.stream AND l.i = lo LEFT JOIN m h ON h.stream = b.stream AND h.i = hi"""
)
def gap_fill_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values (errors) in interior runs of one or two, filled by index."""
    m = samples(spark, sf_dir).select("stream", "i", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return temporal.gap_filled(m, 2).select("stream", "i", F.round("filled", 6).alias("filled"), F.coalesce("was_filled", F.lit(False)).alias("was_filled"))


@query(_S + "SELECT stream, min(i) AS first, max(i) AS last, count(*) AS n_valid, max(i) - min(i) + 1 = count(*) AS gap_free FROM s WHERE event_type <> 'signup' GROUP BY stream")
def sync_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stream the interval of valid samples and whether it has no hole."""
    return seqwin.synchronized_interval(samples(spark, sf_dir).withColumn("ok", F.col("event_type") != "signup"), "ok")


@query(
    _S
    + """, d AS (SELECT stream, i, value - 50 AS q, (value - 50) * lag(value - 50) OVER (PARTITION BY stream ORDER BY i) AS dot FROM s),
g AS (SELECT *, sum(CASE WHEN dot IS NULL OR dot = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY stream ORDER BY i) AS chain FROM d)
SELECT stream, i, (1 - 2 * (sum(CASE WHEN dot < 0 THEN 1 ELSE 0 END) OVER (PARTITION BY stream, chain ORDER BY i) % 2))::BIGINT AS sign FROM g"""
)
def sign_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signs that keep each sample on the side of the one before."""
    d = seqwin.neighbours(samples(spark, sf_dir).withColumn("q", F.col("value") - 50), "q", [-1])
    return seqwin.continuous_signs(d.withColumn("dot", F.col("q") * F.col("q_-1")), "dot").select("stream", "i", F.col("sign").cast("long").alias("sign"))


@query(
    _S
    + """, l AS (SELECT a.stream, k, corr(a.value, b.value) AS r, count(*) AS n FROM s a CROSS JOIN range(-3, 4) g(k) JOIN s b ON b.stream = a.stream AND b.i = a.i + k WHERE k <> 0 GROUP BY ALL HAVING count(*) >= 30)
SELECT stream, k AS lag, round(r, 6) AS r, n FROM l QUALIFY row_number() OVER (PARTITION BY stream ORDER BY round(r, 9) DESC, abs(k), k) = 1"""
)
def lag_search_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stream the lag, within three samples, at which the values correlate best with themselves."""
    s = samples(spark, sf_dir).select("stream", "i", "value")
    shifted = s.select("stream", "i", F.col("value").alias("x"), F.explode(F.array(*[F.lit(k).cast("long") for k in (-3, -2, -1, 1, 2, 3)])).alias("lag")).withColumn("at", F.col("i") + F.col("lag"))
    pairs = shifted.join(s.select("stream", F.col("i").alias("at"), F.col("value").alias("y")), ["stream", "at"])
    r = pairs.groupBy("stream", "lag").agg(F.corr("x", "y").alias("r"), F.count("*").alias("n")).where("n >= 30")
    best = stats.best(r, ["stream"], ["lag", "r", "n"], [-F.round("r", 9), F.abs("lag"), F.col("lag")])
    return best.select("stream", "lag", F.round("r", 6).alias("r"), "n")


@query(
    """SELECT conv_id, count(*) AS rows, min(turn) AS first, max(turn) AS last, count(DISTINCT turn) = count(*) AS increasing,
  count(DISTINCT turn) = count(*) AND max(turn) - min(turn) + 1 = count(*) AS contiguous, count(DISTINCT turn) = count(*) AND min(turn) = 0 AND max(turn) + 1 = count(*) AS from_zero FROM conversations GROUP BY conv_id"""
)
def contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation whether its turns increase, have no hole and begin at zero."""
    return contract.sequence_verdict(spark.read.parquet(f"{sf_dir}/conversations.parquet"), ["conv_id"], "turn")


@query(_S + ", d AS (SELECT stream, t - lag(t) OVER (PARTITION BY stream ORDER BY i) AS step FROM s) SELECT stream, count(step) AS steps, count_if(abs(step - 36e9) > 36e9)::BIGINT AS off, count_if(abs(step - 36e9) > 36e9) = 0 AS holds FROM d GROUP BY stream")
def cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stream how many steps are off ten hours by over ten hours."""
    return contract.cadence(stream_events(spark, sf_dir), ["stream"], "t", 36e9, 36e9)


@query(
    """WITH l AS (SELECT user_id AS stream, epoch_us(ts) // 3600000000 AS h FROM events WHERE event_type = 'click'), r AS (SELECT user_id AS stream, epoch_us(ts) // 3600000000 AS h FROM events WHERE event_type = 'view'),
m AS (SELECT * FROM (SELECT stream, h, count(*) AS l FROM l GROUP BY ALL) FULL JOIN (SELECT stream, h, count(*) AS r FROM r GROUP BY ALL) USING (stream, h)),
o AS (SELECT stream, coalesce(sum(l), 0)::BIGINT AS n_left, coalesce(sum(r), 0)::BIGINT AS n_right, count_if(l IS NOT NULL AND r IS NOT NULL)::BIGINT AS matched, count_if(l > 1)::BIGINT AS left_repeats, count_if(r > 1)::BIGINT AS right_repeats FROM m GROUP BY stream)
SELECT *, n_left = matched AND n_right = matched AS exact FROM o"""
)
def timecode_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stream how clicks and views match one to one by hour."""
    e = stream_events(spark, sf_dir).withColumn("h", F.floor(F.col("t") / 3_600_000_000))
    return contract.one_to_one(e.where("event_type = 'click'"), e.where("event_type = 'view'"), "h", ["stream"])


@query(
    _S
    + """, k AS (SELECT stream, last, CASE WHEN last = 0 THEN [0] ELSE list_distinct(list_transform(range(8), lambda x: round_even(x * last / 7.0, 0)::BIGINT)) END AS picks FROM n)
SELECT stream, i FROM k, unnest(picks) u(i)"""
)
def span_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight samples of each stream, evenly over its span, rounded half to even."""
    n = samples(spark, sf_dir).groupBy("stream").agg(F.max("i").alias("last"))
    picks = F.array_distinct(F.array(*[F.rint(F.lit(x) * F.col("last") / 7.0).cast("long") for x in range(8)]))
    return n.select("stream", F.explode(picks).alias("i"))


@query(_S + "SELECT s.stream, s.i, s.value FROM s JOIN n USING (stream) WHERE s.i >= 2 AND ((s.i - 2) % 10 = 0 OR s.i = last)")
def stride_keep_endpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each tenth sample from the third on, and the last."""
    s = samples(spark, sf_dir)
    n = s.groupBy("stream").agg(F.max("i").alias("last"))
    return s.join(n, "stream").where("i >= 2 and ((i - 2) % 10 = 0 or i = last)").select("stream", "i", "value")


@query(
    _S
    + """, p AS (SELECT s.stream, s.i, s.value, o.value AS other, k FROM s CROSS JOIN range(-2, 3) g(k) JOIN s o ON o.stream = s.stream AND o.i = s.i + k),
r AS (SELECT stream, k, round(avg((value - other - 1) * (value - other - 1)), 8) AS mse FROM p GROUP BY ALL)
SELECT stream, k::BIGINT AS shift, mse, row_number() OVER (PARTITION BY stream ORDER BY mse, abs(k), k) AS rank FROM r"""
)
def offset_content_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stream the shifts within two samples, ranked by how the values differ from a copy that is one lower."""
    s = samples(spark, sf_dir).select("stream", "i", "value")
    a = s.select("stream", F.col("value").alias("x"), "i", F.explode(F.array(*[F.lit(k).cast("long") for k in range(-2, 3)])).alias("shift")).withColumn("at", F.col("i") + F.col("shift"))
    p = a.join(s.select("stream", F.col("i").alias("at"), F.col("value").alias("y")), ["stream", "at"])
    r = p.groupBy("stream", "shift").agg(F.round(F.avg((F.col("x") - F.col("y") - 1) * (F.col("x") - F.col("y") - 1)), 8).alias("mse"))
    return stats.ranked(r, ["stream"], [F.col("mse"), F.abs("shift"), F.col("shift")])
