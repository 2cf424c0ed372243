"""Queries of aligned frames over ``events``: frame tables, pairings, packs, hold-outs, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.operators import frames, seqwin, stats, temporal
from kinestream.plans.registry import query
from kinestream.plans.sequences import _S, _filter_sql, samples
from kinestream.plans.timelines import _E, HOUR, MAX_AGE, MAX_GAP, packets_of, queries_of, samples_of, stream_events


def _bracket_cte(name: str, kind: str) -> str:
    return f""", {name}s AS (SELECT stream, t, event_id AS sample_id, value FROM e WHERE event_type = '{kind}'),
{name}b AS (SELECT q.stream, q.query_id, q.t, max(struct_pack(t := s.t, sample_id := s.sample_id, value := s.value)) FILTER (WHERE s.t <= q.t) AS low,
  min(struct_pack(t := s.t, sample_id := s.sample_id, value := s.value)) FILTER (WHERE s.t >= q.t) AS high FROM q LEFT JOIN {name}s s ON s.stream = q.stream GROUP BY ALL),
{name}g AS (SELECT *, CASE WHEN low.t = t THEN 0 ELSE high.t - low.t END AS span FROM {name}b),
{name}h AS (SELECT *, coalesce(low.t = t OR span <= {MAX_GAP}, false) AS valid FROM {name}g),
{name}a AS (SELECT *, CASE WHEN valid THEN CASE WHEN span > 0 THEN (t - low.t)::DOUBLE / span ELSE 0 END END AS alpha FROM {name}h),
{name} AS (SELECT stream, query_id, low.sample_id AS {name}_low_id, high.sample_id AS {name}_high_id, span AS {name}_span, round(alpha, 9) AS {name}_alpha,
  CASE WHEN valid THEN least(t - low.t, high.t - t) END AS {name}_nearest_delta, valid AS {name}_valid,
  round(CASE WHEN valid THEN CASE WHEN low.t = t THEN low.value ELSE low.value * (1 - alpha) + high.value * alpha END END, 6) AS {name}_value FROM {name}a)
"""


@query(
    f"""WITH {_E}, q AS (SELECT stream, t, event_id AS query_id FROM e WHERE event_type = 'purchase')
{_bracket_cte("body", "click")}{_bracket_cte("glove", "view")}, f AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY t, query_id) - 1 AS frame FROM q),
c AS (SELECT b.stream, greatest(min(b.t), (SELECT min(g.t) FROM gloves g WHERE g.stream = b.stream)) AS start, least(max(b.t), (SELECT max(g.t) FROM gloves g WHERE g.stream = b.stream)) AS stop FROM bodys b
  WHERE EXISTS (SELECT 1 FROM gloves g WHERE g.stream = b.stream) GROUP BY b.stream)
SELECT f.*, body.* EXCLUDE (stream, query_id), glove.* EXCLUDE (stream, query_id), coalesce(f.t BETWEEN start AND stop, false) AS inside, coalesce(f.t BETWEEN start AND stop, false) AND body_valid AND glove_valid AS valid
FROM f JOIN body USING (stream, query_id) JOIN glove USING (stream, query_id) LEFT JOIN c ON c.stream = f.stream"""
)
def frame_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each purchase: the brackets of clicks and views at its time, and whether it is a valid output frame."""
    e = stream_events(spark, sf_dir)
    rows = frames.frame_table(queries_of(e, "purchase"), {"body": samples_of(e, "click"), "glove": samples_of(e, "view")}, MAX_GAP)
    return rows.withColumns({f"{n}_{c}": F.round(f"{n}_{c}", d) for n in ("body", "glove") for c, d in (("alpha", 9), ("value", 6))})


@query(
    f"""WITH {_E}, a AS (SELECT stream, t, event_id, row_number() OVER (PARTITION BY stream ORDER BY t, event_id) - 1 AS i, count(*) OVER (PARTITION BY stream) AS n FROM e WHERE event_type = 'click'),
b AS (SELECT stream, i, t + CASE WHEN stream % 7 = 0 THEN -2500 ELSE 1500 + event_id % 3 * 1000 END AS t FROM a UNION ALL SELECT stream, n, t + 33000 FROM a WHERE i = n - 1 AND stream % 3 = 0),
d AS (SELECT b.stream, b.i, b.t, arg_min(a.i, struct_pack(d := abs(b.t - a.t), t := a.t)) AS nearest, min(a.t) FILTER (WHERE a.i = b.i) AS own FROM b JOIN a USING (stream) GROUP BY ALL),
c AS (SELECT stream, count(own) AS n_first, count(*) AS n_second, count_if(own IS NOT NULL AND nearest = i)::BIGINT AS same_index, count_if(own IS NULL AND nearest = i - 1)::BIGINT AS tail, min(t - own) AS least, max(t - own) AS most FROM d GROUP BY stream)
SELECT *, n_second - n_first IN (0, 1) AND same_index = n_first AND tail = n_second - n_first AND least > 0 AND most < 5000 AS holds FROM c"""
)
def pairing_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and their delayed copies, some with one more at the end, some that come too early: which streams pair by index."""
    e = stream_events(spark, sf_dir).where("event_type = 'click'")
    a = temporal.numbered(e, ["stream"], [F.col("t"), F.col("event_id")], "t")
    shift = F.when(F.col("stream") % 7 == 0, -2500).otherwise(1500 + F.col("event_id") % 3 * 1000)
    last = a.groupBy("stream").agg(F.max("i").alias("i"), F.max("t").alias("t")).where("stream % 3 = 0")
    b = a.select("stream", "i", (F.col("t") + shift).alias("t")).union(last.select("stream", F.col("i") + 1, F.col("t") + 33000))
    return frames.index_pairing(a.select("stream", "i", "t"), b, 0, 5000)


def _pack_cte(name: str, kind: str) -> str:
    return f""", {name}p AS (SELECT stream, t AS acq, t + (event_id * 7919 % 86400) * 1000000 AS arrival, event_id AS packet_id, value FROM e WHERE event_type = '{kind}'),
{name}m AS (SELECT q.stream, q.query_id, q.t, max(struct_pack(acq := p.acq, packet_id := p.packet_id, value := p.value)) FILTER (WHERE p.acq IS NOT NULL) AS s FROM q LEFT JOIN {name}p p ON p.stream = q.stream AND p.arrival <= q.t GROUP BY ALL),
{name}v AS (SELECT stream, query_id, t, CASE WHEN t - s.acq BETWEEN 0 AND {MAX_AGE} THEN s END AS s FROM {name}m),
{name} AS (SELECT stream, query_id, t, s.value AS value, coalesce(t - s.acq, 0) AS age, s IS NOT NULL AND s.packet_id IS DISTINCT FROM last_value(s.packet_id IGNORE NULLS) OVER (PARTITION BY stream ORDER BY t, query_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fresh FROM {name}v)
"""


_PACK = {"glove": "view", "rgb": "click", "depth": "error"}


@query(
    f"WITH {_E}, q AS (SELECT stream, t, event_id AS query_id FROM e WHERE event_type = 'purchase')"
    + "".join(_pack_cte(n, k) for n, k in _PACK.items())
    + "SELECT glove.stream, glove.query_id, glove.t, "
    + ", ".join(f"round(CASE WHEN {n}.fresh AND glove.fresh THEN {n}.value - glove.value ELSE 0 END, 6) AS {n}, {n}.age AS {n}_age, {n}.fresh AND glove.fresh AS {n}_valid" for n in _PACK)
    + " FROM glove JOIN rgb USING (stream, query_id) JOIN depth USING (stream, query_id)"
)
def pack_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources at each purchase, as seen from the first, valid where they and the first are fresh."""
    e = stream_events(spark, sf_dir)
    rows = frames.packed({n: packets_of(e, k) for n, k in _PACK.items()}, queries_of(e, "purchase"), "glove", MAX_AGE)
    return rows.withColumns({n: F.round(n, 6) for n in _PACK})


_Q = [0.1, 0.5, 0.52, 0.9]
_FREE = "list_filter(range(base, base + 200), lambda x: NOT list_contains(out, x) AND NOT list_contains(chosen, x))[1]"


@query(
    _S
    + """, x AS (SELECT s.stream, max(s.i) + 1 AS n, coalesce(list(s.i) FILTER (WHERE s.event_type = 'error'), [])::BIGINT[] AS out FROM s GROUP BY s.stream),
c0 AS (SELECT *, []::BIGINT[] AS chosen FROM x)"""
    + "".join(f", a{k} AS (SELECT *, round_even((n - 1) * {q}, 0)::BIGINT AS base FROM c{k}), c{k + 1} AS (SELECT stream, n, out, list_append(chosen, {_FREE}) AS chosen FROM a{k})" for k, q in enumerate(_Q))
    + f" SELECT stream, (k - 1)::INT AS place, CASE WHEN chosen[k] < n THEN chosen[k] END AS frame FROM c{len(_Q)}, range(1, {len(_Q) + 1}) r(k)"
)
def holdout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four samples of each stream at fixed quantiles, none of which is an error."""
    s = samples(spark, sf_dir)
    counts = s.groupBy("stream").agg((F.max("i") + 1).alias("n"))
    return frames.quantile_holdout(counts, s.where("event_type = 'error'").select("stream", F.col("i").alias("frame")), _Q)


@query(
    _S
    + """, q AS (SELECT stream, i AS query_id, (i * 0.75 + 0.3)::DOUBLE AS counter FROM s), b AS (SELECT *, floor(counter)::BIGINT AS low, ceil(counter)::BIGINT AS high FROM q)
SELECT b.stream, b.query_id, b.counter, b.low, b.high, round(b.counter - b.low, 9) AS alpha, round(l.value * (1 - (b.counter - b.low)) + h.value * (b.counter - b.low), 5) AS value
FROM b LEFT JOIN s l ON l.stream = b.stream AND l.i = b.low LEFT JOIN s h ON h.stream = b.stream AND h.i = b.high"""
)
def counter_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values between the samples of two counters."""
    s = samples(spark, sf_dir)
    t = s.select("stream", F.col("i").alias("query_id"), (F.col("i") * 0.75 + 0.3).alias("counter"))
    return frames.counter_lookup(s, t).withColumns({"alpha": F.round("alpha", 9), "value": F.round("value", 5)})


@query(
    f"""WITH {_E}, a AS (SELECT stream, value, row_number() OVER (PARTITION BY stream ORDER BY t, event_id) - 1 AS i FROM e WHERE event_type = 'click'), b AS (SELECT stream, value, row_number() OVER (PARTITION BY stream ORDER BY t, event_id) - 1 AS i FROM e WHERE event_type = 'view'),
n AS (SELECT stream, coalesce(l = r, false) AS matches FROM (SELECT stream, count(*) AS l FROM a GROUP BY 1) FULL JOIN (SELECT stream, count(*) AS r FROM b GROUP BY 1) USING (stream))
SELECT stream, i, a.value AS image, b.value AS message, matches FROM a FULL JOIN b USING (stream, i) JOIN n USING (stream)"""
)
def positional_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click i beside view i, and whether their stream has as many of both."""
    e = stream_events(spark, sf_dir)
    sides = [temporal.numbered(e.where(F.col("event_type") == k), ["stream"], [F.col("t"), F.col("event_id")], "t").select("stream", "i", F.col("value").alias(n)) for k, n in (("click", "image"), ("view", "message"))]
    return frames.positional(*sides, ["stream"], "i")


@query(
    f"""WITH {_E}, b AS (SELECT *, lag(t) OVER (PARTITION BY stream ORDER BY t) AS before FROM e),
i AS (SELECT *, sum(CASE WHEN t - before < {2 * HOUR} THEN 0 ELSE 1 END) OVER (PARTITION BY stream ORDER BY t, event_id) AS island FROM b)
SELECT stream, min(t) AS first, max(t) AS last, count(*) AS n FROM i GROUP BY stream, island"""
)
def session_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a stream whose steps are under two hours, as session windows."""
    return frames.sessions(stream_events(spark, sf_dir), 2 * HOUR)


@query(
    _S
    + """, p AS (SELECT stream, i, t, value, event_type <> 'error' AS ok, lag(value) OVER w AS v, lag(t) OVER w AS b, lag(event_type <> 'error') OVER w AS was FROM s WINDOW w AS (PARTITION BY stream ORDER BY i))
SELECT stream, i, round((value - v) / ((t - b) / 3.6e9), 6) AS velocity FROM p WHERE ok AND was AND t > b"""
)
def velocity_valid_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change of the value by hour, between neighbouring samples that are both valid."""
    s = samples(spark, sf_dir).withColumn("x", F.struct("t", "value", (F.col("event_type") != "error").alias("ok")))
    p = seqwin.neighbours(s, "x", [-1]).withColumnRenamed("x_-1", "p").where("x.ok and p.ok and x.t > p.t")
    return p.select("stream", "i", F.round((F.col("value") - F.col("p.value")) / ((F.col("t") - F.col("p.t")) / 3.6e9), 6).alias("velocity"))


def _filter_of(weights: list[float]) -> str:
    return _filter_sql(weights, "reflect") + "SELECT stream, i, round(smooth, 9) AS smooth FROM f"


THREE, SEVEN = [0.25, 0.5, 0.25], [w / 64 for w in (1, 6, 15, 20, 15, 6, 1)]


@query(_filter_of(THREE))
def fir_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values under the three-tap binomial filter, mirrored at the ends."""
    return seqwin.filtered(samples(spark, sf_dir), THREE).select("stream", "i", F.round("smooth", 9).alias("smooth"))


@query(_filter_of(SEVEN))
def fir_seven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values under the seven-tap binomial filter, mirrored at the ends."""
    return seqwin.filtered(samples(spark, sf_dir), SEVEN).select("stream", "i", F.round("smooth", 9).alias("smooth"))


@query(_S + "SELECT s.stream, s.i, s.value, s.i % 2 = 0 AS half FROM s JOIN n USING (stream) WHERE s.i >= (last + 1) // 4 AND s.i < (last + 1) * 3 // 4")
def frame_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples from a quarter to three quarters of each stream, the end excluded, dealt into two halves that share none."""
    s = samples(spark, sf_dir)
    n = s.groupBy("stream").agg((F.max("i") + 1).alias("n"))
    kept = temporal.joined(s, n, ["stream"]).where("i >= n div 4 and i < n * 3 div 4")
    return kept.select("stream", "i", "value", (F.col("i") % 2 == 0).alias("half"))


@query(_S + ", z AS (SELECT stream, i, CASE WHEN i < stream % 4 THEN 0 ELSE value END AS v FROM s) SELECT stream, coalesce(min(i) FILTER (WHERE abs(v) > 1e-9), count(*)) AS leading_zeros FROM z GROUP BY stream")
def leading_zero_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many samples of each stream are zero before the first that isn't."""
    z = samples(spark, sf_dir).withColumn("v", F.when(F.col("i") < F.col("stream") % 4, 0.0).otherwise(F.col("value")))
    return z.groupBy("stream").agg(F.coalesce(F.min(F.when(F.abs("v") > 1e-9, F.col("i"))), F.count("*")).alias("leading_zeros"))


@query(_S + ", k AS (SELECT stream, i, t, row_number() OVER (PARTITION BY stream ORDER BY i) - 1 AS r, count(*) OVER (PARTITION BY stream) AS c FROM s WHERE event_type = 'view') SELECT stream, i, t FROM k WHERE r = c // 2")
def midpoint_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle view of each stream."""
    v = temporal.numbered(stream_events(spark, sf_dir), ["stream"], [F.col("t"), F.col("event_id")], "t").where("event_type = 'view'")
    r = temporal.numbered(v, ["stream"], [F.col("i")], "i", "r", 4096)
    c = r.groupBy("stream").agg(F.count("*").alias("c"))
    return temporal.joined(r, c, ["stream"]).where("r = c div 2").select("stream", "i", "t")


@query(
    f"""WITH {_E}, m AS (SELECT event_type, stream % 3 AS take, count(*) AS requested, count_if(value > 20)::BIGINT AS in_frame, count(CASE WHEN value > 40 THEN value END) AS local,
  count_if(abs(value - 60) <= 5 AND value > 40)::BIGINT AS within_5, count_if(abs(value - 60) <= 20 AND value > 40)::BIGINT AS within_20 FROM e GROUP BY GROUPING SETS ((event_type, take), (event_type)))
SELECT *, """
    + ", ".join(f"round(within_{b} / nullif({d}, 0)::DOUBLE, 9) AS within_{b}_of_{d}" for b in (5, 20) for d in ("requested", "in_frame", "local"))
    + " FROM m"
)
def accumulator_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of each take added up, then merged over takes; fractions are made of the merged counters."""
    rows = stream_events(spark, sf_dir).select("event_type", (F.col("stream") % 3).alias("take"), F.when(F.col("value") > 40, F.col("value") - 60).alias("res"), (F.col("value") > 20).alias("inside"))
    parts = stats.threshold_counts(rows, ["event_type", "take"], "res", "inside", (5, 20))
    merged = stats.merged(parts, ["event_type"]).withColumn("take", F.lit(None).cast("long"))
    d = stats.fractions(parts.unionByName(merged), (5, 20))
    names = [c for c in d.columns if "_of_" in c]
    return d.select(*[c for c in d.columns if c not in names], *[F.round(c, 9).alias(c) for c in names])
