"""Queries that join streams on time. A user of ``events`` is a stream, the event's type its sensor."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.operators import stats, temporal
from kinestream.plans.registry import query
from kinestream.shared import tables_dir, written
from kinestream.streaming import asof, gated

HOUR = 3_600_000_000
MAX_AGE, MAX_GAP, TOLERANCE, SNAP = 48 * HOUR, 36 * HOUR, 12 * HOUR, 6 * HOUR


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stream, t (microseconds), event_id, event_type, value."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("stream"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "event_id", "event_type", "value")


def packets_of(events: DataFrame, kind: str) -> DataFrame:
    """Events as packets that arrive up to a day later, in another order."""
    delay = (F.col("event_id") * 7919 % 86400) * 1_000_000
    return events.where(F.col("event_type") == kind).select("stream", F.col("t").alias("acq"), (F.col("t") + delay).alias("arrival"), F.col("event_id").alias("packet_id"), "value")


def queries_of(events: DataFrame, kind: str) -> DataFrame:
    return events.where(F.col("event_type") == kind).select("stream", "t", F.col("event_id").alias("query_id"))


def samples_of(events: DataFrame, kind: str) -> DataFrame:
    return events.where(F.col("event_type") == kind).select("stream", "t", F.col("event_id").alias("sample_id"), "value")


_E = "e AS (SELECT user_id AS stream, epoch_us(ts) AS t, event_id, event_type, value FROM events)"
_ASOF = f"""WITH {_E},
p AS (SELECT stream, t AS acq, t + (event_id * 7919 % 86400) * 1000000 AS arrival, event_id AS packet_id, value FROM e WHERE event_type = 'view'),
q AS (SELECT stream, t, event_id AS query_id FROM e WHERE event_type = 'purchase'),
m AS (SELECT q.stream, q.query_id, q.t, max(struct_pack(acq := p.acq, packet_id := p.packet_id, value := p.value)) FILTER (WHERE p.acq IS NOT NULL) AS s
  FROM q LEFT JOIN p ON p.stream = q.stream AND p.arrival <= q.t GROUP BY ALL),
v AS (SELECT stream, query_id, t, CASE WHEN t - s.acq BETWEEN 0 AND {MAX_AGE} THEN s END AS s FROM m),
asof_rows AS (SELECT stream, query_id, t, s.packet_id AS packet_id, s.value AS value, coalesce(t - s.acq, 0) AS age,
  s IS NOT NULL AND s.packet_id IS DISTINCT FROM last_value(s.packet_id IGNORE NULLS) OVER (PARTITION BY stream ORDER BY t, query_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fresh FROM v)
"""


def _asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stream_events(spark, sf_dir)
    return temporal.asof_causal(packets_of(events, "view"), queries_of(events, "purchase"), MAX_AGE)


@query(_ASOF + "SELECT * FROM asof_rows")
def asof_causal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each purchase the latest view that had arrived."""
    return _asof(spark, sf_dir)


@query(_ASOF + "SELECT stream, count(*) AS n, count(packet_id) AS matched, count_if(fresh)::BIGINT AS fresh FROM asof_rows GROUP BY stream")
def asof_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stream how many queries have a packet, and how many a new one."""
    return _asof(spark, sf_dir).groupBy("stream").agg(F.count("*").alias("n"), F.count("packet_id").alias("matched"), F.count_if("fresh").alias("fresh"))


@query(
    _ASOF
    + """SELECT stream, count(*) AS count, round(avg(age::DOUBLE), 3) AS mean, round(quantile_cont(age::DOUBLE, 0.5), 3) AS median, round(quantile_cont(age::DOUBLE, 0.95), 3) AS p95, max(age::DOUBLE) AS max
FROM asof_rows WHERE packet_id IS NOT NULL GROUP BY stream"""
)
def asof_age_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stream the distribution of ages in microseconds of the packets that queries got."""
    ages = written(_asof(spark, sf_dir).where("packet_id is not null").select("stream", F.col("age").cast("double").alias("s")), "ages")  # read twice
    d = stats.distribution(ages, ["stream"], "s", {"median": 0.5, "p95": 0.95}, ("max",))
    return d.select("stream", "count", *[F.round(c, 3).alias(c) for c in ("mean", "median", "p95")], "max")


def _bracket_sql(source: str, target: str) -> str:
    return f"""WITH {_E},
s AS (SELECT stream, t, event_id AS sample_id, value FROM e WHERE event_type = '{source}'),
q AS (SELECT stream, t, event_id AS query_id FROM e WHERE event_type = '{target}'),
b AS (SELECT q.stream, q.query_id, q.t,
  max(struct_pack(t := s.t, sample_id := s.sample_id, value := s.value)) FILTER (WHERE s.t <= q.t) AS low,
  min(struct_pack(t := s.t, sample_id := s.sample_id, value := s.value)) FILTER (WHERE s.t >= q.t) AS high
  FROM q LEFT JOIN s ON s.stream = q.stream GROUP BY ALL)
"""


def _bracket(spark: SparkSession, sf_dir: str, source: str = "click", target: str = "error") -> DataFrame:
    events = stream_events(spark, sf_dir)
    return temporal.bracket(samples_of(events, source), queries_of(events, target))


@query(
    _bracket_sql("click", "error")
    + f""", g AS (SELECT *, CASE WHEN low.t = t THEN 0 ELSE high.t - low.t END AS span FROM b),
h AS (SELECT *, coalesce(low.t = t OR span <= {MAX_GAP}, false) AS valid FROM g),
a AS (SELECT *, CASE WHEN valid THEN CASE WHEN span > 0 THEN (t - low.t)::DOUBLE / span ELSE 0 END END AS alpha FROM h)
SELECT stream, query_id, t, low.sample_id AS low_id, high.sample_id AS high_id, span, round(alpha, 9) AS alpha, CASE WHEN valid THEN least(t - low.t, high.t - t) END AS nearest_delta, valid,
  round(CASE WHEN valid THEN CASE WHEN low.t = t THEN low.value ELSE low.value * (1 - alpha) + high.value * alpha END END, 6) AS value FROM a"""
)
def bracket_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks' values interpolated at errors, with the audit of each bracket."""
    rows = temporal.interpolated(_bracket(spark, sf_dir), MAX_GAP)
    return rows.withColumn("alpha", F.round("alpha", 9)).withColumn("value", F.round("value", 6))


_NEAREST = """, n AS (SELECT stream, query_id, t, CASE WHEN low IS NOT NULL AND high IS NOT NULL THEN CASE WHEN t - low.t <= high.t - t THEN low ELSE high END END AS pick FROM b)
"""


@query(_bracket_sql("click", "error") + _NEAREST + "SELECT stream, query_id, t, pick.sample_id AS sample_id, pick.value AS value, abs(pick.t - t) AS delta FROM n")
def nearest_earlier_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest click of each error that lies between clicks."""
    return temporal.nearest(_bracket(spark, sf_dir))


@query(_bracket_sql("view", "signup") + _NEAREST + f"SELECT stream, query_id, t, pick.sample_id AS sample_id, pick.value AS value, abs(pick.t - t) AS delta FROM n WHERE abs(pick.t - t) <= {TOLERANCE}")
def nearest_within_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest view of each signup, if it is near enough."""
    return temporal.nearest(_bracket(spark, sf_dir, "view", "signup"), TOLERANCE).where("sample_id is not null")


@query(
    _bracket_sql("signup", "view")
    + f""", ends AS (SELECT stream, min(t) AS first_t, arg_min(value, t) AS first_value, max(t) AS last_t, arg_max(value, t) AS last_value FROM s GROUP BY stream)
SELECT b.stream, query_id, b.t, round(CASE WHEN low.t = b.t THEN low.value
  WHEN low IS NOT NULL AND high IS NOT NULL THEN low.value * (1 - (b.t - low.t)::DOUBLE / (high.t - low.t)) + high.value * ((b.t - low.t)::DOUBLE / (high.t - low.t))
  WHEN b.t BETWEEN first_t - {SNAP} AND first_t THEN first_value WHEN b.t BETWEEN last_t AND last_t + {SNAP} THEN last_value END, 6) AS mapped
FROM b LEFT JOIN ends USING (stream)"""
)
def clock_map_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views' times through the anchors that signups are, snapped to the ends and never beyond."""
    events = stream_events(spark, sf_dir)
    s = samples_of(events, "signup")
    ends = s.groupBy("stream").agg(F.min("t").alias("first_t"), F.min_by("value", "t").alias("first_value"), F.max("t").alias("last_t"), F.max_by("value", "t").alias("last_value"))
    rows = temporal.clock_mapped(temporal.bracket(s, queries_of(events, "view")), ends, SNAP)
    return rows.withColumn("mapped", F.round("mapped", 6))


@query(
    f"""WITH {_E}, b AS (SELECT *, lag(t) OVER (PARTITION BY stream ORDER BY t) AS before FROM e),
i AS (SELECT *, sum(CASE WHEN t - before <= {6 * HOUR} THEN 0 ELSE 1 END) OVER (PARTITION BY stream ORDER BY t, event_id) AS island FROM b)
SELECT stream, island::BIGINT AS island, count(*) AS n, min(t) AS first, max(t) AS last FROM i GROUP BY ALL"""
)
def islands_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of events of a stream without a gap of over six hours."""
    marked = temporal.islands(stream_events(spark, sf_dir), 6 * HOUR)
    numbered = temporal.running_total(marked, ["stream"], [F.col("t"), F.col("event_id")], "t", F.col("starts").cast("long"), "island")
    return numbered.groupBy("stream", "island").agg(F.count("*").alias("n"), F.min("t").alias("first"), F.max("t").alias("last"))


@query(
    f"""WITH {_E}, r AS (SELECT stream, (t - min(t) OVER (PARTITION BY stream)) / 1e6 AS x, (t - min(t) OVER (PARTITION BY stream)) / 1e6 * 1.0000217 + (event_id * 31 % 1000) / 1e3 AS y FROM e)
SELECT stream, round(regr_slope(y, x), 9) AS slope, round(regr_intercept(y, x), 5) AS intercept, count(*) AS n FROM r GROUP BY stream"""
)
def clock_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drift of a second clock against the stream's: a least-squares line per stream over times from its first."""
    events = stream_events(spark, sf_dir)
    first = events.groupBy("stream").agg(F.min("t").alias("t0"))
    r = events.join(first, "stream").select("stream", ((F.col("t") - F.col("t0")) / 1e6).alias("x"), "event_id")
    r = r.withColumn("y", F.col("x") * 1.0000217 + (F.col("event_id") * 31 % 1000) / 1e3)
    return r.groupBy("stream").agg(F.round(F.regr_slope("y", "x"), 9).alias("slope"), F.round(F.regr_intercept("y", "x"), 5).alias("intercept"), F.count("*").alias("n"))


@query(
    f"""WITH {_E}, r AS (SELECT *, t - min(t) OVER (PARTITION BY stream) AS since FROM e)
SELECT event_type, count(*) AS n, count_if(since >= {48 * HOUR} AND since < {120 * HOUR}) ::BIGINT AS masked, round(sum(CASE WHEN since >= {48 * HOUR} AND since < {120 * HOUR} THEN 0 ELSE value END), 4) AS value FROM r GROUP BY event_type"""
)
def outage_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with a half-open outage from the third to the fifth day of each stream taken out, by sensor."""
    events = stream_events(spark, sf_dir)
    since = F.col("t") - F.col("t0")
    r = events.join(events.groupBy("stream").agg(F.min("t").alias("t0")), "stream").withColumn("out", (since >= 48 * HOUR) & (since < 120 * HOUR))
    return r.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if("out").alias("masked"), F.round(F.sum(F.when(F.col("out"), 0.0).otherwise(F.col("value"))), 4).alias("value"))


#: Slices at least, and rows of one at most that come to one call of the operator, about.
SLICES, SLICE_ROWS = 4, 250_000


def _slice_of(time: str, cuts: list[int]) -> Column:
    """The number of a row's slice: how many cuts are before its time, 0 without one."""

    @F.pandas_udf("int")
    def at(t: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts, dtype=np.int64), t.to_numpy(), side="left").astype(np.int32))

    return F.when(F.col(time).isNull(), 0).otherwise(at(F.coalesce(F.col(time), F.lit(0))))


def _cuts(rows: DataFrame, time: str, slices: int | None, part: Column | None) -> list[int]:
    """The last times of all slices but the last one, equal numbers of rows apart. With parts, of slices that are as long as the rows of each part and a share of ``SLICES`` allow."""

    def apart(n: int) -> list[int]:
        return sorted(set(rows.agg(F.percentile_approx(time, [k / n for k in range(1, n)], 100 * n)).first()[0] or [])) if n > 1 else []

    if slices:
        return apart(slices)
    total = rows.count()
    if part is None:
        return apart(max(SLICES, -(-total // SLICE_ROWS)))
    bounds = apart(max(SLICES, -(-4 * total // SLICE_ROWS)))
    found: dict[int, dict] = {}
    for at, of, n in rows.groupBy(_slice_of(time, bounds).alias("at"), part.alias("part")).count().collect():
        found.setdefault(at, {})[of] = n
    cuts, held, size = [], Counter(), 0
    for at in range(len(bounds) + 1):
        here = found.get(at, {})
        more = sum(here.values())
        if size and (size + more > total / SLICES or any(held[k] + n > SLICE_ROWS for k, n in here.items())):
            cuts.append(bounds[at - 1])
            held, size = Counter(), 0
        held.update(here)
        size += more
    return cuts


def streamed(rows: DataFrame, time: str, made: Callable[[DataFrame], DataFrame], name: str, slices: int | None = None, part: Column | None = None) -> DataFrame:
    """What a streaming operator gives for rows that come in ``slices`` batches in the order of ``time``, as a table in the shared folder.

    Each batch is a run of its own that goes on from the state that the last one left in its checkpoint, as after a restart. So a
    micro-batch is bounded by the slice, and results show whether the operator's state is whole. ``rows`` are worked out once and dealt out to their slices once;
    there are as many slices as their number asks for, or as the rows of the fullest ``part`` do, by which the operator is called. ``time`` is a whole number.
    """
    spark, out = rows.sparkSession, f"{tables_dir(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    whole = written(rows, f"{name}-rows")
    cuts, column = _cuts(whole, time, slices, part), f"slice{uuid.uuid4().hex}"
    whole.withColumn(column, _slice_of(time, cuts)).write.partitionBy(column).parquet(f"{out}/slices")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(out).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{out}/source"))
    for k in range(len(cuts) + 1):
        # A slice's files move to where the stream looks; nothing is read for it but these.
        if files.exists(path(f"{out}/slices/{column}={k}")):
            files.rename(path(f"{out}/slices/{column}={k}"), path(f"{out}/source/{k}"))
        else:
            whole.limit(0).write.parquet(f"{out}/source/{k}")
        stream = made(spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{out}/source"))
        stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


@query(_ASOF + "SELECT * FROM asof_rows")
def asof_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``asof_causal`` as a stateful stream."""
    base = stream_events(spark, sf_dir).withColumnRenamed("t", "acq")
    is_packet = F.col("event_type") == "view"
    delay = (F.col("event_id") * 7919 % 86400) * 1_000_000
    rows = base.where(F.col("event_type").isin("view", "purchase")).select(
        "stream",
        F.when(is_packet, 0).otherwise(1).alias("kind"),
        F.when(is_packet, F.col("acq") + delay).otherwise(F.col("acq")).alias("t"),
        "acq",
        F.when(is_packet, F.col("event_id")).alias("packet_id"),
        "value",
        F.when(~is_packet, F.col("event_id")).alias("query_id"),
    )
    return streamed(rows, "t", lambda r: asof.asof_stream(r, MAX_AGE), "asof-stream", part=asof.part_of())


_FILTER = """WITH RECURSIVE s AS (SELECT user_id AS stream, epoch_us(ts) AS t, CASE WHEN event_type <> 'error' THEN value END AS value, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events),
f AS (SELECT stream, i, t, value AS estimate, CASE WHEN value IS NOT NULL THEN 400.0::DOUBLE END AS variance FROM s WHERE i = 1
  UNION ALL SELECT n.stream, n.i, n.t, CASE WHEN n.estimate IS NULL THEN n.value WHEN n.value IS NULL THEN n.estimate ELSE n.estimate + n.p / (n.p + 400) * (n.value - n.estimate) END,
    CASE WHEN n.estimate IS NULL THEN CASE WHEN n.value IS NOT NULL THEN 400.0::DOUBLE END WHEN n.value IS NULL THEN n.p ELSE 400 * n.p / (n.p + 400) END
  FROM (SELECT s.stream, s.i, s.t, s.value, f.estimate, f.variance + 0.0025 * (s.t - f.t) / 1e6 AS p FROM f JOIN s ON s.stream = f.stream AND s.i = f.i + 1) n)
"""


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream_events(spark, sf_dir).select("stream", "t", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return streamed(rows, "t", lambda r: asof.diagonal_filter(r, 20.0, 0.05), "filter-stream", part=asof.part_of())


@query(_FILTER + "SELECT stream, t, round(estimate, 6) AS estimate, round(variance, 6) AS variance FROM f")
def filter_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scalar filter of each stream's values; errors are outages that hold the state."""
    return _filtered(spark, sf_dir).withColumns({c: F.round(c, 6) for c in ("estimate", "variance")})


@query(
    _FILTER
    + """, l AS (SELECT stream, max(t) AS t, arg_max(estimate, i) AS estimate, arg_max(variance, i) AS variance FROM f GROUP BY stream)
SELECT stream, t + hours * 3600000000 AS t, hours::BIGINT AS hours, round(estimate, 6) AS estimate, round(variance + 0.0025 * hours * 3600, 6) AS variance FROM l, (VALUES (1), (6), (24)) h(hours)"""
)
def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stream's state carried on without input over three horizons."""
    state = _filtered(spark, sf_dir).groupBy("stream").agg(F.max("t").alias("t"), F.max_by(F.struct("estimate", "variance"), "t").alias("s"))
    ahead = asof.free_run(state.select("stream", "t", "s.*"), [h * HOUR for h in (1, 6, 24)], 0.05)
    return ahead.select("stream", "t", (F.col("ahead") / HOUR).cast("long").alias("hours"), F.round("estimate", 6).alias("estimate"), F.round("variance", 6).alias("variance"))


TUNING = gated.Tuning(noise=20.0, drift=0.05, gate=3.0, rate=2e-6, bound=8.0, gap=30 * HOUR)


def _gated_sql() -> str:
    k = TUNING
    z, grown = "(s.value - f.bias)", f"f.variance + {k.drift**2!r} * (s.t - f.t) / 1e6"
    return f"""WITH RECURSIVE s AS (SELECT user_id AS stream, epoch_us(ts) AS t, CASE WHEN event_type <> 'error' THEN CASE WHEN event_id % 97 = 0 THEN value + 300 ELSE value END END AS value, CASE WHEN event_type = 'purchase' THEN value - 5 END AS anchor,
  row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events),
f AS (SELECT stream, i, t, value AS estimate, CASE WHEN value IS NOT NULL THEN {k.noise**2}::DOUBLE END AS variance, 0.0::DOUBLE AS bias, value IS NOT NULL AS accepted FROM s WHERE i = 1
  UNION ALL SELECT stream, i, t,
    CASE WHEN value IS NULL THEN x WHEN x IS NULL THEN z WHEN good THEN x + p / (p + {k.noise**2}) * (z - x) ELSE x END, CASE WHEN value IS NULL THEN p WHEN x IS NULL THEN {k.noise**2} WHEN good THEN p * {k.noise**2} / (p + {k.noise**2}) ELSE p END,
    CASE WHEN value IS NOT NULL AND anchor IS NOT NULL THEN greatest(-{k.bound}, least({k.bound}, bias + least(1.0, {k.rate!r} * seconds) * (value - anchor - bias))) ELSE bias END, coalesce(value IS NOT NULL AND (x IS NULL OR good), false)
  FROM (SELECT *, abs(z - x) <= {k.gate} * sqrt(p + {k.noise**2}) AS good FROM (SELECT s.stream, s.i, s.t, s.value, s.anchor, f.estimate AS x, {grown} AS p, f.bias, {z} AS z, (s.t - f.t) / 1e6 AS seconds FROM f JOIN s ON s.stream = f.stream AND s.i = f.i + 1))),
n AS (SELECT *, lead(t) OVER (PARTITION BY stream ORDER BY i) AS next, (SELECT max(t) FROM s) AS latest FROM f)
SELECT stream, t, round(estimate, 6) AS estimate, round(variance, 6) AS variance, round(bias, 6) AS bias, accepted, false AS forecast FROM f
UNION ALL SELECT stream, t + {k.gap}, round(estimate, 6), round(variance + {k.drift**2!r} * {k.gap} / 1e6, 6), round(bias, 6), false, true FROM n WHERE estimate IS NOT NULL AND coalesce(next, latest) - t > {k.gap}"""


@query(_gated_sql())
def gated_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter with a gate for outliers, a slow bias that only anchors move, and forecasts out of gaps, as a stream with timers."""
    kind = F.col("event_type")
    value = F.when(kind != "error", F.when(F.col("event_id") % 97 == 0, F.col("value") + 300).otherwise(F.col("value")))
    rows = stream_events(spark, sf_dir).select("stream", "t", value.alias("value"), F.when(kind == "purchase", F.col("value") - 5).alias("anchor"))
    with gated.timers(spark):
        found = streamed(rows, "t", lambda r: gated.gated_filter(r, TUNING), "gated-stream", part=asof.part_of())
    return found.withColumns({c: F.round(c, 6) for c in ("estimate", "variance", "bias")})
