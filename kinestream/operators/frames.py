"""Tables of aligned frames: one row for each output frame with what every source has at its time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.operators.temporal import asof_each, bracket, bracket_each, interpolation, joined, numbered, running_total


def frame_table(targets: DataFrame, sources: dict[str, DataFrame], max_gap: int, stream: str = "stream") -> DataFrame:
    """One row for each target: frame (its place in its stream), and of each source its bracket's audit and interpolated value.

    targets: stream, t, query_id. sources: stream, t, sample_id, value. inside: the time lies in the interval that all sources cover, ends
    included. valid: it does, and every source's bracket is exact or narrow enough. Columns of a source begin with its name.
    """
    own = bracket_each({f"{n}_": s for n, s in sources.items()}, targets, stream)
    each = own.select(stream, "t", "query_id", *[c for n in sources for c in interpolation(f"{n}_", max_gap)])
    rows = numbered(each, [stream], [F.col("t"), F.col("query_id")], "t", "frame")
    ends = None
    for source in sources.values():
        span = source.where("t is not null").groupBy(stream).agg(F.min("t").alias("first"), F.max("t").alias("last"), F.lit(1).alias("n"))
        ends = span if ends is None else ends.union(span)
    common = ends.groupBy(stream).agg(F.max("first").alias("_start"), F.min("last").alias("_stop"), F.sum("n").alias("_n")).where(F.col("_n") == len(sources)).drop("_n")
    rows = joined(rows, common, [stream]).withColumn("inside", F.coalesce(F.col("t").between(F.col("_start"), F.col("_stop")), F.lit(False))).drop("_start", "_stop")
    return rows.withColumn("valid", reduce(lambda a, b: a & b, [F.col(f"{n}_valid") for n in sources], F.col("inside")))


def index_pairing(first: DataFrame, second: DataFrame, low: int, high: int, stream: str = "stream") -> DataFrame:
    """Per stream the proof that sample i of ``second`` belongs to sample i of ``first``.

    Both: stream, i, t. It holds if for each i the nearest first sample (the earlier of equals) is i, the second is later by more than ``low`` and less than
    ``high``, and the second has no more than one sample more, which is the last and nearest to the last first one.
    """
    counts = [d.groupBy(stream).agg(F.count("*").alias(n)) for d, n in ((first, "n_first"), (second, "n_second"))]
    near = bracket(first.select(stream, "t", F.col("i").alias("sample_id"), F.col("t").alias("value")), second.select(stream, "t", F.col("i").alias("query_id")), stream)
    left = F.col("high").isNull() | (F.coalesce(F.col("t") - F.col("low.t") <= F.col("high.t") - F.col("t"), F.lit(False)))
    picked = near.select(stream, F.col("query_id").alias("i"), "t", F.when(left, F.col("low.sample_id")).otherwise(F.col("high.sample_id")).alias("nearest"))
    own = joined(picked, first.select(stream, "i", F.col("t").alias("first_t")), [stream, "i"])
    tail = F.col("first_t").isNull()
    delta = F.col("t") - F.col("first_t")
    a = own.groupBy(stream).agg(
        F.count_if(~tail & (F.col("nearest") == F.col("i"))).alias("same_index"),
        F.count_if(tail & (F.col("nearest") == F.col("i") - 1)).alias("tail"),
        F.min(delta).alias("least"),
        F.max(delta).alias("most"),
    )
    rows = joined(joined(counts[0], counts[1], [stream]), a, [stream])
    extra = F.col("n_second") - F.col("n_first")
    holds = extra.between(0, 1) & (F.col("same_index") == F.col("n_first")) & (F.col("tail") == extra) & (F.col("least") > low) & (F.col("most") < high)
    return rows.withColumn("holds", F.coalesce(holds, F.lit(False)))


def packed(sources: dict[str, DataFrame], queries: DataFrame, root: str, max_age: int, stream: str = "stream") -> DataFrame:
    """One row for each query: of each source the value that had arrived, less the root source's own, its age, and whether it is valid.

    A value is valid if it is there and fresh, and the root's is valid, too: without the root no other place means anything. Invalid values are zero.
    """
    rows = asof_each(sources, queries, max_age, stream)
    of = lambda n: F.col(f"{n}.fresh") & F.col(f"{root}.fresh")
    made = [c for n in sources for c in (F.when(of(n), F.col(f"{n}.value") - F.col(f"{root}.value")).otherwise(0.0).alias(n), F.col(f"{n}.age").alias(f"{n}_age"), of(n).alias(f"{n}_valid"))]
    return rows.select(stream, "query_id", "t", *made)


def quantile_holdout(counts: DataFrame, excluded: DataFrame, quantiles: list[float], stream: str = "stream") -> DataFrame:
    """(stream, place, frame): the frames at the quantiles of a stream's places, each moved on past excluded and chosen ones.

    counts: stream, n. excluded: stream, frame, any number of them. A frame past the end is null: the contract is broken.

    A stream's free frames are told by their rank: the free frame of rank r is r + the number of excluded ones e_j, in order, with e_j - j <= r. So both ways between frames and ranks
    are running totals over the excluded frames and the few places that are asked for, which buckets split; only as many candidates as there are quantiles reach a stream's row.
    """
    many = len(quantiles)
    out = excluded.where("frame >= 0").select(stream, F.col("frame").cast("long").alias("frame")).distinct()
    out = numbered(out, [stream], [F.col("frame")], "frame", "j", _FRAMES)
    starts = F.array(*[F.struct(F.lit(k).alias("place"), F.rint((F.col("n") - 1) * F.lit(float(q))).cast("long").alias("at")) for k, q in enumerate(quantiles)])
    asked = counts.select(stream, "n", F.inline(starts))
    before = _counted(out.select(stream, F.col("frame").alias("at")), asked, stream, strict=True)
    ranks = before.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(many - 1)))).select(stream, "n", "place", "k", (F.col("at") - F.col("counted") + F.col("k")).alias("at"))
    placed = _counted(out.select(stream, (F.col("frame") - F.col("j")).alias("at")), ranks, stream, strict=False)
    listed = placed.groupBy(stream, "n", "place").agg(F.array_sort(F.collect_list(F.col("at") + F.col("counted"))).alias("free"))
    rows = listed.groupBy(stream, "n").agg(F.array_sort(F.collect_list(F.struct("place", "free"))).alias("_places"))

    def choose(chosen: Column, p: Column) -> Column:
        return F.concat(chosen, F.slice(F.array_except(p["free"], chosen), 1, 1))

    picks = F.aggregate("_places", F.array().cast("array<long>"), choose)
    each = rows.select(stream, "n", F.posexplode(picks).alias("place", "frame"))
    return each.select(stream, "place", F.when(F.col("frame") < F.col("n"), F.col("frame")).alias("frame"))


#: Frames of a bucket.
_FRAMES = 100_000


def _counted(marks: DataFrame, asked: DataFrame, stream: str, strict: bool) -> DataFrame:
    """``asked`` with ``counted``: how many of the stream's ``marks`` are at or, if strict, before ``at``."""
    both = marks.withColumn("kind", F.lit(1 if strict else 0)).unionByName(asked.withColumn("kind", F.lit(0 if strict else 1)), allowMissingColumns=True)
    found = running_total(both.withColumn("mark", F.col("n").isNull().cast("long")), [stream], [F.col("at"), F.col("kind")], "at", F.col("mark"), "counted", _FRAMES)
    return found.where("n is not null").select(*asked.columns, "counted")


def counter_lookup(samples: DataFrame, targets: DataFrame, stream: str = "stream") -> DataFrame:
    """Values at fractional counters, from the samples of the counters below and above.

    samples: stream, i, value. targets: stream, query_id, counter. Null where one of both counters is missing.
    """
    own = samples.select(stream, "i", "value")
    low = joined(targets.withColumns({"low": F.floor("counter"), "high": F.ceil("counter")}), own.toDF(stream, "low", "low_value"), [stream, "low"])
    both = joined(low, own.toDF(stream, "high", "high_value"), [stream, "high"])
    alpha = F.col("counter") - F.col("low")
    return both.select(stream, "query_id", "counter", "low", "high", alpha.alias("alpha"), (F.col("low_value") * (1 - alpha) + F.col("high_value") * alpha).alias("value"))


def positional(left: DataFrame, right: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Rows of both sides at one place of a group, with ``matches``: whether the group has as many rows on both sides. Nothing is dropped."""
    counts = left.groupBy(*keys).agg(F.count("*").alias("_l")).join(right.groupBy(*keys).agg(F.count("*").alias("_r")), keys, "full_outer")
    both = left.join(right, [*keys, index], "full_outer")
    return joined(both, counts.select(*keys, F.coalesce(F.col("_l") == F.col("_r"), F.lit(False)).alias("matches")), keys)


def sessions(events: DataFrame, gap: int, stream: str = "stream", time: str = "t") -> DataFrame:
    """(stream, first, last, n): runs of a stream whose steps are of ``gap`` microseconds at most. A table, not a stream of rows."""
    at = F.timestamp_micros(F.col(time))
    windows = events.where(F.col(time).isNotNull()).groupBy(stream, F.session_window(at, F.lit(f"{gap} microseconds")).alias("_w"))
    return windows.agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count("*").alias("n")).drop("_w")
