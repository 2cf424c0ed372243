"""Joins of streams on time: causal as-of, two-sided bracket, nearest, gap filling.

All of them put both sides in one table (``kind`` 0: packets, 1: queries) and read running extremes. A stream is
split into time buckets, so that a stream with a third of all rows is many tasks: within a bucket a window
runs over its rows, and what earlier buckets hand over is one value each, of which a stream has few.

No row is lost: rows without a stream are one stream, and a row without a time stays, but gives nothing and gets null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

US = 1_000_000
#: Microseconds of a bucket.
BUCKET = 86_400 * US


def joined(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the other columns of ``table``, which has each key once: a left join in which null keys are equal."""
    named = table.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *[c for c in table.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    return rows.join(named, reduce(lambda x, y: x & y, same), "left").drop(*[f"_key_{i}" for i in range(len(keys))])


def running_extreme(df: DataFrame, stream: list[str], order: list[Column], time: str, value: Column, name: str, *, back: bool = False, exclude_current: bool = False, bucket: int = BUCKET) -> DataFrame:
    """``df`` with ``name``: the greatest ``value`` over the row's stream up to the row in ``order``; back: the least one.

    ``order`` begins with ``time`` (a long), descending if back. Null values are passed over. It's exact for any bucket, which should
    hold some 100,000 rows of the densest stream at most.
    """
    return running_extremes(df, stream, order, time, {name: value}, back=back, exclude_current=exclude_current, bucket=bucket)


def running_extremes(df: DataFrame, stream: list[str], order: list[Column], time: str, values: dict[str, Column], *, back: bool = False, exclude_current: bool = False, bucket: int = BUCKET) -> DataFrame:
    """``running_extreme`` of several values by one sort: ``df`` with a column for each of ``values``."""
    best, merge = (F.min, F.least) if back else (F.max, F.greatest)
    key, *rest = free_names(df, "key", *[f"{part}_{i}" for i in range(len(values)) for part in ("value", "local", "carry", "total")])
    parts = [rest[4 * i : 4 * i + 4] for i in range(len(values))]
    timed = F.col(time).isNotNull()
    marked = df.select("*", _bucket_key(df, stream, time, bucket).alias(key), *[F.when(timed, v).alias(own) for v, (own, *_) in zip(values.values(), parts, strict=True)])
    local = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if exclude_current else 0)
    totals = marked.groupBy(key).agg(*[best(own).alias(total) for own, _, _, total in parts])
    carried = totals.select(key, *[best(total).over(_before(key, stream, back)).alias(carry) for _, _, carry, total in parts])
    rows = marked.select("*", *[best(own).over(local).alias(here) for own, here, _, _ in parts]).join(carried, key)
    return rows.select(*df.columns, *[F.when(timed, merge(here, carry)).alias(name) for name, (_, here, carry, _) in zip(values, parts, strict=True)])


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """A name for each of ``wanted`` that no column of ``df`` has: with as many underscores before it as it takes."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        name = f"_{name}"
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


#: Parts that a stream's rows without a time are spread over: they have no order, give nothing and get nothing, so no window needs them together.
_UNTIMED = 1024


def _bucket_key(df: DataFrame, stream: list[str], time: str, bucket: int) -> Column:
    """A row's stream and bucket as one struct: never null itself, and equal where both have a null at the same place, so that a plain join on it
    loses no row and needs no other partitioning than the window before it. Rows without a time are spread over parts of their own before all buckets, by their whole numbers: ids are
    among these, and other columns needn't be read for it."""
    whole = [F.col(c) for c, kind in df.dtypes if kind in ("bigint", "int", "smallint", "tinyint")]
    spread = F.pmod(F.xxhash64(F.lit(0), *whole), F.lit(_UNTIMED)) - F.lit(1 << 62)
    at = F.when(F.col(time).isNull(), spread).otherwise(F.floor(F.col(time) / bucket))
    return F.struct(*[F.col(c).alias(f"s{i}") for i, c in enumerate(stream)], at.alias("bucket"))


def _before(key: str, stream: list[str], back: bool):
    """The buckets of a stream before (back: after) the current one."""
    order = F.col(f"{key}.bucket")
    return Window.partitionBy(*[F.col(f"{key}.s{i}") for i in range(len(stream))]).orderBy(order.desc() if back else order).rowsBetween(Window.unboundedPreceding, -1)


def running_total(df: DataFrame, stream: list[str], order: list[Column], time: str, value: Column, name: str, bucket: int = BUCKET) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the row's stream up to the row in ``order``, by buckets as above."""
    key, own, here, carry, total = free_names(df, "key", "value", "local", "carry", "total")
    timed = F.col(time).isNotNull()
    marked = df.withColumn(key, _bucket_key(df, stream, time, bucket)).withColumn(own, F.when(timed, value))
    local = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = marked.groupBy(key).agg(F.sum(own).alias(total)).select(key, F.sum(total).over(_before(key, stream, False)).alias(carry))
    rows = marked.withColumn(here, F.sum(own).over(local)).join(carried, key)
    summed = F.when(timed & (F.col(here).isNotNull() | F.col(carry).isNotNull()), F.coalesce(here, F.lit(0)) + F.coalesce(carry, F.lit(0)))
    return rows.withColumn(name, summed).select(*df.columns, name)


def numbered(df: DataFrame, stream: list[str], order: list[Column], time: str, name: str = "i", bucket: int = BUCKET) -> DataFrame:
    """``df`` with each row's place in its stream, from 0."""
    (n,) = free_names(df, "n")
    counted = running_total(df, stream, order, time, F.lit(1).cast("long"), n, bucket)
    return counted.withColumn(name, F.col(n) - 1).drop(n)


def asof_causal(packets: DataFrame, queries: DataFrame, max_age: int, stream: str = "stream", bucket: int = BUCKET) -> DataFrame:
    """For each query the packet of the greatest acquisition time among those that have arrived.

    packets: stream, acq, arrival, packet_id, value. queries: stream, t, query_id. Times are longs in microseconds.
    A packet that arrives at the query's time is seen. The packet counts if 0 <= t - acq <= max_age; it is fresh if the
    stream's last query with a packet had another one. Of equal acquisitions the greatest packet_id counts.
    Returns stream, query_id, t, packet_id, value, age, fresh; packet_id, value null and age 0 where there is none.
    """
    found = asof_each({"p": packets}, queries, max_age, stream, bucket)
    return found.select(stream, "query_id", "t", "p.*")


def asof_each(sources: dict[str, DataFrame], queries: DataFrame, max_age: int, stream: str = "stream", bucket: int = BUCKET) -> DataFrame:
    """``asof_causal`` of several sources by the same two sorts: stream, query_id, t and a struct (packet_id, value, age, fresh) for each source."""
    names = list(sources)
    both = queries.select(stream, "t", "query_id").withColumn("kind", F.lit(1))
    for n, packets in sources.items():
        own = packets.select(stream, F.col("arrival").alias("t"), F.lit(0).alias("kind"), F.struct("acq", "packet_id", "value").alias(f"packet_{n}"))
        both = both.unionByName(own, allowMissingColumns=True)
    seen = running_extremes(both, [stream], [F.col("t"), F.col("kind"), F.col("query_id")], "t", {f"last_{n}": F.col(f"packet_{n}") for n in names}, bucket=bucket).where("kind = 1")

    def counts(n: str) -> Column:
        return F.when((F.col("t") - F.col(f"last_{n}.acq")).between(0, max_age), F.col(f"last_{n}")).alias(f"last_{n}")

    chosen = seen.select(stream, "query_id", "t", *map(counts, names))
    given = {f"held_{n}": F.when(F.col(f"last_{n}").isNotNull(), F.struct("t", "query_id", F.col(f"last_{n}.packet_id").alias("packet_id"))) for n in names}
    held = running_extremes(chosen, [stream], [F.col("t"), F.col("query_id")], "t", given, exclude_current=True, bucket=bucket)

    def made(n: str) -> Column:
        last = F.col(f"last_{n}")
        fresh = last.isNotNull() & ~F.col(f"last_{n}.packet_id").eqNullSafe(F.col(f"held_{n}.packet_id"))
        age = F.coalesce(F.col("t") - F.col(f"last_{n}.acq"), F.lit(0))
        return F.struct(F.col(f"last_{n}.packet_id").alias("packet_id"), F.col(f"last_{n}.value").alias("value"), age.alias("age"), fresh.alias("fresh")).alias(n)

    return held.select(stream, "query_id", "t", *map(made, names))


def bracket(source: DataFrame, targets: DataFrame, stream: str = "stream", bucket: int = BUCKET) -> DataFrame:
    """For each target the samples on both sides: low (at or before) and high (at or after), structs (t, sample_id, value).

    source: stream, t, sample_id, value. targets: stream, t, query_id. A target at a sample's time has low = high. Of samples at
    one time the greatest id is low and the least is high, so sources should have increasing times.
    """
    return bracket_each({"": source}, targets, stream, bucket)


def bracket_each(sources: dict[str, DataFrame], targets: DataFrame, stream: str = "stream", bucket: int = BUCKET) -> DataFrame:
    """``bracket`` of several sources by the same two sorts: stream, query_id, t, and low and high of each, with its name before them."""
    both = targets.select(stream, "t", "query_id").withColumn("kind", F.lit(1))
    for n, source in sources.items():
        own = source.select(stream, "t", F.lit(0).alias("kind"), F.struct("t", "sample_id", "value").alias(f"{n}sample"))
        both = both.unionByName(own, allowMissingColumns=True)
    low = running_extremes(both, [stream], [F.col("t"), F.col("kind"), F.col("query_id")], "t", {f"{n}low": F.col(f"{n}sample") for n in sources}, bucket=bucket)
    high = running_extremes(low, [stream], [F.col("t").desc(), F.col("kind"), F.col("query_id")], "t", {f"{n}high": F.col(f"{n}sample") for n in sources}, back=True, bucket=bucket)
    return high.where("kind = 1").select(stream, "query_id", "t", *[f"{n}{side}" for n in sources for side in ("low", "high")])


def interpolated(brackets: DataFrame, max_gap: int, stream: str = "stream") -> DataFrame:
    """Linear interpolation of ``bracket`` rows with an audit: alpha, span, nearest_delta, valid, value.

    An exact hit is valid whatever the gap beside it, with alpha = span = 0. Else both sides must be there and no more than
    ``max_gap`` apart. Invalid rows have null alpha and value.
    """
    return brackets.select(stream, "query_id", "t", *interpolation("", max_gap))


def interpolation(name: str, max_gap: int) -> list[Column]:
    """The columns that ``interpolated`` adds, of the source of that name of ``bracket_each``."""
    low, high, t = (lambda f: F.col(f"{name}low.{f}")), (lambda f: F.col(f"{name}high.{f}")), F.col("t")
    exact = low("t") == t
    span = F.when(exact, F.lit(0)).otherwise(high("t") - low("t"))
    valid = F.coalesce(exact | (span <= max_gap), F.lit(False))
    alpha = F.when(span > 0, (t - low("t")) / span).otherwise(0.0)
    value = F.when(exact, low("value")).otherwise(low("value") * (1 - alpha) + high("value") * alpha)
    made = {"low_id": low("sample_id"), "high_id": high("sample_id"), "span": span, "alpha": F.when(valid, alpha), "nearest_delta": F.when(valid, F.least(t - low("t"), high("t") - t)), "valid": valid, "value": F.when(valid, value)}
    return [c.alias(f"{name}{n}") for n, c in made.items()]


def nearest(brackets: DataFrame, tolerance: int | None = None, stream: str = "stream") -> DataFrame:
    """The nearest sample of ``bracket`` rows, the earlier one on a tie; null outside the source or beyond ``tolerance``."""
    inside = F.col("low").isNotNull() & F.col("high").isNotNull()
    pick = F.when(F.col("t") - F.col("low.t") <= F.col("high.t") - F.col("t"), F.col("low")).otherwise(F.col("high"))
    rows = brackets.withColumn("pick", F.when(inside, pick)).withColumn("delta", F.abs(F.col("pick.t") - F.col("t")))
    good = F.col("pick").isNotNull() if tolerance is None else F.coalesce(F.col("delta") <= tolerance, F.lit(False))
    return rows.select(stream, "query_id", "t", F.when(good, F.col("pick.sample_id")).alias("sample_id"), F.when(good, F.col("pick.value")).alias("value"), F.when(good, F.col("delta")).alias("delta"))


def clock_mapped(brackets: DataFrame, ends: DataFrame, snap: int, stream: str = "stream") -> DataFrame:
    """Map times through a clock's anchors (source t -> value): linear between anchors, never beyond them.

    A time that lies up to ``snap`` outside the first or last anchor takes that anchor's value; others outside are null.
    ``ends``: stream, first_t, first_value, last_t, last_value.
    """
    rows = joined(interpolated(brackets, 1 << 62, stream), ends, [stream])
    early = F.col("t").between(F.col("first_t") - snap, F.col("first_t"))
    late = F.col("t").between(F.col("last_t"), F.col("last_t") + snap)
    mapped = F.when(F.col("valid"), F.col("value")).when(early, F.col("first_value")).when(late, F.col("last_value"))
    return rows.select(stream, "query_id", "t", mapped.alias("mapped"))


def gap_filled(samples: DataFrame, max_gap: int, stream: str = "stream", index: str = "i", value: str = "value", bucket: int = 4096) -> DataFrame:
    """Fill interior runs of up to ``max_gap`` missing values linearly by index; longer runs and edges stay missing."""
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(index).alias("i"), F.col(value).alias("v")))
    low = running_extreme(samples, [stream], [F.col(index)], index, known, "low", bucket=bucket)
    both = running_extreme(low, [stream], [F.col(index).desc()], index, known, "high", back=True, bucket=bucket)
    run = F.col("high.i") - F.col("low.i") - 1
    inside = F.col(value).isNull() & (run <= max_gap)
    line = F.col("low.v") + (F.col("high.v") - F.col("low.v")) * (F.col(index) - F.col("low.i")) / (F.col("high.i") - F.col("low.i"))
    return both.select(*samples.columns, F.when(inside, line).otherwise(F.col(value)).alias("filled"), inside.alias("was_filled"))


def islands(samples: DataFrame, gap: int, stream: str = "stream", time: str = "t", bucket: int = BUCKET) -> DataFrame:
    """``samples`` with ``starts``: whether a new run begins, that is the stream's last sample is more than ``gap`` ago."""
    (last,) = free_names(samples, "before")
    before = running_extreme(samples, [stream], [F.col(time)], time, F.col(time), last, exclude_current=True, bucket=bucket)
    return before.withColumn("starts", F.coalesce(F.col(time) - F.col(last) > gap, F.lit(True))).drop(last)
