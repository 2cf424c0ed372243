"""Window functions over samples in order: filters with edge rules, differences, gradients, sign continuity.

Samples have a stream, a long index ``i`` that counts from 0 without holes, and a value. Filters work
on blocks of a stream, so a long stream is many tasks.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinestream.functions.vec import clip, dot
from kinestream.operators.temporal import free_names, joined, running_extreme, running_total


def gaussian_weights(sigma: float = 1.8, radius: int = 4) -> list[float]:
    """Normalized weights of 2 * radius + 1 taps."""
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    return [w / sum(raw) for w in raw]


BINOMIAL = [w / 16 for w in (1, 4, 6, 4, 1)]


def _edge(at: Column, last: Column, edge: str) -> Column:
    """The index that stands for ``at`` outside 0 to ``last``: mirrored without repeating the edge, or the edge itself."""
    if edge == "reflect":
        return F.when(at < 0, -at).when(at > last, 2 * last - at).otherwise(at)
    return F.least(F.greatest(at, F.lit(0)), last)


def filtered(df: DataFrame, weights: list[float], edge: str = "reflect", stream: str = "stream", index: str = "i", value: str | list[str] = "value", name: str | list[str] = "smooth", block: int = 4096) -> DataFrame:
    """``df`` with the weighted sum of the 2r + 1 samples around each, by ``edge`` ('reflect' or 'edge') at the ends; of several
    values with a list of names.

    A stream of r samples or fewer, or whose indices do not count from 0 without holes and repeats, has no filter and gets null; no row is lost. Each block of indices is one group: it takes the r samples
    on both sides as copies, so no stream is one task, and the taps are ``lag`` and ``lead`` within the block.
    """
    r = len(weights) // 2
    values, names = ([x] if isinstance(x, str) else x for x in (value, name))
    last = df.groupBy(stream).agg(F.max(index).alias("_last"), F.min(index).alias("_least"), F.count("*").alias("_n")).where(f"_least = 0 and _last + 1 = _n and _n > {r}")
    own = joined(df, last.drop("_least", "_n"), [stream]).where("_last is not null")
    # Copies: a sample serves its block, the neighbouring blocks within r, and the mirrored places past the ends.
    places = [F.col(index)]
    for i in range(1, r + 1):
        if edge == "reflect":
            places += [F.when(F.col(index) == i, F.lit(-i).cast("long")), F.when(F.col("_last") - F.col(index) == i, F.col("_last") + i)]
        else:
            places += [F.when(F.col(index) == 0, F.lit(-i).cast("long")), F.when(F.col(index) == F.col("_last"), F.col("_last") + i)]
    placed = own.select(stream, F.struct(*[F.col(v).cast("double").alias(f"v{i}") for i, v in enumerate(values)]).alias("_v"), "_last", F.explode(F.array_compact(F.array(*places))).alias("_at"))
    blocks = F.sequence(*[F.floor((F.col("_at") + d) / block) for d in (-r, r)])
    spread = placed.select("*", F.explode(blocks).alias("_block"))
    w = Window.partitionBy(stream, "_block").orderBy("_at")
    seen = spread.select("*", *[F.lag(F.struct("_at", "_v"), -k).over(w).alias(f"_s{k + r}") for k in range(-r, r + 1)])
    taps = [sum((F.col(f"_s{i}._v.v{k}") * F.lit(c) for i, c in enumerate(weights)), F.lit(0.0)).alias(n) for k, n in enumerate(names)]
    # A hole beside a repeated index would pass for none by the counts above.
    whole = reduce(lambda x, y: x & y, [F.col(f"_s{i}._at") == F.col("_at") + (i - r) for i in range(2 * r + 1)])
    made = seen.where((F.floor(F.col("_at") / block) == F.col("_block")) & F.col("_at").between(0, F.col("_last")) & whole)
    out = made.select(stream, F.col("_at").alias(index), *taps)
    return joined(df, out, [stream, index])


def centered_mean(df: DataFrame, width: int = 7, **columns: str) -> DataFrame:
    """The mean of ``width`` (odd) samples around each; the end samples stand for those beyond the ends."""
    return filtered(df, [1 / width] * width, "edge", **columns)


def neighbours(df: DataFrame, column: str, offsets: list[int], stream: str = "stream", index: str = "i", block: int = 4096) -> DataFrame:
    """``df`` with ``{column}_{offset}`` for each offset: the value so many samples on (or back), null beyond the ends.

    Each block of indices is one group that takes the samples beside it as copies, so a long stream is many tasks. A row without an
    index stays and has no neighbours.
    """
    reach = max(map(abs, offsets))
    (at,) = free_names(df, "block")
    blocks = F.sequence(*[F.floor((F.col(index) + d) / block) for d in (-reach, reach)])
    spread = df.select("*", F.explode_outer(blocks).alias(at))
    w = Window.partitionBy(stream, at).orderBy(index)
    out = spread.select(*df.columns, at, *[F.when(F.col(index).isNotNull(), F.lead(column, k).over(w)).alias(f"{column}_{k}") for k in offsets])
    return out.where(F.floor(F.col(index) / block).eqNullSafe(F.col(at))).drop(at)


def third_difference(df: DataFrame, value: str = "value", name: str = "jerk", **where: str) -> DataFrame:
    """x[i] - 3 x[i-1] + 3 x[i-2] - x[i-3]; null for the first three samples."""
    n = neighbours(df, value, [-1, -2, -3], **where)
    made = F.col(value) - 3 * F.col(f"{value}_-1") + 3 * F.col(f"{value}_-2") - F.col(f"{value}_-3")
    return n.select(*df.columns, made.alias(name))


def turned(df: DataFrame, direction: str, name: str = "turned", **where: str) -> DataFrame:
    """The angle in degrees between a sample's unit vector and the one before; null for the first sample and where either is missing."""
    n = neighbours(df, direction, [-1], **where)
    cosine = dot(F.col(direction), F.col(f"{direction}_-1"))
    known = F.col(direction).isNotNull() & F.col(f"{direction}_-1").isNotNull()
    return n.select(*df.columns, F.when(known, F.degrees(F.acos(clip(cosine, -1.0, 1.0)))).alias(name))


def gradient(df: DataFrame, step: float, value: str = "value", name: str = "gradient", **where: str) -> DataFrame:
    """Central differences over ``step``, one-sided at both ends; null for a stream of one sample."""
    n = neighbours(df, value, [-1, 1], **where)
    x, before, after = F.col(value), F.col(f"{value}_-1"), F.col(f"{value}_1")
    made = F.when(before.isNull(), (after - x) / step).when(after.isNull(), (x - before) / step).otherwise((after - before) / (2 * step))
    return n.select(*df.columns, made.alias(name))


def intervals(df: DataFrame, time: str = "t", name: str = "dt", **where: str) -> DataFrame:
    """The time since the sample before; the first sample takes the interval after it."""
    n = neighbours(df, time, [-1, 1], **where)
    return n.select(*df.columns, F.coalesce(F.col(time) - F.col(f"{time}_-1"), F.col(f"{time}_1") - F.col(time)).alias(name))


def cumulative_index(df: DataFrame, time: str, period: float, stream: str = "stream", index: str = "i", name: str = "dense", block: int = 4096) -> DataFrame:
    """``df`` with the frame index that the steps of ``time`` add up to: in periods, rounded half to even, 1 at least."""
    n = neighbours(df, time, [-1], stream, index, block)
    step = F.greatest(F.lit(1.0), F.rint((F.col(time) - F.col(f"{time}_-1")) / period))
    stepped = n.select(*df.columns, F.coalesce(step.cast("long") * F.col(f"{time}_-1").isNotNull().cast("int"), F.lit(0)).cast("long").alias("_step"))
    return running_total(stepped, [stream], [F.col(index)], index, F.col("_step"), name, block).drop("_step")


def continuous_signs(df: DataFrame, dot: str, stream: str = "stream", index: str = "i", name: str = "sign", block: int = 4096) -> DataFrame:
    """The sign that keeps each quaternion on the side of the one before, as that one was turned itself.

    ``dot``: the product of a sample with the one before, null for the first. A negative product turns the sign; a missing or zero
    one starts a new chain with +1. So the sign is the parity of turns since the chain began.
    """
    new = F.coalesce((F.col(dot) == 0) | F.isnan(dot), F.lit(True))
    turned = running_total(df, [stream], [F.col(index)], index, F.coalesce(F.col(dot) < 0, F.lit(False)).cast("long"), "_turns", block)
    since = running_extreme(turned, [stream], [F.col(index)], index, F.when(new, F.struct(F.col(index).alias("i"), F.col("_turns").alias("turns"))), "_chain", bucket=block)
    return since.withColumn(name, 1 - 2 * ((F.col("_turns") - F.coalesce("_chain.turns", F.lit(0))) % 2)).drop("_turns", "_chain")


def synchronized_interval(df: DataFrame, valid: str, stream: str = "stream", index: str = "i") -> DataFrame:
    """Per stream the first and last valid index, their count, and whether no invalid one lies between."""
    a = df.where(F.col(valid)).groupBy(stream).agg(F.min(index).alias("first"), F.max(index).alias("last"), F.count("*").alias("n_valid"))
    return a.withColumn("gap_free", F.col("last") - F.col("first") + 1 == F.col("n_valid"))
