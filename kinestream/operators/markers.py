"""Marker tracks: aliases of one marker, short gaps, and values on a grid of other times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.functions import vec
from kinestream.operators import temporal
from kinestream.operators.contract import enforce
from kinestream.operators.seqwin import neighbours

#: Samples of a block of a track.
BLOCK = 4096


def logical(samples: DataFrame, tracks: dict[str, list[str]], keys: list[str]) -> DataFrame:
    """keys, counter, track, p, apart: the first known of each track's aliases, and how far the others that are known lie from it at most.

    samples: keys, counter, points (a map from marker to struct x, y, z). A point with a coordinate missing isn't known.
    """

    def one(track: str, aliases: list[str]) -> Column:
        points = [F.try_element_at("points", F.lit(a)) for a in aliases]
        known = F.filter(F.array(*points), lambda p: p.isNotNull() & p["x"].isNotNull() & p["y"].isNotNull() & p["z"].isNotNull())
        return vec.let(known, lambda k: F.struct(F.lit(track).alias("track"), F.get(k, F.lit(0)).alias("p"), F.array_max(F.transform(k, lambda q: vec.norm(vec.sub(q, F.get(k, F.lit(0)))))).alias("apart")))

    return samples.select(*keys, "counter", F.inline(F.array(*[one(t, a) for t, a in tracks.items()])))


def failures(tracked: DataFrame, targets: DataFrame, keys: list[str], most: float) -> DataFrame:
    """keys, rule and detail of what keeps a take's tracks from a grid: diverging aliases, counters with holes or repeats, targets outside of them.

    Only counters around the targets count: from one before the first to one after the last. A take without targets has no failures.
    """
    needed = targets.groupBy(*keys).agg((F.floor(F.min("target")) - 1).alias("_first"), (F.ceil(F.max("target")) + 1).alias("_last"), F.min("target").alias("_low"), F.max("target").alias("_high"))
    near = temporal.joined(tracked, needed, keys).where(F.col("counter").between(F.col("_first"), F.col("_last")))
    apart = near.where(F.col("apart") > most).groupBy(*keys).agg(F.min_by(F.concat_ws(" ", "track", F.col("counter").cast("string")), F.struct("counter", "track")).alias("detail"))
    counted = near.groupBy(*keys).agg(F.countDistinct("counter").alias("n"), F.min("counter").alias("a"), F.max("counter").alias("b"), F.count("*").alias("rows"), F.countDistinct("track").alias("tracks"))
    seen = temporal.joined(needed, counted, keys)
    holes = (F.col("b") - F.col("a") + 1 != F.col("n")) | (F.col("rows") != F.col("n") * F.col("tracks"))
    outside = F.col("n").isNull() | (F.floor("_low") < F.col("a")) | (F.ceil("_high") > F.col("b"))
    rows = [
        apart.select(*keys, F.lit("aliases diverge").alias("rule"), "detail"),
        seen.where(holes).select(*keys, F.lit("counters aren't contiguous").alias("rule"), F.concat_ws(" ", *[F.col(c).cast("string") for c in ("a", "b", "n")]).alias("detail")),
        seen.where(outside).select(*keys, F.lit("targets are outside").alias("rule"), F.concat_ws(" ", *[F.col(c).cast("string") for c in ("_low", "_high")]).alias("detail")),
    ]
    return rows[0].union(rows[1]).union(rows[2])


def filled(tracked: DataFrame, keys: list[str], most: int = 4, block: int = BLOCK) -> DataFrame:
    """``tracked`` with ``p`` filled linearly over interior runs of up to ``most`` unknown samples, and was_filled; longer runs and edges stay unknown."""
    stream = [*keys, "track"]
    known = F.when(F.col("p").isNotNull(), F.struct(F.col("counter").alias("i"), F.col("p").alias("p")))
    low = temporal.running_extreme(tracked, stream, [F.col("counter")], "counter", known, "low", bucket=block)
    both = temporal.running_extreme(low, stream, [F.col("counter").desc()], "counter", known, "high", back=True, bucket=block)
    inside = F.col("p").isNull() & (F.col("high.i") - F.col("low.i") - 1 <= most)
    share = (F.col("counter") - F.col("low.i")) / (F.col("high.i") - F.col("low.i"))
    line = vec.add(vec.scale(F.col("low.p"), 1 - share), vec.scale(F.col("high.p"), share))
    return both.select(*[c for c in tracked.columns if c != "p"], F.when(inside, line).otherwise(F.col("p")).alias("p"), F.coalesce(inside, F.lit(False)).alias("was_filled"))


def grid(samples: DataFrame, targets: DataFrame, keys: list[str], most: int = 4) -> DataFrame:
    """keys, frame, track, p, was_filled: each track at each target, between the two samples beside it; null where one of them is unknown.

    targets: keys, frame, target (a counter with a fraction). samples: as ``filled`` takes them. Every target has every track of its take's, known or not: a row each.
    """
    stream = [*keys, "track"]
    own = filled(samples, keys, most).withColumn("_v", F.struct("counter", "p", "was_filled")).withColumn("_key", F.struct(*stream))
    beside = neighbours(own, "_v", [1], "_key", "counter", BLOCK).withColumn("high", F.when(F.col("_v_1.counter") == F.col("counter") + 1, F.col("_v_1")))
    names = samples.groupBy(*keys).agg(F.sort_array(F.collect_set("track")).alias("_tracks"))  # a take has few tracks
    asked = temporal.joined(targets, names, keys).withColumn("track", F.explode("_tracks")).drop("_tracks").withColumn("counter", F.floor("target"))
    found = temporal.joined(asked, beside.select(*stream, "counter", F.col("_v").alias("low"), "high"), [*stream, "counter"])
    share = F.col("target") - F.col("counter")
    both = F.col("low.p").isNotNull() & F.col("high.p").isNotNull()
    between = F.when(both, vec.add(vec.scale(F.col("low.p"), 1 - share), vec.scale(F.col("high.p"), share)))
    return found.select(
        *keys, "frame", "track", F.when(share == 0, F.col("low.p")).otherwise(between).alias("p"), F.coalesce(F.col("low.was_filled") | ((share > 0) & F.col("high.was_filled")), F.lit(False)).alias("was_filled")
    )


def tracks_on_grid(samples: DataFrame, targets: DataFrame, tracks: dict[str, list[str]], keys: list[str], most_apart: float = 2.0, most_gap: int = 4) -> DataFrame:
    """The whole chain: aliases to tracks, contracts, short gaps, grid. What breaks a contract is a ContractError; nothing is repaired."""
    tracked = logical(samples, tracks, keys)
    enforce(failures(tracked, targets, keys, most_apart), "marker tracks")
    return grid(tracked, targets, keys, most_gap)
