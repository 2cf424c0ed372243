"""Robust aggregates: distributions, thresholds with explicit denominators, trimming, rankings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinestream.operators.temporal import joined
from kinestream.shared import written


def finite(x: Column) -> Column:
    """Null for what isn't finite: percentile and max would take NaN as the largest value."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def _ordered_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """How often each group has each value, sorted by group and value over the whole cluster: _k0 ..., _v, _n, _part. What is not finite is null.

    A table in the shared folder: the parts must be the same whenever they are read.
    """
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    counts = df.select(*named, finite(F.col(value).cast("double")).alias("_v")).groupBy(*_names(keys), "_v").agg(F.count("*").alias("_n"))
    return written(counts.repartitionByRange(*_names(keys), "_v").withColumn("_part", F.spark_partition_id()), "counts")


def _names(keys: list[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(keys))]


def _percentiles(order: DataFrame, keys: list[str], quantiles: dict[str, float]) -> DataFrame:
    names, order = _names(keys), order.where("_v is not null")
    by_key = Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))
    parts = order.groupBy(*names, "_part").agg(F.sum("_n").alias("_size"))
    before = F.sum("_size").over(by_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")
    parts = parts.select(*names, "_part", "_size", before.alias("_start"), F.sum("_size").over(by_key).alias("_all"))
    places = {n: (F.col("_all") - 1) * F.lit(float(q)) for n, q in quantiles.items()}
    ranks = [f(p).cast("long") for p in places.values() for f in (F.floor, F.ceil)]
    holds = reduce(lambda a, b: a | b, [(r >= F.col("_start")) & (r < F.col("_start") + F.col("_size")) for r in ranks])
    near = joined(order, parts.where(holds).drop("_size"), [*names, "_part"]).where("_start is not null")
    upto = F.col("_start") + F.sum("_n").over(Window.partitionBy(*names, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = near.withColumn("_upto", upto)
    at = lambda r: F.max(F.when((r >= F.col("_upto") - F.col("_n")) & (r < F.col("_upto")), F.col("_v")))
    low_high = [(at(F.floor(p).cast("long")).alias(f"{n}_low"), at(F.ceil(p).cast("long")).alias(f"{n}_high")) for n, p in places.items()]
    found = placed.groupBy(*names, "_all").agg(*[c for pair in low_high for c in pair])
    between = [(F.col(f"{n}_low") + (F.col(f"{n}_high") - F.col(f"{n}_low")) * (p - F.floor(p))).alias(n) for n, p in places.items()]
    return found.select(*names, *between)


def split_percentiles(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """keys and a column for each quantile of ``value``, exact and linear between ranks, for groups of any size.

    Spark's ``percentile`` holds all distinct values of a group in one task. Here equal values are counted first, the counts are sorted over
    the whole cluster, and only the parts of the order that hold a wanted rank are looked through. Null keys are one group; values that are
    null or not finite don't count, and a group without others has no row.
    """
    found = _percentiles(_ordered_counts(df, keys, value), keys, quantiles)
    return found.select(*[F.col(n).alias(k) for k, n in zip(keys, _names(keys), strict=True)], *quantiles)


def distribution(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float], extra: tuple[str, ...] = ()) -> DataFrame:
    """count, mean, quantiles (linear between ranks), and of ``extra``: min, max, rmse; a group without values has count 0 and nulls.

    ``df`` is worked out twice: sums of counted values would differ from the rows' own in the last digit.
    """
    x = finite(F.col(value))
    made = {"count": F.count(x), "mean": F.avg(x)}
    made |= {n: f for n, f in {"min": F.min(x), "max": F.max(x), "rmse": F.sqrt(F.avg(x * x))}.items() if n in extra}
    return joined(df.groupBy(*keys).agg(*[c.alias(n) for n, c in made.items()]), split_percentiles(df, keys, value, quantiles), keys)


def threshold_counts(df: DataFrame, keys: list[str], residual: str, in_frame: str, bounds: tuple[float, ...]) -> DataFrame:
    """requested, in_frame, local (a residual is known), and for each bound the count of absolute residuals within it. Counts of parts add up."""
    r = F.abs(F.col(residual))
    return df.groupBy(*keys).agg(F.count("*").alias("requested"), F.count_if(in_frame).alias("in_frame"), F.count(residual).alias("local"), *[F.count_if(r <= b).alias(f"within_{b:g}") for b in bounds])


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """``threshold_counts`` of larger groups from those of their parts."""
    counts = [c for c in parts.columns if c in ("requested", "in_frame", "local") or c.startswith("within_")]
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])


def fractions(counts: DataFrame, bounds: tuple[float, ...]) -> DataFrame:
    """``threshold_counts`` with the fraction of each denominator; a fraction of nothing is null."""
    of = [F.try_divide(F.col(f"within_{b:g}"), F.col(d)).alias(f"within_{b:g}_of_{d}") for b in bounds for d in ("requested", "in_frame", "local")]
    return counts.select("*", *of)


def threshold_fractions(df: DataFrame, keys: list[str], residual: str, in_frame: str, bounds: tuple[float, ...]) -> DataFrame:
    """``fractions`` of ``threshold_counts``."""
    return fractions(threshold_counts(df, keys, residual, in_frame, bounds), bounds)


def mad_trimmed(df: DataFrame, keys: list[str], value: str, least: float = 3.0, min_rows: int = 10, half: bool = True) -> DataFrame:
    """Rows with ``kept``: value <= median + max(3 * 1.4826 * MAD, ``least``).

    A group keeps all rows if fewer than ``min_rows`` (and, with ``half``, fewer than half of them) would stay. No group is
    collected: medians, which few numbers a group are, are joined back by key. Null keys are one group; a null value is not within.
    """
    median = lambda rows, x, name: split_percentiles(rows, keys, x, {name: 0.5})
    near = joined(df, median(df, value, "_median"), keys).withColumn("_off", F.abs(F.col(value) - F.col("_median")))
    mads = median(near, "_off", "_mad")
    marked = joined(near, mads, keys).withColumn("threshold", F.col("_median") + F.greatest(F.lit(3 * 1.4826) * F.col("_mad"), F.lit(least)))
    stay = marked.groupBy(*keys).agg(F.count_if(F.col(value) <= F.col("threshold")).alias("_stay"), F.count("*").alias("_n"))
    enough = F.greatest(F.lit(min_rows), F.floor(F.col("_n") / 2)) if half else F.lit(min_rows)
    refit = joined(marked, stay, keys).withColumn("refined", F.col("_stay") >= enough)
    return refit.withColumn("kept", ~F.col("refined") | (F.col(value) <= F.col("threshold"))).select(*df.columns, "threshold", "refined", "kept")


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """Rank 1, 2, 3 ... within a group by composite keys; the last of ``order`` should break all ties."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))


def best(df: DataFrame, keys: list[str], what: list[str], order: list[Column]) -> DataFrame:
    """The row of the least composite key of each group, by one aggregate without a window."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*what), F.struct(*order)).alias("_b")).select(*keys, "_b.*")


def masked_mean(value: Column, weight: Column) -> Column:
    """Sum of weighted values over the larger of the summed weight and 1; values without weight may be missing."""
    return F.coalesce(F.sum(F.when(weight > 0, value * weight)), F.lit(0.0)) / F.greatest(F.coalesce(F.sum(weight), F.lit(0.0)), F.lit(1.0))


def guarded_correlation(x: Column, y: Column, least: int = 30) -> Column:
    """Pearson correlation of the rows that have both; null below ``least`` rows or without spread."""
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    good = (F.count(a + b) >= least) & (F.stddev_pop(a) > 1e-12) & (F.stddev_pop(b) > 1e-12)
    return F.when(good, F.corr(a, b))
