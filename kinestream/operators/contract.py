"""Data contracts. A check returns its failures as rows, or a verdict per stream; ``enforce`` raises on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.operators.temporal import BUCKET, joined, running_extreme


class ContractError(ValueError):
    """Rows break a contract."""


def enforce(failures: DataFrame, rule: str, shown: int = 5) -> None:
    """Raise if there is a row. At most ``shown`` rows reach the driver."""
    found = failures.limit(shown).collect()
    if found:
        raise ContractError(f"{rule}: {[r.asDict() for r in found]}")


def _steps(df: DataFrame, stream: list[str], order: str, bucket: int) -> DataFrame:
    before = running_extreme(df.select(*stream, order), stream, [F.col(order)], order, F.col(order), "before", exclude_current=True, bucket=bucket)
    return before.select(*stream, order, (F.col(order) - F.col("before")).alias("step"))


def sequence_verdict(df: DataFrame, stream: list[str], order: str) -> DataFrame:
    """Per stream: rows, first, last, increasing (strictly), contiguous (steps of one), from_zero.

    Aggregates only: a sequence increases strictly if no value repeats, and has no hole if it spans as many values as it has.
    """
    a = df.groupBy(*stream).agg(F.count("*").alias("rows"), F.count(order).alias("known"), F.countDistinct(order).alias("different"), F.min(order).alias("first"), F.max(order).alias("last"))
    unique = (F.col("different") == F.col("rows")) & (F.col("known") == F.col("rows"))
    return a.select(*stream, "rows", "first", "last", unique.alias("increasing"), (unique & (F.col("last") - F.col("first") + 1 == F.col("rows"))).alias("contiguous"), (unique & (F.col("first") == 0) & (F.col("last") + 1 == F.col("rows"))).alias("from_zero"))


def cadence(df: DataFrame, stream: list[str], order: str, step: float, tolerance: float, bucket: int = BUCKET) -> DataFrame:
    """Per stream the number of steps and of those off ``step`` by more than ``tolerance``, and whether all hold. Rows without a time have no step."""
    off = F.abs(F.col("step") - step) > tolerance
    a = _steps(df, stream, order, bucket).groupBy(*stream).agg(F.count("step").alias("steps"), F.count_if(off).alias("off"))
    return a.withColumn("holds", F.col("off") == 0)


def split_leakage(df: DataFrame, key: str, split: str) -> DataFrame:
    """Keys that are in more than one split: key, splits. Null keys don't tell."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct(split).alias("splits")).where("splits > 1")


def closure(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: key, side ('missing': expected only, 'extra': actual only)."""
    left, right = expected.select(key).distinct().withColumn("e", F.lit(1)), actual.select(key).distinct().withColumn("a", F.lit(1))
    return left.join(right, key, "full_outer").where("e is null or a is null").select(key, F.when(F.col("a").isNull(), "missing").otherwise("extra").alias("side"))


def bounds(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: for each rule the number of rows that break it; a null verdict breaks it."""
    return df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])


def one_to_one(left: DataFrame, right: DataFrame, key: str, keys: list[str]) -> DataFrame:
    """Per group the counts of a full-outer match by ``key``: left, right, matched keys, duplicates of each side, and exact (all 1:1)."""
    a = left.groupBy(*keys, key).agg(F.count("*").alias("l"))
    b = right.groupBy(*keys, key).agg(F.count("*").alias("r"))
    m = a.join(b, [*keys, key], "full_outer").groupBy(*keys)
    out = m.agg(F.coalesce(F.sum("l"), F.lit(0)).alias("n_left"), F.coalesce(F.sum("r"), F.lit(0)).alias("n_right"), F.count_if(F.expr("l is not null and r is not null")).alias("matched"), F.count_if(F.expr("l > 1")).alias("left_repeats"), F.count_if(F.expr("r > 1")).alias("right_repeats"))
    return out.withColumn("exact", (F.col("n_left") == F.col("matched")) & (F.col("n_right") == F.col("matched")))


def row_hashes(df: DataFrame, columns: list[str], name: str = "row_sha256") -> DataFrame:
    """``df`` with the SHA-256 of each row's columns as JSON with sorted keys and without spaces."""
    return df.withColumn(name, F.sha2(F.to_json(F.struct(*sorted(columns))), 256))


def provenance(copies: DataFrame, originals: DataFrame, key: list[str], fields: list[str], digest: str) -> DataFrame:
    """For each copy: whether its original is there, the fields that differ from it (all, if it isn't), and whether the digest is the original's."""
    named = originals.select(*key, *[F.col(c).alias(f"_{c}") for c in [*fields, digest]], F.lit(True).alias("_there"))
    rows = joined(copies, named, key)
    differing = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in fields]))
    return rows.select(*key, F.coalesce("_there", F.lit(False)).alias("found"), differing.alias("differing"), F.coalesce(F.col(digest) == F.col(f"_{digest}"), F.lit(False)).alias("digest_holds"))


def ordinal_agreement(left: DataFrame, right: DataFrame, keys: list[str], index: str, value: str, tolerance: float) -> DataFrame:
    """Per group the lengths of two sources of one sequence and how far they are apart at both ends; they agree if lengths are equal and ends near."""
    ends = lambda d, s: d.groupBy(*keys).agg(F.count("*").alias(f"n_{s}"), F.min_by(value, index).alias(f"_first_{s}"), F.max_by(value, index).alias(f"_last_{s}"))
    both = ends(left, "left").join(ends(right, "right"), keys, "full_outer")
    off = {e: F.abs(F.col(f"_{e}_left") - F.col(f"_{e}_right")) for e in ("first", "last")}
    holds = (F.col("n_left") == F.col("n_right")) & (off["first"] <= tolerance) & (off["last"] <= tolerance)
    return both.select(*keys, "n_left", "n_right", off["first"].alias("first_off"), off["last"].alias("last_off"), holds.alias("holds"))


def manifest_status(listed: DataFrame, files: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, status) of each file on either side: 'same', 'changed', 'missing' (listed only) or 'extra' (not listed)."""
    a, b = listed.select(key, F.col(digest).alias("_listed")), files.select(key, F.col(digest).alias("_found"))
    status = F.when(F.col("_found").isNull(), "missing").when(F.col("_listed").isNull(), "extra").when(F.col("_listed") == F.col("_found"), "same").otherwise("changed")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def accepted(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """Per group the verdict of each rule (an aggregate), and ``pass``: all hold. What is not known does not hold."""
    a = df.groupBy(*keys).agg(*[F.coalesce(r, F.lit(False)).alias(n) for n, r in rules.items()])
    return a.withColumn("pass", reduce(lambda x, y: x & y, [F.col(n) for n in rules]))


def failures(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` with ``failures``: the names of all rules that the row breaks; a null verdict breaks one."""
    return df.withColumn("failures", F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()])))


def agreement(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str], tolerance: float) -> DataFrame:
    """Per key the largest difference of the fields of two sources, and whether it is within the tolerance; a key on one side only doesn't agree."""
    other = right.select(*keys, *[F.col(c).alias(f"_{c}") for c in fields])
    worst = [F.abs(F.col(c) - F.col(f"_{c}")) for c in fields]
    both = left.join(other, keys, "full_outer").withColumn("worst", F.greatest(*worst) if len(worst) > 1 else worst[0])
    return both.select(*keys, "worst", F.coalesce(F.col("worst") <= tolerance, F.lit(False)).alias("agrees"))


def inputs_only(df: DataFrame, targets: list[str]) -> DataFrame:
    """``df`` without the columns that a model is to predict, and the proof that nothing else in it comes from them: a ContractError if a scan below still reads one.

    Spark prunes what isn't used, so a plan whose scans read no target can't depend on one. Names are those of the tables that are read.
    """
    kept = df.drop(*targets)
    leaves = kept._jdf.queryExecution().sparkPlan().collectLeaves()
    read = {leaves.apply(i).output().apply(j).name() for i in range(leaves.size()) for j in range(leaves.apply(i).output().size())}
    if used := sorted(read & set(targets)):
        raise ContractError(f"columns are made of targets: {used}")
    return kept
