"""Queries of robust aggregates, rankings, sampling and contracts over the business tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.operators import contract, fit, stats
from kinestream.plans.registry import query


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _rounded(df: DataFrame, keys: list[str], names: list[str], digits: int = 6) -> DataFrame:
    return df.select(*keys, *[F.round(n, digits).alias(n) for n in names])


def _sql_rounded(parts: dict[str, str]) -> str:
    return ", ".join(f"round({x}, 6) AS {n}" for n, x in parts.items())


_X = "l_extendedprice"


@query(f"SELECT l_returnflag, l_linestatus, count({_X}) AS count, {_sql_rounded({'min': f'min({_X})', 'mean': f'avg({_X})', 'median': f'quantile_cont({_X}, 0.5)', 'p95': f'quantile_cont({_X}, 0.95)', 'max': f'max({_X})'})} FROM lineitem GROUP BY ALL")
def dist_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """count, min, mean, median, p95 and max of prices."""
    d = stats.distribution(_read(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], _X, {"median": 0.5, "p95": 0.95}, ("min", "max"))
    return _rounded(d, ["l_returnflag", "l_linestatus", "count"], ["min", "mean", "median", "p95", "max"])


@query(f"SELECT l_suppkey, count({_X}) AS count, {_sql_rounded({'mean': f'avg({_X})', 'median': f'quantile_cont({_X}, 0.5)', 'p95': f'quantile_cont({_X}, 0.95)', 'max': f'max({_X})', 'rmse': f'sqrt(avg({_X} * {_X}))'})} FROM lineitem GROUP BY ALL")
def dist_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """count, mean, median, p95, max and root mean square of prices by supplier."""
    d = stats.distribution(_read(spark, sf_dir, "lineitem"), ["l_suppkey"], _X, {"median": 0.5, "p95": 0.95}, ("max", "rmse"))
    return _rounded(d, ["l_suppkey", "count"], ["mean", "median", "p95", "max", "rmse"])


_WIDE = {"p05": 0.05, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


@query("SELECT o_orderstatus, count(o_totalprice) AS count, " + _sql_rounded({"mean": "avg(o_totalprice)"} | {n: f"quantile_cont(o_totalprice, {q})" for n, q in _WIDE.items()} | {"min": "min(o_totalprice)", "max": "max(o_totalprice)"}) + " FROM orders GROUP BY ALL")
def dist_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All quantiles that some report uses, of order totals by status."""
    d = stats.distribution(_read(spark, sf_dir, "orders"), ["o_orderstatus"], "o_totalprice", _WIDE, ("min", "max"))
    return _rounded(d, ["o_orderstatus", "count"], ["mean", *_WIDE, "min", "max"])


_R = "CASE WHEN l_discount > 0.01 THEN l_quantity * (l_discount - 0.05) * 20 END"


@query(
    f"""WITH r AS (SELECT l_returnflag, {_R} AS res, l_tax > 0.02 AS inside FROM lineitem),
c AS (SELECT l_returnflag, count(*) AS requested, count_if(inside)::BIGINT AS in_frame, count(res) AS local, count_if(abs(res) <= 5)::BIGINT AS within_5, count_if(abs(res) <= 20)::BIGINT AS within_20 FROM r GROUP BY ALL)
SELECT *, """
    + ", ".join(f"round(within_{b} / nullif({d}, 0)::DOUBLE, 9) AS within_{b}_of_{d}" for b in (5, 20) for d in ("requested", "in_frame", "local"))
    + " FROM c"
)
def threshold_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residuals within bounds, as fractions of all, of those in frame and of those known."""
    rows = _read(spark, sf_dir, "lineitem").select("l_returnflag", F.expr(_R).alias("res"), (F.col("l_tax") > 0.02).alias("inside"))
    d = stats.threshold_fractions(rows, ["l_returnflag"], "res", "inside", (5, 20))
    names = [c for c in d.columns if "_of_" in c]
    return d.select(*[c for c in d.columns if c not in names], *[F.round(c, 9).alias(c) for c in names])


@query(
    """WITH m AS (SELECT l_suppkey, quantile_cont(l_extendedprice, 0.5) AS med, count(*) AS n FROM lineitem GROUP BY ALL),
a AS (SELECT l.l_suppkey, quantile_cont(abs(l_extendedprice - med), 0.5) AS mad FROM lineitem l JOIN m USING (l_suppkey) GROUP BY ALL),
t AS (SELECT l_suppkey, n, med + greatest(3 * 1.4826 * mad, 3.0) AS threshold FROM m JOIN a USING (l_suppkey)),
s AS (SELECT l_suppkey, count_if(l_extendedprice <= threshold)::BIGINT AS stay FROM lineitem JOIN t USING (l_suppkey) GROUP BY ALL)
SELECT l_suppkey, round(any_value(threshold), 6) AS threshold, bool_or(stay >= greatest(10, n // 2)) AS refined, count(*) AS n,
  count_if(NOT stay >= greatest(10, n // 2) OR l_extendedprice <= threshold)::BIGINT AS kept FROM lineitem JOIN t USING (l_suppkey) JOIN s USING (l_suppkey) GROUP BY l_suppkey"""
)
def mad_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices by supplier without those far above the median."""
    m = stats.mad_trimmed(_read(spark, sf_dir, "lineitem"), ["l_suppkey"], _X)
    return m.groupBy("l_suppkey").agg(F.round(F.first("threshold"), 6).alias("threshold"), F.bool_or("refined").alias("refined"), F.count("*").alias("n"), F.count_if("kept").alias("kept"))


@query(
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_quantity), 6) AS mean, round(quantile_cont(l_quantity, 0.5), 6) AS median FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_returnflag, l_linestatus))"""
)
def error_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One measure at two grains in one pass: a row counts for its group and for the group of all its states."""
    d = _read(spark, sf_dir, "lineitem")
    grains = F.explode(F.array(F.lit(None).cast("string"), F.col("l_linestatus")))
    rows = d.select("l_returnflag", "l_quantity", grains.alias("l_linestatus"))
    a = stats.distribution(rows, ["l_returnflag", "l_linestatus"], "l_quantity", {"median": 0.5})
    return _rounded(a.withColumnRenamed("count", "n"), ["l_returnflag", "l_linestatus", "n"], ["mean", "median"])


@query(
    """WITH f AS (SELECT l_orderkey, l_returnflag, quantile_cont(l_extendedprice, 0.5) AS per_order FROM lineitem GROUP BY ALL)
SELECT l_returnflag, count(*) AS frames, round(avg(per_order), 6) AS mean, round(quantile_cont(per_order, 0.5), 6) AS median FROM f GROUP BY ALL"""
)
def two_level_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of medians: within an order, then over orders."""
    f = _read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.median(_X).alias("m"))
    d = stats.distribution(f, ["l_returnflag"], "m", {"median": 0.5})
    return _rounded(d.withColumnRenamed("count", "frames"), ["l_returnflag", "frames"], ["mean", "median"])


@query(
    """WITH c AS (SELECT l_shipdate::DATE AS d, o AS off, round(quantile_cont(abs(l_quantity - 25 - o), 0.5), 6) AS med FROM lineitem CROSS JOIN (VALUES (-8), (-4), (0), (4), (8)) v(o) GROUP BY ALL)
SELECT d::VARCHAR AS day, off, med FROM c QUALIFY row_number() OVER (PARTITION BY d ORDER BY med, abs(off), off) = 1"""
)
def candidate_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day the offset of least median error, the nearest to zero of equals. Equal quantities are counted before the five offsets are tried."""
    days = _read(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").cast("string").alias("day"), "l_quantity").agg(F.count("*").alias("n"))
    rows = days.select("day", "l_quantity", "n", F.explode(F.array(*[F.lit(o) for o in (-8, -4, 0, 4, 8)])).alias("off"))
    c = rows.groupBy("day", "off").agg(F.round(F.percentile(F.abs(F.col("l_quantity") - 25 - F.col("off")), 0.5, F.col("n")), 6).alias("med"))
    return stats.best(c, ["day"], ["off", "med"], [F.col("med"), F.abs("off"), F.col("off")])


@query(
    """WITH t AS (SELECT p_brand, p_type, quantile_cont(p_retailprice, 0.5) AS med, quantile_cont(p_retailprice, 0.95) AS p95, stddev_pop(p_retailprice) AS jitter FROM part GROUP BY ALL),
m AS (SELECT p_brand, round(avg(med), 6) AS median, round(avg(p95), 6) AS p95, round(avg(jitter), 6) AS jitter FROM t GROUP BY ALL)
SELECT *, round(median + 0.25 * p95 + 0.25 * jitter, 6) AS score, row_number() OVER (ORDER BY median + 0.25 * p95 + 0.25 * jitter, p_brand) AS rank FROM m"""
)
def method_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands ranked by a composite of their types' distributions."""
    t = _read(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.median("p_retailprice").alias("a"), F.percentile("p_retailprice", 0.95).alias("b"), F.stddev_pop("p_retailprice").alias("c"))
    m = t.groupBy("p_brand").agg(*[F.round(F.avg(x), 6).alias(n) for x, n in zip("abc", ("median", "p95", "jitter"), strict=True)])
    s = m.withColumn("score", F.col("median") + 0.25 * F.col("p95") + 0.25 * F.col("jitter"))
    return stats.ranked(s, [], [F.col("score"), F.col("p_brand")]).withColumn("score", F.round("score", 6))


@query("SELECT l_linestatus, round(coalesce(sum(CASE WHEN l_tax > 0 THEN l_extendedprice * l_tax END), 0) / greatest(coalesce(sum(l_tax), 0), 1), 6) AS loss FROM lineitem GROUP BY ALL")
def masked_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weighted mean whose weight is one at least."""
    return _read(spark, sf_dir, "lineitem").groupBy("l_linestatus").agg(F.round(stats.masked_mean(F.col(_X), F.col("l_tax")), 6).alias("loss"))


@query(
    """WITH s AS (SELECT l_suppkey, avg(l_quantity) AS m, stddev_pop(l_quantity) AS sd FROM lineitem GROUP BY ALL)
SELECT l_returnflag, round(avg((abs(l_quantity - m) <= 1.96 * sd)::INT), 9) AS covered, count(*) AS n FROM lineitem JOIN s USING (l_suppkey) GROUP BY ALL"""
)
def coverage_95(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of quantities within 1.96 deviations of their supplier's mean."""
    d = _read(spark, sf_dir, "lineitem")
    s = d.groupBy("l_suppkey").agg(F.avg("l_quantity").alias("m"), F.stddev_pop("l_quantity").alias("sd"))
    inside = (F.abs(F.col("l_quantity") - F.col("m")) <= 1.96 * F.col("sd")).cast("int")
    return d.join(s, "l_suppkey").groupBy("l_returnflag").agg(F.round(F.avg(inside), 9).alias("covered"), F.count("*").alias("n"))


@query("SELECT sha256(text) AS hash, count(DISTINCT doc_id % 3) AS splits FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(DISTINCT doc_id % 3) > 1")
def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are in more than one of three splits."""
    d = _read(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("hash"), (F.col("doc_id") % 3).alias("split"))
    return contract.split_leakage(d, "hash", "split")


@query(
    """SELECT coalesce(o.o_custkey, c.c_custkey) AS c_custkey, CASE WHEN o.o_custkey IS NULL THEN 'missing' ELSE 'extra' END AS side
FROM (SELECT DISTINCT c_custkey FROM customer) c FULL JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 50000) o ON o.o_custkey = c.c_custkey WHERE o.o_custkey IS NULL OR c.c_custkey IS NULL"""
)
def closure_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without a large order, and large orders without a customer."""
    orders = _read(spark, sf_dir, "orders").where("o_totalprice > 50000").select(F.col("o_custkey").alias("c_custkey"))
    return contract.closure(_read(spark, sf_dir, "customer"), orders, "c_custkey")


@query("""SELECT n_nationkey, sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}') AS row_sha256 FROM nation""")
def sha_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash of each nation's canonical JSON."""
    d = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return contract.row_hashes(d, d.columns).select("n_nationkey", "row_sha256")


@query("SELECT page_id, sha256(html) AS sha256, strlen(html) AS bytes FROM pages")
def file_hash_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash and size of each page's content."""
    return _read(spark, sf_dir, "pages").select("page_id", F.sha2("html", 256).alias("sha256"), F.octet_length("html").cast("long").alias("bytes"))


@query(
    """SELECT count_if(NOT coalesce(l_discount BETWEEN 0 AND 1, false))::BIGINT AS discount, count_if(NOT coalesce(l_quantity <= 45, false))::BIGINT AS quantity, count_if(NOT coalesce(l_tax >= 0.01, false))::BIGINT AS tax FROM lineitem"""
)
def bounds_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows break each of three bounds."""
    return contract.bounds(_read(spark, sf_dir, "lineitem"), {"discount": F.col("l_discount").between(0, 1), "quantity": F.col("l_quantity") <= 45, "tax": F.col("l_tax") >= 0.01})


@query("SELECT l_orderkey, l_linenumber, round_even((l_extendedprice - 1000) / 0.25, 0)::BIGINT AS q, abs(round_even((l_extendedprice - 1000) / 0.25, 0) * 0.25 + 1000 - l_extendedprice) <= 0.125 + 1e-9 AS within FROM lineitem")
def quantize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as integers of a quarter from an origin, half to even, and whether they come back within half a step."""
    q = F.rint((F.col(_X) - 1000) / 0.25)
    return _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", q.cast("long").alias("q"), (F.abs(q * 0.25 + 1000 - F.col(_X)) <= 0.125 + 1e-9).alias("within"))


@query("SELECT l_suppkey, floor(quantile_cont(nullif(floor(l_quantity) * (l_linenumber % 3), 0), 0.5))::BIGINT AS depth FROM lineitem GROUP BY ALL")
def temporal_median_nonzero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per place the median of its readings, zero meaning none, cut to an integer."""
    z = F.nullif(F.floor("l_quantity") * (F.col("l_linenumber") % 3), F.lit(0))
    return _read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.floor(F.median(z)).alias("depth"))


@query(
    """SELECT g AS grp, count(*) AS n, round(avg(l_extendedprice), 6) AS mean FROM (SELECT l_extendedprice, unnest(list_filter(['all', CASE WHEN l_quantity > 25 THEN 'large' END, CASE WHEN l_discount > 0.05 THEN 'cheap' END, CASE WHEN l_returnflag = 'R' THEN 'returned' END], lambda x: x IS NOT NULL)) AS g FROM lineitem) GROUP BY g"""
)
def group_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row counts in every group that it belongs to."""
    groups = F.array_compact(F.array(F.lit("all"), F.when(F.col("l_quantity") > 25, "large"), F.when(F.col("l_discount") > 0.05, "cheap"), F.when(F.col("l_returnflag") == "R", "returned")))
    rows = _read(spark, sf_dir, "lineitem").select(_X, F.explode(groups).alias("grp"))
    return rows.groupBy("grp").agg(F.count("*").alias("n"), F.round(F.avg(_X), 6).alias("mean"))


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 10)")
def completeness_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a line of over ten."""
    lines = _read(spark, sf_dir, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("o_orderkey"))
    return _read(spark, sf_dir, "orders").join(lines, "o_orderkey", "left_anti").select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def selected_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of urgent orders."""
    chosen = _read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return _read(spark, sf_dir, "lineitem").join(chosen, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT n_nationkey, arg_min(struct_pack(s_suppkey := s_suppkey, off := abs(s_acctbal - 1000)), struct_pack(a := abs(s_acctbal - 1000), b := s_suppkey)).s_suppkey AS s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_nationkey")
def nearest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation the supplier whose balance is nearest to a thousand."""
    s = _read(spark, sf_dir, "supplier").withColumn("off", F.abs(F.col("s_acctbal") - 1000))
    n = _read(spark, sf_dir, "nation")
    return stats.best(s.join(n, s.s_nationkey == n.n_nationkey), ["n_nationkey"], ["s_suppkey"], [F.col("off"), F.col("s_suppkey")])


def _line_sql(rounds: int) -> str:
    """The rounds one after the other: those after nothing changes repeat the last."""
    text = "WITH k0 AS MATERIALIZED (SELECT l_returnflag AS g, l_quantity::DOUBLE AS x, l_extendedprice::DOUBLE AS y, true AS kept FROM lineitem)"
    for i in range(rounds):
        text += f""", l{i} AS MATERIALIZED (SELECT g, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM k{i} WHERE kept GROUP BY g),
o{i} AS MATERIALIZED (SELECT k.*, y - slope * x - intercept AS r FROM k{i} k JOIN l{i} USING (g)), m{i} AS MATERIALIZED (SELECT g, quantile_cont(r, 0.5) AS mid FROM o{i} WHERE kept GROUP BY g),
d{i} AS MATERIALIZED (SELECT g, quantile_cont(abs(r - mid), 0.5) AS mad FROM o{i} JOIN m{i} USING (g) WHERE kept GROUP BY g),
k{i + 1} AS MATERIALIZED (SELECT g, x, y, abs(r - mid) < greatest(2.5, 3 * 1.4826 * mad) AS kept FROM o{i} JOIN m{i} USING (g) JOIN d{i} USING (g))"""
    return text + f" SELECT g AS l_returnflag, round(slope, 6) AS slope, round(intercept, 5) AS intercept, used FROM l{rounds - 1} JOIN (SELECT g, count_if(kept)::BIGINT AS used FROM k{rounds} GROUP BY g) USING (g)"


@query(_line_sql(10))
def robust_line_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price by quantity per return flag, refitted without outliers until nothing changes."""
    d = fit.robust_line(_read(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", _X)
    return d.select("l_returnflag", F.round("slope", 6).alias("slope"), F.round("intercept", 5).alias("intercept"), "used")


@query("SELECT l_linenumber, round(corr(l_quantity, l_extendedprice), 6) AS r, count(*) AS n FROM lineitem GROUP BY l_linenumber HAVING count(*) >= 30")
def guarded_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of quantity and price by line, of at least thirty rows."""
    d = _read(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(stats.guarded_correlation(F.col("l_quantity"), F.col(_X)).alias("r"), F.count("*").alias("n"))
    return d.where("n >= 30").select("l_linenumber", F.round("r", 6).alias("r"), "n")


@query("SELECT step, count(*) AS n FROM (SELECT (epoch_us(l_shipdate) // 86400000000 - epoch_us(o_orderdate) // 86400000000) AS step FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY step")
def step_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many days lie between order and shipping."""
    day = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / 86_400_000_000)
    d = _read(spark, sf_dir, "lineitem").join(_read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return d.select((day("l_shipdate") - day("o_orderdate")).alias("step")).groupBy("step").agg(F.count("*").alias("n"))


@query("SELECT count(DISTINCT s_nationkey) AS nations, count(DISTINCT s_nationkey) = 1 AS consistent, bool_and(s_acctbal > -1000) AS all_ok, bool_or(s_acctbal < 0) AS any_negative FROM supplier")
def consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether all suppliers agree on a nation, and two verdicts over all."""
    return _read(spark, sf_dir, "supplier").agg(F.countDistinct("s_nationkey").alias("nations"), (F.countDistinct("s_nationkey") == 1).alias("consistent"), F.bool_and(F.col("s_acctbal") > -1000).alias("all_ok"), F.bool_or(F.col("s_acctbal") < 0).alias("any_negative"))
