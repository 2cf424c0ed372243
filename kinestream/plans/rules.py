"""Queries of contracts between tables, sets, texts, times and documents of metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.functions import text
from kinestream.operators import contract, stats
from kinestream.plans.measures import _read
from kinestream.plans.registry import query

_ROW = """sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}')"""


@query(
    f"""WITH p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey, CASE WHEN o_orderkey % 70 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, {_ROW} AS digest FROM orders WHERE o_orderkey % 5 = 0),
o AS (SELECT o_orderkey, o_custkey, o_orderstatus, {_ROW} AS digest FROM orders WHERE o_orderkey % 90 <> 0)
SELECT p.o_orderkey, o.o_orderkey IS NOT NULL AS found, array_to_string(list_filter([CASE WHEN p.o_custkey IS DISTINCT FROM o.o_custkey THEN 'o_custkey' END, CASE WHEN p.o_orderstatus IS DISTINCT FROM o.o_orderstatus THEN 'o_orderstatus' END], lambda x: x IS NOT NULL), ',') AS differing,
  coalesce(p.digest = o.digest, false) AS digest_holds FROM p LEFT JOIN o USING (o_orderkey)"""
)
def provenance_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of orders, some altered, against the orders that they name: which fields differ, and whether the digest is the original's."""
    orders = contract.row_hashes(_read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey", "o_custkey", "o_orderstatus"], "digest")
    key = F.col("o_orderkey")
    copies = orders.where(key % 5 == 0).withColumns({"o_custkey": F.when(key % 50 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")), "o_orderstatus": F.when(key % 70 == 0, "X").otherwise(F.col("o_orderstatus"))})
    rows = contract.provenance(copies, orders.where(key % 90 != 0), ["o_orderkey"], ["o_custkey", "o_orderstatus"], "digest")
    return rows.withColumn("differing", F.array_join("differing", ","))


@query(
    """WITH a AS (SELECT l_suppkey AS k, l_orderkey * 8 + l_linenumber AS i, l_linenumber AS n, l_extendedprice AS x FROM lineitem),
b AS (SELECT k, i, x + CASE WHEN k % 10 = 0 THEN 1 ELSE 0.0004 END AS x FROM a WHERE NOT (k % 11 = 0 AND n = 2)),
l AS (SELECT k, count(*) AS n, arg_min(x, i) AS first, arg_max(x, i) AS last FROM a GROUP BY k), r AS (SELECT k, count(*) AS n, arg_min(x, i) AS first, arg_max(x, i) AS last FROM b GROUP BY k)
SELECT l.k AS l_suppkey, l.n AS n_left, r.n AS n_right, round(abs(l.first - r.first), 6) AS first_off, round(abs(l.last - r.last), 6) AS last_off, l.n = r.n AND abs(l.first - r.first) <= 0.001 AND abs(l.last - r.last) <= 0.001 AS holds FROM l FULL JOIN r USING (k)"""
)
def ordinal_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources of one sequence by supplier agree if they are as long and the same at both ends, within a thousandth."""
    d = _read(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("i"), F.col("l_extendedprice").alias("x"))
    other = d.where("not (l_suppkey % 11 = 0 and l_linenumber = 2)").withColumn("x", F.col("x") + F.when(F.col("l_suppkey") % 10 == 0, 1.0).otherwise(0.0004))
    rows = contract.ordinal_agreement(d, other, ["l_suppkey"], "i", "x", 0.001)
    return rows.withColumns({c: F.round(c, 6) for c in ("first_off", "last_off")})


@query(
    """WITH f AS (SELECT page_id, sha256(html) AS h FROM pages WHERE page_id % 20 <> 3), m AS (SELECT page_id, CASE WHEN page_id % 10 = 7 THEN sha256('') ELSE sha256(html) END AS h FROM pages WHERE page_id % 20 <> 5)
SELECT page_id, CASE WHEN f.h IS NULL THEN 'missing' WHEN m.h IS NULL THEN 'extra' WHEN m.h = f.h THEN 'same' ELSE 'changed' END AS status FROM f FULL JOIN m USING (page_id)"""
)
def manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages against a manifest of their hashes: same, changed, missing, extra."""
    p = _read(spark, sf_dir, "pages").select("page_id", F.sha2("html", 256).alias("sha256"))
    listed = p.where("page_id % 20 <> 5").withColumn("sha256", F.when(F.col("page_id") % 10 == 7, F.sha2(F.lit(""), 256)).otherwise(F.col("sha256")))
    return contract.manifest_status(listed, p.where("page_id % 20 <> 3"), "page_id", "sha256")


@query(
    """WITH a AS (SELECT l_returnflag, count(*) >= 31 AS enough, max(l_discount) <= 0.1 AS bounded, avg(l_quantity) BETWEEN 20 AND 30 AS centred, min(l_tax) > 0 AS taxed FROM lineitem GROUP BY 1)
SELECT *, enough AND bounded AND centred AND taxed AS pass FROM a"""
)
def acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four thresholds on each return flag, and whether all hold."""
    rules = {"enough": F.count("*") >= 31, "bounded": F.max("l_discount") <= 0.1, "centred": F.avg("l_quantity").between(20, 30), "taxed": F.min("l_tax") > 0}
    return contract.accepted(_read(spark, sf_dir, "lineitem"), ["l_returnflag"], rules)


@query(
    """SELECT l_orderkey, l_linenumber, array_to_string(list_filter([CASE WHEN NOT coalesce(l_discount <= 0.08, false) THEN 'discount' END, CASE WHEN NOT coalesce(l_quantity <= 45, false) THEN 'quantity' END, CASE WHEN NOT coalesce(l_tax >= 0.01, false) THEN 'tax' END], lambda x: x IS NOT NULL), ',') AS failures
FROM lineitem WHERE NOT (coalesce(l_discount <= 0.08, false) AND coalesce(l_quantity <= 45, false) AND coalesce(l_tax >= 0.01, false))"""
)
def collect_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules that a row breaks, for rows that break one."""
    rules = {"discount": F.col("l_discount") <= 0.08, "quantity": F.col("l_quantity") <= 45, "tax": F.col("l_tax") >= 0.01}
    rows = contract.failures(_read(spark, sf_dir, "lineitem"), rules).where("size(failures) > 0")
    return rows.select("l_orderkey", "l_linenumber", F.array_join("failures", ",").alias("failures"))


@query(
    """WITH a AS (SELECT s_suppkey, s_acctbal AS fx, s_nationkey::DOUBLE AS cx FROM supplier), b AS (SELECT s_suppkey, s_acctbal + CASE WHEN s_suppkey % 4 = 0 THEN 0.5 ELSE 0.00005 END AS fx, s_nationkey::DOUBLE AS cx FROM supplier WHERE s_suppkey % 9 <> 0)
SELECT s_suppkey, round(greatest(abs(a.fx - b.fx), abs(a.cx - b.cx)), 6) AS worst, coalesce(greatest(abs(a.fx - b.fx), abs(a.cx - b.cx)) <= 0.0001, false) AS agrees FROM a FULL JOIN b USING (s_suppkey)"""
)
def model_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters from two sources agree if none differs by more than a ten-thousandth."""
    a = _read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_acctbal").alias("fx"), F.col("s_nationkey").cast("double").alias("cx"))
    b = a.where("s_suppkey % 9 <> 0").withColumn("fx", F.col("fx") + F.when(F.col("s_suppkey") % 4 == 0, 0.5).otherwise(0.00005))
    return contract.agreement(a, b, ["s_suppkey"], ["fx", "cx"], 0.0001).withColumn("worst", F.round("worst", 6))


@query(
    """WITH a AS (SELECT c_nationkey AS k FROM customer), b AS (SELECT s_nationkey AS k FROM supplier WHERE s_nationkey < 20)
SELECT 'union' AS op, k, count(*) AS n FROM (SELECT k FROM a UNION ALL SELECT k FROM b) GROUP BY k
UNION ALL SELECT 'except_all', k, count(*) FROM (SELECT k FROM a EXCEPT ALL SELECT k FROM b) GROUP BY k
UNION ALL SELECT 'intersect', k, count(*) FROM (SELECT k FROM a INTERSECT SELECT k FROM b) GROUP BY k"""
)
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union, difference with repeats and intersection of customers' and suppliers' nations."""
    a = _read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"))
    b = _read(spark, sf_dir, "supplier").where("s_nationkey < 20").select(F.col("s_nationkey").alias("k"))
    made = {"union": a.unionByName(b), "except_all": a.exceptAll(b), "intersect": a.intersect(b)}
    parts = [d.groupBy("k").agg(F.count("*").alias("n")).select(F.lit(n).alias("op"), "k", "n") for n, d in made.items()]
    return parts[0].union(parts[1]).union(parts[2])


@query(
    """SELECT event_id, (epoch_us(ts) * 1000 + event_id % 1000 + 500) // 1000 AS us, epoch_us(ts) - 8 * 3600000000 AS utc_us, round((event_id % 97 * 0.12)::DOUBLE, 6) AS counter_offset FROM events"""
)
def clock_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nanoseconds rounded to microseconds, a text of a clock eight hours ahead read as UTC, and milliseconds as frames at 120 a second."""
    e = _read(spark, sf_dir, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    ns = F.col("t") * 1000 + F.col("event_id") % 1000
    shown = F.date_format(F.timestamp_micros(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return e.select("event_id", text.rounded_micros(ns).alias("us"), F.unix_micros(text.fixed_zone(shown, "+08:00")).alias("utc_us"), F.round(F.col("event_id") % 97 * 0.12, 6).alias("counter_offset"))


@query(
    """WITH u AS (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS p FROM pages)
SELECT page_id, regexp_replace(p, '[^A-Za-z0-9._-]', '_', 'g') AS safe, 'page' || page_id || '_Pos_X(mm)' AS header, (p = '' OR p LIKE '/%' OR contains(p, chr(92)) OR list_contains(string_split(p, '/'), '..')) AS rejected, string_split(p, '/')[-1] AS leaf FROM u"""
)
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of URLs, headers from a template, and which paths would lead out of their folder."""
    p = F.regexp_replace("url", "^[a-z]+://", "")
    d = _read(spark, sf_dir, "pages").select("page_id", p.alias("p"))
    return d.select("page_id", text.safe_name(F.col("p")).alias("safe"), text.header(F.concat(F.lit("page"), "page_id"), "X").alias("header"), text.leads_out(F.col("p")).alias("rejected"), F.element_at(F.split("p", "/", -1), -1).alias("leaf"))


@query(
    """SELECT o_orderkey, '{"order":{"key":' || o_orderkey || ',"status":"' || o_orderstatus || '"},"positive":' || CASE WHEN o_totalprice > 100000 THEN 'true' ELSE 'false' END || '}' AS document, o_orderstatus AS status FROM orders"""
)
def metrics_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested metrics as compact JSON, and one of its values read back."""
    d = _read(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.struct(F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status")).alias("order"), (F.col("o_totalprice") > 100000).alias("positive"))).alias("document"))
    return d.withColumn("status", F.get_json_object("document", "$.order.status"))


@query(
    """WITH f AS (SELECT l_orderkey, l_returnflag, avg(l_quantity) AS x FROM lineitem GROUP BY ALL), g AS (
SELECT 'pooled' AS grain, l_returnflag, NULL::INT AS part, l_quantity AS x FROM lineitem UNION ALL SELECT 'frame', l_returnflag, NULL, x FROM f UNION ALL SELECT 'part', l_returnflag, l_linenumber, l_quantity FROM lineitem)
SELECT grain, l_returnflag, part, count(*) AS n, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.5), 6) AS median, round(quantile_cont(x, 0.95), 6) AS p95, round(max(x), 6) AS max FROM g GROUP BY ALL"""
)
def error_three_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A measure pooled, as means of frames (orders), and by part (line number)."""
    d = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber", F.col("l_quantity").alias("x"))
    f = d.groupBy("l_orderkey", "l_returnflag").agg(F.avg("x").alias("x"))
    none = F.lit(None).cast("int")
    own = F.array(F.struct(F.lit("pooled").alias("grain"), none.alias("part")), F.struct(F.lit("part").alias("grain"), F.col("l_linenumber").cast("int").alias("part")))
    rows = d.select("l_returnflag", "x", F.inline(own)).unionByName(f.select("l_returnflag", "x", F.lit("frame").alias("grain"), none.alias("part")))
    a = stats.distribution(rows, ["grain", "l_returnflag", "part"], "x", {"median": 0.5, "p95": 0.95}, ("max",))
    return a.select("grain", "l_returnflag", "part", F.col("count").alias("n"), *[F.round(c, 6).alias(c) for c in ("mean", "median", "p95", "max")])


@query(
    """SELECT o_orderstatus, round(min(o_totalprice / 1e6 * 1000), 6) AS min_ms, round(quantile_cont(o_totalprice / 1e6 * 1000, 0.5), 6) AS median_ms, round(quantile_cont(o_totalprice / 1e6 * 1000, 0.95), 6) AS p95_ms, round(max(o_totalprice / 1e6 * 1000), 6) AS max_ms FROM orders GROUP BY 1"""
)
def dist_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """min, median, p95 and max in milliseconds of values in seconds."""
    d = _read(spark, sf_dir, "orders").select("o_orderstatus", (F.col("o_totalprice") / 1e6 * 1000).alias("x"))
    a = stats.distribution(d, ["o_orderstatus"], "x", {"median": 0.5, "p95": 0.95}, ("min", "max"))
    return a.select("o_orderstatus", *[F.round(c, 6).alias(f"{c}_ms") for c in ("min", "median", "p95", "max")])


@query(
    """WITH s AS (SELECT l_suppkey, l_extendedprice / l_quantity / 1000 AS k FROM lineitem)
SELECT l_suppkey, count(*) AS n, round(quantile_cont(k, 0.5), 9) AS median, round(quantile_cont(k, 0.05), 9) AS p05, round(quantile_cont(k, 0.95), 9) AS p95 FROM s WHERE k BETWEEN 0.95 AND 1.75 GROUP BY 1"""
)
def scale_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and spread of scales by supplier, of those within bounds."""
    d = _read(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_extendedprice") / F.col("l_quantity") / 1000).alias("k")).where("k between 0.95 and 1.75")
    a = stats.distribution(d, ["l_suppkey"], "k", {"median": 0.5, "p05": 0.05, "p95": 0.95})
    return a.select("l_suppkey", F.col("count").alias("n"), *[F.round(c, 9).alias(c) for c in ("median", "p05", "p95")])


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY abs(l_extendedprice - 30000), l_orderkey, l_linenumber LIMIT 60")
def best_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sixty prices nearest to a stated one."""
    d = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return d.orderBy(F.abs(F.col("l_extendedprice") - 30000), "l_orderkey", "l_linenumber").limit(60)


@query("SELECT l_suppkey, (list_sort(list(DISTINCT l_extendedprice)))[2] AS second FROM lineitem GROUP BY 1")
def second_smallest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second least price of each supplier: equal prices count once."""
    d = _read(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice")
    least = d.groupBy("l_suppkey").agg(F.min("l_extendedprice").alias("least"))
    return d.join(least, "l_suppkey").groupBy("l_suppkey").agg(F.min(F.when(F.col("l_extendedprice") > F.col("least"), F.col("l_extendedprice"))).alias("second"))
