"""Queries of JSON contracts: the events' own properties, and calibration documents made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.operators import contract, documents
from kinestream.operators.documents import Field
from kinestream.plans.registry import query

PROPS = [Field("k", "integer", low=5, high=94), Field("unit", "string", required=False)]

CALIBRATION = [
    Field("schema", "string", one_of=("camera.v1",)),
    Field("fps", "number", low=1, high=240),
    Field("synthetic", "boolean", one_of=(False,)),
    Field("color", "object"),
    Field("color.resolution", shape=(2,)),
    Field("color.model", "string", required=False, one_of=("rational", "five")),
    Field("transform", shape=(2, 3)),
]


@query("SELECT event_id, 'k' AS path, CASE WHEN json_type(props, '$.k') IS NULL THEN 'missing' WHEN json_type(props, '$.k') NOT IN ('UBIGINT', 'BIGINT') THEN 'not an integer' ELSE 'out of bounds' END AS rule FROM events WHERE coalesce(json_type(props, '$.k') NOT IN ('UBIGINT', 'BIGINT') OR (props->>'$.k')::INT NOT BETWEEN 5 AND 94, true)")
def props_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with the events' properties: all names, kinds and bounds."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return documents.failures(events, ["event_id"], "props", PROPS)


# The document of an event, as text that Spark and DuckDB write alike: parts of it are wrong for some ids.
_DOCUMENT = """concat('{"schema": "camera.v', CASE WHEN event_id % 17 = 0 THEN 2 ELSE 1 END, '"',
  CASE WHEN event_id % 31 = 0 THEN '' WHEN event_id % 29 = 0 THEN ', "fps": "30"' WHEN event_id % 13 = 0 THEN ', "fps": 500' ELSE concat(', "fps": ', CAST(event_id % 100 + 1 AS VARCHAR(9)), '.5') END,
  ', "synthetic": ', CASE WHEN event_id % 41 = 0 THEN 'true' WHEN event_id % 43 = 0 THEN 'null' ELSE 'false' END,
  ', "color": ', CASE WHEN event_id % 47 = 0 THEN '[1]' ELSE concat('{"resolution": ', CASE WHEN event_id % 19 = 0 THEN '[640, "480"]' WHEN event_id % 23 = 0 THEN '[640]' ELSE '[640, 480]' END,
    CASE WHEN event_id % 7 = 0 THEN ', "model": "rational"' WHEN event_id % 11 = 0 THEN ', "model": "fisheye"' ELSE '' END, CASE WHEN event_id % 53 = 0 THEN ', "gamma": 2.2' ELSE '' END, '}') END,
  ', "transform": ', CASE WHEN event_id % 37 = 0 THEN '[[1, 0, 0], [0, 1]]' ELSE '[[1, 0, 0.5], [0, 1, 2]]' END, CASE WHEN event_id % 59 = 0 THEN ', "note": "x"' ELSE '' END, CASE WHEN event_id % 61 = 0 THEN '' ELSE '}' END)"""

_RULES = [
    ("$", "not a JSON object", "broken"),
    ("schema", "not an allowed value", "NOT broken AND event_id % 17 = 0"),
    ("fps", "missing", "NOT broken AND event_id % 31 = 0"),
    ("fps", "not a number", "NOT broken AND event_id % 31 <> 0 AND event_id % 29 = 0"),
    ("fps", "out of bounds", "NOT broken AND event_id % 31 <> 0 AND event_id % 29 <> 0 AND event_id % 13 = 0"),
    ("synthetic", "not an allowed value", "NOT broken AND event_id % 41 = 0"),
    ("synthetic", "not a boolean", "NOT broken AND event_id % 41 <> 0 AND event_id % 43 = 0"),
    ("color", "not an object", "NOT broken AND event_id % 47 = 0"),
    ("color.resolution", "missing", "NOT broken AND event_id % 47 = 0"),
    ("color.resolution", "not all numbers", "NOT broken AND event_id % 47 <> 0 AND event_id % 19 = 0"),
    ("color.resolution", "not of shape 2", "NOT broken AND event_id % 47 <> 0 AND event_id % 19 <> 0 AND event_id % 23 = 0"),
    ("color.model", "not an allowed value", "NOT broken AND event_id % 47 <> 0 AND event_id % 7 <> 0 AND event_id % 11 = 0"),
    ("color.gamma", "unknown", "NOT broken AND event_id % 47 <> 0 AND event_id % 53 = 0"),
    ("transform", "not of shape 2x3", "NOT broken AND event_id % 37 = 0"),
    ("note", "unknown", "NOT broken AND event_id % 59 = 0"),
]


@query(f"WITH d AS (SELECT event_id, NOT json_valid({_DOCUMENT}) AS broken FROM events) " + " UNION ALL ".join(f"SELECT event_id, '{path}' AS path, '{rule}' AS rule FROM d WHERE {when}" for path, rule, when in _RULES))
def calibration_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every failure of every event's calibration document: names, kinds, allowed values, bounds and shapes of arrays."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.expr(_DOCUMENT).alias("document"))
    return documents.failures(events, ["event_id"], "document", CALIBRATION)


_TARGETS = ["l_extendedprice", "l_discount"]


@query("SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity, max(l_tax) AS most_tax FROM lineitem GROUP BY l_orderkey")
def inputs_without_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of orders from lines without the prices that are to be predicted; the plan proves that no scan reads them."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    features = lines.groupBy("l_orderkey").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"), F.max("l_tax").alias("most_tax"), F.sum("l_extendedprice").alias("l_extendedprice"), F.avg("l_discount").alias("l_discount"))
    return contract.inputs_only(features, _TARGETS)
