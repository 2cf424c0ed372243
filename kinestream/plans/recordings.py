"""Queries over recordings that are written as bags and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinestream.plans.registry import query
from kinestream.plans.timelines import stream_events
from kinestream.shared import tables_dir
from kinestream.sources import rosbag

BAGS, TOPIC, FIRST, STOP = 8, "view", 3, 11
_M = f"""WITH m AS (SELECT 'bag-' || (user_id % {BAGS}) AS bag, event_type AS topic, event_id, epoch_us(ts) * 1000 + event_id % 1000 AS ts_ns, value FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY bag, topic ORDER BY ts_ns, event_id) - 1 AS message FROM m)
"""


def _bags(spark: SparkSession, sf_dir: str) -> str:
    """The events as bags of eight streams, in small chunks; returns their folder."""
    path = f"{tables_dir(spark)}/bags-{uuid.uuid4().hex}"
    payload = F.encode(F.concat(F.lpad(F.col("event_id").cast("string"), 12, "0"), F.lit(" "), F.col("value").cast("string")), "utf-8")
    rows = stream_events(spark, sf_dir).select(F.concat(F.lit("bag-"), F.col("stream") % BAGS).alias("bag"), F.col("event_type").alias("topic"), (F.col("t") * 1000 + F.col("event_id") % 1000).alias("ts_ns"), payload.alias("payload"))
    rosbag.write_bags(rows, path, chunk_bytes=16 << 10)
    return path


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("bag", F.regexp_extract("path", r"([^/]+)\.bag$", 1))


@query(_M + "SELECT bag, topic, message, ts_ns FROM n")
def bag_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic, number and time of every message of the events' bags, from index records alone."""
    return _named(rosbag.read_index(spark, _bags(spark, sf_dir), task_bytes=128 << 10)).select("bag", "topic", "message", "ts_ns")


@query(_M + f"SELECT bag, message, ts_ns, event_id, round(value, 6) AS value FROM n WHERE topic = '{TOPIC}' AND message >= {FIRST} AND message < {STOP}")
def bag_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A half-open range of messages of one topic of each bag, in order, reading only their chunks."""
    found = _named(rosbag.read_range(spark, _bags(spark, sf_dir), TOPIC, FIRST, STOP, task_bytes=32 << 10))
    text = F.split(F.decode("payload", "utf-8"), " ")
    return found.select("bag", "message", "ts_ns", text[0].cast("long").alias("event_id"), F.round(text[1].cast("double"), 6).alias("value"))


@query(_M + "SELECT bag, topic, message, event_id FROM n WHERE message % 100 = 7 AND topic = 'purchase' AND message < (SELECT min(c) FROM (SELECT count(*) AS c FROM n WHERE topic = 'purchase' GROUP BY bag))")
def bag_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hundredth purchase that all bags have, by random access."""
    path = _bags(spark, sf_dir)
    purchases = rosbag.read_index(spark, path, ["purchase"])
    fewest = purchases.groupBy("path").agg(F.max("message").alias("last")).agg(F.min("last").alias("last"))
    wanted = purchases.join(fewest, F.col("message") <= F.col("last")).where("message % 100 = 7").select("topic", "message").distinct()
    found = _named(rosbag.read_selected(spark, path, wanted))
    return found.select("bag", "topic", "message", F.split(F.decode("payload", "utf-8"), " ")[0].cast("long").alias("event_id"))
