"""A training corpus from ``documents``: quality rules, near-duplicates, decontamination, secrets, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinestream.llm import queries
from kinestream.llm.common import written

STAGES = [
    ("quality rules", queries.quality_stage),
    ("near-duplicates", queries.near_duplicate_stage),
    ("benchmark decontamination", queries.decontamination_stage),
    ("secret scans", queries.secret_stage),
    ("BPE encoding and decoding", queries.encoding_stage),
]

#: The quality rules' field is fitted by gradient steps, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
