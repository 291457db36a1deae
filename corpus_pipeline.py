"""Corpus pipeline: documents -> cleaned, mixed and sharded training documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import stages
from shelfcast.llm.common import materialize

STAGES = [
    ("quality", stages.quality),
    ("simhash", stages.simhash),
    ("decontaminate", stages.decontaminate),
    ("mix", stages.mix),
    ("shard", stages.shard),
]

# No SQL form: fitted scores, fingerprints, BM25 retrieval and the scheduling
# heap are not SQL-expressible; tests/llm/test_pipeline.py holds the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
