"""The stages of the corpus pipeline (see corpus_pipeline.py at the top)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import decontam, mixing, sharding
from shelfcast.llm import quality as quality_op
from shelfcast.llm import simhash as simhash_op


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts (score of at least ``KEEP_AT``)."""
    model = quality_op.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_op.accepted(docs, model)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component, decided by row: the first by doc_id (nulls last), then by a hash of id and text.

    Rows that repeat the kept one's doc_id and text are the same document and
    become one row. Rows of different texts under one doc_id are different
    documents.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), text))
    found = simhash_op.near_duplicates(docs, key=key)
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")).alias("r"))
    keep = first.select(F.col("r.row_key").alias("_key"))
    return docs.withColumn("_key", key).join(keep, "_key", "left_semi").dropDuplicates(["_key"]).drop("_key")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item, those without a doc_id too."""
    return decontam.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, documents of the smaller sources again as their weight asks."""
    return mixing.repeat_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard 0 to 7; equal texts share a shard."""
    return sharding.assign_shards(docs, n_shards=8)
