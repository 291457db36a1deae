"""The registered ``opN_<name>`` queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    codes, decontam, embdedup, langid, licenses, linededup, mixing, pii, quality, sharding, simhash, tokens, whitening,
)
from shelfcast.llm.common import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    predicted = langid.predict(docs, langid.fit(docs))
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.predict(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= quality.KEEP_AT).cast("int").alias("predicted"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embdedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    joined = {c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",") for c in ("base", "spans")}
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS bigint) AS n_{k}") for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined["base"], 256).alias("base_sha256"), joined["spans"].alias("spans"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors)).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = codes.fit(_table(spark, sf_dir, "embeddings"))
    coded = codes.with_label_error(codes.encode(model))
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"),
                        *[F.expr(f"try_cast({c} AS bigint)").alias(c) for c in ("error", "label_error")],
                        F.lit(model.digest).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_licenses": op2_licenses,
    "op3_simhash": op3_simhash,
    "op4_line_dedup": op4_line_dedup,
    "op5_mixing": op5_mixing,
    "op6_decontaminate": op6_decontaminate,
    "op7_quality": op7_quality,
    "op8_sharding": op8_sharding,
    "op9_embeddings": op9_embeddings,
    "op10_tokens": op10_tokens,
    "op11_personal_data": op11_personal_data,
    "op12_whitening": op12_whitening,
    "op13_codes": op13_codes,
}

ORACLE: dict[str, str] = {
    "op4_line_dedup": linededup.ORACLE,
    "op13_codes": codes.oracle(),
}
