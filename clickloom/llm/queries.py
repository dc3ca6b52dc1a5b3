"""The registered query of each operator: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    decontaminate, fim, hardneg, lm, near, packing, pii, quality, sharding, suffix, topk, toxicity, warc)
from clickloom.llm.common import documents, ship


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(documents(spark, sf_dir), length=200, text=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.kd_shards(documents(spark, sf_dir), shards=8)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    r = F.col("response")
    return warc.round_trip(pages).select(
        warc.field("page-id").cast("long").alias("page_id"),
        F.coalesce(r["payload_bytes"], r["http_length"]).alias("payload_bytes"),
        F.coalesce(r["payload_digest"], F.substring_index(r["header_digest"], ":", -1))
        .alias("payload_digest"),
        r["warc_type"].alias("record_type"),
        warc.field("revisited-page-id").cast("long").alias("refers_to"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.score(docs, quality.train(docs, labels)).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(docs, toxicity.train(docs, labels)).withColumn(
        "predicted", (F.col("score") >= 0.7).cast("int"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=20)


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(documents(spark, sf_dir), benchmark)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(vectors.withColumn("label", label))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    output, form = F.col("output"), F.col("form")
    return fim.fill_in_middle(documents(spark, sf_dir)).select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"), F.sha2(output.cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restored(output, form).cast("binary"), 256).alias("restored_sha256"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    counts = [pii.count_of(spans, kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return pii.personal_data(documents(spark, sf_dir), keep=["doc_id"]).select(
        "doc_id", *counts, F.sha2(pii.digest(spans, base_only=True).cast("binary"), 256).alias("base_sha256"),
        pii.digest(spans).alias("spans"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_suffix_array_dedup": op1_suffix_array_dedup,
        "op2_kd_sharding": op2_kd_sharding,
        "op3_warc": op3_warc,
        "op4_quality": op4_quality,
        "op5_toxicity": op5_toxicity,
        "op6_exact_top_k": op6_exact_top_k,
        "op7_order_minhash": op7_order_minhash,
        "op8_packing": op8_packing,
        "op9_language_model": op9_language_model,
        "op10_decontamination": op10_decontamination,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_personal_data": op13_personal_data,
    }

    def shipped(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(ship(spark), sf_dir)

    return {name: shipped(query) for name, query in found.items()}
