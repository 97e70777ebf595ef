"""The registered queries of this subpackage, with the parameters used in production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, licences, oracles, packing, quality, recurrent, sharding, simhash, tiff, toxicity

SHARDS = 8


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_dynamic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op2_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.media_digest(documents(spark, sf_dir))


def op5_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op9_licence_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(documents(spark, sf_dir))


def op3_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op4_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent.score(documents(spark, sf_dir))


def op6_simhash_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op7_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), labels(spark, sf_dir))


def op10_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(documents(spark, sf_dir), labels(spark, sf_dir))


def op8_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_manifest(documents(spark, sf_dir), "doc_id", "text", SHARDS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_dynamic_packing": op1_dynamic_packing,
    "op2_tiff_media": op2_tiff_media,
    "op3_prefix_decontamination": op3_prefix_decontamination,
    "op4_recurrent_scores": op4_recurrent_scores,
    "op5_chat_repair": op5_chat_repair,
    "op6_simhash_vantage_point": op6_simhash_vantage_point,
    "op7_neighbour_quality": op7_neighbour_quality,
    "op8_jump_sharding": op8_jump_sharding,
    "op9_licence_dice": op9_licence_dice,
    "op10_compression_toxicity": op10_compression_toxicity,
}
ORACLES: dict[str, str] = {
    "op3_prefix_decontamination": oracles.DECONTAMINATION,
    "op8_jump_sharding": oracles.SHARDING,
    "op9_licence_dice": oracles.licences(licences.TEMPLATES, licences.THRESHOLD),
}
