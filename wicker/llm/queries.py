"""The queries of this subpackage, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, flac, license_scan, mixing, packing, periodic, quality_mil, quality_rules, secret_scan, simhash, suffix_dedup, token_counts, token_files
from .common import documents, shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source")
    return mixing.mix(docs)


def op2_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.media_digests(flac.store_texts(documents(spark, sf_dir)))


def media_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every PCM block of the stored texts, with its sample offset and digest."""
    found = flac.pcm_blocks(flac.store_texts(documents(spark, sf_dir)))
    return found.select("doc_id", "sample_offset", "n_samples", F.sha2("pcm", 256).alias("pcm_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), packing.Limits())


def packed_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole conversations as instruction data: all three limits bind."""
    vocab = public_tokenizers.path("byte_bpe_50k.json")
    examples = packing.conversation_examples(table(spark, sf_dir, "conversations"), vocab)
    return packing.pack_examples(examples, packing.Limits(8192, 8, 6144), "conv_id", "tokens", "loss")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(documents(spark, sf_dir))


def op9_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_mil.score_documents(docs, quality_mil.fit(docs, table(spark, sf_dir, "labels")))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/tokens/{uuid.uuid4().hex}"
    return token_files.token_file_digests(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.collapse_runs(documents(spark, sf_dir), plant=True)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_mixing, op2_flac_media, media_blocks, op3_token_counts, op4_simhash, op5_quality_rules, op6_packing,
    packed_conversations, op7_suffix_dedup, op8_secret_scan, op9_quality_mil, op10_license_scan, op11_token_files, op12_periodic_runs, op13_centroids)}
ORACLES: dict[str, str] = {"op5_quality_rules": quality_rules.ORACLE, "op13_centroids": centroids.oracle()}
