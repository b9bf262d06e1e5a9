"""The registered queries of the numbered operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import ann, bpe, fingerprints, licenses, packing, quality, resampling, simhash, substring_dedup, toxicity, url_filters, warc, whitening
from tallyward.llm.common import read_table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_random_indexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_filters.judge(url_filters.captures_of(pages), url_filters.entries_of(pages))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(read_table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(read_table(spark, sf_dir, "documents"), VOCABULARY)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(read_table(spark, sf_dir, "documents"), VOCABULARY, end_id=2, size=1024)


def op8_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_digests(read_table(spark, sf_dir, "documents"))


def op9_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), every=20, k=20)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op11_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten_embeddings(read_table(spark, sf_dir, "embeddings"), components=4)
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))  # null beyond a long


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(read_table(spark, sf_dir, "pages"), least_bytes=100)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), percent=10, least_words=20, runs=1, buckets=10_000, seed=2024)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_random_indexing, op2_closed_syncmers, op3_toxicity, op4_url_filters, op5_license_scan, op6_bpe, op7_best_fit_packing, op8_run_length_index, op9_cross_polytope, op10_simhash, op11_bit_sliced_whitening, op12_warc, op13_importance_resampling)}

ORACLE_SQL: dict[str, str] = {"op4_url_filters": url_filters.ORACLE_SQL, "op8_run_length_index": substring_dedup.ORACLE_SQL, "op12_warc": warc.ORACLE_SQL, "op13_importance_resampling": resampling.ORACLE_SQL}
