"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import table
from . import (countmin_dedup, cross_polytope, langid, merkle, ngram_jaccard, pareto_mix, ppm, rtree, splitters, string_tiling,
               surrogates, url_filter, warc)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "pattern")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = pareto_mix.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitters.digest(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = surrogates.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "n_entities", "entity_types")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return countmin_dedup.dedup(table(spark, sf_dir, "documents"), texts=False).drop("kept_text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.leaf(*map(F.col, fields[:-1]), lowered))
    rows = merkle.manifest(table(spark, sf_dir, "documents"), "doc_id", "source", fields, tampered)
    folded = merkle.fold(F.coalesce("claim", "leaf"), F.col("path"))
    return (rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rtree.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_url_filter, op3_ngram_jaccard, op4_source_mix, op5_sharding, op6_warc, op7_surrogates,
    op8_decontamination, op9_embedding_dedup, op10_substring_dedup, op11_merkle_manifest, op12_hard_negatives, op13_lm_scoring)}
