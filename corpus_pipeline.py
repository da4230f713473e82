"""A training corpus from ``documents``: five stages, each written as Parquet and read again by the next.

1. language: documents in no language the corpus teaches (no letters, or as far from every profile) go.
2. near duplicates: of documents linked by five-word shingles at a similarity of 0.8, the smallest id stays.
3. decontamination: documents that hold a benchmark item go.
4. mixing: sources are brought to their target weights; a document stands as often as the mix takes it.
5. sharding: the mix is dealt into shards of near-equal bytes, with a position in each.

All stages but the last return the columns of ``documents``.  Rows without doc_id pass the second and third stage
unless the third finds them contaminated; null or empty texts go in the first; empty tables stay empty; repeated rows
are kept or dropped together until the mix repeats documents itself."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.llm import langid, ngram_jaccard, pareto_mix, splitters, string_tiling
from larkspur.llm.common import shared_dir

#: Share of the profiles' ranks that a document must meet; prose of a taught language scores above 0.4.
MIN_SCORE = 0.15
SHINGLE, PERCENT = 5, 80

#: Language identification has no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def _whole(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with each row also as one struct, under a name that no column has: whatever an operator adds or replaces,
    the row comes out as it went in."""
    name = "row"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, F.struct(*[F.col(f"`{c}`") for c in docs.columns])), name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    profiles = langid.train(docs.where(~F.coalesce(langid.held_out(F.col("doc_id")), F.lit(True))))
    rows, whole = _whole(docs)
    found = langid.predict(rows.select("text", whole), profiles, keep=[whole])
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE)).select(f"{whole}.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_jaccard.near_duplicates(docs.select("doc_id", "text"), SHINGLE, PERCENT)
    return docs.join(found.where("doc_id <> component_id").select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Items shorter than a seed are no evidence of a leak: a document may well hold one common word."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = string_tiling.contaminated(docs.select("doc_id", "text"), bench).where(F.col("item_words") >= string_tiling.K)
    found = found.select("doc_id").distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"]), "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, whole = _whole(docs)
    mixed = pareto_mix.mix(rows.select("doc_id", "text", "source", whole))
    return mixed.where("copies > 0").select(F.explode(F.array_repeat(whole, F.col("copies").cast("int"))).alias("row")).select("row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return splitters.shard(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix),
          ("shard", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
