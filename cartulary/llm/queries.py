"""The registered queries: each applies one operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm import (
    counting, decontamination, extraction, jaccard, language, licences, negatives, neighbours, packing, suffixes, toxicity, warc, whitening,
)
from cartulary.llm.common import package_on_workers


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    package_on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_read(spark, sf_dir, "pages"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    router = neighbours.fit(neighbours.usable(vectors))
    return neighbours.search(spark, vectors, vectors.where("vec_id % 100 = 0"), router=router)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Passages of over fifty words go from the text too; the counts and the digest are of strings of 400 bytes.
    return suffixes.deduplicate(_read(spark, sf_dir, "documents"), words=51)


def op5_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    edited = counting.sample_edits(_read(spark, sf_dir, "documents"))
    return counting.count(edited, _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_read(spark, sf_dir, "documents")).drop("text", "_row")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.captures(spark, _read(spark, sf_dir, "pages"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.links(spark, _read(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, _read(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, _read(spark, sf_dir, "embeddings"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(spark, _read(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(_read(spark, sf_dir, "documents"))
    return found.withColumn("n_spans", F.size("spans")).drop("spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_extraction": op1_extraction,
    "op2_neighbours": op2_neighbours,
    "op3_toxicity": op3_toxicity,
    "op4_suffixes": op4_suffixes,
    "op5_counting": op5_counting,
    "op6_language": op6_language,
    "op7_warc": op7_warc,
    "op8_jaccard": op8_jaccard,
    "op9_decontamination": op9_decontamination,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_negatives": op12_negatives,
    "op13_licences": op13_licences,
}

ORACLES: dict[str, str] = {
    "op7_warc": warc.ORACLE,
    "op9_decontamination": decontamination.ORACLE,
    "op12_negatives": negatives.ORACLE,
}
