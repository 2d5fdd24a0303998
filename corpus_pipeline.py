"""From documents to packed training sequences: every stage works on all rows that the last one left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartulary.llm import decontamination, jaccard, language, packing, suffixes
from cartulary.llm.common import package_on_workers, stored

TOKENIZER = "word_bpe_49k.json"
#: Bytes of a repeated string; words of a repeated passage that may have fewer bytes.
REPEATED_BYTES = 240
REPEATED_WORDS = 51
ANCHOR_BYTES = 48


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    package_on_workers(spark)
    return language.keep_known(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that n-gram similarity links: five words, 0.8 or more."""
    package_on_workers(spark)
    return jaccard.keep_one(spark, docs, words=5, per_cent=80)


def remove_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that long repeated strings cover, or repeated passages of over fifty words."""
    package_on_workers(spark)
    return suffixes.without_repeats(docs, window=REPEATED_BYTES, anchor=ANCHOR_BYTES, words=REPEATED_WORDS)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    package_on_workers(spark)
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences."""
    import public_tokenizers

    package_on_workers(spark)
    return packing.pack(spark, docs, str(public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("language", keep_known_languages),
    ("near copies", keep_one_of_near_copies),
    ("repeated strings", remove_repeated_strings),
    ("decontamination", remove_contaminated),
    ("packing", pack_sequences),
]

#: Trained models, suffix arrays and tokenizers are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
