"""Identifier lists, curated lists and vocabularies kept as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the column of an identifier list unless told otherwise.
ID_COLUMN = "ccin_ref_number"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, JSON lines, or parquet, by suffix; CSV values stay text."""
    if path.endswith(".csv"):
        return spark.read.csv(path, header=True)
    if path.endswith((".json", ".jsonl")):
        return spark.read.json(path)
    return spark.read.parquet(path)


def identifiers(table: DataFrame, column: str = ID_COLUMN) -> DataFrame:
    """One column of a table as record ids."""
    return table.select(F.col(column).cast("string").alias("record_id"))


def identifier_list(spark: SparkSession, ids: Sequence[str]) -> DataFrame:
    """Ids given by hand."""
    return spark.createDataFrame([(str(value),) for value in ids], "record_id string")


def tagged_union(confirmed: DataFrame, candidates: DataFrame, tag: str = "status") -> DataFrame:
    """Two curated lists stacked, each row tagged with the list it came from."""
    return confirmed.withColumn(tag, F.lit("confirmed")).unionByName(
        candidates.withColumn(tag, F.lit("candidate")), allowMissingColumns=True
    )
