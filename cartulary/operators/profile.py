"""Profiling an attribute over a whole corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _values(attribute: str | Column) -> Column:
    return F.col(attribute) if isinstance(attribute, str) else attribute


def distinct_values(records: DataFrame, attribute: str | Column) -> DataFrame:
    """Distinct values of an array attribute with the number of occurrences."""
    return (
        records.select(F.explode(_values(attribute)).alias("value"))
        .groupBy("value")
        .agg(F.count("*").alias("occurrences"))
    )


def values_by_file(records: DataFrame, attribute: str | Column) -> DataFrame:
    """File -> its values, in document order. Each record brings its own array: no shuffle."""
    return records.select("file_name", _values(attribute).alias("values"))


def profile_column(table: DataFrame, column: str) -> DataFrame:
    """The same profile for a scalar column of any table."""
    return (
        table.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count("*").alias("occurrences"))
    )
