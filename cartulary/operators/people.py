"""Person names kept as a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.functions.names import name_words, person_name
from cartulary.operators.lookup import HOT_ROWS, salted_lookup


def standardise_names(
    table: DataFrame, text: str, house_names: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Add the standardised ``name``; the list of house names is a literal."""
    return table.withColumn("name", person_name(F.col(text), house_names))


def standardise_names_by_table(
    table: DataFrame, text: str, houses: DataFrame, spread: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The same with a ``(full, parts)`` table of house names of any size.

    A house that signs a large share of the rows is a hot key, so the lookup salts it.
    """
    whole = table.withColumn("_whole", F.array_join(name_words(F.col(text)), " "))
    known = houses.select(F.col("full").alias("_whole"), F.col("parts").alias("_parts"))
    found = salted_lookup(whole, known, "_whole", spread, hot_rows=hot_rows)
    named = found.withColumn("name", person_name(F.col(text), {}, F.col("_parts")))
    return named.select(*table.columns, "name")
