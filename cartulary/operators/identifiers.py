"""Resolving local ids to DOIs against a registry table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.operators.lookup import adaptive_lookup
from cartulary.settings import DOI_PREFIXES, DOI_RESOLVER


def best_dois(registry: DataFrame, prefixes: Sequence[str] = DOI_PREFIXES) -> DataFrame:
    """``(local_id, doi_url)``: for each registered id the DOI with the earliest prefix.

    Choosing on the registry side leaves one row per id, so the records need a single join
    whatever the number of prefixes.
    """
    if any("/" in prefix for prefix in prefixes):
        raise ValueError("a DOI prefix has no slash")
    prefix = F.substring_index("doi", "/", 1)
    listed = registry.where(prefix.isin(list(prefixes))).select(
        F.expr("substring(doi, instr(doi, '/') + 1)").alias("local_id"),
        F.array_position(F.array(*map(F.lit, prefixes)), prefix).alias("priority"),
    )
    chosen = F.element_at(F.array(*map(F.lit, prefixes)), F.col("priority").cast("int"))
    return (
        listed.groupBy("local_id")
        .agg(F.min("priority").alias("priority"))
        .select("local_id", F.concat(F.lit(DOI_RESOLVER), chosen, F.lit("/"), "local_id").alias("doi_url"))
    )


def resolve_dois(
    records: DataFrame, registry: DataFrame, prefixes: Sequence[str] = DOI_PREFIXES
) -> DataFrame:
    """Add ``doi_url`` to records with a ``local_id``; an empty text when none is registered.

    The only shuffle of the records, and none when the registry is small enough for a
    broadcast. Ids that many records share are left to adaptive execution, which splits
    their partition: the registry side has one row per id.
    """
    found = adaptive_lookup(records, best_dois(registry, prefixes), "local_id", "record_id")
    return found.withColumn("doi_url", F.coalesce("doi_url", F.lit("")))


def resolve_stored_dois(
    records: DataFrame, located: DataFrame, registry: DataFrame, prefixes: Sequence[str] = DOI_PREFIXES
) -> DataFrame:
    """Add ``doi_url`` to records of a stored table, as ``resolve_dois`` does, without moving them.

    ``located`` holds ``record_id`` and ``local_id`` of the same table, read a second time: these two
    go to the registry, and what is found comes back by ``record_id``, by which the table should be
    bucketed.
    """
    answers = (
        adaptive_lookup(located.select("record_id", "local_id"), best_dois(registry, prefixes), "local_id", "record_id")
        .where(F.col("doi_url").isNotNull())
        .select("record_id", "doi_url")
    )
    return records.join(answers, "record_id", "left").withColumn("doi_url", F.coalesce("doi_url", F.lit("")))
