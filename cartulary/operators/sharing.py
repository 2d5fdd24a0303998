"""Sharing grants: ``(person, user_id, record_key, shared)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.text import text_array
from cartulary.operators.lookup import HOT_ROWS, salted_lookup

GRANT = ("person", "user_id", "record_key", "shared")


def people(persons: Sequence[str] | Column) -> Column:
    """Distinct, non-empty persons as an array."""
    listed = persons if isinstance(persons, Column) else text_array(persons)
    return F.array_distinct(F.filter(listed, lambda person: person != ""))


def shared_with(persons: Sequence[str] | Column) -> Column:
    """The persons as a ``person -> true`` map."""
    return F.map_from_entries(
        F.transform(people(persons), lambda person: F.struct(person, F.lit(True)))
    ).cast("map<string,boolean>")


def share_grants(records: DataFrame, persons: Sequence[str] | Column) -> DataFrame:
    """Every person gets every record of ``(user_id, record_key)``; row-local."""
    return records.select(
        F.explode(people(persons)).alias("person"),
        "user_id",
        "record_key",
        F.lit(True).alias("shared"),
    )


def append_shares(
    existing: DataFrame, new: DataFrame, mode: str = "replace", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Existing grants with new ones added.

    ``replace``: a person's grants from a user give way to the new ones for the same pair;
    pairs without new grants stay. ``merge``: both stay.

    The existing grants meet distinct pairs only, and a pair that holds many grants is
    spread over several tasks.
    """
    existing, new = existing.select(*GRANT), new.select(*GRANT)
    if mode == "merge":
        return existing.unionByName(new).distinct()
    if mode != "replace":
        raise ValueError(f"unknown mode {mode!r}")
    pairs = new.select("person", "user_id").distinct()
    kept = salted_lookup(
        existing, pairs, ["person", "user_id"], "record_key", "left_anti", hot_rows
    )
    return kept.select(*GRANT).unionByName(new)
