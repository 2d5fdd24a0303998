"""Adding new records to an existing export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class KeyCollision(ValueError):
    """New records carry keys that the export already has."""


def colliding_keys(existing: DataFrame, new: DataFrame, key: str = "record_key") -> DataFrame:
    """Distinct keys on both sides. Both are reduced to distinct keys before they meet."""
    return (
        new.select(key).distinct().join(existing.select(key).distinct(), key, "left_semi")
    )


def refuse_repeated_keys(records: DataFrame, key: str = "record_key") -> None:
    """Stops when two records of one batch have the same key."""
    if not records.groupBy(key).count().where("count > 1").isEmpty():
        raise KeyCollision("two records of the batch have the same key")


def append_records(existing: DataFrame, new: DataFrame, key: str = "record_key") -> DataFrame:
    """The union of both, refused as a whole when any key is on both sides."""
    if not colliding_keys(existing, new, key).isEmpty():
        raise KeyCollision("records with the same key already exist in the export")
    return existing.unionByName(new, allowMissingColumns=True)


def latest(table: DataFrame, key: str, number: str) -> DataFrame:
    """The rows of each key's highest run number; rows without a key or a number stay.

    Only keys that stand in several runs meet the rows, so with few changes no row moves: the
    optimizer broadcasts the list while it is small.
    """
    runs = table.groupBy(F.col(key).alias("_key")).agg(F.max(number).alias("_last"), F.min(number).alias("_first"))
    changed = runs.where(F.col("_first") < F.col("_last")).select("_key", "_last")
    return table.join(changed, (F.col(key) == F.col("_key")) & (F.col(number) < F.col("_last")), "left_anti")
