"""Planning a harvest and reporting what failed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.functions.keys import file_name, harvest_url

HTTP_OK = 200


def worklist(
    wanted: DataFrame, present: DataFrame, base_url: str, dialect: str, overwrite: bool = False
) -> DataFrame:
    """Ids still to fetch, each once, with target file and address."""
    ids = wanted.select("record_id").where(F.col("record_id").isNotNull()).distinct()
    if not overwrite:
        ids = ids.join(present.select("record_id").distinct(), "record_id", "left_anti")
    return ids.select(
        "record_id",
        file_name(F.col("record_id"), dialect).alias("file_name"),
        harvest_url(base_url, F.col("record_id"), dialect).alias("url"),
    )


def failures(statuses: DataFrame) -> DataFrame:
    """Fetches that did not succeed."""
    return statuses.where(F.col("status").isNull() | (F.col("status") != HTTP_OK)).select(
        "record_id", "url", "status"
    )


def summary(statuses: DataFrame) -> DataFrame:
    """Totals of one harvest."""
    ok = F.col("status").eqNullSafe(HTTP_OK)
    return statuses.agg(
        F.count("*").alias("attempted"),
        F.count_if(ok).alias("fetched"),
        F.count_if(~ok).alias("failed"),
    )
