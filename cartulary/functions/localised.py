"""Localised text: ``struct<en, fr, translations>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRANSLATIONS = "struct<fr:struct<message:string,verified:boolean>>"
LOCALISED = f"struct<en:string,fr:string,translations:{TRANSLATIONS}>"
DISTRIBUTION = f"struct<description:{LOCALISED},name:{LOCALISED},url:{LOCALISED}>"


def localised(en: Column | None, fr: Column | None = None, notice: Column | None = None) -> Column:
    none = F.lit(None)
    return F.struct(
        (none if en is None else en).cast("string").alias("en"),
        (none if fr is None else fr).cast("string").alias("fr"),
        (none if notice is None else notice).cast(TRANSLATIONS).alias("translations"),
    )


def distribution(description: Column, name: Column, url: Column) -> Column:
    """One way to get the data, as three localised texts."""
    return F.struct(
        localised(description).alias("description"),
        localised(name).alias("name"),
        localised(url).alias("url"),
    )
