"""Exports: records, grants, profiles and reports, always to a new folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "recordKey"


def record_lines(records: DataFrame) -> DataFrame:
    """``(record_key, record)``: the record as JSON text that keeps null fields."""
    names = [name for name in records.columns if name != KEY]
    return records.select(
        F.col(KEY).alias("record_key"),
        F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("record"),
    )


def write_record_lines(records: DataFrame, path: str) -> None:
    """One JSON object per line, ``{"record_key": …, "record": {…}}``."""
    names = [name for name in records.columns if name != KEY]
    line = F.struct(F.col(KEY).alias("record_key"), F.struct(*names).alias("record"))
    records.select(F.to_json(line, {"ignoreNullFields": "false"}).alias("value")).write.text(path)


def write_table(table: DataFrame, path: str, form: str = "parquet") -> None:
    """Grants, profiles, failures, findings or memory versions as parquet or JSON lines."""
    table.write.format(form).save(path)
