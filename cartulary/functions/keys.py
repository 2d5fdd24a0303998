"""Identifiers and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartulary.functions.text import after_last
from cartulary.settings import IDENTIFIER_PREFIX


def record_key(dialect: str, record_id: Column, random: bool = False) -> Column:
    """A stable key per dialect and record, or a random one."""
    if random:
        return F.replace(F.uuid(), F.lit("-"), F.lit(""))
    return F.md5(F.concat_ws("-", F.lit(dialect), record_id))


def identifier(key: Column) -> Column:
    """The key as a prefixed, dashed identifier."""
    dashed = F.regexp_replace(key, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.concat(F.lit(IDENTIFIER_PREFIX), dashed)


def local_id(uri: Column) -> Column:
    """The catalogue's own number, after the last ``=`` of the address."""
    return after_last(uri, "=")


def record_id(file_name: Column, dialect: str) -> Column:
    """A file's path without its dialect's ending, ``_iso.xml`` or ``_fgdc.xml``; others stay as they are."""
    return F.regexp_replace(file_name, rf"_{dialect}\.xml\z", "")


def document_id(file_name: Column, dialect: str) -> Column:
    """The id of the record in a file: its path without the dialect's ending, or else without ``.xml``."""
    own = F.endswith(file_name, F.lit(f"_{dialect}.xml"))
    return F.when(own, record_id(file_name, dialect)).otherwise(F.regexp_replace(file_name, r"\.xml\z", ""))


def file_name(record_id: Column, dialect: str) -> Column:
    return F.format_string(f"%s_{dialect}.xml", record_id)


def harvest_url(base: str, record_id: Column, dialect: str) -> Column:
    return F.format_string(f"{base.rstrip('/')}/{dialect}/%s_{dialect}.xml", record_id)


def translation_key(text: Column, source: Column, target: Column) -> Column:
    """The key a translation is remembered under."""
    return F.md5(F.concat_ws("-", text, source, target))
