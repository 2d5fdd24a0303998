"""The jobs a user runs: plan a harvest, convert a corpus, inspect an attribute."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartulary.operators import appending, harvest, profile, quality, sharing, subjects, translation
from cartulary.plans import records as plans
from cartulary.settings import JobSettings
from cartulary.sinks import versions
from cartulary.sinks.exports import write_record_lines, write_table
from cartulary.sources.documents import land, landed_records, present_records, read_documents
from cartulary.sources.exports import read_export
from cartulary.staging import staging

log = logging.getLogger(__name__)


def plan_harvest(
    spark: SparkSession,
    wanted: DataFrame,
    folder: str,
    base_url: str,
    dialect: str,
    overwrite: bool = False,
) -> DataFrame:
    """The files to fetch into ``folder`` for the wanted record ids."""
    if wanted.isEmpty():
        log.warning("no record ids to harvest")
    present = present_records(spark, folder, dialect)
    return harvest.worklist(wanted, present, base_url, dialect, overwrite)


def report_harvest(statuses: DataFrame, target: str) -> None:
    """Write failures, their findings and the totals of a finished harvest."""
    failed = harvest.failures(statuses)
    write_table(failed, f"{target}/failed")
    write_table(quality.fetch_findings(failed), f"{target}/findings")
    write_table(harvest.summary(statuses), f"{target}/summary", "json")


def harmonise(
    landed: DataFrame, dialect: str, settings: JobSettings, registry: DataFrame | None = None
) -> DataFrame:
    """Output records of a landed corpus: a stored table, bucketed by ``record_id``."""
    usable = landed_records(landed)
    if dialect == "iso":
        return plans.harmonise_iso(usable, settings, registry, stored=True)
    return plans.harmonise_fgdc(usable, settings)


def record_schema(spark: SparkSession, dialect: str) -> StructType:
    """The columns of the dialect's output records."""
    nothing = spark.createDataFrame([], "file_name string, value string, record_id string")
    return harmonise(land(nothing, dialect), dialect, JobSettings()).schema


def grants(records: DataFrame, settings: JobSettings) -> DataFrame:
    owned = records.select(
        F.col("userID").alias("user_id"), F.col("recordKey").alias("record_key")
    )
    return sharing.share_grants(owned, settings.shares)


def convert(
    spark: SparkSession,
    source: str,
    target: str,
    dialect: str = "iso",
    settings: JobSettings = JobSettings(),
    registry: DataFrame | None = None,
    memory: DataFrame | None = None,
    append_to: tuple[DataFrame, DataFrame] | None = None,
    share_mode: str = "replace",
    returned: DataFrame | None = None,
    vocabulary: DataFrame | None = None,
) -> None:
    """Convert a folder of XML files into the tables of an export below ``target``.

    ``records`` (parquet), ``record_lines`` (JSON lines), ``shares``, ``findings`` and
    ``rejected``; with a translation ``memory`` also ``pending``, the texts it lacks, and with
    ``returned`` translations ``memory``, the memory that has them too. ``append_to`` holds the
    records and grants of an earlier export; when any key is on both sides, or twice among the new
    records, the job stops before it writes anything. A ``vocabulary`` table of ``category, term``, of
    any size, replaces the one of the settings: keywords go to it, and categories come back to the
    records (first dialect; the second has no categories).

    The corpus is parsed once, into a staged table that every later step reads. It is bucketed by
    record, and so are the records made of it: identifiers and translations come to them by joins
    that move keys and answers only. Staged tables are removed at the end.
    """
    with staging(spark) as keep:
        landed = keep(land(read_documents(spark, source, dialect), dialect), by="record_id")
        if vocabulary is not None and dialect == "iso":
            themes = landed_records(landed).select("record_id", subjects.theme_keywords().alias("keywords"))
            matched = keep(subjects.matched_by_table(themes, vocabulary), by="record_id")
            landed = landed.join(matched, "record_id", "left")
        records = harmonise(landed, dialect, settings, registry)
        fields = [name for name in translation.TRANSLATED_FIELDS if name in records.columns]
        fields += translation.TRANSLATED_DISTRIBUTION
        if memory is not None:
            if returned is not None:
                memory = keep(translation.update_memory(memory, returned))
            records = translation.with_field_keys(records, fields)
        records = keep(records, by="recordID", dealt=True)
        appending.refuse_repeated_keys(records, "recordKey")
        shares = grants(records, settings)
        if memory is not None:
            texts = translation.field_texts(records, fields)
            pending = translation.pending(translation.with_keys(texts), memory, ("recordKey", "field", "position"))
            records = translation.translate_records(records, memory, key="recordID", fields=fields)
        if append_to is not None:
            old_records, old_shares = append_to
            records = appending.append_records(old_records, records, key="recordKey")
            shares = sharing.append_shares(old_shares, shares, share_mode)
        write_table(records, f"{target}/records")
        written = spark.read.parquet(f"{target}/records")
        write_record_lines(written, f"{target}/record_lines")
        write_table(shares, f"{target}/shares")
        rejected = landed.where("malformed").select("record_id", "file_name", "problem", "rejected")
        write_table(rejected, f"{target}/rejected")
        write_table(findings(landed, dialect, settings), f"{target}/findings")
        if memory is not None:
            write_table(pending, f"{target}/pending")
            if returned is not None:
                write_table(memory, f"{target}/memory")


def extend_export(
    spark: SparkSession,
    source: str,
    export: str,
    dialect: str = "iso",
    settings: JobSettings = JobSettings(),
    **options: DataFrame | str | None,
) -> None:
    """Convert a folder into the next version of an export, which holds the earlier records too.

    All tables of the version come into sight together, after the last is written; until then, and
    if the job fails, readers see the version before. ``options`` are those of ``convert``.
    """
    with versions.next_version(spark, export) as version:
        earlier = read_export(spark, version.before, record_schema(spark, dialect)) if version.before else None
        convert(spark, source, version.folder, dialect, settings, append_to=earlier, **options)


def findings(landed: DataFrame, dialect: str, settings: JobSettings) -> DataFrame:
    """Data-quality findings of a landed corpus, malformed documents included."""
    if dialect == "iso":
        return quality.iso_findings(landed, settings.house_names, settings.vocabulary)
    return quality.fgdc_findings(landed)


def inspect(landed: DataFrame, attribute: str = "keywords", by_file: bool = False) -> DataFrame:
    """Values of an attribute over a landed corpus: distinct with counts, or per file.

    ``keywords`` are the theme keywords; any other extracted text column works too.
    """
    usable = landed_records(landed)
    if attribute == "keywords":
        values = (
            subjects.theme_keywords() if "keyword_groups" in landed.columns else F.col("theme_keys")
        )
    else:
        values = F.array_compact(F.array(attribute))
    return (
        profile.values_by_file(usable, values) if by_file else profile.distinct_values(usable, values)
    )
