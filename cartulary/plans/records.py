"""Assembly of the output record, the same columns for both dialects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions import keys
from cartulary.functions.codes import map_code
from cartulary.functions.dates import normalise_date
from cartulary.functions.localised import DISTRIBUTION, LOCALISED, localised
from cartulary.functions.text import blank_to_null, strip, text_array
from cartulary.operators import contacts, identifiers, sharing, subjects
from cartulary.settings import DEFAULT_EDITION, LANGUAGE_CODES, PROGRESS_CODES, JobSettings

_PLATFORM = f"struct<description:{LOCALISED},id:string,type:string>"
_RESOURCE = (
    "struct<association_type:string,association_type_iso:string,authority:string,"
    f"code:string,title:{LOCALISED}>"
)


def _revised(settings: JobSettings) -> Column:
    if settings.as_of is not None:
        return F.lit(settings.as_of)
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def edition() -> Column:
    return F.coalesce(blank_to_null(strip(F.col("version"))), F.lit(DEFAULT_EDITION))


def comments_text() -> Column:
    """Purpose and supplement under headings; a missing one leaves its heading."""
    return F.concat(
        F.lit("## Purpose: "),
        F.coalesce("purpose", F.lit("")),
        F.lit("\n\n## Supplemental Information: "),
        F.coalesce("supplement", F.lit("")),
    )


def limitations_text() -> Column:
    return F.concat(
        F.coalesce("purpose", F.lit("")), F.lit("\n\n"), F.coalesce("supplement", F.lit(""))
    )


def bounding_box(description: Column) -> Column:
    return F.struct(
        localised(description).alias("description"),
        "north",
        "south",
        "east",
        "west",
        F.lit("").alias("polygon"),
    )


def box_numbers(records: DataFrame) -> DataFrame:
    """The bounds as text and as numbers; text that is no number gives null."""
    sides = ("north", "south", "east", "west")
    return records.select(
        "record_id",
        *sides,
        *[F.col(side).try_cast("double").alias(f"{side}_value") for side in sides],
    )


def associated_resource(settings: JobSettings) -> Column:
    """The entry in the source catalogue that this record equals."""
    return F.struct(
        F.lit("IsIdenticalTo").alias("association_type"),
        F.lit("crossReference").alias("association_type_iso"),
        F.lit("URL").alias("authority"),
        F.col("uri").alias("code"),
        localised(F.lit(settings.equivalent_title_en), F.lit(settings.equivalent_title_fr)).alias(
            "title"
        ),
    )


def _parameters(settings: JobSettings) -> dict[str, Column]:
    return {
        "userID": F.lit(settings.user),
        "category": F.lit("dataset"),
        "dateRevised": _revised(settings),
        "filename": F.col("file_name"),
        "history": _empty("string"),
        "lastEditedBy": F.struct(F.lit("").alias("displayName"), F.lit("").alias("email")),
        "license": F.lit(settings.license),
        "metadataScope": F.lit("Dataset"),
        "noTaxa": F.lit(True),
        "projects": text_array(settings.projects),
        "recordID": F.col("record_id"),
        "region": F.lit(settings.region),
        "resourceType": text_array(settings.resource_type),
        "sharedWith": sharing.shared_with(settings.shares),
        "status": F.lit(settings.status),
        "vertical": F.create_map().cast("map<string,string>"),
        "verticalExtentDirection": F.lit("depthPositive"),
        "verticalExtentMax": F.lit(None).cast("string"),
        "verticalExtentMin": F.lit(None).cast("string"),
    }


def _project(records: DataFrame, fields: dict[str, Column]) -> DataFrame:
    return records.select("recordKey", *[value.alias(name) for name, value in fields.items()])


def harmonise_iso(
    records: DataFrame,
    settings: JobSettings,
    registry: DataFrame | None = None,
    distribution: Column | None = None,
    stored: bool = False,
) -> DataFrame:
    """Output records from extracted records of the first dialect.

    Everything is row-local but the DOI lookup, which is left out without a ``registry``. Records of
    a ``stored`` table are read twice, and only their ids go to the registry. A column ``matched``
    holds the categories of records that were classified by a table; it replaces the vocabulary.
    """
    keyed = (
        records.withColumn(
            "recordKey", keys.record_key("iso", F.col("record_id"), settings.random_keys)
        )
        .withColumn("local_id", keys.local_id(F.col("uri")))
        .withColumn("contacts", contacts.iso_contacts(settings.house_names))
    )
    merged = contacts.merge_contacts(keyed)
    if registry is None:
        resolved = merged.withColumn("doi_url", F.lit(""))
    elif stored:
        located = records.select("record_id", keys.local_id(F.col("uri")).alias("local_id"))
        resolved = identifiers.resolve_stored_dois(merged, located, registry, settings.doi_prefixes)
    else:
        resolved = identifiers.resolve_dois(merged, registry, settings.doi_prefixes)
    stamped = normalise_date(F.col("date_stamp"))
    fields = _parameters(settings) | {
        "title": localised(F.col("title")),
        "abstract": localised(F.col("abstract")),
        "limitations": localised(F.lit("")),
        "contacts": F.col("contacts"),
        "created": stamped,
        "datasetIdentifier": F.col("doi_url"),
        "dateStart": normalise_date(F.col("begin")),
        "dateEnd": normalise_date(F.col("end")),
        "datePublished": stamped,
        "distribution": _empty(DISTRIBUTION) if distribution is None else distribution,
        "doiCreationStatus": F.lit(settings.doi_status),
        "edition": edition(),
        "eov": text_array(settings.categories)
        if settings.categories
        else subjects.or_default(F.col("matched"))
        if "matched" in records.columns
        else subjects.categories(subjects.theme_keywords(), settings.vocabulary),
        "identifier": keys.identifier(F.col("recordKey")),
        "keywords": F.struct(
            subjects.keyword_tokens().alias("en"), _empty("string").alias("fr")
        ),
        "language": map_code(F.col("language_code"), LANGUAGE_CODES),
        "comments": localised(comments_text()),
        "map": bounding_box(subjects.place_description()),
        "noPlatform": F.lit(True),
        "platforms": _empty(_PLATFORM),
        "progress": map_code(F.col("progress_code"), PROGRESS_CODES),
        "timeFirstPublished": stamped,
        "noVerticalExtent": F.lit(True),
        "associated_resources": F.array(associated_resource(settings)).cast(f"array<{_RESOURCE}>"),
    }
    return _project(resolved, fields)


def harmonise_fgdc(records: DataFrame, settings: JobSettings) -> DataFrame:
    """Output records from extracted records of the second dialect; fully row-local.

    Adds ``organization``; contacts are not merged and dates stay as written.
    """
    people = ("points_of_contact", "distributors", "maintainers")
    organisations = F.concat(*[F.col(section)["organisation"] for section in people])
    keyed = records.withColumn(
        "recordKey", keys.record_key("fgdc", F.col("record_id"), settings.random_keys)
    )
    platform = F.struct(
        localised(F.lit("")).alias("description"), F.lit("").alias("id"), F.lit("ship").alias("type")
    )
    fields = _parameters(settings) | {
        "organization": F.get(
            F.filter(organisations, lambda name: name.isNotNull()), F.lit(0)
        ),
        "title": localised(F.col("title")),
        "abstract": localised(F.col("abstract")),
        "limitations": localised(limitations_text()),
        "contacts": contacts.fgdc_contacts(),
        "created": F.col("published"),
        "datasetIdentifier": F.lit(None).cast("string"),
        "dateStart": F.col("begin"),
        "dateEnd": F.col("end"),
        "datePublished": F.col("published"),
        "dateRevised": F.col("revised"),
        "distribution": _empty(DISTRIBUTION),
        "doiCreationStatus": F.lit(""),
        "edition": F.lit(""),
        "eov": _empty("string"),
        "identifier": F.lit(None).cast("string"),
        "keywords": F.struct(subjects.fgdc_keywords().alias("en"), _empty("string").alias("fr")),
        "language": F.lit("en"),
        "map": bounding_box(F.lit("")),
        "noPlatform": F.lit(False),
        "platforms": F.array(platform).cast(f"array<{_PLATFORM}>"),
        "progress": F.lit("onGoing"),
        "timeFirstPublished": F.col("metadata_date"),
        "noVerticalExtent": F.lit(False),
        "verticalExtentMax": F.col("depth_max"),
        "verticalExtentMin": F.col("depth_min"),
    }
    return _project(keyed, fields)


def unified_catalogue(iso: DataFrame, fgdc: DataFrame) -> DataFrame:
    """Both dialects in one table with the dialect as a column."""
    return iso.withColumn("dialect", F.lit("iso")).unionByName(
        fgdc.withColumn("dialect", F.lit("fgdc")), allowMissingColumns=True
    )
