"""Registered queries: every operator over the driver tables, flat columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.functions import citation, dates, keys
from cartulary.functions.codes import map_code, map_role
from cartulary.functions.localised import distribution
from cartulary.operators import (
    appending,
    contacts,
    harvest,
    identifiers,
    people,
    profile,
    quality,
    sharing,
    subjects,
    translation,
)
from cartulary.plans import records as plans
from cartulary.settings import LANGUAGE_CODES, PROGRESS_CODES, JobSettings
from cartulary.sinks.exports import record_lines
from cartulary.sources import documents as sources
from cartulary.sources.lists import tagged_union as stack_lists
from cartulary.staging import stage
from cartulary.vocabulary import vocabulary_table
from cartulary.workload import corpus

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = JobSettings(
    user="keeper",
    region="north",
    shares=("ana", "ben", "", "ana"),
    doi_prefixes=("10.21963", "10.5555"),
    house_names=corpus.HOUSE_NAMES,
    as_of="2024-01-01T00:00:00Z",
)
HARVEST_BASE = "https://records.example.org/xml"
EXPORT_CUT = "1997-01-01"
OVERLAP_FROM = "1996-01-01"


# Inputs


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str, dialect: str) -> DataFrame:
    return sources.identify(corpus.corpus(spark, sf_dir, dialect), dialect)


def _iso(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return sources.extract(_documents(spark, sf_dir, "iso"), "iso", columns or None)


def _fgdc(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return sources.extract(_documents(spark, sf_dir, "fgdc"), "fgdc", columns or None)


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as registered DOIs: finished under one prefix, open under another, rest both."""
    one, other = F.lit("10.21963"), F.lit("10.5555")
    status = F.col("o_orderstatus")
    prefixes = F.when(status == "F", F.array(one)).when(status == "O", F.array(other))
    return (
        _table(spark, sf_dir, "orders")
        .select("o_orderkey", F.explode(F.coalesce(prefixes, F.array(other, one))).alias("prefix"))
        .select(F.concat_ws("/", "prefix", F.col("o_orderkey").cast("string")).alias("doi"))
    )


def _joined(values: Column, separator: str = "|") -> Column:
    return F.array_join(values, separator, "null")


# Sources


def ingest_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = sources.land(_documents(spark, sf_dir, "iso"), "iso", ("title", "abstract"))
    return landed.select("record_id", "file_name", "malformed", "problem", "title", "abstract")


def ingest_fgdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = sources.land(_documents(spark, sf_dir, "fgdc"), "fgdc", ("title", "abstract", "published"))
    return landed.select("record_id", "file_name", "malformed", "problem", "title", "abstract", "published")


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [sources.quarantine(_documents(spark, sf_dir, dialect), dialect) for dialect in ("iso", "fgdc")]
    return found[0].unionByName(found[1])


def file_record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [
        _documents(spark, sf_dir, dialect).select(
            "file_name", "record_id", F.lit(dialect).alias("dialect")
        )
        for dialect in ("iso", "fgdc")
    ]
    return found[0].unionByName(found[1])


def vocabulary_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    themes = _iso(spark, sf_dir, "keyword_groups").select(subjects.theme_keywords().alias("keywords"))
    return subjects.term_usage(themes, vocabulary_table(spark))


def tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = _table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return stack_lists(customers, suppliers)


# Extraction


CORE = (
    "title",
    "abstract",
    "purpose",
    "supplement",
    "language_code",
    "progress_code",
    "date_stamp",
    "begin",
    "end",
    "uri",
    "version",
    "citation",
)


def extract_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    core = _iso(spark, sf_dir, *CORE).select("record_id", *CORE)
    return core.withColumnsRenamed({"begin": "date_begin", "end": "date_end"})


def extract_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.keywords_long(_iso(spark, sf_dir, "keyword_groups"))


def bounding_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.box_numbers(_iso(spark, sf_dir, "north", "south", "east", "west"))


def comments_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(spark, sf_dir, "purpose", "supplement").select("record_id", plans.comments_text().alias("comments"))


def associated_resource(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = _iso(spark, sf_dir, "uri").select(
        "record_id", plans.associated_resource(SETTINGS).alias("resource")
    )
    return linked.select(
        "record_id",
        "resource.association_type",
        "resource.association_type_iso",
        "resource.authority",
        "resource.code",
        F.col("resource.title.en").alias("title_en"),
        F.col("resource.title.fr").alias("title_fr"),
    )


def edition_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(spark, sf_dir, "version").select("record_id", plans.edition().alias("edition"))


def distribution_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as distributions: page title, host and address."""
    page = distribution(
        F.regexp_extract("html", "<title>([^<]*)</title>", 1),
        F.regexp_extract("url", "^[a-z]+://([^/]+)", 1),
        F.col("url"),
    )
    return (
        _table(spark, sf_dir, "pages")
        .select("page_id", F.array(page).alias("distribution"))
        .select("page_id", F.inline("distribution"))
        .select(
            "page_id",
            F.col("description.en").alias("description_en"),
            F.col("name.en").alias("name_en"),
            F.col("url.en").alias("url_en"),
        )
    )


# Rules


def record_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _documents(spark, sf_dir, "iso").select(
        "record_id", keys.record_key("iso", F.col("record_id")).alias("record_key")
    )
    return keyed.withColumn("identifier", keys.identifier(F.col("record_key")))


def uri_local_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(spark, sf_dir, "uri").select(
        "record_id", "uri", keys.local_id(F.col("uri")).alias("local_id")
    )


def normalise_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(spark, sf_dir, "date_stamp", "begin", "end").select(
        "record_id",
        dates.normalise_date(F.col("date_stamp")).alias("created"),
        dates.normalise_date(F.col("begin")).alias("date_start"),
        dates.normalise_date(F.col("end")).alias("date_end"),
        dates.date_finding(F.col("date_stamp")).alias("finding"),
    )


def normalise_order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written differently per status: plain, with slashes, with a time."""
    status = F.col("o_orderstatus")
    pattern = [("F", "yyyy-MM-dd"), ("O", "yyyy/MM/dd")]
    written = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm")
    for code, form in pattern:
        written = F.when(status == code, F.date_format("o_orderdate", form)).otherwise(written)
    return (
        _table(spark, sf_dir, "orders")
        .select("o_orderkey", written.alias("written"))
        .select(
            "o_orderkey",
            "written",
            dates.normalise_date(F.col("written")).alias("normalised"),
            dates.date_finding(F.col("written")).alias("finding"),
        )
    )


def map_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(spark, sf_dir, "language_code", "progress_code").select(
        "record_id",
        map_code(F.col("language_code"), LANGUAGE_CODES).alias("language"),
        map_code(F.col("progress_code"), PROGRESS_CODES).alias("progress"),
    )


def map_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation roles as a listed code, an already translated one, and an unknown one."""
    code = F.when(F.col("role") == "user", "Author").when(F.col("role") == "assistant", "coauthor")
    return (
        _table(spark, sf_dir, "conversations")
        .select("conv_id", "turn", F.coalesce(code, "role").alias("code"))
        .select("conv_id", "turn", "code", map_role(F.col("code")).alias("mapped"))
    )


def standardise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer and supplier names in every written form."""
    given, segment = F.concat(F.lit("N"), F.col("c_nationkey").cast("string")), F.col("c_mktsegment")
    customer = (
        F.when(segment == "AUTOMOBILE", F.concat_ws(" ", given, "c_name"))
        .when(segment == "BUILDING", F.concat_ws(", ", "c_name", given))
        .when(segment == "FURNITURE", F.concat(F.lit("Contact: "), F.concat_ws(" ", given, "c_name")))
        .when(segment == "HOUSEHOLD", F.concat(F.lit("A: "), F.concat_ws(", ", "c_name", given)))
        .otherwise(F.concat_ws(" ", given, F.lit("van"), "c_name"))
    )
    supplier = F.when(F.col("s_acctbal") >= 0, F.concat("s_name", F.lit(", Given, Jr")))
    supplier = F.when(F.col("s_nationkey") < 5, corpus.HOUSE).otherwise(supplier)
    written = (
        _table(spark, sf_dir, "customer")
        .select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), customer.alias("written"))
        .unionByName(
            _table(spark, sf_dir, "supplier").select(
                F.lit("supplier").alias("kind"),
                F.col("s_suppkey").alias("id"),
                supplier.alias("written"),
            )
        )
    )
    return _flat_names(people.standardise_names(written, "written", corpus.HOUSE_NAMES))


def standardise_names_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and customers by name; suppliers in debt are listed as houses."""
    suppliers = _table(spark, sf_dir, "supplier")
    written = suppliers.select(
        F.lit("supplier").alias("kind"),
        F.col("s_suppkey").alias("id"),
        F.concat(F.lit("Firm: "), "s_name").alias("written"),
    ).unionByName(
        _table(spark, sf_dir, "customer").select(
            F.lit("customer").alias("kind"),
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("written"),
        )
    )
    houses = suppliers.where("s_acctbal < 0").select(
        F.col("s_name").alias("full"), F.array("s_name", F.lit("")).alias("parts")
    )
    return _flat_names(people.standardise_names_by_table(written, "written", houses, "id"))


def _flat_names(named: DataFrame) -> DataFrame:
    return named.select(
        "kind",
        "id",
        "written",
        F.col("name.given").alias("given_names"),
        F.col("name.last").alias("last_name"),
        F.col("name.full").alias("full_name"),
        F.col("name.parts").alias("parts"),
    )


def citation_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    authors = _iso(spark, sf_dir, "citation").select(
        "record_id",
        F.posexplode(citation.citation_authors(F.col("citation"))).alias("position", "author"),
    )
    return authors.select(
        "record_id",
        "position",
        F.col("author.lastName").alias("last_name"),
        F.col("author.givenNames").alias("given_names"),
    )


# Subjects


def theme_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(spark, sf_dir, "keyword_groups").select(
        "record_id", _joined(subjects.theme_keywords()).alias("keywords")
    )


def place_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(spark, sf_dir, "keyword_groups").select(
        "record_id", subjects.place_description().alias("description")
    )


def keyword_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(spark, sf_dir, "keyword_groups").select(
        "record_id", _joined(subjects.keyword_tokens()).alias("tokens")
    )


def classify_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(spark, sf_dir, "keyword_groups").select(
        "record_id", _joined(subjects.categories(subjects.theme_keywords())).alias("categories")
    )


def classify_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification against a vocabulary table: the built-in one and one topic per source."""
    by_source = (
        _table(spark, sf_dir, "documents")
        .select(F.concat(F.lit("topic-"), "source").alias("category"), F.col("source").alias("term"))
        .distinct()
    )
    vocabulary = vocabulary_table(spark).unionByName(by_source)
    themes = _iso(spark, sf_dir, "keyword_groups").select("record_id", subjects.theme_keywords().alias("keywords"))
    return subjects.classify_by_table(themes, vocabulary).select(
        "record_id", _joined(F.col("categories")).alias("categories")
    )


# Contacts


def _flat_contacts(long: DataFrame) -> DataFrame:
    return long.select(
        "record_id",
        "position",
        F.col("givenNames").alias("given_names"),
        F.col("lastName").alias("last_name"),
        F.col("inCitation").alias("in_citation"),
        F.col("indName").alias("ind_name"),
        F.col("indEmail").alias("ind_email"),
        F.col("indPosition").alias("ind_position"),
        F.col("orgAddress").alias("org_address"),
        F.col("orgCity").alias("org_city"),
        F.col("orgCountry").alias("org_country"),
        F.col("orgEmail").alias("org_email"),
        F.col("orgName").alias("org_name"),
        _joined(F.col("role")).alias("roles"),
    )


def _contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(spark, sf_dir, "point_of_contact", "maintainer", "distributor", "cited").select(
        "record_id", contacts.iso_contacts(corpus.HOUSE_NAMES).alias("contacts")
    )


def contacts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_contacts(contacts.contacts_long(_contacts(spark, sf_dir)))


def merge_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = contacts.merge_contacts(_contacts(spark, sf_dir))
    return _flat_contacts(contacts.contacts_long(merged))


def merge_contacts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = contacts.contacts_long(_contacts(spark, sf_dir))
    return _flat_contacts(contacts.merge_contacts_long(long))


def fgdc_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _fgdc(spark, sf_dir, "points_of_contact", "distributors", "maintainers", "origins").select("record_id", contacts.fgdc_contacts().alias("contacts"))
    return _flat_contacts(contacts.contacts_long(people))


# Records


def _people(column: str = "contacts") -> Column:
    """Contacts as one text: family name, given names and roles."""
    return _joined(
        F.transform(
            F.col(column),
            lambda person: F.concat(
                person["lastName"],
                F.lit(","),
                person["givenNames"],
                F.lit(":"),
                _joined(person["role"], "+"),
            ),
        ),
        ";",
    )


def _flat_records(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("recordKey").alias("record_key"),
        F.col("recordID").alias("record_id"),
        F.col("userID").alias("user_id"),
        "filename",
        "identifier",
        F.col("title.en").alias("title_en"),
        F.col("abstract.en").alias("abstract_en"),
        F.col("limitations.en").alias("limitations_en"),
        _people().alias("contacts"),
        "created",
        F.col("dateStart").alias("date_start"),
        F.col("dateEnd").alias("date_end"),
        F.col("dateRevised").alias("date_revised"),
        F.col("datasetIdentifier").alias("dataset_identifier"),
        F.col("doiCreationStatus").alias("doi_creation_status"),
        "edition",
        _joined(F.col("eov")).alias("eov"),
        _joined(F.col("keywords.en")).alias("keywords_en"),
        "language",
        "license",
        F.col("map.description.en").alias("map_description"),
        F.col("map.north").alias("north"),
        F.col("map.south").alias("south"),
        F.col("map.east").alias("east"),
        F.col("map.west").alias("west"),
        F.col("noPlatform").alias("no_platform"),
        F.size("platforms").alias("platforms"),
        "progress",
        "region",
        _joined(F.col("resourceType")).alias("resource_type"),
        _joined(F.array_sort(F.map_keys("sharedWith"))).alias("shared_with"),
        "status",
        F.col("timeFirstPublished").alias("time_first_published"),
        F.col("verticalExtentMax").alias("vertical_extent_max"),
        F.col("verticalExtentMin").alias("vertical_extent_min"),
        F.col("verticalExtentDirection").alias("vertical_extent_direction"),
        "category",
        F.col("metadataScope").alias("metadata_scope"),
        F.concat("lastEditedBy.displayName", "lastEditedBy.email").alias("last_edited_by"),
        F.size("projects").alias("projects"),
        F.size("history").alias("history"),
        F.size("distribution").alias("distribution"),
        F.size("vertical").alias("vertical"),
        F.size("keywords.fr").alias("keywords_fr"),
        F.col("noTaxa").alias("no_taxa"),
        F.col("noVerticalExtent").alias("no_vertical_extent"),
        F.col("map.polygon").alias("polygon"),
        F.col("datePublished").alias("date_published"),
        *[column for column in ("comments_en", "resource_code", "organization") if column in records.columns],
    )


def harmonise_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = plans.harmonise_iso(_iso(spark, sf_dir), SETTINGS, _registry(spark, sf_dir))
    return _flat_records(
        records.withColumn("comments_en", F.col("comments.en")).withColumn(
            "resource_code", F.get("associated_resources", F.lit(0))["code"]
        )
    )


def harmonise_fgdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_records(plans.harmonise_fgdc(_fgdc(spark, sf_dir), SETTINGS))


def fgdc_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fgdc(spark, sf_dir, "theme_keys", "places").select(
        "record_id", _joined(subjects.fgdc_keywords()).alias("keywords")
    )


def unified_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = plans.unified_catalogue(
        plans.harmonise_iso(_iso(spark, sf_dir), SETTINGS),
        plans.harmonise_fgdc(_fgdc(spark, sf_dir), SETTINGS),
    )
    return both.select(
        "dialect",
        F.col("recordKey").alias("record_key"),
        F.col("recordID").alias("record_id"),
        F.col("title.en").alias("title_en"),
        "language",
        "progress",
        "organization",
        F.size("contacts").alias("contacts"),
        F.col("comments.en").alias("comments_en"),
        F.col("limitations.en").alias("limitations_en"),
    )


def export_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = plans.harmonise_iso(_iso(spark, sf_dir), SETTINGS)
    return record_lines(
        records.select(
            "recordKey",
            "userID",
            "title",
            "abstract",
            "created",
            "language",
            "edition",
            "map",
            "noPlatform",
            "resourceType",
            "verticalExtentMax",
        )
    )


def harmonise_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole records again, from a landed corpus that is bucketed by record: only ids meet the registry."""
    landed = stage(sources.land(_documents(spark, sf_dir, "iso"), "iso"), by="record_id")
    records = plans.harmonise_iso(sources.landed_records(landed), SETTINGS, _registry(spark, sf_dir), stored=True)
    return _flat_records(
        records.withColumn("comments_en", F.col("comments.en")).withColumn(
            "resource_code", F.get("associated_resources", F.lit(0))["code"]
        )
    )


def doi_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = _iso(spark, sf_dir, "uri").select("record_id", keys.local_id(F.col("uri")).alias("local_id"))
    return identifiers.resolve_dois(
        located, _registry(spark, sf_dir), SETTINGS.doi_prefixes
    ).select("record_id", "local_id", "doi_url")


# Translation


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return translation.with_keys(
        _table(spark, sf_dir, "documents").select("doc_id", "text")
    )


def _memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A memory that holds about half of the texts: those with a key below ``8``."""
    return (
        _texts(spark, sf_dir)
        .where(F.col("cache_key") < "8")
        .groupBy("cache_key")
        .agg(F.concat(F.lit("[fr] "), F.first("text")).alias("translated"))
    )


def translation_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("doc_id", "cache_key")


def translate_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = stage(_texts(spark, sf_dir).select("doc_id", "cache_key"))
    return translation.look_up(keyed, _memory(spark, sf_dir), "doc_id").select(
        "doc_id", "cache_key", "translated"
    )


def translate_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return translation.pending(
        _texts(spark, sf_dir), _memory(spark, sf_dir), ("doc_id",), terminology="marine terms"
    )


def translate_memory_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translations come back for every key from ``4`` on, some of which are known already."""
    returned = (
        _texts(spark, sf_dir)
        .where(F.col("cache_key") >= "4")
        .select("cache_key", F.concat(F.lit("[new] "), "text").alias("translated"))
    )
    return translation.update_memory(_memory(spark, sf_dir), returned)


def translate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that the memory knows get their French, in fields and in ways to get the data; others stay.

    The records are bucketed by their key, so only keys and translations move.
    """
    ways = F.array(
        distribution(F.col("abstract"), F.col("title"), F.col("uri")), distribution(F.col("title"), F.col("abstract"), F.col("uri"))
    )
    records = plans.harmonise_iso(_iso(spark, sf_dir), SETTINGS, distribution=ways)
    narrow = records.select("recordKey", "distribution", *translation.TRANSLATED_FIELDS)
    fields = translation.TRANSLATED_FIELDS + translation.TRANSLATED_DISTRIBUTION
    keyed = stage(translation.with_field_keys(narrow, fields), by="recordKey")
    translated = translation.translate_records(keyed, _memory(spark, sf_dir), fields=fields)
    first, second = (F.get("distribution", F.lit(n)) for n in (0, 1))
    return translated.select(
        first["description"]["fr"].alias("first_description_fr"),
        first["name"]["fr"].alias("first_name_fr"),
        second["name"]["en"].alias("second_name_en"),
        second["name"]["fr"].alias("second_name_fr"),
        second["name"]["translations"]["fr"]["message"].alias("second_notice"),
        second["url"]["en"].alias("second_url_en"),
        F.col("recordKey").alias("record_key"),
        F.col("title.fr").alias("title_fr"),
        F.col("abstract.en").alias("abstract_en"),
        F.col("abstract.fr").alias("abstract_fr"),
        F.col("abstract.translations.fr.message").alias("notice"),
        F.col("abstract.translations.fr.verified").alias("verified"),
        F.col("comments.fr").alias("comments_fr"),
        F.col("limitations.fr").alias("limitations_fr"),
    )


# Publishing


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as export records: key, owner, person they are shared with, date."""
    return _table(spark, sf_dir, "orders").select(
        F.md5(F.col("o_orderkey").cast("string")).alias("record_key"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderpriority").alias("person"),
        F.lit(True).alias("shared"),
        F.col("o_orderdate").cast("date").alias("day"),
    )


def _old(export: DataFrame) -> DataFrame:
    return export.where(F.col("day") < EXPORT_CUT)


def shared_with(spark: SparkSession, sf_dir: str) -> DataFrame:
    persons = F.array("source", "lang", F.lit(""), "source")
    return (
        _table(spark, sf_dir, "documents")
        .select("doc_id", sharing.shared_with(persons).alias("shared_with"))
        .select(
            "doc_id",
            _joined(F.array_sort(F.map_keys("shared_with"))).alias("persons"),
            F.forall(F.map_values("shared_with"), lambda flag: flag).alias("all_shared"),
        )
    )


def share_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharing.share_grants(_export(spark, sf_dir), SETTINGS.shares)


def append_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = _export(spark, sf_dir)
    old, new = _old(export), export.where(F.col("day") >= EXPORT_CUT)
    return appending.append_records(
        old.select("record_key", "user_id"), new.select("record_key", "user_id", "person")
    )


def append_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = _export(spark, sf_dir)
    return appending.colliding_keys(_old(export), export.where(F.col("day") >= OVERLAP_FROM))


def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed in a first run, and those from a day on again, changed, in a second one."""
    export = _export(spark, sf_dir)
    first = export.select("record_key", "person", F.lit(1).alias("run"))
    again = export.where(F.col("day") >= OVERLAP_FROM).select("record_key", F.lower("person").alias("person"), F.lit(2).alias("run"))
    return appending.latest(first.unionByName(again), "record_key", "run")


def append_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = _export(spark, sf_dir)
    return sharing.append_shares(_old(export), export.where(F.col("day") >= OVERLAP_FROM))


def append_shares_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = _export(spark, sf_dir)
    return sharing.append_shares(
        _old(export), export.where(F.col("day") >= OVERLAP_FROM), mode="merge"
    )


# Profiling, harvest, quality


def inspect_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_values(_iso(spark, sf_dir, "keyword_groups"), subjects.theme_keywords())


def inspect_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.values_by_file(_iso(spark, sf_dir, "keyword_groups"), subjects.theme_keywords())
    return found.select("file_name", _joined(F.col("values")).alias("keywords"))


def inspect_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_column(_table(spark, sf_dir, "events"), "event_type")


def harvest_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    def ids(table: str) -> DataFrame:
        return _table(spark, sf_dir, table).select(
            F.col("doc_id").cast("string").alias("record_id")
        )

    return harvest.worklist(ids("documents"), ids("labels"), HARVEST_BASE, "iso")


def _statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch results: documents in languages the catalogue does not serve fail."""
    record_id = F.col("doc_id").cast("string")
    status = F.when(F.col("lang") == "de", 404).when(F.col("lang") == "es", 500).otherwise(200)
    return _table(spark, sf_dir, "documents").select(
        record_id.alias("record_id"),
        keys.harvest_url(HARVEST_BASE, record_id, "iso").alias("url"),
        status.alias("status"),
    )


def harvest_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harvest.failures(_statuses(spark, sf_dir))


def harvest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harvest.summary(_statuses(spark, sf_dir))


def citation_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.citation_mismatch(_iso(spark, sf_dir, "citation", "cited"))


def dq_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = sources.land(_documents(spark, sf_dir, "iso"), "iso")
    fgdc = sources.land(_documents(spark, sf_dir, "fgdc"), "fgdc")
    return (
        quality.iso_findings(iso, corpus.HOUSE_NAMES)
        .unionByName(quality.fgdc_findings(fgdc))
        .unionByName(quality.fetch_findings(harvest.failures(_statuses(spark, sf_dir))))
    )


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summarise(dq_findings(spark, sf_dir))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        harmonise_iso,
        harmonise_fgdc,
        unified_catalogue,
        ingest_iso,
        ingest_fgdc,
        quarantine,
        file_record_ids,
        vocabulary_terms,
        tagged_union,
        extract_core,
        extract_keywords,
        bounding_box,
        comments_text,
        associated_resource,
        edition_default,
        distribution_struct,
        record_keys,
        uri_local_id,
        normalise_dates,
        normalise_order_dates,
        map_codes,
        map_roles,
        standardise_names,
        standardise_names_by_table,
        citation_authors,
        citation_mismatch,
        theme_keywords,
        place_description,
        keyword_tokens,
        classify_keywords,
        classify_by_table,
        contacts_long,
        merge_contacts,
        merge_contacts_long,
        fgdc_contacts,
        fgdc_keywords,
        export_json_lines,
        harmonise_stored,
        doi_resolve,
        translation_keys,
        translate_lookup,
        translate_pending,
        translate_memory_update,
        translate_records,
        shared_with,
        share_grants,
        append_records,
        append_collisions,
        latest_rows,
        append_shares,
        append_shares_merge,
        inspect_set,
        inspect_by_file,
        inspect_events,
        harvest_worklist,
        harvest_failures,
        harvest_summary,
        dq_findings,
        dq_summary,
    )
}
