"""Data-quality findings: ``(record_id, rule, severity, detail)``.

Each rule is an array of findings for one record, so all rules together are one row-local
pass and one explode. Landed tables bring their malformed documents along; for those the
one finding is that nothing could be read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions import citation as citations
from cartulary.functions.codes import map_code, map_role
from cartulary.functions.dates import date_finding
from cartulary.functions.names import author_name, labelled_name, person_name
from cartulary.functions.text import blank_to_null
from cartulary.operators import subjects
from cartulary.settings import LANGUAGE_CODES, PROGRESS_CODES
from cartulary.vocabulary import CATEGORIES

SEVERITY = {
    "malformed_xml": "error",
    "missing_section": "warning",
    "element_missing": "info",
    "invalid_date": "warning",
    "unparsable_date": "warning",
    "unmapped_role": "warning",
    "unmapped_code": "warning",
    "missing_name": "info",
    "name_more_than_two_parts": "warning",
    "citation_et_al": "info",
    "citation_no_authors": "warning",
    "citation_party_mismatch": "warning",
    "no_keywords": "warning",
    "no_category": "warning",
    "fgdc_incomplete": "warning",
    "wrong_dialect": "error",
    "undecodable": "error",
    "literal_null": "info",
    "fetch_failed": "error",
}

_FINDING = "struct<rule:string,detail:string>"
_REQUIRED = ("title", "abstract", "purpose", "supplement", "date_stamp", "begin", "end", "uri")
_SECTIONS = ("point_of_contact", "maintainer", "distributor")
_FGDC_REQUIRED = ("title", "abstract", "purpose", "supplement", "published", "begin", "end")
_FGDC_PEOPLE = ("points_of_contact", "distributors", "maintainers")
_PARTY_TEXTS = ("name", "organisation", "position", "address", "city", "country", "email")


def _finding(rule: str | Column, detail: Column | str, when: Column) -> Column:
    rule = F.lit(rule) if isinstance(rule, str) else rule
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return F.when(F.coalesce(when, F.lit(False)), F.struct(rule.alias("rule"), detail.alias("detail")))


def _labelled(field: str, value: Column) -> Column:
    return F.concat(F.lit(f"{field}="), F.coalesce(value, F.lit("null")))


def _explode(records: DataFrame, singles: Sequence[Column], lists: Sequence[Column]) -> DataFrame:
    found = F.filter(
        F.concat(F.array(*singles), *lists).cast(f"array<{_FINDING}>"),
        lambda finding: finding.isNotNull(),
    )
    if "malformed" in records.columns:
        broken = F.array(_finding(F.col("problem"), F.col("file_name"), F.lit(True)))
        found = F.when(F.col("malformed"), broken).otherwise(found)
    return with_severity(
        records.select("record_id", F.explode(found).alias("finding")).select(
            "record_id", "finding.rule", "finding.detail"
        )
    )


def with_severity(findings: DataFrame) -> DataFrame:
    return findings.select(
        "record_id", "rule", map_code(F.col("rule"), SEVERITY).alias("severity"), "detail"
    )


def _absent(rule: str, columns: Sequence[str]) -> Column:
    """One finding per column without a value."""
    absent = ", ".join(f"if({name} IS NULL, '{name}', NULL)" for name in columns)
    return F.expr(
        f"transform(array_compact(array({absent})), "
        f"name -> named_struct('rule', '{rule}', 'detail', name))"
    )


def _date_findings(columns: Sequence[str]) -> Column:
    entries = ", ".join(f"named_struct('field', '{name}', 'text', {name})" for name in columns)
    return F.transform(
        F.expr(f"array({entries})"),
        lambda entry: _finding(
            date_finding(entry["text"]),
            F.concat(entry["field"], F.lit("="), entry["text"]),
            date_finding(entry["text"]).isNotNull(),
        ),
    )


def _name_findings(names: Column) -> Column:
    """Missing and over-long names; ``names`` is an array of (section, raw text, standardised)."""
    return F.flatten(
        F.transform(
            names,
            lambda entry: F.array(
                _finding("missing_name", entry["section"], entry["text"].isNull()),
                _finding(
                    "name_more_than_two_parts",
                    F.concat(entry["section"], F.lit("="), entry["name"]["full"]),
                    entry["name"]["parts"] > 2,
                ),
            ),
        )
    )


def _named(section: str, text: Column, name: Column) -> Column:
    return F.struct(F.lit(section).alias("section"), text.alias("text"), name.alias("name"))


def citation_mismatch(records: DataFrame) -> DataFrame:
    """Citations that list more people than the record names, unless shortened.

    Counted and tested inside one generator, so the citation is parsed once.
    """
    counted = F.struct(
        "citation",
        F.size(citations.citation_authors(F.col("citation"))).alias("authors"),
        F.size("cited").alias("parties"),
    )
    mismatched = F.filter(
        F.array(counted),
        lambda row: (row["authors"] > row["parties"])
        & ~citations.abbreviates_authors(row["citation"]),
    )
    return records.select("record_id", F.inline(mismatched))


def iso_findings(
    records: DataFrame,
    house_names: Mapping[str, Sequence[str]],
    vocabulary: Mapping[str, Sequence[str]] = CATEGORIES,
) -> DataFrame:
    """Findings of extracted records of the first dialect.

    A column ``matched`` holds the categories of records that were classified by a table.
    """
    staged = records.withColumn("_themes", subjects.theme_keywords()).withColumn(
        "_authors", F.size(citations.citation_authors(F.col("citation")))
    )
    citation, themes = F.col("citation"), F.col("_themes")
    published = citations.is_published(citation)
    shortened = citations.abbreviates_authors(citation)
    unlisted = published & ~citations.lists_authors(citation)
    by_table = "matched" in records.columns
    matched = F.when(themes.isNotNull(), F.col("matched")) if by_table else subjects.matched_categories(themes, vocabulary)
    unmatched = F.size(matched) == 0

    def role_finding(party: Column) -> Column:
        return _finding(
            "unmapped_role", _labelled("role", party["role"]), map_role(party["role"]).isNull()
        )

    singles = [
        *[
            _finding("unmapped_code", _labelled(name, F.col(name)), map_code(F.col(name), codes).isNull())
            for name, codes in (
                ("language_code", LANGUAGE_CODES),
                ("progress_code", PROGRESS_CODES),
            )
        ],
        _finding("citation_et_al", citation, unlisted & shortened),
        _finding("citation_no_authors", citation, unlisted & ~shortened),
        _finding(
            "citation_party_mismatch",
            F.concat(
                F.col("_authors").cast("string"), F.lit(" > "), F.size("cited").cast("string")
            ),
            (F.col("_authors") > F.size("cited")) & ~shortened,
        ),
        _finding("no_keywords", "theme", F.size(themes) == 0),
        _finding("no_category", F.array_join(themes, ","), unmatched),
    ]
    sections = ", ".join(
        f"named_struct('section', '{name}', 'text', {name}.name)" for name in _SECTIONS
    )
    everyone = F.expr(
        f"concat(array({sections}), "
        "transform(cited, party -> named_struct('section', 'cited', 'text', party.name)))"
    )

    def standardised(entry: Column) -> Column:
        name = person_name(entry["text"], house_names)
        return F.struct(entry["section"], entry["text"], name.alias("name"))

    lists = [
        _absent("element_missing", _REQUIRED),
        _absent("missing_section", _SECTIONS),
        _date_findings(("date_stamp", "begin", "end")),
        F.transform(F.col("cited"), role_finding),
        _name_findings(F.transform(everyone, standardised)),
    ]
    return _explode(staged, singles, lists)


def fgdc_findings(records: DataFrame) -> DataFrame:
    """Findings of extracted records of the second dialect."""

    people = F.expr(
        "concat("
        + ", ".join(
            f"transform({section}, "
            f"party -> named_struct('section', '{section}', 'text', party.name))"
            for section in _FGDC_PEOPLE
        )
        + ")"
    )

    def standardised(entry: Column) -> Column:
        name = labelled_name(entry["text"])
        return F.struct(entry["section"], entry["text"], name.alias("name"))

    def literal_nulls(section: str) -> Column:
        found = ", ".join(
            f"if(party.{field} = 'NULL', '{section}.{field}', NULL)" for field in _PARTY_TEXTS
        )
        return F.expr(
            f"transform(flatten(transform({section}, party -> array_compact(array({found})))), "
            "place -> named_struct('rule', 'literal_null', 'detail', place))"
        )

    singles = [_finding("fgdc_incomplete", "fgdc", F.lit(True))]
    lists = [
        _absent("element_missing", _FGDC_REQUIRED),
        _name_findings(F.transform(people, standardised)),
        *[literal_nulls(section) for section in _FGDC_PEOPLE],
        _name_findings(
            F.transform(
                F.col("origins"),
                lambda origin: _named("origins", blank_to_null(origin), author_name(origin)),
            )
        ),
    ]
    return _explode(records, singles, lists)


def fetch_findings(failed: DataFrame) -> DataFrame:
    """One finding per failed fetch."""
    return with_severity(
        failed.select(
            "record_id",
            F.lit("fetch_failed").alias("rule"),
            F.concat(
                F.lit("status="), F.coalesce(F.col("status").cast("string"), F.lit("null"))
            ).alias("detail"),
        )
    )


def summarise(findings: DataFrame) -> DataFrame:
    """Findings and distinct records per rule.

    Findings are first reduced to one row per rule and record, so a rule that every record
    breaks is spread over all tasks before the last, small aggregation.
    """
    return (
        findings.groupBy("rule", "severity", "record_id")
        .agg(F.count("*").alias("found"))
        .groupBy("rule", "severity")
        .agg(F.sum("found").alias("findings"), F.count("*").alias("records"))
    )
