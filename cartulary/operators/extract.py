"""From parsed documents to flat record columns.

One row per record. Texts are as written; an empty element counts as no text. Parties of
both dialects become ``struct<name, organisation, position, address, city, country, email,
role>`` so that everything after this step is shared.

The paths are SQL text: one expression per column, parsed on the JVM, instead of thousands
of calls from Python for every plan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame


def _text(path: str) -> str:
    return f"nullif({path}, '')"


def _present(items: str) -> str:
    return f"filter({items}, item -> item IS NOT NULL)"


def _first(items: str) -> str:
    """The text of the first element that exists; an empty first element gives null."""
    return _text(f"get({_present(items)}, 0)")


def _gather(items: str, child: str) -> str:
    """All children of a repeated element, in document order."""
    return f"coalesce(flatten({_present(f'{items}.{child}')}), array())"


def _struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in fields.items()) + ")"


def _party(element: str) -> str:
    party = f"{element}.CI_ResponsibleParty"
    address = f"{party}.contactInfo.CI_Contact.address.CI_Address"
    fields = _struct(
        name=_text(f"{party}.individualName.CharacterString"),
        organisation=_text(f"{party}.organisationName.CharacterString"),
        position="CAST(NULL AS STRING)",
        address=_first(f"{address}.deliveryPoint.CharacterString"),
        city=_text(f"{address}.city.CharacterString"),
        country=_text(f"{address}.country.CharacterString"),
        email=_first(f"{address}.electronicMailAddress.CharacterString"),
        role=_text(f"{party}.role.CI_RoleCode"),
    )
    return f"if({party} IS NULL, NULL, {fields})"


def _parties(elements: str) -> str:
    return _present(f"transform({elements}, party -> {_party('party')})")


_PARTY_FIELDS = "name organisation position address city country email role".split()


def _section_party(people: str) -> str:
    """One party for a section that may name several: each field from the first that has it."""
    fields = _struct(**{name: _first(f"{people}.{name}") for name in _PARTY_FIELDS})
    return f"if(size({people}) > 0, {fields}, NULL)"


def _fgdc_party(element: str) -> str:
    info = f"{element}.cntinfo"
    address = f"get({info}.cntaddr, 0)"
    return _struct(
        name=_text(f"coalesce({info}.cntorgp.cntper, {info}.cntperp.cntper)"),
        organisation=_text(f"coalesce({info}.cntorgp.cntorg, {info}.cntperp.cntorg)"),
        position=_text(f"{info}.cntpos"),
        address=_first(f"{address}.address"),
        city=_text(f"{address}.city"),
        country=_text(f"{address}.country"),
        email=_first(f"{info}.cntemail"),
        role="CAST(NULL AS STRING)",
    )


def _fgdc_parties(elements: str) -> str:
    return f"transform(coalesce({elements}, array()), party -> {_fgdc_party('party')})"


def _aliased(columns: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in columns.items()]


def _select(table: DataFrame, carry: Sequence[str], columns: dict[str, str]) -> DataFrame:
    return table.selectExpr("record_id", "file_name", *carry, *_aliased(columns))


def _chosen(columns: dict[str, str], names: Sequence[str] | None) -> dict[str, str]:
    return columns if names is None else {name: columns[name] for name in names}


# Intermediate columns of the first dialect: repeated elements gathered from all sections.
# Their names start with an underscore so that they can be told from element names.
_ISO_STAGES = (
    {
        "_sections": "identificationInfo.MD_DataIdentification",
        "_cites": "identificationInfo.MD_DataIdentification.citation.CI_Citation",
        "_distribution": "distributionInfo.MD_Distribution",
        "_maintenance": _parties("metadataMaintenance.MD_MaintenanceInformation.contact"),
    },
    {
        "_groups": f"{_gather('_sections', 'descriptiveKeywords')}.MD_Keywords",
        "_extents": f"{_gather('_sections', 'extent')}.EX_Extent",
    },
    {
        "_boxes": f"{_gather('_extents', 'geographicElement')}.EX_GeographicBoundingBox",
        "_periods": f"{_gather('_extents', 'temporalElement')}"
        ".EX_TemporalExtent.extent.TimePeriod",
        "_thesauri": "_groups.thesaurusName.CI_Citation",
    },
)
_KEYWORD_GROUPS = (
    f"transform({_present('_groups')}, g -> "
    + _struct(
        type=_text("g.type.MD_KeywordTypeCode"),
        keywords="transform(filter(coalesce(g.keyword.CharacterString, array()), "
        "word -> word IS NOT NULL), word -> nullif(word, ''))",
    )
    + ")"
)
_ISO_COLUMNS = {
    "title": _first(
        "concat(coalesce(_cites.title.CharacterString, array()), "
        "coalesce(_thesauri.title.CharacterString, array()))"
    ),
    "abstract": _first("_sections.abstract.CharacterString"),
    "purpose": _first("_sections.purpose.CharacterString"),
    "supplement": _first("_sections.supplementalInformation.CharacterString"),
    "language_code": _first(
        f"concat(array(language.CharacterString), {_gather('_sections', 'language')}.CharacterString)"
    ),
    "progress_code": _first(f"{_gather('_sections', 'status')}.MD_ProgressCode"),
    "date_stamp": _text("dateStamp.Date"),
    "begin": _first("_periods.beginPosition"),
    "end": _first("_periods.endPosition"),
    "uri": _text("dataSetURI.CharacterString"),
    "north": _first("_boxes.northBoundLatitude.Decimal"),
    "south": _first("_boxes.southBoundLatitude.Decimal"),
    "east": _first("_boxes.eastBoundLongitude.Decimal"),
    "west": _first("_boxes.westBoundLongitude.Decimal"),
    "version": _first("_distribution.distributionFormat.MD_Format.version.CharacterString"),
    "citation": _first(f"{_gather('_cites', 'otherCitationDetails')}.CharacterString"),
    "keyword_groups": _KEYWORD_GROUPS,
    "point_of_contact": f"get({_parties(_gather('_sections', 'pointOfContact'))}, 0)",
    "maintainer": _section_party("_maintenance"),
    "distributor": f"get({_parties('_distribution.distributor.MD_Distributor.distributorContact')}, 0)",
    "cited": _parties(
        f"concat({_gather('_cites', 'citedResponsibleParty')}, "
        f"{_gather('_thesauri', 'citedResponsibleParty')})"
    ),
}


def _stages(sql: Sequence[str]) -> list[dict[str, str]]:
    """The intermediate columns that some expressions use, directly or through others."""
    needed: list[dict[str, str]] = []
    for stage in reversed(_ISO_STAGES):
        used = {
            name: text
            for name, text in stage.items()
            if any(re.search(rf"\b{name}\b", expression) for expression in sql)
        }
        sql = [*sql, *used.values()]
        needed.insert(0, used)
    return [stage for stage in needed if stage]


def extract_iso(
    documents: DataFrame, carry: Sequence[str] = (), columns: Sequence[str] | None = None
) -> DataFrame:
    """Flat columns of the first dialect, all or some, and the columns to ``carry`` along."""
    chosen = _chosen(_ISO_COLUMNS, columns)
    for stage in _stages(list(chosen.values())):
        documents = documents.selectExpr("*", *_aliased(stage))
    return _select(documents, carry, chosen)


_FGDC_COLUMNS = {
    "title": _text("idinfo.citation.citeinfo.title"),
    "abstract": _text("idinfo.descript.abstract"),
    "purpose": _text("idinfo.descript.purpose"),
    "supplement": _text("idinfo.descript.supplinf"),
    "published": _text("idinfo.citation.citeinfo.pubdate"),
    "begin": _text("idinfo.timeperd.timeinfo.rngdates.begdate"),
    "end": _text("idinfo.timeperd.timeinfo.rngdates.enddate"),
    "north": _text("idinfo.spdom.bounding.northbc"),
    "south": _text("idinfo.spdom.bounding.southbc"),
    "east": _text("idinfo.spdom.bounding.eastbc"),
    "west": _text("idinfo.spdom.bounding.westbc"),
    "theme_keys": f"transform({_present(_gather('idinfo.keywords.theme', 'themekey'))}, "
    "word -> nullif(word, ''))",
    "places": _first("idinfo.keywords.place.placekt"),
    "metadata_date": _text("metainfo.metd"),
    "revised": "revised",
    "depth_max": "depth_max",
    "depth_min": "depth_min",
    "points_of_contact": _fgdc_parties("idinfo.ptcontac"),
    "distributors": _fgdc_parties("distinfo.distrib"),
    "maintainers": _fgdc_parties("metainfo.metc"),
    "origins": "coalesce(idinfo.citation.citeinfo.origin, array())",
}


def extract_fgdc(
    documents: DataFrame, carry: Sequence[str] = (), columns: Sequence[str] | None = None
) -> DataFrame:
    """Flat columns of the second dialect, all or some, and the columns to ``carry`` along."""
    return _select(documents, carry, _chosen(_FGDC_COLUMNS, columns))


EXTRACTORS = {"iso": extract_iso, "fgdc": extract_fgdc}
