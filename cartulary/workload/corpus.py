"""XML corpora in both dialects, rendered from the ``documents`` table.

Every document becomes one record whose fields vary with its id, language, source and
length, so that each rule meets every case. Rendering is row-local column arithmetic; the
oracle SQL restates the same arithmetic on the table and never sees the XML.

Some rows give faulty documents as well, beside their own: one that is cut off before its end,
one with content behind its end, one of another kind.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.functions.text import quoted
from cartulary.vocabulary import categories_by_term

HOUSE = "Northern Records House"
HOUSE_NAMES = {HOUSE: [HOUSE, ""]}
TERMS = sorted(categories_by_term())
# Role codes as they come in: six listed, one already translated, one unknown.
ROLES = [
    "Originator",
    "Collaborator",
    "Author",
    "coAuthor",
    "pointOfContact",
    "principalInvestigator",
    "originator",
    "funder",
]
PROGRESS = ["completed", "ongoing", "planned", "underDevelopment", "obsolete"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, dealt over the tasks of a shuffle: rendering and parsing are bound by the processor.

    The number of tasks is given, as adaptive execution goes by bytes and would leave cores idle.
    """
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(tasks, "doc_id")


def _pick(values: list[str], index: str) -> str:
    listed = ", ".join(quoted(value) for value in values)
    return f"get(array({listed}), CAST({index} AS INT) % {len(values)})"


_PEOPLE = "'C' || person_1 || ', G., & C' || person_2 || ', G. '"
_BASICS = {
    "record_id": "CAST(doc_id AS STRING)",
    "title": "'Record ' || doc_id || ' of ' || source",
    "person_1": "doc_id % 997",
    "person_2": "if(doc_id % 4 = 0, doc_id % 997, (doc_id * 3 + 1) % 997)",
    "first_day": "date_add(DATE'1990-01-01', CAST(doc_id % 9000 AS INT))",
}
_SHAPE = {
    "language_code": "CASE lang WHEN 'en' THEN 'eng; CAN' WHEN 'fr' THEN 'fra; CAN' ELSE lang END",
    "progress_code": _pick(PROGRESS, "doc_id"),
    "date_stamp": "CASE WHEN doc_id % 11 = 0 THEN 'Undefined' WHEN doc_id % 13 = 0 THEN '2020' "
    "WHEN doc_id % 17 = 0 THEN '2020-13-40' "
    "ELSE CAST(date_add(DATE'2020-01-01', CAST(doc_id % 1500 AS INT)) AS STRING) END",
    "begin": "CAST(first_day AS STRING)",
    "end": "if(doc_id % 31 <> 0, "
    "CAST(date_add(first_day, CAST(n_chars % 400 AS INT)) AS STRING), NULL)",
    "uri": "if(doc_id % 37 <> 0, 'https://records.example.org/show?doi_id=' || doc_id, NULL)",
    "north": "(doc_id % 90) || '.5'",
    "south": "'-' || (doc_id % 90) || '.25'",
    "east": "CAST(doc_id % 180 AS STRING)",
    "west": "'-' || (n_chars % 180)",
    "version": "if(doc_id % 8 <> 0, '2.' || (doc_id % 4), NULL)",
    "purpose": "if(doc_id % 9 <> 0, 'Purpose of ' || title, NULL)",
    "supplement": "'Held by ' || source",
    "has_themes": "doc_id % 19 <> 0",
    "theme_1": _pick(TERMS, "doc_id"),
    "theme_2": _pick(TERMS, "(doc_id * 7 + 3)"),
    "has_untyped": "doc_id % 6 = 0",
    "place": "source || ', ' || lang",
    "has_point_of_contact": "doc_id % 41 <> 0",
    "has_curator": "doc_id % 3 = 0",
    "role_1": _pick(ROLES, "doc_id"),
    "role_2": _pick(ROLES, "(doc_id + 3)"),
    "has_thesaurus": "doc_id % 10 = 0",
    "has_depth": "doc_id % 5 = 0",
    "citation": "CASE WHEN doc_id % 7 = 0 THEN 'Unpublished Data' "
    "WHEN doc_id % 23 = 0 THEN 'C' || person_1 || ', G., et al. (2020). ' || title "
    "WHEN doc_id % 43 = 0 THEN 'C' || person_1 || ', G., et al., in press' "
    "WHEN doc_id % 29 = 0 THEN 'C' || person_1 || ' and others' "
    f"WHEN doc_id % 12 = 5 THEN {_PEOPLE} || 'and Poe, B., Roe, D., Coe, E. 2020. ' || title "
    f"ELSE {_PEOPLE} || '(2020). ' || title END",
}


def shape(documents: DataFrame) -> DataFrame:
    """The facts each record is rendered from."""
    for stage in (_BASICS, _SHAPE):
        documents = documents.selectExpr(
            "*", *[f"{sql} AS {name}" for name, sql in stage.items()]
        )
    return documents


# Templates: literal XML with ``${sql}`` in place of values.


def _concat(template: str) -> str:
    """The SQL that fills a template."""
    pieces = re.split(r"\$\{(.*?)\}", template)
    parts = [
        piece if i % 2 else quoted(piece) for i, piece in enumerate(pieces) if piece
    ]
    return f"concat({', '.join(parts)})"


def _fill(template: str) -> Column:
    return F.expr(_concat(template))


def _when(condition: str, template: str, otherwise: str = "") -> str:
    other = _concat(otherwise) if otherwise else "''"
    return "${if(" + f"{condition}, {_concat(template)}, {other}" + ")}"


def _value(sql: str) -> str:
    """A value as XML text; most hold no sign that needs an entity, and to look for one is quick."""
    signs = {"&": "&amp;", "<": "&lt;", ">": "&gt;", "\\r": "&#13;"}
    escaped = sql
    for plain, entity in signs.items():
        escaped = f"replace({escaped}, '{plain}', '{entity}')"
    held = " OR ".join(f"contains({sql}, '{plain}')" for plain in signs)
    return "${" + f"if({held}, {escaped}, {sql})" + "}"


def _characters(tag: str, text: str) -> str:
    return f"<gmd:{tag}><gco:CharacterString>{text}</gco:CharacterString></gmd:{tag}>"


def _maybe(tag: str, column: str) -> str:
    """An element that is left out when it has no text."""
    return _when(f"{column} IS NOT NULL", _characters(tag, _value(column)))


def _party(name: str, organisation: str, city: str, email: str, role: str) -> str:
    return (
        "<gmd:CI_ResponsibleParty>"
        + (_characters("individualName", name) if name else "")
        + _characters("organisationName", organisation)
        + "<gmd:contactInfo><gmd:CI_Contact><gmd:address><gmd:CI_Address>"
        + _characters("deliveryPoint", "1 Archive Road")
        + _characters("city", city)
        + _characters("country", "Canada")
        + _characters("electronicMailAddress", email)
        + "</gmd:CI_Address></gmd:address></gmd:CI_Contact></gmd:contactInfo>"
        f'<gmd:role><gmd:CI_RoleCode codeList="roles">{role}</gmd:CI_RoleCode></gmd:role>'
        "</gmd:CI_ResponsibleParty>"
    )


_HOUSE_PARTY = _party(HOUSE, "Records Network", "Norwick", "desk@example.org", "pointOfContact")
_CURATOR_PARTY = _party(
    "Curator: Smith, Ann", "Records Network", "Norwick", "ann@example.org", "custodian"
)
_THESAURUS = (
    "<gmd:thesaurusName><gmd:CI_Citation>"
    + _characters("title", "Keyword library")
    + "<gmd:citedResponsibleParty>"
    + _party("", "Records Network", "Norwick", "desk@example.org", "Originator")
    + "</gmd:citedResponsibleParty></gmd:CI_Citation></gmd:thesaurusName>"
)


def _cited(n: int) -> str:
    party = _party(
        f"C${{person_{n}}}, Given${{person_{n} % 25}}",
        "Org ${source}",
        "Southwick",
        f"c${{person_{n}}}@example.org",
        f"${{role_{n}}}",
    )
    return f"<gmd:citedResponsibleParty>{party}</gmd:citedResponsibleParty>"


def _keywords(kind: str, columns: list[str], extra: str = "") -> str:
    typed = (
        f'<gmd:type><gmd:MD_KeywordTypeCode codeList="types">{kind}'
        "</gmd:MD_KeywordTypeCode></gmd:type>"
    )
    return (
        "<gmd:descriptiveKeywords><gmd:MD_Keywords>"
        + "".join(_characters("keyword", _value(column)) for column in columns)
        + (typed if kind else "")
        + extra
        + "</gmd:MD_Keywords></gmd:descriptiveKeywords>"
    )


def _bound(tag: str, side: str) -> str:
    return f"<gmd:{tag}><gco:Decimal>${{{side}}}</gco:Decimal></gmd:{tag}>"


ISO_TEMPLATE = (
    '<?xml version="1.0" encoding="UTF-8"?>\n'
    '<gmd:MD_Metadata xmlns:gmd="http://www.isotc211.org/2005/gmd"'
    ' xmlns:gco="http://www.isotc211.org/2005/gco" xmlns:gml="http://www.opengis.net/gml">'
    + _characters("language", "${language_code}")
    + f"<gmd:contact>{_HOUSE_PARTY}</gmd:contact>"
    "<gmd:dateStamp><gco:Date>${date_stamp}</gco:Date></gmd:dateStamp>"
    + _maybe("dataSetURI", "uri")
    + "<gmd:identificationInfo><gmd:MD_DataIdentification><gmd:citation><gmd:CI_Citation>"
    + _characters("title", _value("title"))
    + _cited(1)
    + _cited(2)
    + _maybe("otherCitationDetails", "citation")
    + "</gmd:CI_Citation></gmd:citation>"
    + _characters("abstract", _value("text"))
    + _maybe("purpose", "purpose")
    + '<gmd:status><gmd:MD_ProgressCode codeList="progress">${progress_code}'
    "</gmd:MD_ProgressCode></gmd:status>"
    + _when("has_point_of_contact", f"<gmd:pointOfContact>{_HOUSE_PARTY}</gmd:pointOfContact>")
    + _when(
        "has_themes",
        _keywords("theme", ["theme_1", "theme_2", "source"], _when("has_thesaurus", _THESAURUS)),
    )
    + _keywords("place", ["place", "'Second place, ' || source"])
    + _when("has_untyped", _keywords("", ["'untyped ' || lang"]))
    + "<gmd:extent><gmd:EX_Extent><gmd:geographicElement><gmd:EX_GeographicBoundingBox>"
    + _bound("westBoundLongitude", "west")
    + _bound("eastBoundLongitude", "east")
    + _bound("southBoundLatitude", "south")
    + _bound("northBoundLatitude", "north")
    + "</gmd:EX_GeographicBoundingBox></gmd:geographicElement>"
    "<gmd:temporalElement><gmd:EX_TemporalExtent><gmd:extent><gml:TimePeriod>"
    "<gml:beginPosition>${begin}</gml:beginPosition>"
    "<gml:endPosition>${coalesce(end, '')}</gml:endPosition>"
    "</gml:TimePeriod></gmd:extent></gmd:EX_TemporalExtent></gmd:temporalElement>"
    "</gmd:EX_Extent></gmd:extent>"
    + _maybe("supplementalInformation", "supplement")
    + "</gmd:MD_DataIdentification></gmd:identificationInfo>"
    "<gmd:distributionInfo><gmd:MD_Distribution><gmd:distributionFormat><gmd:MD_Format>"
    + _characters("name", "Digital file")
    + _maybe("version", "version")
    + "</gmd:MD_Format></gmd:distributionFormat>"
    f"<gmd:distributor><gmd:MD_Distributor><gmd:distributorContact>{_HOUSE_PARTY}"
    "</gmd:distributorContact></gmd:MD_Distributor></gmd:distributor>"
    "</gmd:MD_Distribution></gmd:distributionInfo>"
    "<gmd:metadataMaintenance><gmd:MD_MaintenanceInformation><gmd:contact>"
    + _when("has_curator", _CURATOR_PARTY, _HOUSE_PARTY)
    + "</gmd:contact></gmd:MD_MaintenanceInformation></gmd:metadataMaintenance>"
    "</gmd:MD_Metadata>"
)


def _cdata(tag: str, text: str) -> str:
    return f"<{tag}><![CDATA[{text}]]></{tag}>"


def _fgdc_party(block: str, name: str, organisation: str, position: str, email: str) -> str:
    return (
        f"<cntinfo><{block}>"
        + _cdata("cntorg", organisation)
        + _cdata("cntper", name)
        + f"</{block}>"
        + _cdata("cntpos", position)
        + "<cntaddr>"
        + _cdata("address", "1 Archive Road")
        + _cdata("city", "Norwick")
        + _cdata("country", "Canada")
        + "</cntaddr>"
        + _cdata("cntemail", email)
        + "</cntinfo>"
    )


def _fgdc_person(n: int, block: str, label: str, position: str) -> str:
    return _fgdc_party(
        block,
        f"{label}Given${{person_{n} % 25}} C${{person_{n}}}",
        "Org ${source}",
        position,
        f"c${{person_{n}}}@example.org",
    )


FGDC_TEMPLATE = (
    "<metadata><idinfo><citation><citeinfo>"
    + _cdata("origin", "C${person_1}, Given${person_1 % 25}")
    + _cdata("origin", "C${person_2}, Given${person_2 % 25}")
    + "<pubdate>${date_stamp}</pubdate>"
    + _cdata("title", "${title}")
    + f"</citeinfo></citation><descript><abstract>{_value('text')}</abstract>"
    + _when("purpose IS NOT NULL", _cdata("purpose", "${purpose}"))
    + _cdata("supplinf", "${supplement}")
    + "</descript><timeperd><timeinfo><rngdates>"
    "<begdate>${replace(begin, '-', '')}</begdate>"
    + _when("end IS NOT NULL", "<enddate>${replace(end, '-', '')}</enddate>")
    + "</rngdates></timeinfo></timeperd><spdom><bounding>"
    "<westbc>${west}</westbc><eastbc>${east}</eastbc>"
    "<northbc>${north}</northbc><southbc>${south}</southbc></bounding>"
    + _when("has_depth", "<depthmax>${n_chars % 500}</depthmax><depthmix>0</depthmix>")
    + "</spdom><keywords>"
    + _when(
        "has_themes",
        "<theme><themekt>NULL</themekt>"
        + "".join(_cdata("themekey", f"${{{name}}}") for name in ("theme_1", "theme_2", "source"))
        + "</theme>",
    )
    + "<place><placekt>${place}; ${source}</placekt></place></keywords>"
    f"<ptcontac>{_fgdc_person(1, 'cntorgp', 'Contact: ', 'NULL')}</ptcontac></idinfo>"
    "<distinfo><distrib>"
    + _fgdc_party("cntperp", HOUSE, "Records Network", "Director", "desk@example.org")
    + "</distrib></distinfo><metainfo><metd>20200403</metd>"
    + _when("has_curator", "<revdate><![CDATA[${replace(begin, '-', '')}]]></revdate>")
    + f"<metc>{_fgdc_person(2, 'cntperp', '', 'Keeper')}</metc></metainfo>"
    "</metadata>"
)

TEMPLATES = {"iso": ISO_TEMPLATE, "fgdc": FGDC_TEMPLATE}


# Faulty documents: which rows have one (by remainder of their id by 20), and its text.
FAULTY_EVERY = 20
# Which good rows have very much around their root.
SURROUNDED_EVERY = 5000
FAULTS = {
    "cut": (0, "<${root}><title>${text}"),
    "trailing": (7, "<${root}><title>${text}</title></${root}>\n<more/>"),
    "foreign": (13, "<html><body>${text}</body></html>"),
}
ROOTS = {"iso": "MD_Metadata", "fgdc": "metadata"}


def fault_template(kind: str, dialect: str) -> str:
    return FAULTS[kind][1].replace("${root}", ROOTS[dialect])


def _surrounded(value: Column) -> Column:
    """Some documents with a megabyte of blanks and 20,000 comments before and behind their root."""
    around = F.concat(F.repeat(F.lit(" \n"), 500_000), F.repeat(F.lit("<!-- a note -->\n"), 20_000))
    head = F.regexp_extract(value, r"\A(?:<\?[^>]*\?>)?", 0)
    body = F.substring(value, F.length(head) + 1, F.length(value))
    return F.when(F.expr(f"doc_id % {SURROUNDED_EVERY} = 3"), F.concat(head, around, body, around)).otherwise(value)


def corpus(spark: SparkSession, sf_dir: str, dialect: str) -> DataFrame:
    """``(file_name, value)`` for every document, and the faulty ones beside them.

    All are rendered in one pass over the table, by kind: null is a document's own.
    """
    doc_id, kind = F.col("doc_id"), F.col("kind")
    faults = [F.when(doc_id % FAULTY_EVERY == remainder, F.lit(name)) for name, (remainder, _) in FAULTS.items()]
    kinds = F.concat(F.array(F.lit(None).cast("string")), F.array_compact(F.array(*faults)))
    table = shape(documents(spark, sf_dir).select("*", F.explode(kinds).alias("kind")))
    file_name = F.expr(f"record_id || '_{dialect}.xml'")
    value = _surrounded(_fill(TEMPLATES[dialect]))
    for name in FAULTS:
        template = fault_template(name, dialect).replace("${text}", _value("text"))
        file_name = F.when(kind == name, F.expr(f"doc_id || '-{name}_{dialect}.xml'")).otherwise(file_name)
        value = F.when(kind == name, _fill(template)).otherwise(value)
    return table.select(file_name.alias("file_name"), value.alias("value"))
