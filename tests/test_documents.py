"""Whole documents of both dialects, expected values derived by hand."""

import time

import pytest
from pyspark.sql import functions as F

from cartulary.operators import quality
from cartulary.plans import records as plans
from cartulary.settings import JobSettings
from cartulary.sources import documents as sources
from cartulary.sources.schemas import PATHS
import documents as made

SETTINGS = JobSettings(
    user="keeper",
    region="north",
    shares=("ana", "", "ben", "ana"),
    house_names=made.HOUSE_NAMES,
    as_of="2024-01-01T00:00:00Z",
)


@pytest.fixture
def harmonised(spark):
    def run(*texts, dialect="iso", settings=SETTINGS, registry=None):
        files = [(f"{i}_{dialect}.xml", text) for i, text in enumerate(texts)]
        table = spark.createDataFrame(files, "file_name string, value string")
        records = sources.extract(sources.identify(table, dialect), dialect)
        if dialect == "iso":
            result = plans.harmonise_iso(records, settings, registry)
        else:
            result = plans.harmonise_fgdc(records, settings)
        return {row.recordID: row for row in result.collect()}

    return run


def test_iso_document(harmonised, spark):
    registry = spark.createDataFrame([("10.21963/4471",)], "doi string")
    record = harmonised(made.iso(), registry=registry)["0"]
    assert record.title.en == "Orchard soils" and record.title.fr is None
    assert record.abstract.en == "First line & <more>\n\nSecond line "
    assert (record.language, record.progress) == ("en", "underDevelopment")
    assert record.created == record.datePublished == record.timeFirstPublished
    assert record.created == "2021-03-09T00:00:00Z"
    assert record.dateStart == "2016-05-02T00:00:00Z"
    assert record.dateEnd == "2017-11-30T00:00:00Z"
    assert record.dateRevised == "2024-01-01T00:00:00Z"
    box = record.map
    assert (box.north, box.south, box.east, box.west) == ("52.5", "44", "7.25", "-3.5")
    assert box.description.en == made.PLACE and box.polygon == ""
    tokens = set(made.THEMES) | {piece.strip() for piece in made.PLACE.split(",")}
    assert record.keywords.en == sorted(tokens) and record.keywords.fr == []
    assert record.eov == ["other"]
    assert record.edition == "1.0"
    assert record.datasetIdentifier == "https://doi.org/10.21963/4471"
    assert record.comments.en == "## Purpose: Why\n\n## Supplemental Information: Details"
    assert record.sharedWith == {"ana": True, "ben": True}
    assert record.identifier.startswith("ccin-") and record.filename == "0_iso.xml"
    assert (record.userID, record.status, record.license) == ("keeper", "submitted", "CC-BY-4.0")
    assert record.resourceType == ["oceanographic"] and record.projects == []
    assert (record.noPlatform, record.noTaxa, record.noVerticalExtent) == (True, True, True)
    assert record.vertical == {} and record.history == [] and record.distribution == []
    assert record.associated_resources[0].code.endswith("doi_id=4471")
    assert record.doiCreationStatus == "findable"


def test_iso_contacts_merge(harmonised):
    contacts = harmonised(made.iso())["0"].contacts
    assert [(c.givenNames, c.lastName, c.indName, c.inCitation, c.role) for c in contacts] == [
        (made.HOUSE, "", f"{made.HOUSE} ", False, ["pointOfContact", "custodian", "distributor"]),
        ("Ingrid", "Hale", "Ingrid Hale", True, ["principalInvestigator"]),
        ("Tomas", "Quist", "Tomas Quist", True, ["originator"]),
        ("", "", "", True, ["originator"]),
    ]
    assert contacts[0].indEmail == contacts[0].orgEmail == "desk@example.org"
    assert contacts[1].indEmail is None and contacts[3].orgName == "Farm Circle"


def test_same_party_twice_keeps_both_roles(harmonised):
    twice = [
        made.party("Hale, Ingrid", "Org", "i@example.org", "Author"),
        made.party("Hale, Ingrid", "Org", "i@example.org", "funder"),
        made.party("Hale, Ingrid", "Org", None, "Author"),
        made.party("Ingrid Hale", "Org", "i@example.org", "Author"),
    ]
    contacts = harmonised(made.iso(cited=twice, groups=[made.keywords("place", ["x"])]))["0"].contacts
    assert [c.role for c in contacts[1:]] == [["author", None, "author"], ["author"]]


def test_missing_and_empty_parts(harmonised):
    bare = made.iso(
        point_of_contact=None,
        language="<gmd:language/>",
        date_stamp="",
        uri=None,
        version='<gmd:version gco:nilReason="unknown"/>',
        citation="Unpublished",
        groups=[made.keywords(None, ["a, b ,a", ""])],
    )
    record = harmonised(bare)["0"]
    assert record.contacts[0].role == ["pointOfContact"]
    assert record.contacts[0].orgName is None and record.contacts[0].indName == ""
    assert record.contacts[1].role == ["custodian", "distributor"]
    assert record.language is None and record.created is None
    assert record.datasetIdentifier == "" and record.edition == "1.0"
    assert record.keywords.en == ["a", "b"] and record.eov == ["other"]
    assert record.map.description.en == ""


def test_language_falls_back_to_the_identification(harmonised):
    text = made.iso(language="").replace(
        "<gmd:extent><gmd:EX_Extent", made.cs("language", "fra; CAN") + "<gmd:extent><gmd:EX_Extent", 1
    )
    assert harmonised(text)["0"].language == "fr"


def test_keyword_rules(harmonised):
    groups = [
        made.keywords("theme", ["Chlorophyll", "salinity", "Salinity "]),
        made.keywords("place", ["One, x", "dropped place"]),
        made.keywords("place", ["Two"]),
        made.keywords("temporal", ["Salinity"]),
        made.keywords("theme", ["CTD profiles"]),
    ]
    record = harmonised(made.iso(groups=groups))["0"]
    assert record.eov == [
        "oceanColour",
        "phytoplanktonBiomassAndDiversity",
        "subSurfaceSalinity",
        "subSurfaceTemperature",
    ]
    assert record.map.description.en == "One, x - Two"
    assert "Salinity" in record.keywords.en and "dropped place" in record.keywords.en


def test_categories_parameter_wins(harmonised):
    chosen = JobSettings(categories=("seaIce",), house_names=made.HOUSE_NAMES, as_of="x")
    assert harmonised(made.iso(), settings=chosen)["0"].eov == ["seaIce"]


def test_doi_prefix_priority(harmonised, spark):
    dois = ["10.2/4471", "10.21963/4471", "10.2/7", "10.9/4471", "10.2/8/9"]
    registry = spark.createDataFrame([(doi,) for doi in dois], "doi string")
    both = JobSettings(doi_prefixes=("10.2", "10.21963"), as_of="x")
    uri = "https://records.example.org/show?doi_id="
    found = harmonised(
        made.iso(), made.iso(uri=f"{uri}6"), made.iso(uri=f"{uri}8/9"), settings=both, registry=registry
    )
    assert found["0"].datasetIdentifier == "https://doi.org/10.2/4471"
    assert found["1"].datasetIdentifier == ""
    assert found["2"].datasetIdentifier == "https://doi.org/10.2/8/9"


def test_no_namespace_and_declaration(harmonised):
    plain = made.iso().replace("gmd:", "").replace("gco:", "").replace("gml:", "")
    declared = '<?xml version="1.0" encoding="UTF-8"?>\n' + made.iso()
    found = harmonised(plain, declared)
    assert found["0"].title.en == found["1"].title.en == "Orchard soils"
    assert len(found["0"].contacts) == 4


def test_fgdc_document(harmonised):
    record = harmonised(made.fgdc(), dialect="fgdc")["0"]
    assert record.organization == "Vale College"
    assert record.title.en == "Orchard soils" and record.abstract.en == "Text & more"
    assert [(c.givenNames, c.lastName, c.role) for c in record.contacts] == [
        ("Tomas", "Quist", ["pointOfContact"]),
        ("Farm Letters", "Desk", ["owner"]),
        ("Tomas", "Quist", ["custodian"]),
        ("Ingrid", "Hale", ["author"]),
        ("Tomas", "Quist", ["author"]),
    ]
    first, second, third, author, _ = record.contacts
    assert (first.indPosition, second.indPosition, third.indPosition) == ("NULL", "Director", None)
    assert first.orgEmail == "" and first.indEmail == "one@example.org"
    assert first.orgAddress == "2 Mill Lane" and author.inCitation and author.orgName is None
    assert len(record.keywords.en) == 6 and record.keywords.en[-1] == "Low Pasture"
    assert (record.created, record.dateStart, record.dateEnd) == ("20210309", "20160502", "20171130")
    assert record.dateRevised is None and record.timeFirstPublished == "20190612"
    assert (record.language, record.progress) == ("en", "onGoing")
    assert record.limitations.en == "Why\n\nDetails" and record.edition == ""
    assert record.platforms[0].type == "ship" and record.noPlatform is False
    assert (record.map.north, record.map.west) == ("52.5", "-3.5")


def _landed(spark, texts, dialect):
    files = [(f"{i}_{dialect}.xml", text) for i, text in enumerate(texts)]
    table = spark.createDataFrame(files, "file_name string, value string")
    return sources.land(sources.identify(table, dialect), dialect)


def test_malformed_documents_are_set_aside(spark):
    broken = made.iso().replace("</gmd:MD_Metadata>", "")
    texts = [made.iso(), broken, "", None, made.fgdc(), "no markup"]
    landed = _landed(spark, texts, "iso")
    rows = {row.record_id: row for row in landed.collect()}
    assert [rows[str(i)].malformed for i in range(6)] == [False, True, True, True, True, True]
    assert [rows[str(i)].problem for i in range(6)] == [None, *["malformed_xml"] * 3, "wrong_dialect", "malformed_xml"]
    assert rows["1"].rejected == broken and rows["1"].title is None
    assert rows["0"].rejected is None and rows["4"].title is None
    table = spark.createDataFrame(
        [(f"{i}_iso.xml", text) for i, text in enumerate(texts)], "file_name string, value string"
    )
    rejected = sources.quarantine(sources.identify(table, "iso"), "iso").collect()
    assert sorted(row.record_id for row in rejected) == ["1", "2", "3", "4", "5"]
    assert next(row.text for row in rejected if row.record_id == "1") == broken
    usable = sources.landed_records(landed)
    assert sorted(row.record_id for row in usable.collect()) == ["0"]


def test_what_stands_around_a_document(spark):
    whole = made.fgdc().replace("<metd>", "<revdate>2021</revdate><metd>")
    texts = [
        whole,
        "<!DOCTYPE metadata [<!ENTITY x 'y'>]>\n" + whole,
        "<?xml version='1.0'?><!-- metadata --><?pi x?>\n" + whole + "\n<!-- end -->\n",
        whole + "<more/>",
        whole + whole,
        whole + "text",
        "<html><body><metadata></metadata></body></html>",
        whole.replace("<metd>", "<!-- </metadata> --><metd>"),
    ]
    rows = {row.record_id: row for row in _landed(spark, texts, "fgdc").collect()}
    found = [rows[str(i)].problem for i in range(8)]
    assert found == [None, None, None, *["malformed_xml"] * 3, "wrong_dialect", None]
    assert [rows[str(i)].revised for i in range(8)] == ["2021"] * 3 + [None] * 4 + ["2021"]


AROUND = [" \n" * 2_500_000, "<!-- a note -->\n" * 20_000, "<?a step?>" * 20_000, "\n" * 2_000, "<!--" + "x" * 5_000_000 + "-->"]


@pytest.mark.parametrize("dialect", ["iso", "fgdc"])
def test_much_white_space_and_many_comments_around_the_root(spark, dialect):
    """Five million characters before, behind and on both sides of a root: good records, in linear time."""
    text = getattr(made, dialect)()
    declared = text.startswith("<?xml")
    head, body = (text[: text.index("?>") + 2], text[text.index("?>") + 2 :]) if declared else ("", text)
    texts = [text] + [t for around in AROUND for t in (head + around + body, text + around, head + around + body + around)]
    rows = [(str(i), t) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "record_id string, value string").withColumn("file_name", F.col("record_id")).repartition(4)
    started = time.monotonic()
    found = {r.record_id: (r.problem, r.document) for r in sources.parse(table, dialect, ("title",)).collect()}
    assert time.monotonic() - started < 60
    assert [found[str(i)] for i in range(len(texts))] == [(None, found["0"][1])] * len(texts)


def test_hostile_texts_are_set_aside_in_linear_time(spark):
    good = "<metadata><idinfo/></metadata>"
    texts = [
        "<!--" * 300_000, good + "<!--" * 300_000, good + "</metadata>" * 100_000, "<?" * 300_000 + good, good + "<![CDATA[" * 100_000,
        "</metadata><!--" * 60_000, "<metadata>" + "<" * 500_000 + "</metadata>x", good + "<![CDATA[x]]>", good + "<!-- open </metadata>",
        "<!DOCTYPE metadata [" * 50_000, "<metadata" + " a='b'" * 100_000 + "/>", "<metadata/><!-- </metadata> --> ",
    ]
    table = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "record_id string, value string")
    started = time.monotonic()
    reasons = table.select("record_id", sources._outer(F.col("value"), "fgdc").alias("problem")).collect()
    assert time.monotonic() - started < 30
    assert [r.problem for r in sorted(reasons, key=lambda r: int(r.record_id))] == ["malformed_xml"] * 10 + [None] * 2


def _rules(findings):
    return sorted((row.record_id, row.rule, row.detail) for row in findings.collect())


def test_findings(spark):
    worst = made.iso(
        point_of_contact=None,
        language=cs_language("deu"),
        date_stamp="2021-13-40",
        status="obsolete",
        uri=None,
        citation="Doe, J., Roe, R., Poe, B., Coe, D. (2020)",
        cited=[made.party("Anna Maria Hale", role="funder")],
        groups=[made.keywords("theme", ["Unlisted"])],
    )
    found = _rules(quality.iso_findings(_landed(spark, [worst, "<a>"], "iso"), made.HOUSE_NAMES))
    assert found == sorted(
        [
            ("0", "element_missing", "uri"),
            ("0", "missing_section", "point_of_contact"),
            ("0", "unparsable_date", "date_stamp=2021-13-40"),
            ("0", "unmapped_code", "language_code=deu"),
            ("0", "unmapped_code", "progress_code=obsolete"),
            ("0", "unmapped_role", "role=funder"),
            ("0", "missing_name", "point_of_contact"),
            ("0", "name_more_than_two_parts", "cited=Anna Maria Hale"),
            ("0", "citation_party_mismatch", "4 > 1"),
            ("0", "no_category", "Unlisted"),
            ("1", "wrong_dialect", "1_iso.xml"),
        ]
    )


def cs_language(code):
    return made.cs("language", code)


def test_citation_findings(spark):
    texts = [
        made.iso(citation="Doe, J. et al. in press"),
        made.iso(citation="Doe, J. in press"),
        made.iso(citation="A, B, C, D, et al. (2020)"),
        made.iso(),
    ]
    found = _rules(quality.iso_findings(_landed(spark, texts, "iso"), made.HOUSE_NAMES))
    cites = [(i, rule) for i, rule, _ in found if rule.startswith("citation")]
    assert cites == [("0", "citation_et_al"), ("1", "citation_no_authors")]


def test_fgdc_findings(spark):
    found = _rules(quality.fgdc_findings(_landed(spark, [made.fgdc()], "fgdc")))
    assert found == [
        ("0", "fgdc_incomplete", "fgdc"),
        ("0", "literal_null", "points_of_contact.position"),
        ("0", "name_more_than_two_parts", "distributors=Farm Letters Desk"),
    ]


def test_summary_counts_records_once(spark):
    rows = [("1", "r", "info", "a"), ("1", "r", "info", "b"), ("2", "r", "info", "a")]
    findings = spark.createDataFrame(rows, "record_id string, rule string, severity string, detail string")
    (row,) = quality.summarise(findings).collect()
    assert (row.findings, row.records) == (3, 2)


def test_bounding_numbers(spark):
    table = spark.createDataFrame(
        [("1", "52.5", "x", "", None)], "record_id string, north string, south string, east string, west string"
    )
    (row,) = plans.box_numbers(table).collect()
    assert (row.north_value, row.south_value, row.east_value, row.west_value) == (52.5, None, None, None)


def test_one_parser_per_document(spark):
    files = spark.createDataFrame([("0_iso.xml", made.iso())], "file_name string, value string")
    extracted = sources.extract(sources.identify(files, "iso"), "iso")
    records = plans.harmonise_iso(extracted, SETTINGS)
    plan = records.where(F.col("title.en") != "")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 1


def test_elements_without_a_fixed_place(harmonised):
    text = made.fgdc().replace(
        "<metd>", "<deep><revdate><![CDATA[2021]]></revdate></deep><depthmax>40</depthmax><depthmix/><metd>"
    )
    found = harmonised(text, made.fgdc(), text.replace("</metadata>", ""), dialect="fgdc")
    assert sorted(found) == ["0", "1"]
    first = found["0"]
    assert (first.dateRevised, first.verticalExtentMax, first.verticalExtentMin) == ("2021", "40", None)
    assert found["1"].dateRevised is None


@pytest.mark.parametrize("dialect", ["iso", "fgdc"])
def test_each_column_alone_equals_all_together(spark, dialect):
    texts = [getattr(made, dialect)(), "<broken>", "<other/>", "<MD_Metadata/>", "<metadata/>"]
    if dialect == "fgdc":
        texts.append(texts[0].replace("<metd>", "<revdate>2021</revdate><metd>"))
    files = spark.createDataFrame(
        [(f"{i}_{dialect}.xml", text) for i, text in enumerate(texts)],
        "file_name string, value string",
    )
    files = sources.identify(files, dialect)
    whole = {row.record_id: row.asDict() for row in sources.extract(files, dialect).collect()}
    assert set(PATHS[dialect]) | {"record_id", "file_name"} == set(whole["0"])
    for name in PATHS[dialect]:
        alone = sources.extract(files, dialect, (name,)).collect()
        assert {row.record_id: row[name] for row in alone} == {
            record_id: row[name] for record_id, row in whole.items()
        }
