"""Edge rows of every rule that looks at one text."""

from pyspark.sql import functions as F

from cartulary.functions import citation, codes, dates, keys, names, text
from cartulary.settings import LANGUAGE_CODES, PROGRESS_CODES

HOUSE_NAMES = {"Example Archive": ["Example Archive", ""]}


def test_dates(evaluate):
    text_column = F.col("text")
    cases = {
        None: (None, None),
        "": (None, None),
        "Undefined": (None, None),
        "2024": ("2024", "invalid_date"),
        "July 2024": ("July 2024", "invalid_date"),
        "2024-07-18": ("2024-07-18T00:00:00Z", None),
        "2024-13-40": ("2024-13-40", "unparsable_date"),
        "2024-02-30": ("2024-02-30", "unparsable_date"),
        "2024-02-29": ("2024-02-29T00:00:00Z", None),
        "2024-07-18T00:00": ("2024-07-18T00:00", "unparsable_date"),
        "2024-7-18": ("2024-7-18", "invalid_date"),
        "+2024-07-18": ("+2024-07-18", "invalid_date"),
    }
    assert evaluate(list(cases), dates.normalise_date(text_column)) == [v[0] for v in cases.values()]
    assert evaluate(list(cases), dates.date_finding(text_column)) == [v[1] for v in cases.values()]


def test_roles_and_codes(evaluate):
    text_column = F.col("text")
    cases = {
        "Originator": "originator",
        "Collaborator": "collaborator",
        "Author": "author",
        "coAuthor": "coauthor",
        "pointOfContact": "pointOfContact",
        "principalInvestigator": "principalInvestigator",
        "coauthor": "coauthor",
        "originator": "originator",
        "AUTHOR": None,
        "funder": None,
        "": None,
        None: None,
    }
    assert evaluate(list(cases), codes.map_role(text_column)) == list(cases.values())
    languages = ["eng; CAN", "fra; CAN", "eng", None]
    assert evaluate(languages, codes.map_code(text_column, LANGUAGE_CODES)) == ["en", "fr", None, None]
    progress = ["ongoing", "onGoing", "planned", "completed", "underDevelopment", "obsolete"]
    assert evaluate(progress, codes.map_code(text_column, PROGRESS_CODES)) == [
        "onGoing", None, "planned", "completed", "underDevelopment", None
    ]


def test_person_names(evaluate):
    text_column = F.col("text")
    cases = {
        None: ("", "", "", 0),
        "": ("", "", "", 0),
        "  \t ": ("", "", "", 0),
        "Doe": ("", "Doe", "Doe", 1),
        "Jane Doe": ("Jane", "Doe", "Jane Doe", 2),
        "Doe, Jane": ("Jane", "Doe", "Jane Doe", 2),
        "Contact: Jane Doe": ("Jane", "Doe", "Jane Doe", 2),
        "A: Doe, Jane": ("Jane", "Doe", "Jane Doe", 2),
        "A: B: Doe, Jane": ("Jane", "Doe", "Jane Doe", 2),
        "Jane van Doe": ("Jane van", "Doe", "Jane van Doe", 3),
        "Doe, Jane, Jr": ("Jr Jane", "Doe", "Jr Jane Doe", 3),
        "Example Archive": ("Example Archive", "", "Example Archive ", 0),
        " Example   Archive ": ("Example Archive", "", "Example Archive ", 0),
        "Archive, Example": ("Example Archive", "", "Example Archive ", 0),
        "Jane Doe": ("Jane", "Doe", "Jane Doe", 2),
        "Doe:": ("", "", "", 0),
    }
    found = evaluate(list(cases), names.person_name(text_column, HOUSE_NAMES))
    assert [tuple(name) for name in found] == list(cases.values())


def test_house_names_from_a_column(evaluate):
    text_column = F.col("text")
    override = F.when(text_column == "Long List Name", F.array(F.lit("Long List"), F.lit("Name")))
    found = evaluate(["Long List Name", "Jane Doe"], names.person_name(text_column, {}, override))
    assert [tuple(name) for name in found] == [
        ("Long List", "Name", "Long List Name", 0),
        ("Jane", "Doe", "Jane Doe", 2),
    ]


def test_second_dialect_names(evaluate):
    text_column = F.col("text")
    found = evaluate(
        ["Contact: Jane  Doe", "Doe, Jane", None, "Desk of Records"], names.labelled_name(text_column)
    )
    assert [tuple(name) for name in found] == [
        ("Jane", "Doe", "Jane  Doe", 2),
        ("Doe,", "Jane", "Doe, Jane", 2),
        ("", "", "", 0),
        ("Desk of", "Records", "Desk of Records", 3),
    ]
    found = evaluate(["Doe, Jane", "A: Doe", None], names.author_name(text_column))
    assert [tuple(name)[:2] for name in found] == [("Jane", "Doe"), ("A:", "Doe"), ("", "")]


def test_citations(evaluate):
    text_column = F.col("text")
    cases = {
        None: [],
        "": [],
        "Unpublished": [],
        "unpublished data": [],
        "UNPUBLISHED DATA": [],
        "Doe, J., & Roe, R. (2020). Title": [("Doe", "J."), ("Roe", "R.")],
        "Doe, J. and Roe, R. (2020)": [("Doe", "R.")],
        "Doe, J., A., Poe, B. 2020. T": [("Doe", "A."), ("Poe", "B.")],
        "Doe, J. without a year": [],
        "Doe, J., et al. (2020). T": [("Doe", "J."), ("et al.", None)],
        "(2020). T": [],
        "J., Doe (2020)": [("J.", None), ("Doe", None)],
        "Étienne, É., Doe (2020)": [("Étienne", "É."), ("Doe", None)],
        " , Doe,, J. ,(2020)": [("Doe", "J.")],
        "Institute 2020. T": [("Institute", None)],
    }
    found = evaluate(list(cases), citation.citation_authors(text_column))
    assert [[tuple(author) for author in authors] for authors in found] == list(cases.values())
    assert evaluate(["a et al. b", "x", None], citation.abbreviates_authors(text_column)) == [
        True, False, False
    ]


def test_keys(evaluate):
    text_column = F.col("text")
    import hashlib

    key = hashlib.md5(b"iso-13172").hexdigest()
    assert evaluate(["13172"], keys.record_key("iso", text_column)) == [key]
    dashed = "-".join((key[:8], key[8:12], key[12:16], key[16:20], key[20:]))
    assert evaluate([key], keys.identifier(text_column)) == [f"ccin-{dashed}"]
    assert evaluate(["x?a=1&b=22", "plain", None], keys.local_id(text_column)) == ["22", "plain", None]
    assert evaluate(["9_iso.xml", "9_fgdc.xml"], keys.record_id(text_column, "iso")) == ["9", "9_fgdc.xml"]
    url = keys.harvest_url("https://example.org/xml/", text_column, "fgdc")
    assert evaluate(["9"], url) == ["https://example.org/xml/fgdc/9_fgdc.xml"]
    remembered = hashlib.md5("été-en-fr".encode()).hexdigest()
    assert evaluate(["été"], keys.translation_key(text_column, F.lit("en"), F.lit("fr"))) == [remembered]


def test_random_keys_differ(spark):
    made = spark.range(50).select(keys.record_key("iso", F.col("id"), random=True).alias("key"))
    found = [row.key for row in made.collect()]
    assert len(set(found)) == 50 and all(len(key) == 32 for key in found)


def test_literals_are_quoted(evaluate):
    text_column = F.col("text")
    odd = "it's a \\ \"text\" %s ${x}\n"
    assert evaluate(["k"], F.element_at(text.text_map({"k": odd}), text_column)) == [odd]
    assert evaluate(["k"], text.text_array([odd, ""])) == [[odd, ""]]
    assert evaluate(["k"], text.text_array([])) == [[]]
