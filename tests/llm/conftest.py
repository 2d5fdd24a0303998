"""Tables with awkward rows: nulls, empty and long texts, ties, repeated rows, clashing names."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, score string, spans string, `class` string"
LONG = " ".join(f"word{k * 7919 % 10007} filler{k % 13}" for k in range(9000))
PASSAGE = " ".join(f"passage{k}" for k in range(60))


def rows():
    texts = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "One two"), (5, "one TWO"), (6, LONG), (7, LONG + " end"),
        (8, "start " + PASSAGE + " tail one"), (9, "other begin " + PASSAGE + " different"), (9, "other begin " + PASSAGE + " different"),
        (10, "Ünïcödé — “quotes” 日本語 text’s ÅNGSTRÖM İstanbul 𝔘"), (None, "no id here at all"), (None, None),
        (11, "one-word"), (12, "12345 67890"), (13, "it's we're <|endoftext|> they'll"), (14, "a " * 700), (15, "a " * 700),
        (16, PASSAGE), (4, "same id other text"),
    ]
    return [(i, t, "en" if k % 2 else None, None, None, "x", "y", "z", "c") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
