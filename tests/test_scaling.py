"""What keeps rendering and parsing cheap and spread, with results that stay the same."""

from pyspark.sql import functions as F

from cartulary.functions import keys
from cartulary.sources import documents as sources
from cartulary.workload import corpus

TAG = "</gmd:MD_Metadata>"
TEXTS = [
    "",
    ">",
    TAG,
    "é" * 3000 + TAG,
    "𝄞" * 900,
    "a𝄞" * 900 + TAG,
    "x" * 3000 + TAG + " \n" * 300,
    "x" * 3000 + TAG + " \n" * 3000,
    "é" * 500 + TAG + " " * 765,
    " \t\r\n" * 700,
    "y" * 2000 + "é \n",
    "/MD_Metadata" + "z" * 3000 + "</MD_Metadata>",
    "<!-- /MD_Metadata /MD_Metadata -->" * 90 + TAG,
    *["/MD_Metadata" + "q" * n for n in range(1005, 1027)],
    None,
]


def test_ends_of_texts_are_read_as_whole_texts_are(evaluate):
    text = F.col("text")
    tails = [None if x is None else x.rstrip(" \t\r\n")[-256:] for x in TEXTS]
    assert evaluate(TEXTS, sources._tail(text)) == tails
    for part in ("/MD_Metadata", ":MD_Metadata"):
        assert evaluate(TEXTS, sources._occurrences(text, part)) == [x and x.count(part) if x else (None if x is None else 0) for x in TEXTS]


def test_root_names_behind_anything(evaluate):
    named = {
        "<metadata>": "metadata",
        "<gmd:MD_Metadata xmlns='x'/>": "MD_Metadata",
        "<!-- <other> -->" * 200 + "<metadata/>": "metadata",
        "<?xml version='1.0'?><!DOCTYPE a [ <!ELEMENT a (b)> ] >" + " " * 2000 + "<p:a\n>": "a",
        "<!--" + "x" * 1020 + "--><metadata>": "metadata",
        **{" " * n + "<gmd:MD_Metadata>": "MD_Metadata" for n in range(1000, 1030)},
        "<a:b:c>": "b",
        "<" + "n" * 2000 + ">": "n" * 2000,
        "plain": "",
        "<!-- never closed <metadata>": "",
    }
    assert evaluate(list(named), sources._root_name(F.col("text"))) == list(named.values())


def test_document_ids(evaluate):
    names = ["9_iso.xml", "9_fgdc.xml", "deep/plain.xml", "a.xml_iso.xml", "x_iso.xml.bak", None]
    assert evaluate(names, keys.document_id(F.col("text"), "iso")) == ["9", "9_fgdc", "deep/plain", "a.xml", "x_iso.xml.bak", None]


def test_corpus_is_rendered_in_one_pass_by_a_given_number_of_tasks(spark, tmp_path):
    rows = [(n, "a & b <c>\r" if n % 2 else "plain", "en", "s", 9) for n in range(40)] + [(None, "t", "en", "s", 1), (7, None, "fr", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    found = corpus.corpus(spark, str(tmp_path), "fgdc")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == plan.count("Scan parquet") == 1
    least = 4 * spark.sparkContext.defaultParallelism
    assert found.rdd.getNumPartitions() >= least
    made = {row.file_name: row.value for row in found.collect()}
    faulty = {f"{n}-{kind}_fgdc.xml" for kind, (r, _) in corpus.FAULTS.items() for n in range(40) if n % corpus.FAULTY_EVERY == r}
    assert set(made) == {f"{n}_fgdc.xml" for n in range(40)} | faulty | {None}
    assert made["20-cut_fgdc.xml"] == "<metadata><title>plain" and "a &amp; b &lt;c&gt;&#13;" in made["1_fgdc.xml"]
    assert found.count() == len(rows) + len(faulty) + 1  # id 7 twice, and its faulty document
