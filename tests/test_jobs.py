"""Jobs over files: ingest, conversion, export and append, incremental runs."""

import json
import re
import subprocess
import sys
from dataclasses import replace
from pathlib import Path

import documents as made
import pytest

from cartulary.operators import appending, subjects, translation
from cartulary.operators.appending import KeyCollision
from cartulary.plans import jobs
from cartulary.settings import JobSettings
from cartulary.sources import exports, lists
from cartulary.sources.documents import land, present_records, read_documents
from cartulary.staging import staging
from cartulary.streaming.incremental import ingest_new

SETTINGS = JobSettings(
    user="keeper", shares=("ana",), house_names=made.HOUSE_NAMES, as_of="2024-01-01T00:00:00Z"
)


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "xml"
    (source / "deep").mkdir(parents=True)
    (source / "1_iso.xml").write_text(made.iso())
    (source / "deep" / "2_iso.xml").write_text(made.iso(date_stamp="Undefined"))
    (source / "3_iso.xml").write_text(made.iso()[:-10])
    (source / "4_fgdc.xml").write_text(made.fgdc())
    (source / "notes.txt").write_text("not a record")
    return source


def test_read_documents(spark, folder):
    found = {row.record_id: row for row in read_documents(spark, str(folder), "iso").collect()}
    assert sorted(found) == ["1", "3", "deep/2"] and found["1"].value == made.iso()
    assert [r.record_id for r in read_documents(spark, str(folder), "fgdc").collect()] == ["4"]
    assert sorted(r.record_id for r in present_records(spark, str(folder), "iso").collect()) == ["1", "3", "deep/2"]
    assert present_records(spark, str(folder / "absent"), "iso").count() == 0


def test_declared_encodings(spark, tmp_path):
    def text(encoding):
        return f"<?xml version='1.0' encoding='{encoding}'?>\n" + made.iso().replace("Why", "Été")

    for i, (encoding, codec) in enumerate(
        [
            ("ISO-8859-1", "latin-1"), ("UTF-8", "utf-8"), ("utf-8", "utf-8-sig"), ("windows-1252", "cp1252"),
            ("ISO-8859-15", "iso-8859-15"), ("UTF-16", "utf-16"),
        ]
    ):
        (tmp_path / f"{i}_iso.xml").write_bytes(text(encoding).encode(codec))
    (tmp_path / "6_iso.xml").write_bytes(text("windows-1252").replace("Été", "5 €").encode("cp1252"))
    (tmp_path / "7_iso.xml").write_bytes(text("unheard-of").encode())
    (tmp_path / "8_iso.xml").write_bytes(text("UTF-8").encode("latin-1"))
    (tmp_path / "9_iso.xml").write_bytes(made.iso().replace("Why", "encoding='latin1' Été").encode())
    landed = land(read_documents(spark, str(tmp_path), "iso"), "iso")
    found = {row.record_id: (row.purpose, row.problem) for row in landed.collect()}
    assert found == {
        **dict.fromkeys("012345", ("Été", None)), "6": ("5 €", None), **dict.fromkeys("78", (None, "undecodable")),
        "9": ("encoding='latin1' Été", None),
    }


def test_patterns_and_equal_names(spark, folder):
    (folder / "deep" / "1_iso.xml").write_text(made.iso())
    (folder / "plain.xml").write_text(made.iso())
    found = [row.record_id for row in read_documents(spark, str(folder), "iso").collect()]
    assert sorted(found) == ["1", "3", "deep/1", "deep/2"]
    for pattern, ids in (("*.xml", ["1", "3", "4_fgdc", "plain"]), ("*/*.xml", ["deep/1", "deep/2"]), ("plain.xml", ["plain"])):
        rows = read_documents(spark, f"{folder}/{pattern}", "iso").collect()
        assert sorted(row.record_id for row in rows) == ids


def test_convert_and_append(spark, folder, tmp_path):
    first = str(tmp_path / "first")
    jobs.convert(spark, str(folder), first, "iso", SETTINGS)
    records = spark.read.parquet(f"{first}/records")
    assert sorted(row.recordID for row in records.collect()) == ["1", "deep/2"]
    assert not list(Path(spark.conf.get("spark.checkpoint.dir")).glob("cartulary-*"))
    assert spark.read.parquet(f"{first}/shares").count() == 2
    (rejected,) = spark.read.parquet(f"{first}/rejected").collect()
    assert rejected.record_id == "3" and rejected.rejected == made.iso()[:-10]
    findings = spark.read.parquet(f"{first}/findings")
    assert findings.where("rule = 'malformed_xml'").count() == 1

    lines = exports.read_record_lines(spark, f"{first}/record_lines")
    assert lines.count() == 2
    back = exports.typed_records(lines, records.schema)
    assert sorted(back.select(*records.columns).collect()) == sorted(records.collect())
    text = next(Path(f"{first}/record_lines").glob("*.txt")).read_text().splitlines()[0]
    assert json.loads(text)["record"]["verticalExtentMax"] is None

    earlier = (records, spark.read.parquet(f"{first}/shares"))
    refused = tmp_path / "refused"
    with pytest.raises(KeyCollision):
        jobs.convert(spark, str(folder), str(refused), "iso", SETTINGS, append_to=earlier)
    assert not refused.exists()

    second = str(tmp_path / "second")
    jobs.convert(spark, str(folder), second, "fgdc", SETTINGS, append_to=earlier)
    both = spark.read.parquet(f"{second}/records")
    assert sorted(row.recordID for row in both.collect()) == ["1", "4", "deep/2"]
    assert [r.organization for r in both.where("recordID = '4'").collect()] == ["Vale College"]


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_vocabulary_as_a_table(spark, folder, tmp_path, limit):
    """The same records and findings as with the mapping, whether the table is broadcast or not."""
    landed = land(read_documents(spark, str(folder), "iso"), "iso")
    themes = {w for row in landed.where("not malformed").select(subjects.theme_keywords().alias("w")).collect() for w in row.w}
    pairs = [("first", min(themes)), ("first", min(themes)), ("second", min(themes)), ("third", None), ("fourth", "unheard of")]
    table = spark.createDataFrame(pairs, "category string, term string")
    mapping = {"first": [min(themes)], "second": [min(themes)], "third": [], "fourth": ["unheard of"]}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        for vocabulary in (table, table.limit(0)):
            terms = mapping if vocabulary is table else {}
            target = str(tmp_path / f"out{len(terms)}")
            jobs.convert(spark, str(folder), f"{target}a", "iso", replace(SETTINGS, vocabulary=terms))
            jobs.convert(spark, str(folder), f"{target}b", "iso", SETTINGS, vocabulary=vocabulary)
            for name in ("records", "findings", "rejected"):
                left, right = (spark.read.parquet(f"{target}{x}/{name}") for x in "ab")
                assert left.columns == right.columns
                assert sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))
            found = {tuple(r.eov) for r in spark.read.parquet(f"{target}b/records").collect()}
            assert (("first", "second") in found) == bool(terms)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _moved(table):
    """The columns that each exchange of a plan moves."""
    text = table._sc._jvm.PythonSQLUtils.explainString(table._jdf.queryExecution(), "formatted")
    parts = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", text)
    return [{name.split("#")[0].strip() for name in re.sub(r"\(.*?\)", "", part).split(",")} for part in parts]


def test_records_stay_where_they_are(spark, folder):
    """With tables too large to broadcast, ids, keys and answers move; contacts and texts don't."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with staging(spark) as keep:
            landed = keep(land(read_documents(spark, str(folder), "iso"), "iso"), by="record_id")
            registry = spark.createDataFrame([("10.21963/7",)], "doi string")
            records = jobs.harmonise(landed, "iso", SETTINGS, registry)
            exchanges = _moved(records)
            assert len(exchanges) >= 3
            assert set().union(*exchanges) <= {"record_id", "local_id", "doi_url", "_bucket", "priority", "min"}
            themes = landed.select("record_id", subjects.theme_keywords().alias("keywords"))
            terms = spark.createDataFrame([("c", "t")], "category string, term string")
            matched = keep(subjects.matched_by_table(themes, terms), by="record_id")
            classified = _moved(jobs.harmonise(landed.join(matched, "record_id", "left"), "iso", SETTINGS, registry))
            assert sorted(map(sorted, classified)) == sorted(map(sorted, exchanges))
            fields = ("title", "abstract", "distribution.name")
            stored = keep(translation.with_field_keys(records, fields), by="recordID", dealt=True)
            memory = spark.createDataFrame([("k", "t")], "cache_key string, translated string")
            done = translation.translate_records(stored, memory, key="recordID", fields=fields)
            exchanges = _moved(done)
            assert exchanges and not set().union(*exchanges) & {"title", "abstract", "contacts", "distribution", "keywords", "map"}
            assert done.count() == 2
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("cartulary_")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_convert_with_translation(spark, folder, tmp_path):
    memory_file = tmp_path / "memory.json"
    assert exports.read_memory(spark, str(memory_file)).count() == 0
    import hashlib

    key = hashlib.md5(b"Orchard soils-en-fr").hexdigest()
    memory_file.write_text(json.dumps({key: "Sols de verger"}, indent=2))
    target = str(tmp_path / "out")
    memory = exports.read_memory(spark, str(memory_file))
    jobs.convert(spark, str(folder), target, "iso", SETTINGS, memory=memory)
    titles = {row.title.fr for row in spark.read.parquet(f"{target}/records").collect()}
    assert titles == {"Sols de verger"}
    pending = {row.text for row in spark.read.parquet(f"{target}/pending").collect()}
    assert pending == {
        "First line & <more>\n\nSecond line ",
        "## Purpose: Why\n\n## Supplemental Information: Details",
    }


def test_envelopes(spark, tmp_path):
    body = {
        "records": {"k1": {"title": {"en": "T"}}, "k2": {"title": {"en": "U"}}},
        "shares": {"ana": {"u": {"k1": {"shared": True}, "k2": {"shared": True}}}},
    }
    for name, content in (("object.json", body), ("list.json", [body])):
        path = tmp_path / name
        path.write_text(json.dumps(content, indent=2))
        records = exports.read_envelope_records(spark, str(path))
        assert {row.record_key: json.loads(row.record) for row in records.collect()} == body["records"]
        shares = {tuple(row) for row in exports.read_envelope_shares(spark, str(path)).collect()}
        assert shares == {("ana", "u", "k1", True), ("ana", "u", "k2", True)}
    bare = tmp_path / "bare.json"
    bare.write_text("{}")
    assert exports.read_envelope_records(spark, str(bare)).count() == 0
    assert exports.read_envelope_shares(spark, str(bare)).count() == 0


def test_memories_of_every_layout(spark, tmp_path):
    """One entry a line is split over tasks; any other layout gives the same entries."""
    entries = {"a": "x, y", "b": 'quote " and \\ and {', "c": "", "d": "line\nend", '},"e': "}", "f": "é" * 3}
    by_line = {"lines": json.dumps(entries, indent=2), "returns": json.dumps(entries, indent=1).replace("\n", "\r\n"), "none": "{\n}"}
    whole = {
        "compact": json.dumps(entries),
        "number": json.dumps({**entries, "g": 1}, indent=2),
        "nested": json.dumps({**entries, "g": {"h": "i"}}, indent=2),
        "listed": json.dumps({**entries, "g": ["h", "i"]}, indent=2),
    }
    for name, text in {**by_line, **whole}.items():
        path = tmp_path / f"{name}.json"
        path.write_bytes(text.encode())
        assert (exports._entry_lines(spark, str(path)) is not None) == (name in by_line), name
        found = {row.cache_key: row.translated for row in exports.read_memory(spark, str(path)).collect()}
        found.pop("g", None)
        assert found == ({} if name == "none" else entries), name
    (tmp_path / "twice.json").write_text('{\n"a": "x",\n"a": "y"\n}')
    assert exports._entry_lines(spark, str(tmp_path / "twice.json")) is None
    large = tmp_path / "large.json"
    large.write_text(json.dumps({f"{i:032}": "text" * 10 for i in range(20_000)}, indent=2))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        memory = exports.read_memory(spark, str(large))
        assert memory.rdd.getNumPartitions() > 4 and memory.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_cut_off_json_fails(spark, tmp_path):
    (tmp_path / "cut.json").write_text('{"records": {"k1": {"title"')
    for read in (exports.read_envelope_records, exports.read_envelope_shares, exports.read_memory):
        with pytest.raises(Exception, match="(?i)malformed|parse"):
            read(spark, str(tmp_path / "cut.json")).collect()
    (tmp_path / "cut_line.json").write_text('{\n  "a": "b",\n  "c": "d"\n')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        exports.read_memory(spark, str(tmp_path / "cut_line.json")).collect()


def test_append_to_an_envelope(spark, folder, tmp_path):
    earlier = tmp_path / "earlier.json"
    body = {"records": {"k1": {"title": {"en": "T"}, "recordID": "old"}}, "shares": {"ana": {"u": {"k1": {"shared": True}}}}}
    earlier.write_text(json.dumps(body))
    export = exports.read_export(spark, str(earlier), jobs.record_schema(spark, "iso"))
    target = str(tmp_path / "both")
    returned = spark.createDataFrame([("k", "v")], exports.MEMORY_SCHEMA)
    jobs.convert(
        spark, str(folder), target, "iso", SETTINGS, append_to=export, memory=exports.read_memory(spark, str(tmp_path / "none.json")),
        returned=returned,
    )
    assert sorted(row.recordID for row in spark.read.parquet(f"{target}/records").collect()) == ["1", "deep/2", "old"]
    assert spark.read.parquet(f"{target}/shares").count() == 3
    memory = exports.read_memory(spark, f"{target}/memory")
    assert [tuple(row) for row in memory.collect()] == [("k", "v")]


def test_repeated_keys_are_refused(spark):
    records = spark.createDataFrame([("k",), ("k",)], "recordKey string")
    with pytest.raises(KeyCollision):
        appending.refuse_repeated_keys(records, "recordKey")


def test_inspect(spark, folder):
    landed = land(read_documents(spark, str(folder), "iso"), "iso")
    found = {row.value: row.occurrences for row in jobs.inspect(landed).collect()}
    assert found == dict.fromkeys(made.THEMES, 2)
    files = {row.file_name: row["values"] for row in jobs.inspect(landed, by_file=True).collect()}
    assert files == {"1_iso.xml": made.THEMES, "deep/2_iso.xml": made.THEMES}
    stamps = {row.value: row.occurrences for row in jobs.inspect(landed, "date_stamp").collect()}
    assert stamps == {"2021-03-09": 1, "Undefined": 1}


def test_harvest(spark, folder, tmp_path):
    csv = tmp_path / "ids.csv"
    csv.write_text("ccin_ref_number,other\n007,x\n1,y\n")
    wanted = lists.identifiers(lists.read_table(spark, str(csv)))
    work = jobs.plan_harvest(spark, wanted, str(folder), "https://example.org", "iso")
    assert [tuple(row) for row in work.collect()] == [
        ("007", "007_iso.xml", "https://example.org/iso/007_iso.xml")
    ]
    statuses = spark.createDataFrame([("007", "u", 503)], "record_id string, url string, status int")
    jobs.report_harvest(statuses, str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report" / "failed")).count() == 1
    (finding,) = spark.read.parquet(str(tmp_path / "report" / "findings")).collect()
    assert (finding.rule, finding.detail) == ("fetch_failed", "status=503")


def test_incremental_ingest_takes_each_file_once(spark, folder, tmp_path):
    target, checkpoint = str(tmp_path / "landed"), str(tmp_path / "checkpoint")

    def run():
        ingest_new(spark, str(folder), target, checkpoint, "iso").awaitTermination()
        return spark.read.parquet(target)

    assert run().count() == 3
    assert run().count() == 3
    (folder / "5_iso.xml").write_text(made.iso())
    landed = run()
    assert sorted(row.record_id for row in landed.collect()) == ["1", "3", "5", "deep/2"]
    assert landed.where("malformed").count() == 1
    assert jobs.harmonise(landed, "iso", SETTINGS).count() == 3


def test_command_line(folder, tmp_path):
    target = tmp_path / "words"
    done = subprocess.run(
        [sys.executable, "-m", "cartulary", "inspect", "--files", str(folder), "--output", str(target)],
        cwd=Path(__file__).resolve().parents[1],
        capture_output=True,
        timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    lines = [json.loads(line) for part in target.glob("*.json") for line in part.read_text().splitlines()]
    assert {line["value"] for line in lines} == set(made.THEMES)
