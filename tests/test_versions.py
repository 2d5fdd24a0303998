"""Exports and ingests that are committed as a whole."""

import os
from pathlib import Path

import documents as made
import pytest

from cartulary.operators import appending
from cartulary.operators.appending import KeyCollision
from cartulary.plans import jobs
from cartulary.settings import JobSettings
from cartulary.sinks import versions
from cartulary.sources import exports
from cartulary.streaming import incremental

SETTINGS = JobSettings(user="keeper", shares=("ana",), as_of="2024-01-01T00:00:00Z")


@pytest.fixture
def folders(tmp_path):
    """Two folders of records, one in each dialect."""
    for name, text in (("1_iso.xml", made.iso()), ("2_fgdc.xml", made.fgdc())):
        (tmp_path / name[2:-4]).mkdir()
        (tmp_path / name[2:-4] / name).write_text(text)
    return {"iso": str(tmp_path / "iso"), "fgdc": str(tmp_path / "fgdc")}


def _ids(spark, export):
    records, shares = exports.read_export(spark, export, jobs.record_schema(spark, "iso"))
    assert records.count() == shares.count()
    return sorted(row.recordID for row in records.collect())


def test_a_stop_between_two_tables_leaves_the_old_export(spark, folders, tmp_path, monkeypatch):
    export = str(tmp_path / "export")
    jobs.extend_export(spark, folders["iso"], export, "iso", SETTINGS)
    assert _ids(spark, export) == ["1"]
    write = jobs.write_table

    def stops(table, path, form="parquet"):
        if path.endswith("/findings"):
            raise KeyboardInterrupt
        write(table, path, form)

    monkeypatch.setattr(jobs, "write_table", stops)
    with pytest.raises(KeyboardInterrupt):
        jobs.extend_export(spark, folders["fgdc"], export, "fgdc", SETTINGS, share_mode="merge")
    assert _ids(spark, export) == ["1"] and len(list(Path(export, "versions").iterdir())) == 1

    # A lost driver removes nothing: what it wrote stays, unseen.
    lost = Path(export, "versions", "lost", "records")
    lost.mkdir(parents=True)
    (Path(export, "commits") / ".lost").write_text("lost")
    assert _ids(spark, export) == ["1"]

    monkeypatch.setattr(jobs, "write_table", write)
    jobs.extend_export(spark, folders["fgdc"], export, "fgdc", SETTINGS, share_mode="merge")
    assert _ids(spark, export) == ["1", "2"]
    with pytest.raises(KeyCollision):
        jobs.extend_export(spark, folders["iso"], export, "iso", SETTINGS)
    assert _ids(spark, export) == ["1", "2"] and len(versions.committed(spark, export)) == 2


def test_one_of_two_writers_is_refused(spark, tmp_path):
    root = str(tmp_path / "root")
    assert versions.current(spark, root) is None
    with pytest.raises(versions.CommitConflict):
        with versions.next_version(spark, root) as slow:
            spark.range(1).write.parquet(f"{slow.folder}/t")
            with versions.next_version(spark, root) as fast:
                spark.range(2).write.parquet(f"{fast.folder}/t")
    assert versions.committed(spark, root) == [fast.folder] and fast.number == slow.number == 1
    assert spark.read.parquet(f"{versions.current(spark, root)}/t").count() == 2
    assert not Path(slow.folder).exists()
    assert sorted(path.name for path in Path(root, "commits").iterdir() if not path.name.endswith(".crc")) == [f"{1:012}"]


def test_changed_files_replace_their_rows(spark, tmp_path):
    source, target = tmp_path / "xml", str(tmp_path / "landed")
    (source / "deep").mkdir(parents=True)

    def put(name, text, at):
        (source / name).write_text(text)
        os.utime(source / name, (at, at))

    def run():
        count = incremental.ingest_changed(spark, str(source), target, "iso")
        rows = incremental.landed_files(spark, target)
        return count, rows and {row.file_name: row.purpose or row.problem for row in rows.collect()}

    assert run() == (0, None)
    put("1_iso.xml", made.iso(), 1000)
    put("deep/1_iso.xml", made.iso(), 2000)
    put("2_iso.xml", made.iso()[:-10], 3000)
    first = {"1_iso.xml": "Why", "deep/1_iso.xml": "Why", "2_iso.xml": "malformed_xml"}
    assert run() == (3, first) and run() == (0, first)

    # Mended; changed to the same length; new, but older than everything landed.
    put("2_iso.xml", made.iso(), 4000)
    put("1_iso.xml", made.iso().replace("Why", "Yes"), 1001)
    put("3_iso.xml", made.iso(), 5)
    second = {"1_iso.xml": "Yes", "deep/1_iso.xml": "Why", "2_iso.xml": "Why", "3_iso.xml": "Why"}
    assert run() == (3, second) and run() == (0, second)

    # Back to what it was at first; another one is gone.
    put("1_iso.xml", made.iso(), 1000)
    (source / "3_iso.xml").unlink()
    assert run() == (1, {**second, "1_iso.xml": "Why"})
    assert len(versions.committed(spark, target)) == 3


def test_latest_rows(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "x"), (None, 1, "x"), (None, 2, "y"), ("c", None, "x"), ("c", 1, "y")]
    table = spark.createDataFrame(rows, "k string, n int, text string")
    found = appending.latest(table, "k", "n")
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, rows[1:]))
    assert appending.latest(table.limit(0), "k", "n").count() == 0
