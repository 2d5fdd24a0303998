"""Versioned folders: the tables of a run come into sight together, or not at all.

A run writes into a folder of its own, ``versions/<id>``, and is committed last, by a small file
``commits/<number>`` that names the folder. Readers go by the commits, so a run that fails or whose
driver is lost leaves what was there before. Two runs that start from the same commit can't both be
committed: the second finds its number taken. That holds on stores that rename without overwriting in
one step, HDFS and local disks; on others, run one writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from uuid import uuid4

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another run was committed since this one started."""


@dataclass(frozen=True)
class Version:
    """A run's place: its number, its folder, and the folder of the run before it, if any."""

    number: int
    folder: str
    before: str | None


def _located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def committed(spark: SparkSession, root: str) -> list[str]:
    """Folders of all committed runs, the oldest first; empty for a folder without commits."""
    commits, store = _located(spark, f"{root}/commits")
    if not store.exists(commits):
        return []
    names = sorted(s.getPath().getName() for s in store.listStatus(commits))
    names = [name for name in names if name.isdigit()]
    if not names:
        return []
    rows = spark.read.text([f"{root}/commits/{name}" for name in names]).selectExpr("_metadata.file_name", "value")
    folders = {row.file_name: row.value for row in rows.collect()}
    return [f"{root}/versions/{folders[name]}" for name in names]


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the last committed run."""
    return (committed(spark, root) or [None])[-1]


def _commit(spark: SparkSession, root: str, number: int, name: str) -> None:
    fs = spark._jvm.org.apache.hadoop.fs
    pending, store = _located(spark, f"{root}/commits/.{name}")
    stream = store.create(pending, True)
    stream.write(bytearray(name.encode()))
    stream.close()
    rename = getattr(fs, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.valueOf("NONE")
    context = fs.FileContext.getFileContext(store.makeQualified(pending).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(store.makeQualified(pending), store.makeQualified(fs.Path(f"{root}/commits/{number:012}")), options)
    except Py4JJavaError as error:
        store.delete(pending, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise CommitConflict(f"{root}: run {number} was committed by another writer") from error
        raise


@contextmanager
def next_version(spark: SparkSession, root: str) -> Iterator[Version]:
    """A folder for the next run below ``root``: committed when the block ends, removed if it fails."""
    earlier = committed(spark, root)
    name = uuid4().hex
    version = Version(len(earlier) + 1, f"{root}/versions/{name}", earlier[-1] if earlier else None)
    try:
        yield version
        _commit(spark, root, version.number, name)
    except BaseException:
        folder, store = _located(spark, version.folder)
        store.delete(folder, True)
        raise
