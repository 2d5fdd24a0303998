"""Incremental ingest: every file is processed once, however often the job runs; or once a change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartulary.operators.appending import latest
from cartulary.sinks import versions
from cartulary.sources.documents import as_documents, file_options, land, listed
from cartulary.staging import staging

#: Column with the number of the run that landed a row.
RUN = "run"


def stream_documents(spark: SparkSession, path: str, dialect: str) -> DataFrame:
    """New ``*_{dialect}.xml`` files below a folder as they appear."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .options(**file_options(path, dialect))
        .load(path)
    )
    return as_documents(files, dialect, path)


def ingest_new(
    spark: SparkSession, source: str, target: str, checkpoint: str, dialect: str
) -> StreamingQuery:
    """Land all files not seen before into the parquet table ``target``, then stop.

    The checkpoint folder remembers the files; it must be on shared storage, like the
    target, so that the job can resume on another machine.
    """
    landed = land(stream_documents(spark, source, dialect), dialect)
    return (
        landed.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _runs(spark: SparkSession, target: str, name: str) -> DataFrame | None:
    folders = versions.committed(spark, target)
    return spark.read.parquet(*[f"{folder}/{name}" for folder in folders]) if folders else None


def ingest_changed(spark: SparkSession, source: str, target: str, dialect: str) -> int:
    """Land the files that are new or have changed since the last run; how many there were.

    A file is known by its path below the input folder, and has changed if its time of change or its
    length has. Contents are read of the files that changed, and of others only if they are no older
    than the oldest of those. Each run is a committed version below ``target`` with ``landed`` rows and
    the ``files`` they come from; a run that finds nothing commits nothing. Rows of files that are gone
    stay. ``landed_files`` gives the rows that hold now.
    """
    known = _runs(spark, target, "files")
    with staging(spark) as keep:
        found = listed(spark, source, dialect)
        if known is not None:
            last = latest(known, "file_name", RUN).select("file_name", "modified", "length")
            found = found.join(last, ["file_name", "modified", "length"], "left_anti")
        changed = keep(found)
        first, count = changed.agg(F.unix_micros(F.min("modified")), F.count("*")).first()
        if not count:
            return 0
        with versions.next_version(spark, target) as version:
            contents = (
                spark.read.format("binaryFile").options(**file_options(source, dialect)).load(source)
                .where(F.col("modificationTime") >= F.timestamp_micros(F.lit(first)))
                .join(changed.select("path"), "path", "left_semi")
            )
            rows = land(as_documents(contents, dialect, source), dialect).withColumn(RUN, F.lit(version.number))
            rows.write.parquet(f"{version.folder}/landed")
            changed.withColumn(RUN, F.lit(version.number)).write.parquet(f"{version.folder}/files")
    return count


def landed_files(spark: SparkSession, target: str) -> DataFrame | None:
    """The landed rows of all files as they were last seen, or None before the first run."""
    landed = _runs(spark, target, "landed")
    return None if landed is None else latest(landed, "file_name", RUN)
