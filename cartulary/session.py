"""Session settings for the jobs. Sessions made elsewhere work too; nothing depends on these."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Skewed partitions are split and small ones merged at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Parsing is bound by the processor: splits smaller than the default spread it better.
    "spark.sql.files.maxPartitionBytes": "64m",
    # Metadata files are small: many go into one split.
    "spark.sql.files.openCostInBytes": "64k",
    # No stack inspection for every column expression built in Python.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def builder(name: str, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """``shuffle_partitions``: how many partitions a shuffle starts with before small ones are merged;
    for large corpora about one for each 128 MB that it moves.
    """
    made = SparkSession.builder.appName(name)
    if shuffle_partitions:
        made = made.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", shuffle_partitions)
    for key, value in SETTINGS.items():
        made = made.config(key, value)
    return made
