"""Intermediate tables for results that several later steps read."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def staging_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names.

    Only a session that runs on this machine alone may do without the setting; its tables then go
    where its warehouse is.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError(f"set {_SETTING} to a folder on shared storage")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/staged"


def _write(table: DataFrame, by: str | None = None, dealt: bool = False) -> tuple[str, DataFrame]:
    spark = table.sparkSession
    name = f"cartulary_{uuid4().hex}"
    path = f"{staging_folder(spark)}/{name.replace('_', '-')}"
    if by is None:
        table.write.parquet(path)
        return path, spark.read.schema(table.schema).parquet(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = table if dealt else table.repartition(buckets, by)
    rows.write.bucketBy(buckets, by).format("parquet").option("path", path).saveAsTable(name)
    return path, spark.table(name)


def stage(table: DataFrame, by: str | None = None) -> DataFrame:
    """Write a table once and read it back.

    The copy outlives lost executors, and readers fetch only the columns they need. With ``by``, it
    is bucketed by that column: whatever is joined with it on that column goes to its rows, which
    stay where they are.
    """
    return _write(table, by)[1]


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """Stages tables for a job, and removes them when it ends.

    ``keep(table, by, dealt)``: ``by`` as in ``stage``; ``dealt`` says that the rows come from a table
    bucketed by the same values, so that they need not move again.
    """
    paths: list[str] = []

    def keep(table: DataFrame, by: str | None = None, dealt: bool = False) -> DataFrame:
        path, copy = _write(table, by, dealt)
        paths.append(path)
        return copy

    try:
        yield keep
    finally:
        for name in paths:
            spark.sql(f"DROP TABLE IF EXISTS {name.rsplit('/', 1)[-1].replace('-', '_')}")
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
