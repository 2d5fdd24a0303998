"""Readers for the JSON forms: exports and translation memories.

A text that is no such JSON, one that was cut off for example, fails the job: read as empty, it
would pass for an export without records, or a memory without translations.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartulary.sinks import versions

MEMORY_SCHEMA = "cache_key string, translated string"

_GRANTS = "map<string,map<string,map<string,struct<shared:boolean>>>>"
_ENVELOPE = f"array<struct<records:map<string,string>,shares:{_GRANTS}>>"


_STRICT = {"mode": "FAILFAST"}


def _envelopes(spark: SparkSession, path: str) -> DataFrame:
    """The envelope of each file; a lone object reads like a list of one."""
    texts = spark.read.text(path, wholetext=True)
    return texts.select(F.inline(F.from_json("value", _ENVELOPE, _STRICT)))


def read_envelope_records(spark: SparkSession, path: str) -> DataFrame:
    """``(record_key, record)`` of an export envelope, the record as JSON text."""
    return _envelopes(spark, path).select(F.explode("records").alias("record_key", "record"))


def read_envelope_shares(spark: SparkSession, path: str) -> DataFrame:
    """``(person, user_id, record_key, shared)`` of an export envelope."""
    return (
        _envelopes(spark, path)
        .select(F.explode("shares").alias("person", "users"))
        .select("person", F.explode("users").alias("user_id", "grants"))
        .select("person", "user_id", F.explode("grants").alias("record_key", "grant"))
        .select("person", "user_id", "record_key", F.col("grant.shared").alias("shared"))
    )


def read_record_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(record_key, record)`` of an export in JSON lines, the record as JSON text."""
    return spark.read.schema("record_key string, record string").json(path)


def typed_records(lines: DataFrame, schema: StructType) -> DataFrame:
    """Record texts as columns of the output schema, the key first."""
    body = StructType([field for field in schema.fields if field.name != "recordKey"])
    return lines.select(
        F.col("record_key").alias("recordKey"), F.from_json("record", body, _STRICT).alias("record")
    ).select("recordKey", "record.*")


def read_export(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Records and grants of an earlier export: its folder of tables, the last committed version of a
    versioned one, or its JSON envelope.
    """
    if not path.endswith(".json"):
        path = versions.current(spark, path) or path
        return spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/shares")
    return typed_records(read_envelope_records(spark, path), schema), read_envelope_shares(spark, path)


def _entry_lines(spark: SparkSession, path: str) -> DataFrame | None:
    """The entries of JSON objects that are written one entry a line, or None for any other layout.

    Strings of JSON hold no line ends, so such files can be split at any line and read by many tasks.
    Every line but the two braces must be an entry, all but one of them with a comma, and no key may
    stand twice in a file; otherwise the object has to be read as one.
    """
    line = F.trim(F.col("value"), F.lit(" \t\r"))
    bare = F.rtrim(F.when(line.endswith(","), F.left(line, F.length(line) - 1)).otherwise(line), F.lit(" \t"))
    pairs = F.from_json(F.concat(F.lit("{"), bare, F.lit("}")), "map<string,string>", {"mode": "PERMISSIVE"})
    entry = F.when(bare.startswith('"') & bare.endswith('"'), pairs)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), line.alias("line"), entry.alias("entry"))
    lines = lines.where("line <> ''")
    brace = F.col("line").isin("{", "}")
    layout = lines.groupBy("file").agg(
        F.count_if(F.col("line") == "{").alias("opened"),
        F.count_if(F.col("line") == "}").alias("closed"),
        F.count_if(~brace & (F.coalesce(F.size("entry"), F.lit(0)) < 1)).alias("others"),
        F.count_if(~brace).alias("entries"),
        F.count_if(~brace & ~F.col("line").endswith(",")).alias("ends"),
    )
    if not layout.where("opened <> 1 OR closed <> 1 OR others > 0 OR (entries > 0 AND ends <> 1)").isEmpty():
        return None
    entries = lines.select("file", F.explode("entry").alias("cache_key", "translated"))
    if not entries.groupBy("file", "cache_key").count().where("count > 1").isEmpty():
        return None
    return entries.select("cache_key", "translated")


def read_memory(spark: SparkSession, path: str) -> DataFrame:
    """A translation memory: a table of ``cache_key`` and ``translated`` in parquet or JSON lines
    (``.parquet``, ``.jsonl``, or a folder), or else one JSON object; an absent one is empty. An object
    with one entry a line is read by many tasks, others by one task a file.
    """
    try:
        if path.endswith(".jsonl"):
            return spark.read.schema(MEMORY_SCHEMA).option("mode", "FAILFAST").json(path)
        if not path.endswith(".json"):
            return spark.read.parquet(path).select("cache_key", "translated")
        entries = _entry_lines(spark, path)
        if entries is not None:
            return entries
        texts = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MEMORY_SCHEMA)
    pairs = F.from_json("value", "map<string,string>", _STRICT)
    return texts.select(F.explode(pairs).alias("cache_key", "translated"))
