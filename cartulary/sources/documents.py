"""XML corpora: one whole document per row, parsed once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.functions import keys
from cartulary.operators.extract import EXTRACTORS
from cartulary.sources.encodings import decoded
from cartulary.sources.schemas import CORRUPT, UNPLACED, document_schema

_OPTIONS = {
    "ignoreNamespace": "true",
    "ignoreSurroundingSpaces": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}


# The root elements of the dialects.
ROOTS = {"iso": "MD_Metadata", "fgdc": "metadata"}

#: Comments, processing instructions and character data; of what is never closed, and of character
#: data, the opening mark stays (groups 1 and 2), so that it still counts as content.
_ASIDE = r"(?s)<!--.*?-->|<\?.*?\?>|(<!\[CDATA\[).*?\]\]>|(<!--|<\?|<!\[CDATA\[).*+\z"
#: White space of XML, and how much of a text's end is looked at before all of it is.
_BLANK = " \t\r\n"
_END = 256
#: Bytes at a text's ends that hold what is looked for there, as a rule.
_WINDOW = 4 * _END
_ROOT_NAME = (
    r"(?s)\A\s*+(?:<\?.*?\?>\s*+|<!--.*?-->\s*+|<!DOCTYPE[^\[>]*+(?:\[.*?\]\s*+)?>\s*+)*+<(?:[^\s<>/:]+:)?([^\s<>/:!?][^\s<>/:]*)"
)


def identify(files: DataFrame, dialect: str) -> DataFrame:
    """Add the record id that a file name carries."""
    return files.withColumn("record_id", keys.document_id(F.col("file_name"), dialect))


def _is_pattern(path: str) -> bool:
    return any(sign in path.rsplit("/", 1)[-1] for sign in "*?[{") or path.endswith(".xml")


def file_options(path: str, dialect: str) -> dict[str, str]:
    """Which files a path means: what a pattern or a file name matches, or a dialect's below a folder."""
    if _is_pattern(path):
        return {}
    return {"pathGlobFilter": f"*_{dialect}.xml", "recursiveFileLookup": "true"}


def _relative(file_path: Column, root: str) -> Column:
    """A file's path below the input folder; files of the folder itself are just names.

    For a pattern, the folder is what stands before the first part with a sign.
    """
    parts = root.rstrip("/").split("/")
    fixed = next((n for n, part in enumerate(parts) if any(sign in part for sign in "*?[{")), len(parts))
    if fixed == len(parts) and parts[-1].endswith(".xml"):
        fixed -= 1
    folder = "/".join(parts[:fixed]).split("://", 1)[-1].removeprefix("file:").strip("/") + "/"
    return F.when(
        F.contains(file_path, F.lit(folder)),
        F.substring(file_path, F.instr(file_path, F.lit(folder)) + len(folder), F.length(file_path)),
    ).otherwise(F.substring_index(file_path, "/", -1))


def as_documents(files: DataFrame, dialect: str, root: str) -> DataFrame:
    """Files as ``(file_name, value, record_id, decodable)``, one whole document per row.

    ``file_name`` is the path below the input folder, so that equal names in different folders are
    different records.
    """
    text, decodable = decoded(F.col("content"))
    texts = files.select(
        _relative(F.col("path"), root).alias("file_name"), text.alias("value"), decodable.alias("decodable")
    )
    return identify(texts, dialect)


def read_documents(spark: SparkSession, path: str, dialect: str) -> DataFrame:
    """All ``*_{dialect}.xml`` files below a folder, or the files that a pattern matches."""
    files = spark.read.format("binaryFile").options(**file_options(path, dialect)).load(path)
    return as_documents(files, dialect, path)


def listed(spark: SparkSession, path: str, dialect: str) -> DataFrame:
    """``(file_name, path, modified, length)`` of the files that ``read_documents`` reads; contents are not read."""
    files = spark.read.format("binaryFile").options(**file_options(path, dialect)).load(path)
    return files.select(
        _relative(F.col("path"), path).alias("file_name"), "path", F.col("modificationTime").alias("modified"), "length"
    )


def _occurrences(value: Column, part: str) -> Column:
    """How often a literal without signs of patterns stands in a text.

    It mostly stands in the last bytes only: what comes before is searched, and counted if it holds one.
    """
    last, content = _last_bytes(value), value.cast("binary")
    before = F.substring(content, F.lit(1), F.octet_length(value) - _WINDOW + len(part) - 1).cast("string")
    more = F.when(F.contains(before, F.lit(part)), F.regexp_count(before, F.lit(part))).otherwise(0)
    return F.regexp_count(last, F.lit(part)) + more


def _last_bytes(value: Column) -> Column:
    return F.substring(value.cast("binary"), -_WINDOW, _WINDOW).cast("string")


def _tail(value: Column) -> Column:
    """The last ``_END`` characters before the blanks at a text's end.

    Trimming and counting characters go through a whole text, and cost more than parsing it. A text's
    last bytes are enough, unless so much of them is blank that too few characters stay; of a
    character that they cut, up to three bytes count as one each.
    """
    last = _last_bytes(value)
    trimmed = F.when(F.endswith(last, F.lit(">")), last).otherwise(F.rtrim(last, F.lit(_BLANK)))
    enough = (F.octet_length(value) <= _WINDOW) | (F.length(trimmed) >= _END + 3)
    return F.right(F.when(enough, trimmed).otherwise(F.rtrim(value, F.lit(_BLANK))), F.lit(_END))


def _root_name(value: Column) -> Column:
    """The local name of the root element, from a text's first bytes if they hold all of it."""
    head = F.substring(value.cast("binary"), 1, _WINDOW).cast("string")
    near = F.regexp_extract(head, rf"{_ROOT_NAME}(?=[\s<>/])", 1)
    return F.when(near != "", near).otherwise(F.regexp_extract(value, _ROOT_NAME, 1))


def _outer(value: Column, dialect: str) -> Column:
    """Why a text is no single document of the dialect: ``wrong_dialect``, ``malformed_xml``, or null.

    A plain document ends with its root's end tag and has one: that is seen at its end and by
    counting literals. Only others lose their comments, instructions and character data in one pass
    and are looked at as a whole. No pattern goes back over what it has read, so the time is linear
    whatever stands around the root.
    """
    root = ROOTS[dialect]
    closing = rf"</(?:[^\s<>/:]+:)?{root}\s*>"
    bare_name, prefixed = _occurrences(value, f"/{root}"), _occurrences(value, f":{root}")
    plain = _tail(value).rlike(rf"{closing}\z") & (
        ((bare_name <= 1) & (prefixed == 0)) | ((bare_name == 0) & (prefixed <= 2))
    )
    rest = F.rtrim(F.regexp_replace(value, _ASIDE, "$1$2"), F.lit(_BLANK))
    ends = F.regexp_count(rest, F.lit(closing))
    alone = rest.rlike(rf"<(?:[^\s<>/:]+:)?{root}(?:\s[^<>]*)?/>\z") & (ends == 0)
    whole = F.when(plain, F.lit(True)).otherwise((rest.rlike(rf"{closing}\z") & (ends == 1)) | alone)
    name = _root_name(value)
    return F.when((name != "") & (name != root), F.lit("wrong_dialect")).when(
        value.isNull() | (name == "") | ~whole, F.lit("malformed_xml")
    )


def _inner(documents: DataFrame, dialect: str, document: Column) -> Column:
    """Why a document is set aside, or null: undecodable, another dialect, or malformed."""
    reason = _outer(F.col("value"), dialect)
    if "decodable" in documents.columns:
        reason = F.when(~F.col("decodable"), F.lit("undecodable")).otherwise(reason)
    broken = document.isNull() | document[CORRUPT].isNotNull()
    return F.coalesce(reason, F.when(broken, F.lit("malformed_xml")))


def _anywhere(tag: str) -> Column:
    """The first element of a name at any depth, for leaf elements without a fixed place."""
    value = F.when(F.contains("value", F.lit("<!--")), F.regexp_replace("value", "(?s)<!--.*?-->", "")).otherwise(F.col("value"))
    inner = F.regexp_extract(value, rf"(?s)<(?:[^\s<>/:]+:)?{tag}(?:\s[^<>]*)?(?<!/)>(.*?)</(?:[^\s<>/:]+:)?{tag}\s*>", 1)
    plain = F.regexp_replace(inner, r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        inner = F.replace(inner, F.lit(entity), F.lit(sign))
    text = F.when(F.contains(inner, F.lit("<![CDATA[")), plain).otherwise(inner)
    return F.when(F.contains("value", F.lit(f"{tag}")), F.nullif(text, F.lit("")))


def parse(
    documents: DataFrame, dialect: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Documents as the ``document`` struct; those set aside stay, with ``problem`` and their text.

    ``columns`` limits the schema to what those record columns need.
    """
    document = F.from_xml("value", document_schema(dialect, columns), _OPTIONS)
    kept = [name for name in ("record_id", "file_name", "value", "decodable") if name in documents.columns]
    parsed = documents.select(*kept, document.alias("document"))
    problem = _inner(documents, dialect, F.col("document"))
    return parsed.select("record_id", "file_name", "value", "document", problem.alias("problem")).select(
        "record_id",
        "file_name",
        "document",
        "problem",
        F.col("problem").isNotNull().alias("malformed"),
        F.when(F.col("problem").isNotNull(), F.coalesce("value", F.lit(""))).alias("rejected"),
        *[
            F.when(F.col("problem").isNull(), _anywhere(tag)).alias(name)
            for name, tag in UNPLACED[dialect].items()
            if columns is None or name in columns
        ],
    )


_FLAGS = ("problem", "malformed", "rejected")


def well_formed(parsed: DataFrame) -> DataFrame:
    """The parsed documents, one column per root element, without those set aside.

    The condition sits inside the generator. As a filter it would be pushed below the
    projection with a second copy of the parser.
    """
    intact = F.filter(
        F.array(F.struct("document", "problem")), lambda row: row["problem"].isNull()
    )
    carried = [name for name in parsed.columns if name not in ("document", *_FLAGS)]
    return parsed.select(*carried, F.inline(intact)).select(*carried, "document.*").drop(CORRUPT)


def extract(
    documents: DataFrame, dialect: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Record columns of the well-formed documents, all or some."""
    return EXTRACTORS[dialect](well_formed(parse(documents, dialect, columns)), columns=columns)


def land(documents: DataFrame, dialect: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Extracted columns of every document, to be written once and read by all jobs.

    Documents set aside stay as rows with ``malformed``, the ``problem``, their whole text in
    ``rejected`` and no other column, so that one write holds both the corpus and its
    quarantine. ``columns`` limits what is extracted.
    """
    flagged = parse(documents, dialect, columns).select(
        "*", F.when(F.col("problem").isNull(), F.col("document")).alias("_usable")
    ).select("*", "_usable.*").drop("document", "_usable", CORRUPT)
    return EXTRACTORS[dialect](flagged, carry=_FLAGS, columns=columns)


def landed_records(landed: DataFrame) -> DataFrame:
    """The usable rows of a landed table; the filter reaches the parquet scan."""
    return landed.where(~F.col("malformed")).drop(*_FLAGS)


def quarantine(documents: DataFrame, dialect: str) -> DataFrame:
    """The documents set aside with their whole text."""
    document = F.from_xml("value", document_schema(dialect, ()), _OPTIONS)
    rows = documents.withColumn("document", document)
    set_aside = F.filter(
        F.array(F.struct(_inner(documents, dialect, F.col("document")).alias("problem"), F.coalesce("value", F.lit("")).alias("text"))),
        lambda row: row["problem"].isNotNull(),
    )
    return rows.select("record_id", "file_name", F.inline(set_aside)).select(
        "record_id", "file_name", F.lit(dialect).alias("dialect"), "problem", "text"
    )


def present_records(spark: SparkSession, path: str, dialect: str) -> DataFrame:
    """Ids of the records that a folder already holds, as ingest gives them; file contents are not read."""
    try:
        files = spark.read.format("binaryFile").options(**file_options(path, dialect)).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "record_id string")
    names = files.select(_relative(F.col("path"), path).alias("file_name"))
    return identify(names, dialect).select("record_id")
