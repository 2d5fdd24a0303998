"""WARC archives: writing captures, reading archives back, and assembling transactions.

A capture is three records: a request, a response (or a revisit, if the payload is stored with
another capture), and metadata. Request and metadata name the response's id as ``WARC-Concurrent-To``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm.common import new_path, stored

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"

#: Smaller payloads are always stored.
LEAST_REVISIT_BYTES = 100
#: Rows that may be broadcast; longer lists are joined by shuffling.
BROADCAST_ROWS = 300_000


def _record(kind: str, record_id: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    """A record's text without the two line ends that close it."""
    lines = [F.lit(f"{VERSION}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), record_id]
    for name, value in fields:
        lines.append(F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit("")))  # a null field is left out
    return F.concat(*lines, F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)


def write_archives(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes ``pages(page_id, url, html)`` as gzipped archives, one for each task.

    Of pages with equal payloads of at least 100 bytes, that with the smallest id is a response and
    the others revisit it; rows that repeat that id and payload are responses too.
    """
    captures = pages.select(
        F.col("page_id"),
        F.regexp_replace(F.regexp_replace(F.col("url").cast("string"), "\r", "%0D"), "\n", "%0A").alias("uri"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    first = stored(
        captures.where(F.col("size") >= LEAST_REVISIT_BYTES).groupBy("digest").agg(
            F.min("page_id").alias("first"), F.count("*").alias("n")
        ).where("n > 1").select(F.col("digest").alias("_digest"), "first"),
        "payloads",
    )
    if first.count() <= BROADCAST_ROWS:
        first = F.broadcast(first)
    known = captures.join(first, F.col("digest") == F.col("_digest"), "left").withColumn("_n", F.monotonically_increasing_id())

    def name(role: str) -> Column:
        hexed = F.md5(F.concat_ws("|", F.lit(role), F.col("_n").cast("string"), F.col("page_id").cast("string"), F.col("digest")))
        parts = [F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"), F.lit(END),
    )
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("uri"))]
    answer = [*common, ("Content-Type", F.lit("application/http;msgtype=response"))]
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    beside = ("WARC-Concurrent-To", name("response"))
    records = F.array(
        _record(
            "request", name("request"), [*common, beside, ("Content-Type", F.lit("application/http;msgtype=request"))],
            F.concat(F.lit("GET "), F.coalesce("uri", F.lit("/")), F.lit(" HTTP/1.1" + END)),
        ),
        F.when(again, _record("revisit", name("response"), [*answer, digest, ("WARC-Profile", F.lit(REVISIT_PROFILE))], head)).otherwise(
            _record("response", name("response"), [*answer, digest], F.concat(head, F.col("payload")))
        ),
        _record(
            "metadata", name("metadata"), [*common, beside, ("Content-Type", F.lit("application/warc-fields"))],
            F.concat(F.lit("page_id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n")),
        ),
    )
    known.select(F.explode(records).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives at ``path``, whatever tool wrote them.

    Files are streamed, cut where a new record seems to begin. The declared lengths decide: a record
    that was cut within, because its content holds such a place, is put together again, and a piece
    that holds several (the reader may miss a place at the edge of its buffer) gives them all. A
    record that its file ends within is an error.
    """
    schema = (
        "type string, record_id string, concurrent_to string, uri string, declared_digest string, "
        "payload_bytes long, payload_digest string, page_id string" + (", payload binary" if with_payload else "")
    )
    names = [x.split()[0] for x in schema.split(", ")]
    cut = f"{END}{VERSION}\r\n"
    mark, start = cut.encode(), f"{VERSION}\r\n".encode()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = b""
        for batch in batches:
            rows = []
            for value in batch.column("value"):
                piece = value.as_py()
                if not pending and piece.startswith(start):  # a file's first record
                    piece = piece[len(start) :]
                pending = pending + mark + piece if pending else piece
                while pending:
                    record, rest = _parsed(pending)
                    if record is None:
                        break  # it goes on in the next piece
                    rows.append(record)
                    rest = rest.lstrip(b"\r\n")
                    if rest and not rest.startswith(start):
                        raise ValueError(f"a record is longer than it declares: {pending[:200]!r}")
                    pending = rest[len(start) :]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.get(n) for r in rows], pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string()) for n in names],
                    names,
                )
        if pending.strip():
            raise ValueError(f"an archive ends within a record: {pending[:200]!r}")

    # Compressed archives are never split; plain ones must not be either, as records are put together in order.
    lines = spark.read.option("lineSep", cut).text(path).select(F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(run, schema)


def _parsed(raw: bytes) -> tuple[dict | None, bytes]:
    """The record, if it is all there, and what follows it."""
    header, found, block = raw.partition(b"\r\n\r\n")
    if not found:
        return None, raw
    fields = {}
    for line in header.decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    length = int(fields.get("content-length", 0))
    if len(block) < length:
        return None, raw
    rest, block = block[length:], block[:length]
    kind = fields.get("warc-type")
    record = {
        "type": kind,
        "record_id": fields.get("warc-record-id"),
        "concurrent_to": fields.get("warc-concurrent-to"),
        "uri": fields.get("warc-target-uri"),
        "declared_digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
    }
    if kind in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        if kind == "response":
            record |= {"payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest(), "payload": payload}
        else:
            size = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            record |= {"payload_bytes": int(size[0]) if size else None, "payload_digest": record["declared_digest"]}
    elif kind == "metadata":
        for line in block.decode("utf-8", "replace").split("\r\n"):
            name, _, value = line.partition(":")
            if name.strip() == "page_id":
                record["page_id"] = value.strip() or None
    return record, rest


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, request, response, metadata`` (null where missing).

    Requests and metadata belong to the response or revisit that they name as concurrent.
    """
    role = F.when(F.col("type") == "revisit", "response").otherwise(F.col("type"))
    key = F.when(role == "response", F.col("record_id")).otherwise(F.col("concurrent_to"))
    fields = F.struct(*[c for c in records.columns])

    def only(name: str) -> Column:
        return F.first(F.when(F.col("_role") == name, F.col("_record")), ignorenulls=True).alias(name)

    return (
        records.select(key.alias("capture_id"), role.alias("_role"), fields.alias("_record"))
        .where(F.col("capture_id").isNotNull() & F.col("_role").isin("request", "response", "metadata"))
        .groupBy("capture_id").agg(only("request"), only("response"), only("metadata"))
    )


def captures(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` as archives, reads these back, and assembles captures:
    ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``.

    Null html is an empty payload; null ids stay null, and so do null addresses; every row, repeated
    ones too, is a capture. Line ends in an address are escaped. Other columns are ignored; an
    empty table gives no rows.
    """
    path = new_path(spark, "warc")
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    found = stored(
        assemble(read_records(spark, path)).select(
            F.col("metadata.page_id").cast(kind).alias("page_id"), F.col("response.uri").alias("url"),
            F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
            F.col("response.type").alias("record_type"),
        ),
        "captures",
    )
    # Both sides are written tables, so a payload that very many captures share can be split.
    first = stored(
        found.where("record_type = 'response'").groupBy("payload_digest").agg(F.min("page_id").alias("first")), "responses"
    ).withColumnRenamed("payload_digest", "_digest")
    revisits = found.where("record_type = 'revisit'").join(first, F.col("payload_digest") == F.col("_digest"), "left").select(
        *found.columns, F.col("first").alias("refers_to")
    )
    return found.where("record_type != 'revisit'").withColumn("refers_to", F.lit(None).cast(kind)).unionByName(revisits)


#: Without the archive: what each capture must be.
ORACLE = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS payload_digest,
    octet_length(encode(coalesce(html, ''))) AS payload_bytes
  FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, url, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
