"""What several operators need: plain inputs, stored tables, hashing of bytes in numpy."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``.

    Only a local session may go without; it then gets a temporary folder.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _OWN_FOLDERS.setdefault(context.applicationId, tempfile.mkdtemp(prefix="llm-"))


def package_on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package where it isn't installed but lies at the same path."""
    small_batches(spark)
    top = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if top not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [top, environment.get("PYTHONPATH", "")]))


#: Bytes of one batch between the JVM and a Python worker. Both sides hold it, some steps several times.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lets batches for Python tasks hold ``BATCH_BYTES`` at most, or one row; a smaller setting stays.

    Spark's own bound is 10,000 rows or 64 MB, which whole texts and packed arrays do reach.
    """
    now = int(spark.conf.get(_BATCH_SETTING).rstrip("b"))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(table: DataFrame, name: str) -> DataFrame:
    """The table, written to the shared folder and read again: it cuts lineage."""
    path = new_path(table.sparkSession, name)
    table.write.option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def is_empty(table: DataFrame) -> bool:
    return len(table.take(1)) == 0


def documents_of(table: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: bool = False) -> DataFrame:
    """Only ``doc_id``, ``text`` (null: empty) and ``_row``, a hash of both.

    Other columns are left out, whatever their names; with ``carry`` they are kept in ``_carried``,
    from which ``restored`` makes the row again. ``_row`` tells rows apart that share an id; rows equal in id and text stay equal,
    and each gives its own, equal, result row.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    own = [F.col(id_column).alias("doc_id"), text.alias("text")]
    if carry:
        others = [F.col(f"`{name}`") for name in table.columns if name != text_column]
        own.append(F.struct(*others, F.col(text_column).isNull().alias("_no_text")).alias("_carried"))
    return table.select(*own).withColumn("_row", F.xxhash64(F.col("doc_id"), F.col("text")))


def restored(carried: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The rows that ``documents_of(..., carry=True)`` carried, some columns with new values."""
    values = {"text": F.when(~F.col("_carried._no_text"), F.col("text"))} | new
    return carried.select(*[values.get(name, F.col(f"_carried.`{name}`")).alias(name) for name in columns])


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of a batch's rows whose texts hold about ``most_bytes`` together, one row at least."""
    offsets = batch.column(column)
    if isinstance(offsets, pa.ChunkedArray):
        offsets = offsets.combine_chunks()
    lengths = np.asarray(pc.binary_length(offsets).fill_null(0)).astype(np.int64)
    start, total = 0, 0
    for row, length in enumerate(lengths.tolist()):
        if row > start and total + length > most_bytes:
            yield start, row
            start, total = row, 0
        total += length
    if start < len(lengths):
        yield start, len(lengths)


def joined_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes one after another, and the n + 1 borders between them."""
    raw = [text.encode("utf-8", "surrogatepass") for text in texts]
    borders = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(x) for x in raw], out=borders[1:])
    return np.frombuffer(b"".join(raw), np.uint8), borders


def lean(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """A task's function that gives freed memory back at its end: workers are used again, and
    keep what the allocator keeps."""

    def task(batches: Iterable) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # not on every system
            ctypes.CDLL(None).malloc_trim(0)

    return task


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RangeHash:
    """Hashes of any ranges of one sequence of 64-bit values, by polynomial prefix sums.

    Equal ranges have equal hashes wherever they stand. Other values for the same symbols make
    another function.
    """

    _powers: list[tuple[np.ndarray, np.ndarray]] = []  # shared by all: the values tell functions apart

    def __init__(self, values: np.ndarray) -> None:
        up, self.down = self._table(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    @classmethod
    def _table(cls, size: int) -> tuple[np.ndarray, np.ndarray]:
        if not cls._powers or len(cls._powers[0][0]) < size:
            base = (int(mixed(np.array([1], np.uint64))[0]) << 3 | 5) % 2**64
            size = 1 << max(18, size.bit_length())
            tables = []
            for factor in (base, pow(base, -1, 2**64)):
                powers = np.full(size, factor, np.uint64)
                powers[0] = 1
                tables.append(np.multiply.accumulate(powers))
            cls._powers[:] = [(tables[0], tables[1])]
        return cls._powers[0]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def byte_values(salt: int) -> np.ndarray:
    """A table of 256 pseudo-random values, one for each byte."""
    return mixed(mixed(np.arange(256, dtype=np.uint64) + np.uint64(salt * 1024 + 1)))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: Bits of a key filter: 4 MB, whatever the number of keys.
FILTER_BITS = 1 << 25


class KeyFilter:
    """A bitmap of keys' hashes, of fixed size: it tells most rows apart that can find no partner.

    Rows that pass may still have none; with very many keys more and more of them pass.
    """

    def __init__(self, keys: DataFrame, key: str, name: str) -> None:
        place, bit = self._place(F.col(key))
        self.rows = stored(keys.groupBy(place.alias("_place")).agg(F.bitmap_construct_agg(bit).alias("_bits")), name)

    @staticmethod
    def _place(key: Column) -> tuple[Column, Column]:
        at = F.pmod(F.xxhash64(key, F.lit(17)), F.lit(FILTER_BITS))
        return F.floor(at / 32768), at % 32768

    def mark(self, table: DataFrame, key: str) -> DataFrame:
        """Adds ``_passes``."""
        place, bit = self._place(F.col(key))
        held = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        passes = F.coalesce(F.getbit(held, (bit % 8).cast("int")) == 1, F.lit(False))
        small = F.broadcast(self.rows.withColumnRenamed("_place", "_own"))
        return table.join(small, place == F.col("_own"), "left").withColumn("_passes", passes).drop("_own", "_bits")
