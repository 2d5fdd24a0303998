"""Best-fit packing of tokenised documents, planned over the histogram of lengths.

The plan never looks at documents: it places *counts* of equal lengths, longest first, each into
the open sequences with the least room that fits. What it makes are runs of slots, and a
document's piece takes the slot of its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import os
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartulary.llm.common import RangeHash, byte_values, documents_of, lean, slices, stored

END_ID = 0
CAPACITY = 2048
_CACHED_WORDS = 700_000

# Classes of characters below U+0250, where NFC changes nothing and case maps to one character.
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_UNUSUAL = re.compile("[^\x00-\u012f\u0131-\u024f]|<\\|")
_CHUNK = re.compile("[^ \t-\r]+")
_PLAIN = re.compile("[!-~]+")
_TOKENIZERS: dict[str, WordCachedTokenizer] = {}


def _character_classes() -> np.ndarray:
    """The class of each character below U+0250, by its general category."""
    found = np.full(0x250, _OTHER, np.uint8)
    for point in range(0x250):
        kind = unicodedata.category(chr(point))[0]
        found[point] = _LETTER if kind == "L" else _NUMBER if kind == "N" else _OTHER
    found[[9, 10, 11, 12, 13, 0x20, 0x85, 0xA0]] = _SPACE
    return found


class WordCachedTokenizer:
    """Ids of whole texts; each different word is encoded once in a worker.

    For a tokenizer that lower-cases, drops white space, and cuts words into runs of letters,
    single numbers, runs of other characters and English contractions. Words never reach over
    white space, so a text's ids are its words' ids in a row. Words are found and told apart by
    hash in numpy over many texts at once. Texts with characters from U+0250 on, the dotted
    capital I, or special-token marks are cut at ASCII white space only, and the tokenizer does
    the rest.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.word = Tokenizer.from_file(path)
        self.word.normalizer = normalizers.Sequence([])
        self.word.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.model = self.word.model
        self.classes = _character_classes()
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        self.lower, self.values = lower, byte_values(1)[lower]
        self.chunks: dict[str, np.ndarray] = {}
        self.forget()

    @classmethod
    def of(cls, path: str) -> WordCachedTokenizer:
        """The worker's own, kept from task to task."""
        return _TOKENIZERS.setdefault(path, cls(path)) if path not in _TOKENIZERS else _TOKENIZERS[path]

    def forget(self) -> None:
        # Known words: sorted hashes and their slots. A dictionary took 90 bytes more for each (measured).
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.known = 0
        self.flat, self.filled = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        raw = [text.encode("utf-8", "surrogatepass") for text in texts]
        joined = b"\n".join(raw) + b"\n"
        buffer = np.frombuffer(joined, np.uint8)
        usual = np.ones(len(texts), bool)
        if (buffer >= 0xCA).any() or b"<|" in joined or b"\xc4\xb0" in joined:
            usual = np.array([_UNUSUAL.search(text) is None for text in texts], bool)
            joined = b"".join(x + b"\n" for x, plain in zip(raw, usual.tolist(), strict=True) if plain)
            buffer = np.frombuffer(joined, np.uint8)
        ends = np.cumsum([len(x) + 1 for x, plain in zip(raw, usual.tolist(), strict=True) if plain])
        found = iter(self._usual(joined, buffer, np.asarray(ends, np.int64)))
        return [next(found) if plain else self._unusual(text) for text, plain in zip(texts, usual.tolist(), strict=True)]

    def _unusual(self, text: str) -> np.ndarray:
        words = _CHUNK.findall(text)
        if len(self.chunks) > _CACHED_WORDS:
            self.chunks = {}
        new = list({word for word in words if word not in self.chunks})
        for word, got in zip(new, self.whole.encode_batch_fast(new, add_special_tokens=False), strict=True):
            self.chunks[word] = np.array(got.ids, np.uint32)
        return np.concatenate([self.chunks[word] for word in words]) if words else np.zeros(0, np.uint32)

    def _words(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end byte of each word."""
        kind = self.classes[np.minimum(buffer, 0x7F)]
        lead = np.flatnonzero(buffer >= 0xC2)
        wide = self.classes[(buffer[lead].astype(np.int64) & 0x1F) << 6 | (buffer[lead + 1] & 0x3F)]
        kind[lead] = wide
        kind[lead + 1] = wide
        begins = np.empty(len(buffer), bool)
        begins[0] = True
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins |= kind == _NUMBER
        begins[lead + 1] = False
        mark = np.flatnonzero(buffer == 39)
        mark = mark[begins[mark]]
        mark = mark[begins[mark + 1]]
        if len(mark):  # the text ends in a line feed, and no letter stands before a missing third byte
            one, two = self.lower[buffer[mark + 1]], self.lower[buffer[np.minimum(mark + 2, len(buffer) - 1)]]
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            double = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
            begins[mark[short | double] + 1] = False
            begins[mark[short] + 2] = True
            begins[mark[double] + 3] = True
        first = np.flatnonzero(begins)
        end = np.append(first[1:], len(buffer))
        word = kind[first] != _SPACE
        return first[word], end[word]

    def _usual(self, joined: bytes, buffer: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        if not len(buffer):
            return []
        first, end = self._words(buffer)
        hashes = RangeHash(self.values[buffer]).of(first, end)
        code, different = pd.factorize(hashes)
        sample = np.empty(len(different), np.int64)
        sample[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        if len(self.keys) + len(different) > _CACHED_WORDS:
            self.forget()
        slot = self._slots(different, lambda i: joined[first[sample[i]] : end[sample[i]]])[code]
        sizes = self.sizes[slot]
        before = np.zeros(len(slot) + 1, np.int64)
        np.cumsum(sizes, out=before[1:])
        ids = self.flat[np.repeat(self.starts[slot] - before[:-1], sizes) + np.arange(before[-1])]
        cuts = before[np.searchsorted(first, ends)]
        return np.split(ids, cuts[:-1])

    def _slots(self, hashes: np.ndarray, spelling: Callable[[int], bytes]) -> np.ndarray:
        """The slots of different words; those not known yet are learned."""
        order = np.argsort(hashes)
        wanted = hashes[order]
        at = np.searchsorted(self.keys, wanted)
        known = np.zeros(len(wanted), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == wanted[inside]
        found = np.empty(len(wanted), np.int32)
        found[known] = self.slots[at[known]]
        new = np.flatnonzero(~known)
        found[new] = [self._learn(spelling(i).decode().lower()) for i in order[new].tolist()]
        self.keys, self.slots = np.insert(self.keys, at[new], wanted[new]), np.insert(self.slots, at[new], found[new])
        slots = np.empty(len(hashes), np.int64)
        slots[order] = found
        return slots

    def _learn(self, word: str) -> int:
        if _PLAIN.fullmatch(word):
            ids = [token.id for token in self.model.tokenize(word)]
        else:
            ids = self.word.encode(word, add_special_tokens=False).ids
        slot = self.known
        if slot == len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        while self.filled + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.known, self.starts[slot], self.sizes[slot] = slot + 1, self.filled, len(ids)
        self.flat[self.filled : self.filled + len(ids)] = ids
        self.filled += len(ids)
        return slot


def pieces(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, _row, piece, start, length, ids_crc32`` and, if asked, ``ids``.

    A document is its ids and then id 0; only documents over the capacity are cut.
    """
    schema = "doc_id {}, _row long, piece int, start long, length long, ids_crc32 long".format(
        documents.schema["doc_id"].dataType.simpleString()
    ) + (", ids binary" if with_ids else "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordCachedTokenizer.of(tokenizer_path)
        for batch in batches:
            for first, last in slices(batch, "text", 1 << 18):
                part = batch.slice(first, last - first)
                row, out = [], defaultdict(list)
                for k, ids in enumerate(tokenizer.ids(part.column("text").to_pylist())):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    for piece, at in enumerate(range(0, len(ids), capacity)):
                        cut = ids[at : at + capacity]
                        row.append(k)
                        out["piece"].append(piece)
                        out["start"].append(at)
                        out["length"].append(len(cut))
                        out["ids_crc32"].append(zlib.crc32(cut))
                        if with_ids:
                            out["ids"].append(cut.tobytes())
                at = pa.array(row, pa.int64())
                columns = [part.column("doc_id").take(at), part.column("_row").take(at), pa.array(out["piece"], pa.int32())]
                columns += [pa.array(out[name], pa.int64()) for name in ("start", "length", "ids_crc32")]
                names = ["doc_id", "_row", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(out["ids"], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return documents.mapInArrow(lean(run), schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs of slots ``(length, first rank, end rank, first sequence, offset, ranks a sequence)``.

    Best fit, longest first, over counts: equal open sequences are one entry (room, first
    sequence, how many). Their number depends on the capacity, not on the documents.
    """
    rooms: list[int] = []
    open_by_room: dict[int, list[tuple[int, int]]] = {}
    slots, sequences = [], 0

    def keep(room: int, first: int, many: int) -> None:
        if room and many:
            if room not in open_by_room:
                bisect.insort(rooms, room)
                open_by_room[room] = []
            open_by_room[room].append((first, many))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, many = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room], rooms[at]
            else:
                room, first, many = capacity, sequences, -(-left // (capacity // length))
                sequences += many
            each = room // length
            full = min(many, left // each)
            if full:
                slots.append((length, rank, rank + full * each, first, capacity - room, each))
                keep(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            rest = 0
            if left and full < many:
                rest = 1
                slots.append((length, rank, rank + left, first + full, capacity - room, left))
                keep(room - left * length, first + full, 1)
                left = 0
            keep(room, first + full + rest, many - full - rest)
    return slots


def pack(
    spark: SparkSession,
    table: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """Packs all rows of ``table(doc_id, text)``; a row per piece with its sequence and offset.

    Null or empty text: one piece holding only the end id. Rows that share an id are packed each
    for itself; an empty table gives no rows; other columns are ignored. Null ids are kept.
    """
    cut = stored(pieces(documents_of(table), tokenizer_path, capacity, with_ids), "pieces")
    # At most `capacity` rows reach the driver.
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(
        plan(counts, capacity),
        "_length long, _first long, _end long, _sequence long, _offset long, _each long",
    )
    return _ranked(spark, cut).join(
        F.broadcast(slots),  # bounded by the capacity
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end")),
    ).select(
        *[c for c in cut.columns if c != "_row"],
        F.expr("_sequence + (_rank - _first) div _each").alias("sequence_id"),
        F.expr("_offset + (_rank - _first) % _each * length").alias("offset"),
    )


def _ranked(spark: SparkSession, cut: DataFrame) -> DataFrame:
    """Adds ``_rank`` from 0 among the pieces of a length.

    Pieces are dealt over buckets by a hash, so that a length that a third of all documents share
    is ranked by many tasks: the rank is the number in earlier buckets plus that in its own.
    """
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.withColumn("_bucket", F.pmod(F.xxhash64("_row", "piece", "ids_crc32"), F.lit(buckets)))
    earlier = (
        dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
        .withColumn(
            "_before",
            F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
            - F.col("_n"),
        )
        .select(F.col("length").alias("_l"), F.col("_bucket").alias("_b"), "_before")
    )
    own = Window.partitionBy("length", "_bucket").orderBy("_row", "doc_id", "piece")
    return (
        dealt.withColumn("_place", F.row_number().over(own) - 1)
        .join(earlier, (F.col("length") == F.col("_l")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("_rank", F.col("_before") + F.col("_place"))
    )
