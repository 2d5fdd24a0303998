"""Documents linked by the Jaccard similarity of their word n-grams, and the groups they form.

Equal sets are one class from the start. Candidates are found without pairs, in two steps that lose
no link. A share of the incidence matrix's columns (n-grams) is dealt over tasks; a class with more
n-grams there that no other class holds than a linked set may lack is out. The
sets that are left are cut into one part more than two linked sets of their size can differ in
elements, so linked sets have an equal part (for every size that a partner can have). Classes with
equal parts form blocks (or else, at a loose threshold, classes that share one of their rarest
n-grams); within a block, the product of its sparse incidence matrix (class by
n-gram) with its transpose gives the overlaps, and those below the bound of the two sizes go.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm.common import (
    KeyFilter, RangeHash, byte_values, documents_of, is_empty, joined_bytes, lean, mixed, restored, signed, slices, stored,
)
from cartulary.llm.components import connected_components

WORDS = 3
PER_CENT = 90
#: N-grams in one block of the matrix product at most (unless one document has more).
BLOCK_NGRAMS = 1_000_000
#: The share of columns that is looked at first, as a multiple of the square of what a linked set may
#: lack: all at 0.8, a quarter at 0.9. A looser threshold means shorter parts, which many sets have
#: by chance, so more must be ruled out before parts are compared.
COLUMNS = 25
#: Bytes of texts that are hashed at once.
STRETCH = 1 << 18
_FLUSH = 400_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _word_hashes(raw: np.ndarray, stretch: int) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and their hashes, from bytes worked on a stretch at a time."""
    starts, hashes, begin = [], [], 0
    while begin < len(raw):
        end = min(begin + stretch, len(raw))
        while end < len(raw):  # to the next white space: no word is cut
            spaces = np.flatnonzero(_SPACE[raw[end : end + 4096]])
            if len(spaces):
                end += int(spaces[0])
                break
            end = min(end + 4096, len(raw))
        part = raw[begin:end]
        inside = np.concatenate([[False], ~_SPACE[part], [False]])
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        starts.append(turns[::2] + begin)
        hashes.append(RangeHash(byte_values(2)[_LOWER[part]]).of(turns[::2], turns[1::2]))
        begin = end
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: list[str], words: int = WORDS, stretch: int = STRETCH) -> list[np.ndarray]:
    """Each text's sorted set of 64-bit n-gram hashes.

    Words are what stands between ASCII white space, A-Z in lower case. A text with fewer words
    than an n-gram has one element, its whole sequence; one without words has none. Beyond a
    stretch of bytes, memory holds words and n-grams only.
    """
    raw, ends = joined_bytes([text + "\n" for text in texts])
    if not len(raw):
        return []
    first, word = _word_hashes(raw, stretch)
    borders = np.searchsorted(first, ends)
    found = []
    for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        if b - a >= words:
            grams = np.zeros(b - a - words + 1, np.uint64)
            for k in range(words):
                grams = mixed(grams + word[a + k : a + k + len(grams)])
            found.append(np.unique(grams))
        else:
            one = np.zeros(min(1, b - a), np.uint64)
            for k in range(a, b):
                one = mixed(one + word[k : k + 1])
            found.append(mixed(one + np.uint64(b - a)))
    return found


def class_of(grams: np.ndarray) -> int:
    """A 64-bit hash of the whole set: equal sets are one class."""
    return int(signed(mixed(mixed(grams + np.uint64(7)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(grams))))[0])


def size_bands(size: int, per_cent: int) -> tuple[int, int]:
    """The band of a size, and the largest size in it; partners are in it or next to it."""
    low, band = 1, 0
    while True:
        high = low * 100 // per_cent
        if size <= high:
            return band, high
        low, band = high + 1, band + 1


class Parts:
    """The hashed parts of a set, for its own size band and the next."""

    def __init__(self, per_cent: int) -> None:
        self.per_cent, self.known = per_cent, {}

    def plans(self, size: int) -> list[tuple[int, np.ndarray]]:
        if size not in self.known:
            band, high = size_bands(size, self.per_cent)
            following = size_bands(high + 1, self.per_cent)[1]
            self.known[size] = [
                (number, np.linspace(0, 2.0**64, parts + 1)[1:-1].astype(np.uint64))
                # Linked sets of at most `top` elements differ in (100 - p) / (100 + p) of both sizes' sum at most.
                for number, top in ((band, high), (band + 1, following))
                if (parts := 2 * top * (100 - self.per_cent) // (100 + self.per_cent) + 1) > 1
            ]
        return self.known[size]

    def of(self, grams: np.ndarray) -> np.ndarray:
        """A hash for each part; sets of one size range with an equal part share it."""
        found = []
        for band, edges in self.plans(len(grams)):
            first, empty = self._cut(grams, edges, band)
            found.append(first[~empty])
            if empty.any():
                # An empty part says little. Sets that share one share a part of a second cut too,
                # or, if that is empty again, both.
                other, none = self._cut(np.sort(mixed(grams + np.uint64(11))), edges, band + 100_000)
                found += [other[~none], mixed(other[none][:, None] + first[empty][None]).ravel()]
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    @staticmethod
    def _cut(grams: np.ndarray, edges: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
        sums = np.zeros(len(grams) + 1, np.uint64)
        np.cumsum(mixed(grams + np.uint64(13)), out=sums[1:])
        at = np.concatenate([[0], np.searchsorted(grams, edges), [len(grams)]])
        number = np.uint64(band) << np.uint64(32) | np.arange(len(at) - 1, dtype=np.uint64)
        return mixed(mixed(sums[at[1:]] - sums[at[:-1]]) + mixed(number)), at[1:] == at[:-1]


def _per_text(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for first, last in slices(batch, "text", 1 << 20):
            part = batch.slice(first, last - first)
            yield part, shingle_sets(part.column("text").to_pylist(), words)


def _first_columns(per_cent: int) -> np.uint64:
    """N-grams with a smaller hash are the columns that are looked at first."""
    share = min(1.0, COLUMNS * ((100 - per_cent) / 100) ** 2)
    return np.uint64(min(int(share * 2.0**64), 2**64 - 1))


def classes_of(documents: DataFrame, words: int = WORDS, per_cent: int = PER_CENT) -> DataFrame:
    """``doc_id, _row, n_shingles, class`` (null without words) of each document, and of its n-grams
    the number ``looked`` in the first columns."""
    columns = _first_columns(per_cent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _per_text(batches, words):
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("_row"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([class_of(x) if len(x) else None for x in sets], pa.int64()),
                    pa.array([int(np.searchsorted(x, columns)) for x in sets], pa.int64()),
                ],
                ["doc_id", "_row", "n_shingles", "class", "looked"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(lean(run), f"doc_id {kind}, _row long, n_shingles long, class long, looked long")


def _by_bucket(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """The places of each bucket that has any."""
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
        if b > a:
            yield k, order[a:b]


def _shared(entries: list[np.ndarray], classes: int) -> np.ndarray:
    """How many n-grams of each class another one has too, or more: entries are 32 bits of an n-gram
    and the class, a list from each task, and a class comes from every task that has copies of it.

    N-grams of a class that these bits don't tell apart all count, as they may all be shared.
    """
    merged = np.zeros(classes, np.int64)
    for own in entries:
        own.sort()
        twice = own[1:][own[1:] == own[:-1]] & np.uint64(0xFFFFFFFF)
        if len(twice):
            found, many = np.unique(twice.astype(np.int64), return_counts=True)
            merged[found] = np.maximum(merged[found], many)
    every = np.unique(np.concatenate(entries))
    gram = every >> np.uint64(32)
    alike = np.zeros(len(gram), bool)
    alike[1:] = gram[1:] == gram[:-1]
    alike[:-1] |= alike[1:].copy()
    return merged + np.bincount((every[alike] & np.uint64(0xFFFFFFFF)).astype(np.int64), minlength=classes)


def shared_counts(documents: DataFrame, words: int, per_cent: int, buckets: int, class_buckets: int) -> DataFrame:
    """``class, shared``: how many of a class's n-grams in the first columns some other class has too, or more.

    Tasks send the entries of the incidence matrix packed by blocks of columns. An n-gram is told by
    its block and 32 bits more; taking two for one can only make a count larger. Counts of a block
    travel packed too, by buckets of classes, where they are added up.
    """
    names, kinds = ["bucket", "grams", "holder", "classes"], [pa.int32(), *[pa.binary()] * 3]
    columns = _first_columns(per_cent)
    wide = np.uint64((int(columns) >> 33) + 1)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            grams = np.concatenate(held)
            holder = np.repeat(np.arange(len(held)), [len(x) for x in held]).astype(np.uint16)
            classes = np.fromiter(seen, np.int64, len(seen))
            rows = []
            for k, at in _by_bucket(((grams >> np.uint64(33)) * np.uint64(buckets) // wide).astype(np.int32), buckets):
                own, place = np.unique(holder[at], return_inverse=True)
                rows.append((k, grams[at].astype(np.uint32).tobytes(), place.astype(np.uint16).tobytes(), classes[own].tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in enumerate(kinds)], names)

        size = 0
        for _, sets in _per_text(batches, words):
            for grams in sets:
                first = grams[: np.searchsorted(grams, columns)]
                if not len(first) or (node := class_of(grams)) in seen:
                    continue
                seen[node] = len(held)
                held.append(first.copy())
                size += len(first)
                if size > 2 * _FLUSH or len(held) > 65_000:
                    yield flush()
                    seen, held, size = {}, [], 0
        if held:
            yield flush()

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["bucket"]):
            lists = [np.frombuffer(x, np.int64) for x in rows["classes"]]
            classes, place = np.unique(np.concatenate(lists), return_inverse=True)
            borders = np.cumsum([0, *map(len, lists)])
            entries = [
                np.frombuffer(g, np.uint32).astype(np.uint64) << np.uint64(32) | place[first + np.frombuffer(h, np.uint16).astype(np.int64)].astype(np.uint64)
                for g, h, first in zip(rows["grams"], rows["holder"], borders.tolist(), strict=False)
            ]
            many = _shared(entries, len(classes))
            classes, many = classes[many > 0], many[many > 0].astype(np.int32)
            found = [
                (k, classes[at].tobytes(), many[at].tobytes())
                for k, at in _by_bucket(mixed(classes.view(np.uint64)) % np.uint64(class_buckets), class_buckets)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in found], t) for n, t in enumerate((pa.int32(), pa.binary(), pa.binary()))],
                ["of", "classes", "shared"],
            )

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, classes, many = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            columns = batch.to_pydict()
            for of, names, counts in zip(columns["of"], columns["classes"], columns["shared"], strict=True):
                if of != now:
                    yield _counted(classes, many)
                    now, classes, many = of, np.zeros(0, np.int64), np.zeros(0, np.int64)
                classes, place = np.unique(np.concatenate([classes, np.frombuffer(names, np.int64)]), return_inverse=True)
                each = np.concatenate([many, np.frombuffer(counts, np.int32)])
                many = np.bincount(place, each, len(classes)).astype(np.int64)
        yield _counted(classes, many)

    packed = documents.mapInArrow(lean(cut), "bucket int, grams binary, holder binary, classes binary")
    met = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(lean(meet), "of int, classes binary, shared binary")
    return met.repartition(class_buckets, "of").sortWithinPartitions("of").mapInArrow(lean(add), "class long, shared long")


def _counted(classes: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(classes), pa.array(many)], ["class", "shared"])


def _documents_of_classes(documents: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    """The first document of each class of ``classes(class, doc_id, _row, ...)``, with their columns."""
    wanted = classes.withColumnsRenamed({"doc_id": "_doc", "_row": "_key"})
    marked = KeyFilter(wanted, "_key", name).mark(documents, "_row").where("_passes").drop("_passes")
    return marked.join(wanted, (F.col("_row") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc"))).drop("_doc", "_key")


def _stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each key its smallest node, and edges from that to the key's other nodes."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    begins = np.empty(len(keys), bool)
    begins[:1] = True
    np.not_equal(keys[1:], keys[:-1], out=begins[1:])
    least = nodes[begins]
    centre = least[np.cumsum(begins) - 1]
    edges = np.unique(np.stack([centre, nodes], 1)[centre != nodes], axis=0) if len(keys) else np.zeros((0, 2), np.int64)
    return keys[begins], least, edges[:, 0], edges[:, 1]


def candidate_edges(documents: DataFrame, words: int, per_cent: int, buckets: int) -> DataFrame:
    """``a, b``: classes that share a part, as stars around the smallest class that has it.

    Tasks first form their own stars, so a part that very many classes share comes as one row of
    each task, and what a bucket gets are packed arrays.
    """
    schema = "bucket int, keys binary, nodes binary, a binary, b binary"
    names = ["bucket", "keys", "nodes", "a", "b"]
    kinds = [pa.int32(), *[pa.binary()] * 4]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, keys, nodes, held, seen = Parts(per_cent), [], [], 0, set()

        def flush() -> pa.RecordBatch:
            sig, least, a, b = _stars(np.concatenate(keys), np.concatenate(nodes))
            bucket = ((sig >> np.uint64(33)) * np.uint64(buckets) >> np.uint64(31)).astype(np.int64)
            at = np.searchsorted(bucket, np.arange(buckets + 1))  # sorted, as the hashes are
            share = np.linspace(0, len(a), buckets + 1).astype(np.int64)
            rows = [
                (k, sig[i:j].tobytes(), least[i:j].tobytes(), a[p:q].tobytes(), b[p:q].tobytes())
                for k, (i, j, p, q) in enumerate(zip(at[:-1], at[1:], share[:-1], share[1:], strict=True))
                if j > i or q > p
            ]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, kinds, strict=True)], names)

        for _, sets in _per_text(batches, words):
            for grams in sets:
                if not len(grams) or (node := class_of(grams)) in seen:
                    continue
                seen.add(node)
                if len(found := parts.of(grams)):
                    keys.append(found)
                    nodes.append(np.full(len(found), node, np.int64))
                    held += len(found)
            if held > _FLUSH:
                yield flush()
                keys, nodes, held, seen = [], [], 0, set()
        if held:
            yield flush()

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["bucket"]):
            read = [[np.frombuffer(x, t) for x in rows[n]] for n, t in zip(names[1:], (np.uint64, *[np.int64] * 3), strict=True)]
            keys, nodes, a, b = (np.concatenate(x) for x in read)
            _, _, c, d = _stars(keys, nodes)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, c])), pa.array(np.concatenate([b, d]))], ["a", "b"])

    cut_up = documents.mapInArrow(lean(cut), schema)
    return cut_up.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(lean(meet), "a long, b long")


def prefix_edges(documents: DataFrame, words: int, per_cent: int, buckets: int) -> DataFrame:
    """``a, b``: classes that share one of their rarest n-grams, as stars around the smallest class.

    With n-grams in one order for all, rarest first, two linked sets share one of the first
    ``size - least overlap + 1`` of each. N-grams are counted by blocks of columns, their counts go
    back to the sets packed, and only n-grams of such a beginning that another class has too are sent
    on. Passages that very many documents share are at the sets' ends, so they bring none together;
    a looser threshold's short parts would.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0
        for _, sets in _per_text(batches, words):
            for grams in sets:
                if len(grams) and (node := class_of(grams)) not in held:
                    held[node] = grams
                    size += len(grams)
                    if size > _FLUSH:
                        yield _packed(*_entries(held), buckets, grams_bucket)
                        held, size = {}, 0
        if held:
            yield _packed(*_entries(held), buckets, grams_bucket)

    def grams_bucket(grams: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return ((grams >> np.uint64(33)) * np.uint64(buckets) >> np.uint64(31)).astype(np.int64)

    def nodes_bucket(grams: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return (mixed(nodes.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["bucket"]):
            grams, nodes = (np.concatenate([np.frombuffer(x, t) for x in rows[n]]) for n, t in (("grams", np.uint64), ("nodes", np.int64)))
            order = np.lexsort((nodes, grams))
            grams, nodes = grams[order], nodes[order]
            new = np.ones(len(grams), bool)  # a class comes from every task that has copies of it
            new[1:] = (grams[1:] != grams[:-1]) | (nodes[1:] != nodes[:-1])
            grams, nodes = grams[new], nodes[new]
            _, place, many = np.unique(grams, return_inverse=True, return_counts=True)
            yield _packed(grams, nodes, np.minimum(many, 65_535)[place].astype(np.uint16), buckets, nodes_bucket)

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["bucket"]):
            grams, nodes, many = (
                np.concatenate([np.frombuffer(x, t) for x in rows[n]])
                for n, t in (("grams", np.uint64), ("nodes", np.int64), ("many", np.uint16))
            )
            order = np.lexsort((grams, many, nodes))
            grams, nodes, many = grams[order], nodes[order], many[order]
            first = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
            size = np.diff(np.append(first, len(nodes)))
            # Of `size` n-grams, at least (size * p / 100) are shared with any partner.
            begin = size - -(-size * per_cent // 100) + 1
            place = np.arange(len(nodes)) - np.repeat(first, size)
            sent = (place < np.repeat(begin, size)) & (many > 1)
            yield _packed(grams[sent], nodes[sent], many[sent], buckets, grams_bucket)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["bucket"]):
            grams, nodes = (np.concatenate([np.frombuffer(x, t) for x in rows[n]]) for n, t in (("grams", np.uint64), ("nodes", np.int64)))
            _, _, a, b = _stars(grams, nodes)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    schema = "bucket int, grams binary, nodes binary, many binary"
    rows = documents.mapInArrow(lean(cut), schema)
    for step in (count, choose):
        rows = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(lean(step), schema)
    return rows.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(lean(meet), "a long, b long")


def _entries(held: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of these rows of the incidence matrix: n-grams, classes, and no counts yet."""
    grams = np.concatenate([*held.values()])
    nodes = np.repeat(np.fromiter(held, np.int64, len(held)), [len(x) for x in held.values()])
    return grams, nodes, np.zeros(len(grams), np.uint16)


def _packed(
    grams: np.ndarray, nodes: np.ndarray, many: np.ndarray, buckets: int, bucket_of: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> pa.RecordBatch:
    """Entries as one row a bucket, by class in each: equal classes side by side pack well."""
    order = np.argsort(nodes, kind="stable")
    grams, nodes, many = grams[order], nodes[order], many[order]
    rows = [(k, grams[at].tobytes(), nodes[at].tobytes(), many[at].tobytes()) for k, at in _by_bucket(bucket_of(grams, nodes), buckets)]
    kinds = (pa.int32(), *[pa.binary()] * 3)
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in enumerate(kinds)], ["bucket", "grams", "nodes", "many"])


def _runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """The columns of each run of rows that are equal in ``keys``; rows come sorted by them."""
    now, rows = None, {}
    for batch in batches:
        columns = batch.to_pydict()
        names = [*zip(*(columns[k] for k in keys), strict=True)]
        start = 0
        for i in range(1, len(names) + 1):
            if i < len(names) and names[i] == names[start]:
                continue
            if names[start] != now:
                if now is not None:
                    yield rows
                now, rows = names[start], {name: [] for name in columns}
            for name, values in columns.items():
                rows[name] += values[start:i]
            start = i
    if now is not None:
        yield rows


#: How candidates are found: of documents, words, per cent and buckets, edges ``a, b``.
Candidates = Callable[[DataFrame, int, int, int], DataFrame]


class BlockProduct:
    """Rows of the product of a block's incidence matrix with its transpose."""

    def __init__(self, sets: list[np.ndarray], per_cent: int) -> None:
        self.sizes = np.array([len(x) for x in sets], np.int64)
        self.per_cent = per_cent
        column = np.unique(np.concatenate(sets), return_inverse=True)[1] if sets else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(sets)), self.sizes)
        self.columns = np.split(column, np.cumsum(self.sizes)[:-1]) if sets else []
        self.holders = row[np.argsort(column, kind="stable")]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(column))]) if len(column) else np.zeros(1, np.int64)

    def linked(self, row: int) -> np.ndarray:
        """The rows whose overlap with ``row`` reaches the bound of the two sizes; itself too."""
        columns = self.columns[row]
        first, last = self.starts[columns], self.starts[columns + 1]
        many = last - first
        at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        overlap = np.bincount(self.holders[at], minlength=len(self.sizes))
        union = self.sizes + self.sizes[row] - overlap
        return np.flatnonzero(100 * overlap >= self.per_cent * union)

    def groups(self, rows: np.ndarray | None = None) -> np.ndarray:
        """A label for each row, equal for rows that links join.

        Links inside the largest group add nothing, so only rows outside it are multiplied. With
        ``rows``, only these rows are multiplied.
        """
        label = np.arange(len(self.sizes))
        todo = np.ones(len(label), bool) if rows is None else np.isin(label, rows)
        while True:
            if rows is None:
                largest = np.bincount(label).argmax()
                left = np.flatnonzero(todo & (label != largest))
            else:
                left = np.flatnonzero(todo)
            if not len(left):
                return label
            row = left[0]
            todo[row] = False
            joined = np.unique(label[self.linked(row)])
            label[np.isin(label, joined)] = joined[0]


def _blocks(rows: DataFrame, keys: list[str], edges_of: Callable[[dict[str, list]], Iterator[tuple[int, int]]]) -> DataFrame:
    """Runs ``edges_of`` on each block of rows; the edges that it finds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _runs(batches, keys):
            found = [*edges_of(block)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(lean(run), "a long, b long")


def _sets(block: dict[str, list]) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in block["grams"]]


def links(
    spark: SparkSession, table: DataFrame, words: int = WORDS, per_cent: int = PER_CENT, block_ngrams: int = BLOCK_NGRAMS,
    candidates: Candidates = candidate_edges,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``table(doc_id, text)``.

    Null or empty text, or one without words: 0 n-grams, linked with nothing. Rows equal in id and
    text are one document twice and are linked by their equal sets. Null ids come last when the
    smallest id of a component is chosen. Other columns are ignored; an empty table gives no rows.
    N-grams and whole sets are compared by 64-bit hashes. ``candidates`` may be ``candidate_edges``
    or ``prefix_edges``, with equal results.
    """
    return _grouped(spark, documents_of(table), words, per_cent, block_ngrams, candidates).select("doc_id", "n_shingles", "component_id")


def keep_one(
    spark: SparkSession, table: DataFrame, words: int = WORDS, per_cent: int = PER_CENT, block_ngrams: int = BLOCK_NGRAMS,
    candidates: Candidates = prefix_edges,
) -> DataFrame:
    """One row of each group of linked documents, with all its columns: that with the smallest id.

    Rows without words are in no group and stay.
    """
    keyed = documents_of(table, carry=True)
    rows = stored(_grouped(spark, keyed.select("doc_id", "text", "_row"), words, per_cent, block_ngrams, candidates).where("root is not null"), "grouped")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    first = rows.groupBy("root").agg(F.min(key).alias("kept"), F.count("*").alias("n")).where("n > 1")
    groups = stored(rows.join(stored(first, "first").withColumnRenamed("root", "_root"), F.col("root") == F.col("_root")), "larger")
    leading = (F.col("_row") == F.col("kept._row")) & F.col("doc_id").eqNullSafe(F.col("kept.doc_id"))
    marked = groups.groupBy(F.col("doc_id").alias("_doc"), F.col("_row").alias("_key")).agg(
        F.count("*").alias("copies"), F.bool_or(leading).alias("leads")
    )
    marked = stored(marked.where("copies > 1 or not leads"), "marked")
    same = (F.col("_row") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    told = KeyFilter(marked, "_key", "marked-keys").mark(keyed, "_row")
    single = told.where("not _passes").select("_carried", "text").unionByName(
        told.where("_passes").join(marked, same, "left_anti").select("_carried", "text")
    )
    copies = told.where("_passes").join(marked.where("leads"), same).dropDuplicates(["doc_id", "_row"])
    return restored(single.unionByName(copies.select("_carried", "text")), table.columns)


def _grouped(
    spark: SparkSession, documents: DataFrame, words: int, per_cent: int, block_ngrams: int, candidates: Candidates
) -> DataFrame:
    nodes = stored(classes_of(documents, words, per_cent), "nodes")
    classes = stored(
        nodes.where("class is not null").groupBy("class").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("first"),
            F.max("n_shingles").alias("size"), F.max("looked").alias("looked"),
        ).select("class", F.col("first.doc_id").alias("doc_id"), F.col("first._row").alias("_row"), "size", "looked"),
        "classes",
    )
    looked = _buckets(spark, classes, "looked")
    shared = shared_counts(documents, words, per_cent, looked, _buckets(spark, classes, F.lit(1)))
    # N-grams that no other class has are more than a linked set may lack, or else the class stays.
    alone = F.col("looked") - F.coalesce("shared", F.lit(0))
    able = stored(
        classes.join(shared.withColumnRenamed("class", "_class"), F.col("class") == F.col("_class"), "left").where(
            alone * 100 <= F.col("size") * (100 - per_cent)
        ).select(*classes.columns),
        "able",
    )
    chosen = _documents_of_classes(documents, able, "able-keys").select("doc_id", "_row", "text")
    near = stored(candidates(chosen, words, per_cent, _buckets(spark, able)).distinct(), "candidates")
    if is_empty(near):
        joined = classes.select("class", F.col("class").alias("root"))
    else:
        groups = stored(connected_components(near), "groups")
        edges = _verified(documents, classes, groups, words, per_cent, block_ngrams)
        roots = connected_components(edges).select(F.col("node").alias("class"), "root")
        joined = classes.select("class").join(stored(roots, "roots"), "class", "left").select(
            "class", F.coalesce("root", "class").alias("root")
        )
    joined = stored(joined, "joined")
    smallest = stored(
        joined.join(classes, "class").groupBy("root").agg(
            F.min("doc_id").alias("component_id"), F.count("*").alias("many")
        ), "smallest",
    )
    by_class = stored(joined.join(smallest, "root").select(F.col("class").alias("_class"), "component_id", "root"), "by-class")
    # Both sides are written tables, so the class of a third of all documents can be split.
    return nodes.join(by_class, F.col("class") == F.col("_class"), "left").select(
        "doc_id", "_row", "n_shingles", "root",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _buckets(spark: SparkSession, classes: DataFrame, weight: str | Column = "size") -> int:
    """Into how many blocks of a task's memory so much of these classes goes."""
    total = classes.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / (2 * _FLUSH)))


def _verified(
    documents: DataFrame, classes: DataFrame, groups: DataFrame, words: int, per_cent: int, block_ngrams: int
) -> DataFrame:
    """Edges between classes that join the same classes as all links do."""
    spark = documents.sparkSession
    members = stored(groups.join(classes, groups["node"] == classes["class"]).drop("node"), "members")
    weights = members.groupBy("root").agg(
        F.ceil(F.sum("size") / block_ngrams).alias("chunks"), F.min("class").alias("centre")
    )
    members = stored(members.join(weights, "root"), "weighed")
    chosen = _documents_of_classes(documents, members.drop("size"), "member-keys")

    def grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _per_text(batches, words):
            columns = [part.column(c) for c in ("root", "class", "chunks", "centre")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())],
                ["root", "class", "chunks", "centre", "size", "grams"],
            )

    # A row that is in the table several times gives the same class as often; one is enough.
    rows = chosen.select("root", "class", "chunks", "centre", "text").mapInArrow(
        lean(grams), "root long, class long, chunks long, centre long, size long, grams binary"
    )
    rows = stored(rows, "incidence")

    def whole(block: dict[str, list]) -> Iterator[tuple[int, int]]:
        label = BlockProduct(_sets(block), per_cent).groups()
        nodes = np.array(block["class"], np.int64)
        for group in np.unique(label):
            own = nodes[label == group]
            yield from ((int(own.min()), int(x)) for x in own)

    edges = _blocks(rows.where("chunks <= 1"), ["root"], whole)
    large = rows.where("chunks > 1").withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks")))
    if is_empty(large):
        return edges
    return edges.unionByName(_large(spark, large, per_cent, block_ngrams))


def _large(spark: SparkSession, large: DataFrame, per_cent: int, block_ngrams: int) -> DataFrame:
    """Edges within groups too large for one block.

    Every chunk meets one centre first. Classes linked to it are together already, so what is left
    are pairs with at least one class that isn't: chunks of these meet every chunk.
    """
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    centres = large.where("class = centre").withColumn("chunk", everywhere)
    by_chunk = large.where("class != centre").withColumn("lead", F.lit(False)).unionByName(
        centres.withColumn("lead", F.lit(True)).select(*large.columns, "lead")
    )

    def to_centre(block: dict[str, list]) -> Iterator[tuple[int, int]]:
        if True in block["lead"]:
            at = block["lead"].index(True)
            for row in BlockProduct(_sets(block), per_cent).linked(at).tolist():
                yield block["class"][at], block["class"][row]

    near = stored(_blocks(by_chunk, ["root", "chunk"], to_centre), "near")
    outside = large.join(near.select(F.col("b").alias("class")).distinct(), "class", "left_anti")
    shares = outside.groupBy("root").agg(F.ceil(F.sum("size") / block_ngrams).alias("shares"))
    outside = outside.join(shares, "root").withColumn("share", F.pmod(F.xxhash64("class", F.lit(1)), F.col("shares")))
    meeting = (
        outside.withColumn("chunk", everywhere).withColumn("lead", F.lit(True)).select("root", "share", "chunk", "lead", "class", "grams")
        .unionByName(
            large.join(shares, "root")
            .withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
            .withColumn("lead", F.lit(False)).select("root", "share", "chunk", "lead", "class", "grams")
        )
    )

    def outsiders(block: dict[str, list]) -> Iterator[tuple[int, int]]:
        label = BlockProduct(_sets(block), per_cent).groups(np.flatnonzero(block["lead"]))
        nodes = np.array(block["class"], np.int64)
        for group in np.unique(label[np.array(block["lead"], bool)]):
            own = nodes[label == group]
            yield from ((int(own.min()), int(x)) for x in own)

    return near.unionByName(_blocks(meeting, ["root", "share", "chunk"], outsiders))
