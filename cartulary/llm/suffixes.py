"""Removal of byte strings that occur more than once, by suffix arrays over shards.

A window is a string of ``WINDOW`` bytes. Every window chooses an anchor, the n-gram in it with the
smallest hash, so equal windows choose equal anchors at equal places. The windows that choose one
anchor occurrence are a *run*: neighbouring starts, one stretch of text. Runs with the same anchor
n-gram are all that can share a window, and form a shard:

1. Runs are counted by anchor and by their whole text. Equal runs repeat each other's windows.
2. Of each anchor with different runs, one run of each text goes to the anchor's shard. There a
   suffix array (Larsson and Sadakane's refinement) and the common prefixes of neighbours (Kasai)
   show which windows occur in two runs.
3. Anchors with very many different runs are dealt over several shards. Each sends one fingerprint
   for every different window, and binary search in the sorted fingerprints finds those that two
   shards have.

A passage of a number of words may be wanted too, if it is shorter than a window. Where few passages
are, they meet by fingerprint. Where most are, they choose anchors of a few words and form runs, which
go through the same steps; in a shard, passages are compared by fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.llm.common import KeyFilter, RangeHash, byte_values, documents_of, is_empty, joined_bytes, lean, restored, signed, slices, stored

WINDOW = 400
ANCHOR = 64
#: Different runs of an anchor in one shard.
SHARD_RUNS = 1024
#: Bytes over which a suffix array is built at once, a few large anchors apart.
SHARD_BYTES = 400_000
#: Words of the anchors of passages.
PASSAGE_ANCHOR = 8
#: Bits of a byte's place in a stretch of text, and bytes of a stretch (no more than these bits count).
PLACE_BITS = 24
STRETCH = 1 << 22


def sliding_argmin(keys: np.ndarray, width: int, place_bits: int = PLACE_BITS) -> np.ndarray:
    """Where the smallest of each ``width`` neighbouring keys stands (the first of equal ones).

    The low ``place_bits`` bits of a key are replaced by its place, so there may be no more keys.
    """
    low = np.uint64((1 << place_bits) - 1)
    if len(keys) > 1 << place_bits:
        raise ValueError(f"{len(keys)} keys for places of {place_bits} bits")
    tagged = (keys & ~low) | np.arange(len(keys), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        tagged = np.minimum(tagged[:-span], tagged[span:])
        span *= 2
    if span < width:
        tagged = np.minimum(tagged[: len(tagged) - (width - span)], tagged[width - span :])
    return (tagged & low).astype(np.int64)


def stretches(size: int, window: int, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``most`` bytes that overlap by ``window - 1``: each window is in exactly one."""
    step = most - (window - 1)
    if step < 1:
        raise ValueError(f"windows of {window} bytes in stretches of {most}")
    for first in range(0, max(size - (window - 1), 1), step):
        yield first, min(first + most, size)


def runs_of(texts: list[str], window: int, anchor: int, most: int = STRETCH) -> Iterator[dict[str, np.ndarray]]:
    """The runs of each text: its place in the list, first byte, number of windows, and hashes.

    Stretches of at most ``most`` bytes are worked on one after another. A run that goes over the
    end of one is two runs: their windows have the same anchor, and still meet all that they equal.
    """
    yield from _joined_runs(*joined_bytes(texts), window, anchor, most)


def _joined_runs(
    raw: np.ndarray, borders: np.ndarray, window: int, anchor: int, most: int = STRETCH, made: dict[int, RangeHash] | None = None
) -> Iterator[dict[str, np.ndarray]]:
    for first, end in stretches(len(raw), window, min(most, 1 << PLACE_BITS)):
        found = _stretch_runs(raw[first:end], borders - first, window, anchor, made or {})
        if found:
            yield found


def _hashes_of(raw: np.ndarray) -> dict[int, RangeHash]:
    """Hashes of ranges of joined texts by salt; none if the texts are more than a stretch."""
    return {salt: RangeHash(byte_values(salt)[raw]) for salt in (3, 4)} if len(raw) <= STRETCH else {}


def _stretch_runs(raw: np.ndarray, borders: np.ndarray, window: int, anchor: int, made: dict[int, RangeHash]) -> dict[str, np.ndarray]:
    """The runs of a stretch of joined texts, whose borders are counted from the stretch's start."""
    if len(raw) < window:
        return {}
    hashes = made.get(3) or RangeHash(byte_values(3)[raw])
    starts = np.arange(len(raw) - anchor + 1)
    grams = hashes.of(starts, starts + anchor)
    chosen = sliding_argmin(grams, window - anchor + 1)
    begin = np.arange(len(chosen))
    owner = np.repeat(np.arange(len(borders) - 1), np.diff(np.clip(borders, 0, len(raw))))[: len(chosen)]
    whole = begin + window <= borders[owner + 1]  # windows never cross documents
    begin, chosen, owner = begin[whole], chosen[whole], owner[whole]
    if not len(begin):
        return {}
    new = np.ones(len(begin), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    many = np.diff(np.append(at, len(begin)))
    first, owner, chosen = begin[at], owner[at], chosen[at]
    end = first + many - 1 + window
    again = made.get(4) or RangeHash(byte_values(4)[raw])
    return {
        "owner": owner,
        "first": first - borders[owner],
        "many": many,
        "anchor": grams[chosen],
        "one": hashes.of(first, end),
        "two": again.of(first, end),
    }


def suffix_array(text: np.ndarray, ends: np.ndarray, depth: int, pack: bool = True) -> np.ndarray:
    """Suffixes in order; a suffix stops at its text's end, and equal ones stand by place.

    ``ends`` has, for every byte, the end of the text that it is in; ``depth`` is the length of the
    longest text (a smaller one would break Kasai's rule). Starts with the order by a few bytes; each
    step doubles the length, and sorts only the groups that aren't settled, by the ranks that stand a
    length further on. As long as two ranks and a place fit into 64 bits, plain numbers are sorted.
    """
    size = len(text)
    bits = np.uint64((size + 1).bit_length())
    packs = pack and 3 * int(bits) <= 64
    length = (60 - int(bits)) // 8 if packs else 8
    padded = np.concatenate([text, np.zeros(length, np.uint8)]).astype(np.uint64)
    key = np.zeros(size, np.uint64)
    place = np.arange(size)
    for k in range(length):
        inside = place + k < ends
        key = key << np.uint64(8) | np.where(inside, padded[k : k + size], np.uint64(0))
    left = np.minimum(ends - place, length).astype(np.uint64)
    new = np.ones(size, bool)
    if packs:
        mask = (np.uint64(1) << bits) - np.uint64(1)
        packed = (key << np.uint64(4) | left) << bits | place.astype(np.uint64)
        packed.sort()
        order = (packed & mask).astype(np.int64)
        packed >>= bits
        new[1:] = packed[1:] != packed[:-1]
    else:
        order = np.lexsort((left, key))
        key, left = key[order], left[order]
        new[1:] = (key[1:] != key[:-1]) | (left[1:] != left[:-1])
    rank = np.empty(size + 1, np.int64)
    rank[size] = -1
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    at = place
    while length < depth:
        # Groups of more than one suffix, if these reach beyond what is compared.
        single = new[at] & np.append(new, True)[at + 1]
        at = at[~single]
        at = at[ends[order[at]] - order[at] >= length]
        if not len(at):
            break
        suffix = order[at]
        further = np.where(suffix + length < ends[suffix], suffix + length, size)
        if packs:
            own, beyond = rank[suffix].astype(np.uint64), (rank[further] + 1).astype(np.uint64)
            packed = (own << bits | beyond) << bits | suffix.astype(np.uint64)
            packed.sort()
            suffix = (packed & mask).astype(np.int64)
            packed >>= bits  # both ranks
            split = np.ones(len(at), bool)
            split[1:] = packed[1:] != packed[:-1]
        else:
            sort = np.lexsort((rank[further], rank[suffix]))
            suffix, further = suffix[sort], further[sort]
            own, beyond = rank[suffix], rank[further]
            split = np.ones(len(at), bool)
            split[1:] = (own[1:] != own[:-1]) | (beyond[1:] != beyond[:-1])
        order[at] = suffix
        new[at] |= split
        rank[suffix] = np.maximum.accumulate(np.where(split, at, 0))
        length *= 2
    return order


def common_prefixes(
    text: np.ndarray, order: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int
) -> np.ndarray:
    """How many bytes each suffix shares with the one before it in ``order``, ``depth`` at most.

    Kasai's rule: a suffix shares at least one byte less than the suffix one byte earlier did with
    its own neighbour. All texts go through their bytes side by side.
    """
    size = len(text)
    before = np.empty(size, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    limit = ends_of(starts, ends, size)
    shared = np.zeros(size, np.int64)
    run = np.zeros(len(starts), np.int64)
    words = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(8, np.uint8)]), 8)
    words = np.ascontiguousarray(words).view(np.uint64)[:, 0]
    for step in range(int((ends - starts).max())):
        lane = np.flatnonzero(starts + step < ends)
        at = starts[lane] + step
        other = before[at]
        most = np.where(other >= 0, np.minimum(np.minimum(limit[at] - at, limit[other] - other), depth), 0)
        have = np.minimum(np.maximum(run[lane] - 1, 0), most)
        live = np.flatnonzero(have < most)
        while len(live):
            differ = words[at[live] + have[live]] ^ words[other[live] + have[live]]
            # Bytes below the lowest bit that differs; all eight, if none does.
            same = (np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3).astype(np.int64)
            have[live] = np.minimum(have[live] + same, most[live])
            live = live[(same == 8) & (have[live] < most[live])]
        run[lane] = have
        shared[at] = have
    return shared


def ends_of(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    return np.repeat(ends, ends - starts)[:size]


def repeated_windows(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the texts one after another: where each starts; whether the window at each byte occurs
    at another byte too; and for equal windows a common number (-1 where there is no window)."""
    text = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(x) for x in texts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    limit = np.repeat(ends, sizes)
    order = suffix_array(text, limit, int(sizes.max()))
    shared = common_prefixes(text, order, starts, ends, window)[order]
    twin = shared >= window
    again = np.zeros(len(text), bool)
    again[order[twin]] = True
    again[order[np.flatnonzero(twin) - 1]] = True
    number = np.empty(len(text), np.int64)
    number[order] = np.cumsum(~twin)
    number[limit - np.arange(len(text)) < window] = -1
    return starts, again, number


def _spans(flags: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal ranges of bytes that the flagged windows cover."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > window) + 1
    return [(int(x[0]), int(x[-1]) + window) for x in np.split(at, cut)]


def find_spans(
    documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_runs: int = SHARD_RUNS, words: int | None = None
) -> DataFrame:
    """``doc_id, _row, first, end, passage``: byte ranges of documents that repeated windows cover.

    With ``words``, also those (``passage``) that repeated passages of so many words cover, of passages
    that are shorter than a window. Ranges of a document may touch or overlap.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    # An anchor's lowest bit tells passages from windows.
    of_passage = F.col("anchor").bitwiseAND(1) == 1 if words else F.lit(False)

    def cut_runs(texts: list[str]) -> Iterator[dict[str, np.ndarray]]:
        raw, borders = joined_bytes(texts)
        made = _hashes_of(raw) if words else None
        for found in _joined_runs(raw, borders, window, anchor, made=made):
            found["size"] = found["many"] + (window - 1)
            if words:
                found["anchor"] = found["anchor"] & ~np.uint64(1)
            yield found
        found = _passage_runs(raw, borders, words, window, made) if words else {}
        if found:
            yield found | {"anchor": found["anchor"] | np.uint64(1)}

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch, "text", 1 << 18):
                part = batch.slice(a, b - a)
                for found in cut_runs(part.column("text").to_pylist()):
                    owner = pa.array(found["owner"])
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id").take(owner),
                            part.column("_row").take(owner),
                            pa.array(found["first"], pa.int64()),
                            pa.array(found["size"], pa.int32()),
                            *[pa.array(signed(found[x])) for x in ("anchor", "one", "two")],
                        ],
                        ["doc_id", "_row", "first", "size", "anchor", "one", "two"],
                    )

    runs = documents.mapInArrow(
        lean(cut), f"doc_id {kind}, _row long, first long, size int, anchor long, one long, two long"
    )
    runs = stored(runs, "runs")
    common = stored(
        runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select(F.col("anchor").alias("_anchor")), "anchors"
    )
    # Two written tables: the anchor of a very common passage can be split.
    runs = stored(runs.join(common, F.col("anchor") == F.col("_anchor")).drop("_anchor"), "shared-runs")
    texts = stored(
        runs.groupBy("anchor", "one", "two").agg(
            F.count("*").alias("n"), F.min(F.struct("first", "_row", "doc_id", "size")).alias("run")
        ),
        "texts",
    )
    equal = runs.join(
        stored(
            texts.where("n > 1").select(F.col("anchor").alias("_a"), F.col("one").alias("_one"), F.col("two").alias("_two")), "equal"
        ),
        (F.col("anchor") == F.col("_a")) & (F.col("one") == F.col("_one")) & (F.col("two") == F.col("_two")),
    ).select("doc_id", "_row", "first", (F.col("first") + F.col("size")).alias("end"), of_passage.alias("passage"))
    several = stored(
        texts.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select(
            F.col("anchor").alias("_anchor"), F.ceil(F.col("kinds") / shard_runs).alias("shards")
        ),
        "several",
    )
    chosen = texts.join(several, F.col("anchor") == F.col("_anchor")).select(
        "anchor", F.when(F.col("shards") > 1, F.pmod(F.col("two"), F.col("shards"))).otherwise(F.lit(0)).alias("shard"),
        (F.col("shards") > 1).alias("split"), (F.col("n") > 1).alias("known"),
        F.col("run.doc_id").alias("_doc"), F.col("run._row").alias("_key"), "run.first", "run.size",
        F.xxhash64("anchor", "one", "two").alias("run"),
    )
    chosen = stored(chosen, "chosen")
    if is_empty(chosen):
        return equal
    shards = stored(_sharded(documents, chosen, window, kind, words), "windows")
    inside = shards.where("bucket is null").select("doc_id", "_row", "first", "end", "passage")
    split = shards.where("bucket is not null")
    found = equal.unionByName(inside)
    if is_empty(split):
        return found
    places = chosen.where("split").select(
        F.col("run").alias("_run"), F.col("_doc").alias("doc_id"), F.col("_key").alias("_row"), F.col("first").alias("_first"),
        of_passage.alias("passage"),
    )
    across = stored(_merged(split), "across").join(places, F.col("run") == F.col("_run")).select(
        "doc_id", "_row", (F.col("_first") + F.col("first")).alias("first"), (F.col("_first") + F.col("end")).alias("end"), "passage"
    )
    return found.unionByName(across)


#: Bytes that part words: ASCII white space.
_SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))


def _passages(raw: np.ndarray, borders: np.ndarray, words: int, window: int) -> tuple[np.ndarray, ...]:
    """First byte and end of every word of joined texts; which words begin a passage that is shorter
    than a window, and the text that each of these is in."""
    space = _SPACE[raw]
    word = ~space
    begins, stops = word.copy(), word.copy()
    begins[1:] &= space[:-1]
    stops[:-1] &= space[1:]
    inner = borders[(borders > 0) & (borders < len(raw))]
    begins[inner], stops[inner - 1] = word[inner], word[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first, end = starts[: max(len(starts) - words + 1, 0)], ends[words - 1 :]
    at = np.flatnonzero(end - first < window)
    owner = np.searchsorted(borders, first[at], "right") - 1
    whole = end[at] <= borders[owner + 1]  # passages never cross documents
    return starts, ends, at[whole], owner[whole]


def _range_hashes(
    raw: np.ndarray, first: np.ndarray, end: np.ndarray, longest: int, salts: tuple[int, ...], made: dict[int, RangeHash] | None = None
) -> list[np.ndarray]:
    """Hashes of ranges of at most ``longest`` bytes, which are sorted by first byte; a stretch after another."""
    if made:
        return [made[salt].of(first, end) for salt in salts]
    found = [np.empty(len(first), np.uint64) for _ in salts]
    for at in range(0, len(raw), STRETCH):
        a, b = np.searchsorted(first, (at, at + STRETCH)).tolist()
        if a < b:
            part = raw[at : at + STRETCH + longest]
            for hashes, salt in zip(found, salts, strict=True):
                hashes[a:b] = RangeHash(byte_values(salt)[part]).of(first[a:b] - at, end[a:b] - at)
    return found


def _short_passages(raw: np.ndarray, borders: np.ndarray, words: int, window: int) -> dict[str, np.ndarray]:
    starts, ends, at, owner = _passages(raw, borders, words, window)
    first, end = starts[at], ends[at + words - 1]
    one, two = _range_hashes(raw, first, end, window, (3, 4))
    return {"owner": owner, "first": first - borders[owner], "end": end - borders[owner], "one": one, "two": two}


def short_passages(texts: list[str], words: int, window: int) -> dict[str, np.ndarray]:
    """Every passage of so many words that is shorter than a window: text, first byte, end, fingerprints."""
    return _short_passages(*joined_bytes(texts), words, window)


def passage_runs(texts: list[str], words: int, window: int) -> dict[str, np.ndarray]:
    """Runs of neighbouring passages, each shorter than a window, that choose one anchor: of the strings
    of a few words in a passage that with the smallest hash. Text, first byte, bytes and hashes of each."""
    return _passage_runs(*joined_bytes(texts), words, window)


def _passage_runs(
    raw: np.ndarray, borders: np.ndarray, words: int, window: int, made: dict[int, RangeHash] | None = None
) -> dict[str, np.ndarray]:
    starts, ends, at, owner = _passages(raw, borders, words, window)
    if not len(at):
        return {}
    few = max(1, min(PASSAGE_ANCHOR, words // 2))
    first = starts[: len(starts) - few + 1]
    # Longer strings are in no short passage.
    (grams,) = _range_hashes(raw, first, np.minimum(ends[few - 1 :], first + window), window, (3,), made)
    width = words - few + 1
    chosen = np.concatenate(
        [a + sliding_argmin(grams[a:b], width) for a, b in stretches(len(grams), width, 1 << PLACE_BITS)]
    )[at]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1]) | (chosen[1:] != chosen[:-1])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(at)) - 1
    first, end, owner = starts[at[begin]], ends[at[last] + words - 1], owner[begin]
    one, two = _range_hashes(raw, first, end, 2 * window, (3, 4), made)
    return {
        "owner": owner, "first": first - borders[owner], "size": end - first, "anchor": grams[chosen[begin]], "one": one, "two": two
    }


def _met_passages(found: dict[str, np.ndarray]) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """Ranges (text, first byte, end) of passages that occur twice in these texts; one place of each
    different passage; and whether these occur twice."""
    order = np.lexsort((found["two"], found["one"]))
    one, two = found["one"][order], found["two"][order]
    new = np.ones(len(order), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    at = np.flatnonzero(new)
    many = np.diff(np.append(at, len(order)))
    again = np.empty(len(order), bool)
    again[order] = np.repeat(many > 1, many)
    owner, first, end = (found[x][again] for x in ("owner", "first", "end"))
    apart = np.ones(len(owner), bool)
    apart[1:] = (owner[1:] != owner[:-1]) | (first[1:] > end[:-1])
    begin = np.flatnonzero(apart)
    last = np.append(begin[1:], len(owner)) - 1 if len(begin) else begin
    return (owner[begin], first[begin], end[last]), order[at], many > 1


def find_passages(documents: DataFrame, words: int, window: int) -> DataFrame:
    """``doc_id, _row, first, end``: byte ranges that repeated passages of ``words`` words cover, of those
    that are shorter than ``window`` bytes. Longer ones are covered by repeated windows.

    A task settles those that it has twice, and sends one of each different passage.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch, "text", 1 << 18):
                part = batch.slice(a, b - a)
                found = short_passages(part.column("text").to_pylist(), words, window)
                if not len(found["owner"]):
                    continue
                ranges, sent, known = _met_passages(found)
                owner, first, end = (
                    np.concatenate([x, found[name][sent]]) for x, name in zip(ranges, ("owner", "first", "end"), strict=True)
                )
                none = np.arange(len(owner)) < len(ranges[0])
                pad = np.zeros(len(ranges[0]), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(owner)),
                        part.column("_row").take(pa.array(owner)),
                        pa.array(first, pa.int64()),
                        pa.array(end, pa.int64()),
                        *[pa.array(np.concatenate([pad, signed(found[x])[sent]]), mask=none) for x in ("one", "two")],
                        pa.array(np.concatenate([pad > 0, known])),
                    ],
                    ["doc_id", "_row", "first", "end", "one", "two", "known"],
                )

    rows = stored(
        documents.mapInArrow(lean(cut), f"doc_id {kind}, _row long, first long, end long, one long, two long, known boolean"), "passages"
    )
    sent = rows.where("one is not null")
    common = stored(
        sent.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select(F.col("one").alias("_one"), F.col("two").alias("_two")),
        "common-passages",
    )
    across = sent.where("not known").join(common, (F.col("one") == F.col("_one")) & (F.col("two") == F.col("_two")))
    names = ["doc_id", "_row", "first", "end"]
    return rows.where("one is null").select(*names).unionByName(across.select(*names))


def _run_texts(documents: DataFrame, chosen: DataFrame, kind: str) -> DataFrame:
    """Adds the text of each chosen run, from its document."""
    runs = chosen.groupBy("_doc", "_key").agg(
        F.collect_list(F.struct("anchor", "shard", "split", "known", "first", "size", "run")).alias("runs")  # of one document
    )
    wanted = KeyFilter(chosen, "_key", "run-keys").mark(documents, "_row").where("_passes")
    found = wanted.join(runs, (F.col("_row") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
    found = found.select("doc_id", "_row", "text", "runs")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, runs = batch.column("runs").offsets.to_pylist(), batch.column("runs").values
            fields = {x: runs.field(x) for x in ("anchor", "shard", "split", "known", "first", "run", "size")}
            for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                raw = batch.column("text")[k].as_py().encode("utf-8", "surrogatepass")
                own = {x: values.slice(a, b - a) for x, values in fields.items()}
                places = zip(own["first"].to_pylist(), own.pop("size").to_pylist(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array([k] * (b - a))),
                        batch.column("_row").take(pa.array([k] * (b - a))),
                        *own.values(),
                        pa.array([raw[first : first + size] for first, size in places], pa.binary()),
                    ],
                    ["doc_id", "_row", "anchor", "shard", "split", "known", "first", "run", "bytes"],
                )

    return found.mapInArrow(
        lean(cut),
        f"doc_id {kind}, _row long, anchor long, shard long, split boolean, known boolean, first long, run long, bytes binary",
    )


def _sharded(documents: DataFrame, chosen: DataFrame, window: int, kind: str, words: int | None) -> DataFrame:
    """Spans of windows or passages that occur twice in a shard; and, of anchors dealt over several shards,
    every different one once for the shard, packed by bucket of its fingerprint: fingerprints, run and
    place in the run, bytes, and whether it is settled."""
    rows = _run_texts(documents, chosen, kind)
    names = ["doc_id", "_row", "first", "end", "passage", "bucket", "packed"]
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    batch_type = _arrow_type(documents)

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _held(batches, bool(words)):
            out: list[tuple] = []
            kinds = [bool(words) and x & 1 == 1 for x in block["anchor"]]
            for passage in set(kinds):
                own = {name: [x for x, k in zip(values, kinds, strict=True) if k == passage] for name, values in block.items()}
                spans, packed = _solved_passages(own, words, window) if passage else _solved_windows(own, window)
                for k, first, end in spans:
                    begin = own["first"][k]
                    out.append((own["doc_id"][k], own["_row"][k], begin + first, begin + end, passage, None, None))
                bucket = (packed["one"] % np.uint64(parts)).astype(np.int64)
                order = np.lexsort((packed["two"], packed["one"], bucket))
                cut = np.searchsorted(bucket[order], np.arange(parts + 1))
                out += [
                    (*[None] * 5, k, packed[order[a:b]].tobytes())
                    for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if b > a
                ]
            types = [batch_type, *[pa.int64()] * 3, pa.bool_(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], t) for n, t in enumerate(types)], names)

    return rows.repartition(parts, "anchor", "shard").sortWithinPartitions("anchor", "shard").mapInArrow(
        lean(solve), f"doc_id {kind}, _row long, first long, end long, passage boolean, bucket long, packed binary"
    )


def _solved_windows(block: dict[str, list], window: int) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """Spans (run, first byte, end) of windows that occur twice in these runs, where that was not known;
    and every different window of a shard of several."""
    starts, again, number = repeated_windows(block["bytes"], window)
    text = np.frombuffer(b"".join(block["bytes"]), np.uint8)
    ends = np.append(starts[1:], len(text))
    split, known = np.array(block["split"], bool), np.array(block["known"], bool)
    spans = [(k, *span) for k in np.flatnonzero(~known).tolist() for span in _spans(again[starts[k] : ends[k]], window)]
    if not split.any():
        return spans, np.zeros(0, _PACKED)
    owner = np.repeat(np.arange(len(starts)), ends - starts)
    at = np.flatnonzero((number >= 0) & split[owner])
    at = at[np.unique(number[at], return_index=True)[1]]
    packed = np.zeros(len(at), _PACKED)
    for name, salt in (("one", 3), ("two", 4)):
        packed[name] = RangeHash(byte_values(salt)[text]).of(at, at + window)
    packed["run"] = np.array(block["run"], np.int64)[owner[at]]
    packed["first"], packed["size"], packed["settled"] = at - starts[owner[at]], window, again[at] | known[owner[at]]
    return spans, packed


def _solved_passages(block: dict[str, list], words: int, window: int) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """The same for runs of passages."""
    borders = np.zeros(len(block["bytes"]) + 1, np.int64)
    np.cumsum([len(x) for x in block["bytes"]], out=borders[1:])
    found = _short_passages(np.frombuffer(b"".join(block["bytes"]), np.uint8), borders, words, window)
    ranges, place, again = _met_passages(found)
    split, known = np.array(block["split"], bool), np.array(block["known"], bool)
    spans = [x for x in zip(*(r.tolist() for r in ranges), strict=True) if not known[x[0]]]
    owner, first, end = (found[x][place] for x in ("owner", "first", "end"))
    packed = np.zeros(len(place), _PACKED)
    packed["one"], packed["two"], packed["run"] = found["one"][place], found["two"][place], np.array(block["run"], np.int64)[owner]
    packed["first"], packed["size"], packed["settled"] = first, end - first, again | known[owner]
    return spans, packed[split[owner]]


_PACKED = np.dtype([("one", "<u8"), ("two", "<u8"), ("run", "<i8"), ("first", "<i4"), ("size", "<i4"), ("settled", "?")])


def _arrow_type(documents: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(documents.schema["doc_id"].dataType)


def _held(batches: Iterable[pa.RecordBatch], passages: bool) -> Iterator[dict[str, list]]:
    """Rows of whole shards, as many as one suffix array takes, a shard dealt over several alone; and
    no more bytes of runs of passages, which are in no suffix array."""
    held: dict[str, list] = {}
    sizes, last = [0, 0], None
    for batch in batches:
        columns = batch.to_pydict()
        for k, key in enumerate(zip(columns["anchor"], columns["shard"], columns["split"], strict=True)):
            if key != last and held and (max(sizes) >= SHARD_BYTES or key[2] or last[2]):
                yield held
                held, sizes = {}, [0, 0]
            if not held:
                held = {name: [] for name in columns}
            for name, values in columns.items():
                held[name].append(values[k])
            sizes[key[0] & passages] += len(columns["bytes"][k])
            last = key
    if held:
        yield held


def _merged(split: DataFrame) -> DataFrame:
    """``run, first, last, end``: ranges of windows of a run that another shard has too, and theirs not.

    A packed part holds fingerprints of one shard in order, each once. Parts of a bucket are merged two
    by two: binary search finds the fingerprints of the one in the other.
    """

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if held and bucket not in held:
                    yield _found(held.popitem()[1])
                held.setdefault(bucket, []).append(packed)
        if held:
            yield _found(held.popitem()[1])

    parts = int(split.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return split.select("bucket", "packed").repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(
        lean(search), "run long, first long, last long, end long"
    )


def _meet(low: np.ndarray, high: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """Looks the sorted fingerprints of one part up in those of another by binary search.

    Rows that both have, and that aren't settled, are added to ``found``. The two parts as one, each
    fingerprint once.
    """
    if len(high) > len(low):
        low, high = high, low
    at = np.searchsorted(low["one"], high["one"], "left")
    new = np.ones(len(high), bool)
    open_ = np.arange(len(high))
    while len(open_):  # more than once only where a first half is equal and the second is not
        open_ = open_[at[open_] < len(low)]
        open_ = open_[low["one"][at[open_]] == high["one"][open_]]
        same = low["two"][at[open_]] == high["two"][open_]
        new[open_[same]] = False
        open_ = open_[~same]
        at[open_] += 1
    theirs, ours = high[~new], at[~new]
    found += [theirs[~theirs["settled"]], low[ours][~low["settled"][ours]]]
    low["settled"][ours] = True
    both = np.concatenate([low, high[new]])
    return both[np.argsort(both["one"], kind="stable")]


def _found(packed: list[bytes]) -> pa.RecordBatch:
    """Ranges of windows that several parts have, and their ends; parts are sorted, and merged two by two."""
    parts = [np.frombuffer(part, _PACKED).copy() for part in packed]
    found = [np.zeros(0, _PACKED)]
    while len(parts) > 1:
        pairs = [(parts[k], parts[k + 1]) for k in range(0, len(parts) - 1, 2)]
        parts = [_meet(*pair, found) for pair in pairs] + parts[2 * len(pairs) :]
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows["first"], rows["run"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["run"][1:] != rows["run"][:-1]) | (rows["first"][1:] != rows["first"][:-1] + 1)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(rows)) - 1 if len(at) else at
    first = rows["first"].astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (rows["run"][at], first[at], first[last], (first + rows["size"])[last])], ["run", "first", "last", "end"]
    )


def deduplicate(
    table: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_runs: int = SHARD_RUNS, words: int | None = None
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_bytes, text`` for each row of ``table(doc_id, text)``.

    Texts are judged as UTF-8 bytes: every byte that a repeated window covers goes, the first
    occurrence too; ``text`` is what is left, without the rest of a character that a range cuts.
    With ``words``, bytes of repeated passages of so many words (parted by ASCII white space) that are
    shorter than a window go from ``text`` too, ``n_passage_bytes`` beside ``n_removed``; the other columns
    stay as they are without. Null text is empty; texts shorter than a window lose nothing to windows. Rows equal in id
    and text are two documents that repeat each other; rows that share an id are judged each for
    itself. Null ids are kept. Other columns are ignored; an empty table gives no rows. Strings are
    compared by 128 bits where they are not compared byte by byte.
    """
    documents = documents_of(table)
    spans = find_spans(documents, window, anchor, shard_runs, words)
    return _removed(documents, spans).withColumnRenamed("kept", "text")


def without_repeats(
    table: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_runs: int = SHARD_RUNS, words: int | None = None
) -> DataFrame:
    """The rows of ``table`` with all columns, ``text`` without its repeated bytes.

    With ``words``, a repeated passage of so many words (parted by ASCII white space) goes too if it
    is shorter than a window.
    What is left of a character that a removed range cuts goes too. ``n_chars`` is counted anew if
    it is there. Null text stays null.
    """
    documents = documents_of(table, carry=True)
    plain = documents.select("doc_id", "text", "_row")
    spans = find_spans(plain, window, anchor, shard_runs)
    if words:
        spans = spans.unionByName(find_passages(plain, words, window).withColumn("passage", F.lit(True)))
    found = _removed(documents, spans)
    there = ~F.col("_carried._no_text")
    return restored(
        found, table.columns, text=F.when(there, F.col("kept")), n_chars=F.when(there, F.length("kept").cast("long"))
    )


def _removed(documents: DataFrame, spans: DataFrame) -> DataFrame:
    by_document = stored(
        spans.groupBy("doc_id", "_row").agg(F.collect_set(F.struct("first", "end", "passage")).alias("spans")), "spans"
    ).select(F.col("doc_id").alias("_doc"), F.col("_row").alias("_key"), "spans")
    marked = KeyFilter(by_document, "_key", "span-keys").mark(documents, "_row")
    joined = marked.where("_passes").join(
        by_document, (F.col("_row") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left"
    ).drop("_doc", "_key").unionByName(
        marked.where("not _passes").withColumn("spans", F.lit(None).cast(by_document.schema["spans"].dataType))
    ).drop("_row", "_passes")
    passing = joined.drop("text", "spans").schema
    numbers, strings = T.LongType(), T.StringType()
    added = {"n_bytes": numbers, "n_removed": numbers, "n_spans": numbers, "kept_sha256": strings, "n_passage_bytes": numbers, "kept": strings}
    schema = T.StructType([*passing, *[T.StructField(x, kind) for x, kind in added.items()]])

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, stop in slices(whole, "text", 1 << 20):
                batch = whole.slice(start, stop - start)
                rows, spans = [], batch.column("spans").fill_null([])
                bounds = spans.offsets.to_pylist()
                fields = [spans.values.field(x).to_numpy(zero_copy_only=False) for x in ("first", "end", "passage")]
                for text, a, b in zip(batch.column("text"), bounds[:-1], bounds[1:], strict=True):
                    rows.append(_kept(text.as_py().encode("utf-8", "surrogatepass"), *(x[a:b] for x in fields)))
                kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.string()]
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*[batch.column(x) for x in passing.names], *columns], schema.names)

    return joined.mapInArrow(lean(keep), schema)


def _kept(raw: bytes, first: np.ndarray, end: np.ndarray, passage: np.ndarray) -> tuple[int, int, int, str, int, str]:
    """Bytes, removed bytes, removed ranges and digest of what windows leave; bytes that passages take
    beside, and the text that is left."""
    left, removed, count = _without(raw, first[~passage], end[~passage])
    digest, more = hashlib.sha256(left).hexdigest(), 0
    if passage.any():
        left, both, _ = _without(raw, first, end)
        more = both - removed
    return len(raw), removed, count, digest, more, left.decode("utf-8", "ignore")


def _without(raw: bytes, first: np.ndarray, end: np.ndarray) -> tuple[bytes, int, int]:
    """What is left without these ranges, removed bytes, and removed ranges."""
    if not len(first):
        return raw, 0, 0
    order = np.argsort(first)
    first, reach = first[order], np.maximum.accumulate(end[order])
    new = np.append(True, first[1:] > reach[:-1])
    begin, stop = first[new], reach[np.append(new[1:], True)]
    kept = [raw[a:b] for a, b in zip([0, *stop.tolist()], [*begin.tolist(), len(raw)], strict=True)]
    return b"".join(kept), int((stop - begin).sum()), len(begin)
