"""Packing, repeated strings, similarity groups, decontamination and languages against plain Python."""

import hashlib
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartulary.llm import decontamination, jaccard, language, packing, queries, suffixes
from cartulary.llm.common import documents_of
from cartulary.llm.components import connected_components

TOKENIZER = str(public_tokenizers.path("word_bpe_49k.json"))


def plain(table):
    return [(r["doc_id"], r["text"] or "") for r in table.select("doc_id", "text").collect()]


# Packing


def test_ids_are_the_tokenizers_own():
    tokenizer, whole = packing.WordCachedTokenizer(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    texts = [
        "", "'", "It's I'LL we'Re they've 'd'm x'", "''s '", "İstanbul it's", "naïve café 12¼² x\x1cy\x85z\xa0w", "<|endoftext|> a",
        "日本語 text’s “q”", "é x", "é x", "'re're 'v", "É'Tat l'LL", "'ll'l", "a'\nb", "ǅ ß ŉ ʼn",
    ]
    assert [x.tolist() for x in tokenizer.ids(texts)] == [whole.encode(x, add_special_tokens=False).ids for x in texts]


def test_plan_fills_sequences():
    draw = np.random.default_rng(0)
    for _ in range(50):
        capacity = int(draw.integers(1, 60))
        counts = {int(k): int(draw.integers(1, 30)) for k in draw.integers(1, capacity + 1, 8)}
        held, taken = Counter(), Counter()
        for length, first, end, sequence, offset, each in packing.plan(counts, capacity):
            for rank in range(first, end):
                place = sequence + (rank - first) // each, offset + (rank - first) % each * length
                taken[length] += 1
                held[place[0]] = max(held[place[0]], place[1] + length)
        assert taken == counts
        assert max(held.values()) <= capacity
        assert sum(held.values()) == sum(k * n for k, n in counts.items())  # without gaps
        rooms = []  # best fit, one piece after another
        for length in sorted(taken.elements(), reverse=True):
            best = min((r for r in rooms if r >= length), default=None)
            rooms.append((capacity if best is None else rooms.pop(rooms.index(best))) - length)
        assert len(held) == len(rooms)


def test_packing_of_awkward_rows(spark, awkward, nothing):
    found = packing.pack(spark, awkward, TOKENIZER, capacity=128, with_ids=True).collect()
    whole, expected = Tokenizer.from_file(TOKENIZER), Counter()
    for key, text in plain(awkward):
        ids = whole.encode(text, add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), 128)):
            raw = struct.pack(f"<{len(ids[at:at + 128])}I", *ids[at : at + 128])
            expected[key, piece, at, len(raw) // 4, zlib.crc32(raw), raw] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in found) == expected
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for rows in places.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 128
    assert packing.pack(spark, nothing, TOKENIZER).count() == 0


# Repeated strings


def removed(texts, window):
    raw = [t.encode() for t in texts]
    seen = Counter(x[k : k + window] for x in raw for k in range(len(x) - window + 1))
    found = []
    for x in raw:
        gone = np.zeros(len(x) + 1, bool)
        for k in range(len(x) - window + 1):
            if seen[x[k : k + window]] > 1:
                gone[k : k + window] = True
        kept = bytes(b for b, g in zip(x, gone, strict=False) if not g)
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0]) if len(x) else 0
        found.append((len(x), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return found


def test_repeated_windows_are_exact():
    draw = np.random.default_rng(1)
    for _ in range(150):
        window = int(draw.integers(3, 20))
        texts = [bytes(draw.choice([0, 97, 98], int(draw.integers(1, 60))).astype(np.uint8)) for _ in range(int(draw.integers(1, 8)))]
        texts += [texts[0], texts[-1][3:] + b"zz"]
        starts, again, number = suffixes.repeated_windows(texts, window)
        places = {}
        for k, x in enumerate(texts):
            for i in range(len(x) - window + 1):
                places.setdefault(x[i : i + window], []).append(int(starts[k]) + i)
        expected = np.zeros(len(again), bool)
        for at in places.values():
            expected[at] = len(at) > 1
            assert len(set(number[at])) == 1
        assert (expected == again).all()


def anchors_of(texts, window, anchor, **sizes):
    """The anchor of every window, by text and first byte."""
    found = {}
    for runs in suffixes.runs_of(texts, window, anchor, **sizes):
        for owner, first, many, key in zip(*(runs[x].tolist() for x in ("owner", "first", "many", "anchor")), strict=True):
            for place in range(first, first + many):
                assert (owner, place) not in found  # each window is in one run
                found[owner, place] = key
    return found


def test_sorted_parts_meet_by_binary_search():
    draw = np.random.default_rng(17)
    for _ in range(60):
        parts, held = [], Counter()
        for part in range(int(draw.integers(1, 8))):
            rows = np.zeros(int(draw.integers(0, 30)), suffixes._PACKED)
            # Few different first halves: equal ones with other second halves.
            rows["one"], rows["two"] = draw.integers(0, 12, len(rows)), draw.integers(0, 3, len(rows))
            rows = np.unique(rows[["one", "two"]]).astype([("one", "<u8"), ("two", "<u8")])
            full = np.zeros(len(rows), suffixes._PACKED)
            full["one"], full["two"], full["run"], full["first"] = rows["one"], rows["two"], part, 2 * np.arange(len(rows))
            full["settled"] = draw.random(len(rows)) < 0.2
            held.update(map(tuple, rows.tolist()))
            parts.append(full)
        found = suffixes._found([x.tobytes() for x in parts]).to_pylist()
        expected = sorted((r["run"], r["first"]) for x in parts for r in x if held[r["one"].item(), r["two"].item()] > 1 and not r["settled"])
        assert sorted((r["run"], r["first"]) for r in found) == expected and all(r["first"] == r["last"] for r in found)


def test_sorted_suffixes_and_common_prefixes():
    """Against sorting the suffixes themselves, with numbers that hold two ranks and a place, and without."""
    draw = np.random.default_rng(4)
    for k in range(60):
        texts = [bytes(draw.integers(97, 98 + k % 3, int(draw.integers(1, 60))).astype(np.uint8)) for _ in range(1 + k % 8)]
        text, sizes = np.frombuffer(b"".join(texts), np.uint8), np.array([len(x) for x in texts])
        ends = np.cumsum(sizes)
        limit, raw = np.repeat(ends, sizes), text.tobytes()
        expected = sorted(range(len(raw)), key=lambda i: (raw[i : limit[i]], i))  # noqa: B023
        order = suffixes.suffix_array(text, limit, int(sizes.max()), pack=k % 2 == 0)
        assert order.tolist() == expected
        shared = suffixes.common_prefixes(text, order, ends - sizes, ends, 9)
        for i, j in zip(expected[1:], expected, strict=False):
            ours, other = raw[i : min(limit[i], i + 9)], raw[j : min(limit[j], j + 9)]
            assert shared[i] == next((n for n, (x, y) in enumerate(zip(ours, other, strict=False)) if x != y), min(len(ours), len(other)))


@pytest.mark.parametrize("most", [20, 33, 64, 1000])
def test_stretches_change_no_anchor(most):
    draw = np.random.default_rng(4)
    texts = ["".join(draw.choice(list("abc é"), int(draw.integers(0, 300)))) for _ in range(12)]
    found = anchors_of(texts, 20, 6, most=most)
    assert found == anchors_of(texts, 20, 6)
    assert found.keys() == {(k, i) for k, t in enumerate(texts) for i in range(len(t.encode()) - 19)}


def test_places_have_room():
    keys = np.random.default_rng(6).integers(0, 2**63, 256).astype(np.uint64)
    expected = [k + int((keys[k : k + 9] >> np.uint64(8)).argmin()) for k in range(248)]
    assert suffixes.sliding_argmin(keys, 9, place_bits=8).tolist() == expected
    with pytest.raises(ValueError, match="places of 8 bits"):
        suffixes.sliding_argmin(np.append(keys, keys[:1]), 9, place_bits=8)


def test_repeats_far_behind_in_a_long_text(spark):
    draw = np.random.default_rng(8)
    passage = " ".join(f"passage{k}" for k in range(60))
    long = draw.integers(97, 123, (1 << 24) + 50_000).astype(np.uint8).tobytes().decode() + "  " + passage
    other = "other begin " + passage + " different"
    table = spark.createDataFrame([(1, long), (2, other)], "doc_id long, text string")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.deduplicate(table).collect()}
    for key, text in ((1, long), (2, other)):
        # The blank before the passage repeats too.
        kept = text.replace(" " + passage, "")
        assert found[key] == (len(text), len(passage) + 1, 1, hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("shard_runs", [1, 1024])
def test_deduplication_of_awkward_rows(awkward, nothing, shard_runs):
    window = 100
    found = suffixes.deduplicate(awkward, window, 16, shard_runs).collect()
    for row in found:
        if row.text.isascii():
            assert hashlib.sha256(row.text.encode()).hexdigest() == row.kept_sha256
    texts = plain(awkward)
    expected = Counter((key, *x) for (key, _), x in zip(texts, removed([t for _, t in texts], window), strict=True))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == expected
    assert suffixes.deduplicate(nothing).count() == 0


def test_text_without_repeats_keeps_columns(awkward):
    found = suffixes.without_repeats(awkward, 100, 16)
    assert found.columns == awkward.columns
    texts = {r.doc_id: r.text for r in found.collect() if r.doc_id}
    assert texts[1] is None
    assert texts[2] == ""
    assert texts[16] == ""
    assert texts[11] == "one-word"


def cut_passages(texts, words, window):
    """Texts without repeated passages of so many words that are shorter than a window."""
    raw = [t.encode() for t in texts]
    places = {}
    for k, x in enumerate(raw):
        found = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", x)]
        for (first, _), (_, end) in zip(found, found[words - 1 :], strict=False):
            if end - first < window:
                places.setdefault(x[first:end], []).append((k, first, end))
    keep = [np.ones(len(x), bool) for x in raw]
    for at in places.values():
        for k, first, end in at if len(at) > 1 else ():
            keep[k][first:end] = False
    return [bytes(b for b, stays in zip(x, own, strict=True) if stays).decode("utf-8", "ignore") for x, own in zip(raw, keep, strict=True)]


def test_passages_of_short_words(spark, monkeypatch):
    draw = np.random.default_rng(14)
    short = ["".join(draw.choice(list("abcdefgh"), int(draw.integers(1, 4)))) for _ in range(400)]
    passage = " ".join(short[:51])
    assert len(passage) < 240
    texts = [f"{' '.join(draw.choice(short, 30))} {passage} {' '.join(draw.choice(short, 30))}" for _ in range(4)]
    texts += ["lone " + " ".join(short[200:260]), " ".join(short[:50]), "a " * 700, "", " \n ", "é\tü " * 40, passage.replace(" ", "\n")]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wide = 10_000  # so that only passages go
    for parts in (1, 11):
        found = suffixes.without_repeats(table.repartition(parts), wide, 48, words=51)
        expected = cut_passages(texts, 51, wide)
        assert passage not in " ".join(expected)
        assert {r.doc_id: r.text for r in found.collect()} == dict(enumerate(expected))
    whole = suffixes.short_passages(texts, 51, wide)
    monkeypatch.setattr(suffixes, "STRETCH", 64)
    again = suffixes.short_passages(texts, 51, wide)
    assert all((whole[x] == again[x]).all() for x in whole)


def without_both(texts, words, window):
    """Bytes that only passages take, and the text without repeated windows and repeated short passages."""
    raw = [t.encode() for t in texts]
    seen = Counter(x[k : k + window] for x in raw for k in range(len(x) - window + 1))
    spans = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", x)] for x in raw]
    passages = [[(a, b) for (a, _), (_, b) in zip(s, s[words - 1 :], strict=False) if b - a < window] for s in spans]
    met = Counter(x[a:b] for x, own in zip(raw, passages, strict=True) for a, b in own)
    result = []
    for x, own in zip(raw, passages, strict=True):
        windows, both = np.zeros(len(x), bool), np.zeros(len(x), bool)
        for k in range(len(x) - window + 1):
            if seen[x[k : k + window]] > 1:
                windows[k : k + window] = True
        for a, b in own:
            both[a:b] |= met[x[a:b]] > 1
        both |= windows
        result.append((int((both & ~windows).sum()), bytes(b for b, gone in zip(x, both, strict=True) if not gone).decode("utf-8", "ignore")))
    return result


@pytest.mark.parametrize("shard_runs", [1, 2, 1024])
def test_short_passages_go_from_the_text_only(spark, shard_runs):
    draw = np.random.default_rng(21)
    vocabulary = ["".join(draw.choice(list("abcdeé"), int(draw.integers(1, 9)))) for _ in range(300)]
    some = [[*draw.choice(vocabulary, int(draw.integers(6, 14)))] for _ in range(8)]  # passages around 6 words
    texts = []
    for k in range(60):
        parts = [word for _ in range(int(draw.integers(0, 4))) for word in [*draw.choice(vocabulary, 9), *some[int(draw.integers(8))]]]
        texts.append(str(draw.choice(["", " "])) + str(draw.choice([" ", "\n"], p=[0.9, 0.1])).join(map(str, parts)))
    texts += ["", " ", "a " * 80, "a\tb " * 30, texts[1], texts[2] + " end", "x" * 300 + " y z " + "x" * 300, "one " + " ".join(some[0])]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in suffixes.deduplicate(table, 60, 12, shard_runs, words=6).collect()}
    expected, both = removed(texts, 60), without_both(texts, 6, 60)
    assert sum(n for n, _ in both) > 500
    for key, r in found.items():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[key]
        assert (r.n_passage_bytes, r.text) == both[key]
    assert len(found) == len(texts)


def test_passages_of_over_fifty_words_go_from_the_querys_text(spark, tmp_path):
    draw = np.random.default_rng(22)
    word = lambda: "".join(draw.choice(list("abcdefghij"), int(draw.integers(2, 9))))
    passage = " ".join(word() for _ in range(51))
    assert len(passage) < 400
    texts = [" ".join([*(word() for _ in range(70)), passage, *(word() for _ in range(70))]) for _ in range(3)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.op4_suffixes(spark, str(tmp_path)).collect():
        text = texts[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(text), 0, 0)
        assert r.kept_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.text == text.replace(passage, "") and r.n_passage_bytes == len(passage)


def test_runs_hold_every_short_passage(monkeypatch):
    draw = np.random.default_rng(23)
    texts = [" ".join("".join(draw.choice(list("abé"), int(draw.integers(1, 12)))) for _ in range(int(draw.integers(0, 90)))) for _ in range(20)]
    texts.append("a " * 70)
    runs, single = suffixes.passage_runs(texts, 9, 50), suffixes.short_passages(texts, 9, 50)
    raw = [t.encode() for t in texts]
    covered = Counter()
    for owner, first, size in zip(*(runs[x].tolist() for x in ("owner", "first", "size")), strict=True):
        own = suffixes.short_passages([raw[owner][first : first + size].decode()], 9, 50)
        covered.update((owner, first + a, first + b) for a, b in zip(own["first"].tolist(), own["end"].tolist(), strict=True))
    assert covered == Counter(zip(*(single[x].tolist() for x in ("owner", "first", "end")), strict=True))
    monkeypatch.setattr(suffixes, "STRETCH", 64)
    again = suffixes.passage_runs(texts, 9, 50)
    assert all((runs[x] == again[x]).all() for x in runs)


# Similarity


def groups(texts, words, per_cent):
    sets = []
    for _, text in texts:
        plain_case = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        found = re.findall(r"[^\x20\x09-\x0D]+", plain_case)
        sets.append(set(zip(*[found[k:] for k in range(words)], strict=False)) if len(found) >= words else {tuple(found)} if found else set())
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= per_cent * len(a | b):
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    result = Counter()
    for i, (key, _) in enumerate(texts):
        ids = [texts[j][0] for j in range(len(sets)) if root[j] == root[i] and texts[j][0] is not None]
        result[key, len(sets[i]), min(ids, default=None)] += 1
    return result


def near_copies():
    """A family of texts that differ in a few words each, around the threshold, and others."""
    draw = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for family in range(6):
        for copy in range(12):
            words = [f"{family}-{w}" if family % 2 else w for w in base[: 20 + 20 * family]]
            for place in draw.integers(0, len(words), copy % 5):
                words[place] = f"edit{family}{copy}{place}"
            texts.append((len(texts), " ".join(words)))
    return texts


@pytest.mark.parametrize(
    ("block", "per_cent", "candidates"),
    [(4_000_000, 90, jaccard.candidate_edges), (900, 90, jaccard.candidate_edges), (4_000_000, 90, jaccard.prefix_edges), (900, 80, jaccard.prefix_edges)],
)
def test_links_lose_nothing(spark, block, per_cent, candidates):
    texts = near_copies()
    table = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = jaccard.links(spark, table, per_cent=per_cent, block_ngrams=block, candidates=candidates).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == groups(texts, 3, per_cent)


def test_rarest_ngrams_meet_and_common_passages_do_not(spark):
    draw = np.random.default_rng(19)
    passage = " ".join(f"shared{k}" for k in range(40))
    own = [" ".join(draw.choice(9000, 60).astype(str)) for _ in range(40)]
    texts = [f"{text} {passage}" for text in own] + [f"{text} {passage} end" for text in own[:15]]
    documents = documents_of(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(2))
    names = {r["class"]: r.doc_id for r in jaccard.classes_of(documents).collect()}
    edges = {frozenset((names[r.a], names[r.b])) for r in jaccard.prefix_edges(documents, 3, 80, 3).collect()}
    assert edges == {frozenset((k, 40 + k)) for k in range(15)}


def test_first_columns_rule_out_most_and_lose_no_partner(spark):
    draw = np.random.default_rng(13)
    texts = [" ".join(draw.choice(5000, 150).astype(str)) for _ in range(60)]
    texts += [text.rsplit(" ", 4)[0] for text in texts[:20]]  # linked with the first 20
    documents = documents_of(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"))
    rows = {r["class"]: r for r in jaccard.classes_of(documents).collect()}
    shared = {r["class"]: r.shared for r in jaccard.shared_counts(documents, 3, 90, 5, 3).collect()}
    able = {r.doc_id for c, r in rows.items() if (r.looked - shared.get(c, 0)) * 100 <= r.n_shingles * 10}
    assert able == {*range(20), *range(60, 80)}
    assert sum(r.looked for r in rows.values()) < 0.3 * sum(r.n_shingles for r in rows.values())


@pytest.mark.parametrize("stretch", [1, 7, 5000])
def test_long_texts_are_hashed_in_stretches(stretch):
    long = " ".join(f"word{k * 7919 % 10007} filler{k % 13}" for k in range(3000))
    texts = ["", "one two", long, " \t", "x" * 9000 + " y z x y z", "Ünï cödé " * 40, long[:333]]
    for ours, whole in zip(jaccard.shingle_sets(texts, 3, stretch), jaccard.shingle_sets(texts), strict=True):
        assert (ours == whole).all()


def test_links_of_awkward_rows(spark, awkward, nothing):
    found = jaccard.links(spark, awkward).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == groups(plain(awkward), 3, 90)
    assert jaccard.links(spark, nothing).count() == 0


def test_one_of_each_group_stays(spark, awkward):
    kept = jaccard.keep_one(spark, awkward)
    assert kept.columns == awkward.columns
    found = Counter((r.doc_id, r.text) for r in kept.select("doc_id", "text").collect())
    keys = Counter(key for key, _ in found.elements())
    assert keys[8] == keys[14] == 1 and keys[9] == keys[16] == keys[5] == keys[7] == keys[15] == 0
    assert keys[1] == keys[2] == keys[3] == 1 and keys[4] == 2 and keys[None] == 2


def test_sets_with_an_equal_part_meet():
    """Any two sets over the threshold share a part, however their differences fall."""
    draw = np.random.default_rng(5)
    parts = jaccard.Parts(90)
    for _ in range(300):
        size = int(draw.integers(1, 80))
        a = np.unique(draw.integers(0, 2**63, size).astype(np.uint64))
        drop = int(draw.integers(0, size // 10 + 1))
        add = draw.integers(0, 2**63, int(draw.integers(0, size // 10 + 1))).astype(np.uint64)
        b = np.unique(np.concatenate([a[drop:], add]))
        shared, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 100 * shared >= 90 * union and shared < union:
            assert set(parts.of(a).tolist()) & set(parts.of(b).tolist())


def test_ngrams_taken_for_one_all_count():
    def sent(*pairs):
        return np.array([gram << 32 | owner for gram, owner in pairs], np.uint64)

    # Class 0 has two n-grams whose bits are 5, as class 1 has; class 2 shares nothing; class 0 is sent twice.
    first = [(5, 0), (7, 0), (5, 0)]
    found = jaccard._shared([sent(*first, (9, 2)), sent((5, 1), (5, 1), (7, 1)), sent(*first)], 3)
    assert found.tolist() == [3, 3, 0]


def test_very_many_classes(spark):
    """More classes in a block than a task packs at once."""
    table = spark.range(70_000).selectExpr("id AS doc_id", "concat('a', id div 2, ' b', id div 2, ' c', id div 2, ' d', id) AS text")
    found = jaccard.shared_counts(documents_of(table.coalesce(1)), 3, 50, 1, 2)  # all columns
    assert found.count() == 70_000 and found.where("shared < 1").count() == 0
    assert found.where("shared > 1").count() < 20  # 32 bits tell n-grams of a block apart


def test_components(spark):
    draw = np.random.default_rng(7)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 400, (260, 2)) if a != b] + [(1000 + k, 1001 + k) for k in range(30)]
    root = {x: x for e in edges for x in e}
    for _ in range(60):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == root and len(found) == len(root)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# Decontamination


def contained(documents, items):
    def shingles(text):
        words = re.findall(r"[^\W_]+", text.lower())
        return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    found = Counter()
    for key, text in documents:
        own = shingles(text)
        for item, wanted in {(i, t) for i, t in items}:
            needed = shingles(wanted or "")
            if needed and 100 * len(own & needed) >= 80 * len(needed):
                found[key, item, len(needed), len(own & needed)] += 1
    return found


def test_contamination(spark, awkward, nothing):
    changed = PASSAGE_WORDS[:30] + ["swapped"] + PASSAGE_WORDS[31:]
    items = [
        (1, " ".join(PASSAGE_WORDS)), (1, " ".join(PASSAGE_WORDS)), (2, " ".join(changed)), (3, None), (4, ""), (5, "ONE, two!"), (None, " ".join(PASSAGE_WORDS[:7])),
        (6, " ".join(PASSAGE_WORDS[:20] + ["x", "y", "z"] * 4)),
    ]
    benchmark = spark.createDataFrame([(i, t, "n") for i, t in items], "item_id long, text string, doc_id string")
    found = decontamination.contaminated(awkward, benchmark).collect()
    assert Counter((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in found) == contained(plain(awkward), items)
    assert decontamination.contaminated(nothing, benchmark).count() == 0
    assert decontamination.contaminated(awkward, benchmark.limit(0)).count() == 0
    clean = decontamination.without_contaminated(awkward, benchmark)
    assert clean.columns == awkward.columns
    dirty = {key for key, *_ in contained(plain(awkward), items)}
    assert {8, 9, 16} <= dirty
    assert clean.count() == sum(key not in dirty for key, _ in plain(awkward)) + 1  # 4 has another text too


PASSAGE_WORDS = [f"passage{k}" for k in range(60)]


def test_contamination_runs_without_python(spark, awkward):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    plan = decontamination.contaminated(awkward, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Languages


@pytest.fixture(scope="module")
def two_languages(spark):
    draw = np.random.default_rng(11)
    words = {"xx": ["alba", "morin", "teso", "valu", "endi"], "yy": ["grüth", "schpek", "zwonk", "thräd", "krumf"]}
    rows = []
    for k in range(240):
        lang = "xx" if k % 3 else "yy"
        rows.append((k, " ".join(draw.choice(words[lang], int(draw.integers(3, 300)))), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_held_out_documents(two_languages):
    found = language.identify(two_languages).collect()
    truth = {r.doc_id: r.lang for r in two_languages.collect()}
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {k for k in truth if zlib.crc32(str(k).encode()) % 4 == 2}
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_every_language_is_learned(spark):
    draw = np.random.default_rng(12)
    syllables = [a + b for a in "bcdfghjklmnprstvwz" for b in "aeiou"]
    rows = []
    for k in range(70):
        own = draw.choice(syllables, 14, replace=False)
        words = ["".join(draw.choice(own, int(draw.integers(1, 4)))) for _ in range(120)]
        rows += [(f"lang{k}", " ".join(draw.choice(words, 60))) for _ in range(16 if k else 400)]
    table = spark.createDataFrame([(n, text, lang) for n, (lang, text) in enumerate(rows)], "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in language.identify(table).collect()}
    assert len(set(found.values())) == 70
    assert sum(found[n] == lang for n, (lang, _) in enumerate(rows)) > 0.97 * len(rows)


def test_windows_by_blocks(monkeypatch):
    network = language.ByteNetwork(["x", "y", "z"])
    network.start(0)
    raw = [b"some words " * k for k in (1, 300, 2, 90)]
    whole = language.probabilities(network, network.tables(), raw)
    monkeypatch.setattr(language, "_CELLS", 12)
    assert np.allclose(language.probabilities(network, network.tables(), raw), whole)


def test_languages_of_awkward_rows(awkward, nothing):
    found = language.identify(awkward)
    rows = Counter((r.doc_id, r.lang_pred) for r in found.collect())
    assert rows[1, "und"] == rows[2, "und"] == rows[3, "und"] == rows[12, "und"] == 1
    assert rows[6, "en"] == 1  # one language is known: it is always predicted
    assert sum(rows.values()) == awkward.count()
    assert language.identify(nothing).count() == 0
    assert language.keep_known(awkward).columns == awkward.columns


def test_slopes_are_right():
    """The network's slopes against differences of its loss."""
    network = language.ByteNetwork(["a", "b", "c"], filters=3, dimensions=4)
    network.start(1)
    draw = np.random.default_rng(2)
    symbols = draw.integers(0, 64, (4, 40)).astype(np.uint8)
    answers = np.array([0, 1, 2, 1])

    def loss():
        kept = []
        vectors = network.weights["e"][symbols]
        for w in network.widths:
            view = np.concatenate([vectors[:, k : 40 - 8 + k] for k in range(w)], 2)
            kept.append(np.maximum((view @ network.weights[f"f{w}"] + network.weights[f"b{w}"]).max(1), 0))
        chance = language._softmax(np.concatenate(kept, 1) @ network.weights["o"] + network.weights["c"])
        return -np.log(chance[np.arange(4), answers]).mean()

    slopes = network._slope(symbols, answers)
    for name, value in network.weights.items():
        for at in draw.integers(0, value.size, 5):
            place = np.unravel_index(at, value.shape)
            value[place] += 1e-5
            up = loss()
            value[place] -= 2e-5
            down = loss()
            value[place] += 1e-5
            assert abs((up - down) / 2e-5 - slopes[name][place]) < 1e-4, name
