"""Token counts that follow edits without encoding a document again.

A document's pre-tokens are the leaves' content of a segment tree that holds characters and tokens
of every subtree. An edit encodes only pre-tokens that it touches, those before that could see it,
and those after until the old borders fit again; then the sums on the way to the root change.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import documents_of, slices

#: Pre-tokens in a leaf when a tree is built.
LEAF = 32
#: How far behind its end the pattern looks, in characters, to end a pre-token.
LOOK_AHEAD = 2
_CACHED = 1_000_000
_COUNTERS: dict[tuple[str, str], Counter] = {}


class Counter:
    """Tokens of pre-tokens, by a byte-pair vocabulary in rank form and its pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    @classmethod
    def of(cls, path: str, pattern: str) -> Counter:
        """The worker's own, kept from task to task."""
        if (path, pattern) not in _COUNTERS:
            _COUNTERS[path, pattern] = cls(path, pattern)
        return _COUNTERS[path, pattern]

    def counts(self, pretokens: list[str]) -> list[int]:
        known = self.known
        found = [known.get(x, 0) for x in pretokens]
        for k, many in enumerate(found):
            if not many:
                x = pretokens[k]
                if x not in known:
                    if len(known) >= _CACHED:
                        known.clear()
                    raw = x.encode("utf-8", "surrogatepass")
                    known[x] = 1 if raw in self.ranks else len(self.encoding.encode_ordinary(x))
                found[k] = known[x]
        return found


class CountTree:
    """A text's token count under edits."""

    def __init__(self, text: str, counter: Counter) -> None:
        self.counter, self.encoded = counter, 0
        pretokens = counter.pattern.findall(text)
        tokens = counter.counts(pretokens)
        starts = range(0, max(1, len(pretokens)), LEAF)
        self.leaves: list[tuple[list[str], list[int]]] = [(pretokens[k : k + LEAF], tokens[k : k + LEAF]) for k in starts]
        self.base = 1 << (len(self.leaves) - 1).bit_length()
        sums = np.zeros((2, 2 * self.base), np.int64)
        if pretokens:
            at = np.arange(0, len(pretokens), LEAF)
            sums[0, self.base : self.base + len(at)] = np.add.reduceat(np.fromiter(map(len, pretokens), np.int64, len(pretokens)), at)
            sums[1, self.base : self.base + len(at)] = np.add.reduceat(np.array(tokens, np.int64), at)
        width = self.base
        while width > 1:
            sums[:, width // 2 : width] = sums[:, width : 2 * width : 2] + sums[:, width + 1 : 2 * width : 2]
            width //= 2
        self.characters, self.tokens = sums[0].tolist(), sums[1].tolist()

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, or the last one, and where the leaf begins."""
        node, before = 1, 0
        while node < self.base:
            node *= 2
            if place - before >= self.characters[node] and self.characters[node + 1]:
                before += self.characters[node]
                node += 1
        return node - self.base, before

    def _update(self, leaf: int) -> None:
        pretokens, tokens = self.leaves[leaf]
        node = self.base + leaf
        self.characters[node], self.tokens[node] = sum(map(len, pretokens)), sum(tokens)
        while node > 1:
            node //= 2
            for sums in (self.characters, self.tokens):
                sums[node] = sums[2 * node] + sums[2 * node + 1]

    def replace(self, start: int, length: int, text: str) -> None:
        """Puts ``text`` in the place of ``length`` characters from ``start``; both are cut to the document."""
        whole = self.characters[1]
        start = min(max(start, 0), whole)
        length = min(max(length, 0), whole - start)
        if not length and not text:
            return
        # The first pre-token whose end, or what the pattern sees behind it, reaches the edit.
        leaf, at = self._leaf_at(max(0, start - LOOK_AHEAD))
        first = 0
        while first < len(self.leaves[leaf][0]) and at + len(self.leaves[leaf][0][first]) <= start - LOOK_AHEAD:
            at += len(self.leaves[leaf][0][first])
            first += 1
        # Old pre-tokens from there on, as many as needed: their text, and where each begins.
        old, borders, cursor, end = [], [], [leaf, first], at
        stop, changed = start + length, len(text) - length

        def more() -> bool:
            """Takes the next old pre-token; false behind the last."""
            nonlocal end
            while cursor[0] < len(self.leaves) and cursor[1] >= len(self.leaves[cursor[0]][0]):
                cursor[0], cursor[1] = cursor[0] + 1, 0
            if cursor[0] >= len(self.leaves):
                return False
            old.append(self.leaves[cursor[0]][0][cursor[1]])
            borders.append(end)
            end += len(old[-1])
            cursor[1] += 1
            return True

        while end < stop + LOOK_AHEAD and more():
            pass
        ahead = LEAF
        while True:
            for _ in range(ahead):
                if not more():
                    break
            ended = end >= whole
            joined = "".join(old)
            new = joined[: start - at] + text + joined[stop - at :]
            found, place, settled = [], 0, None
            fits = {b - at + changed: k for k, b in enumerate(borders) if b >= stop}
            for match in self.counter.pattern.finditer(new):
                if match.start() in fits:
                    settled = fits[match.start()]
                    break
                if not ended and match.end() + LOOK_AHEAD > len(new):
                    place = -1  # the pattern could see beyond what was taken
                    break
                found.append(match[0])
            if settled is not None or place == 0 and ended:
                break
            ahead *= 2
        taken = len(old) if settled is None else settled
        self.encoded += sum(map(len, found))
        self._splice(leaf, first, taken, found, self.counter.counts(found))

    def _splice(self, leaf: int, first: int, many: int, pretokens: list[str], tokens: list[int]) -> None:
        """Replaces ``many`` pre-tokens from a place in a leaf; the leaf takes all the new ones."""
        here = self.leaves[leaf]
        gone = min(many, len(here[0]) - first)
        here[0][first : first + gone], here[1][first : first + gone] = pretokens, tokens
        self._update(leaf)
        many -= gone
        while many:
            leaf += 1
            here = self.leaves[leaf]
            gone = min(many, len(here[0]))
            if gone:
                del here[0][:gone], here[1][:gone]
                self._update(leaf)
                many -= gone

    def text(self) -> str:
        return "".join(x for leaf in self.leaves for x in leaf[0])


def with_edits(table: DataFrame, edits: DataFrame) -> DataFrame:
    """Adds the array ``edits`` to ``table``, from ``edits(doc_id, seq, start, length, replacement)``.

    The edits of one document are one array, in the order of ``seq``.
    """
    listed = edits.groupBy(F.col("doc_id").alias("_doc")).agg(
        F.array_sort(F.collect_list(F.struct("seq", "start", "length", "replacement"))).alias("edits")
    )
    return table.drop("edits").join(listed, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").drop("_doc")


def count(table: DataFrame, tokenizer_path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, n_edits, n_tokens_after, n_encoded`` for ``table(doc_id, text, edits)``.

    ``edits`` is an array of ``struct<seq, start, length, replacement>``, applied one after another;
    places are code points of the text as it then is, and are cut to it. ``n_encoded`` is how many
    characters the edits made the tokenizer see. Null text is empty; null edits are none; a null
    place or length is 0, a null replacement is empty. Repeated rows count each for itself; null ids
    are kept. Other columns are ignored; an empty table gives no rows.
    """
    documents = table.select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce("edits", F.expr("cast(array() as array<struct<seq:int,start:int,length:int,replacement:string>>)")).alias("edits"),
    )
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(tokenizer_path, pattern)
        for batch in batches:
            for first, last in slices(batch, "text", 1 << 20):
                part = batch.slice(first, last - first)
                rows = []
                for text, edits in zip(part.column("text").to_pylist(), part.column("edits").to_pylist(), strict=True):
                    tree = CountTree(text, counter)
                    before = tree.total
                    for edit in edits:
                        tree.replace(edit["start"] or 0, edit["length"] or 0, edit["replacement"] or "")
                    rows.append((before, len(edits), tree.total, tree.encoded))
                columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *columns], ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_encoded"]
                )

    return documents.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_edits long, n_tokens_after long, n_encoded long")


def sample_edits(table: DataFrame) -> DataFrame:
    """``doc_id, text, edits``: three edits of every document, at places that a hash of it picks.

    A range of its own text is inserted elsewhere, another is deleted, and a third is replaced by its
    source's name.
    """
    documents = documents_of(table, carry=True)
    size = F.length("text")

    def place(n: int) -> Column:
        return F.pmod(F.xxhash64("_row", F.lit(n)), size + 1).cast("int")

    edits = [
        F.struct(
            F.lit(0).alias("seq"), place(1).alias("start"), F.lit(0).alias("length"), F.substring(F.col("text"), place(2) + 1, F.lit(37)).alias("replacement")
        ),
        F.struct(F.lit(1).alias("seq"), place(3).alias("start"), F.lit(23).alias("length"), F.lit("").alias("replacement")),
        F.struct(
            F.lit(2).alias("seq"), place(4).alias("start"), F.lit(11).alias("length"), F.coalesce(F.col("_carried.source"), F.lit("")).alias("replacement")
        ),
    ]
    return documents.select("doc_id", "text", F.array(*edits).alias("edits"))
