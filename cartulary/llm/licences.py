"""Fuzzy search for short licence notices in texts.

A text becomes its words with single spaces between them. A notice that may have k edits is split
into k + 1 pieces: k edits leave at least one piece as it is (pigeonhole). One automaton finds the
pieces of all notices exactly; around each hit the ``regex`` library looks for the whole notice with
at most k errors and gives the span and its edits. Fixed phrases that must stand word for word are
counted beside that.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import slices

# Phrases that must stand word for word, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public licence notices, their labels, and how many edits each may have.
NOTICES = [
    ("gnu general public license", "gpl", 2),
    ("this program is free software you can redistribute it and or modify it", "gpl", 6),
    ("gnu lesser general public license", "lgpl", 3),
    ("gnu affero general public license", "agpl", 3),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("released under the mit license", "mit", 2),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("redistribution and use in source and binary forms with or without modification", "bsd", 6),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", 6),
    ("subject to the terms of the mozilla public license", "mpl", 4),
    ("licensed under the eclipse public license", "epl", 3),
    ("this is free and unencumbered software released into the public domain", "unlicense", 6),
    ("licensed under cc by 4 0", "cc-by", 1),
    ("licensed under cc by nc 4 0", "cc-by-nc", 1),
    ("licensed under cc by sa 4 0", "cc-by-sa", 1),
    ("creative commons attribution 4 0 international license", "cc-by", 4),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc", 5),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa", 5),
    ("creative commons zero v1 0 universal", "cc0", 3),
]

#: Characters of texts that a task hands on at once.
BATCH = 4 << 20
#: Characters of a text that are worked on at once; longer texts are cut into overlapping stretches.
STRETCH = 1 << 20
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


@dataclass(frozen=True)
class Notice:
    """A notice, and how many characters of it may be put in, left out or replaced."""

    text: str
    label: str
    edits: int

    def pieces(self) -> list[tuple[int, str]]:
        """The notice in ``edits + 1`` pieces, each with its place."""
        cuts = [len(self.text) * k // (self.edits + 1) for k in range(self.edits + 2)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@dataclass
class Findings:
    """What a text holds: words, places of phrases, and notices ``(number, first word, words, edits, text)``."""

    words: int = 0
    places: int = 0
    first: int | None = None
    last: int | None = None
    labels: set[str] = field(default_factory=set)
    spans: list[tuple[int, int, int, int, str]] = field(default_factory=list)


def _word_at(line: str, start: int) -> Callable[[int], int]:
    """The number of the word that starts at a place of the line; places come in rising order."""
    seen, number = 0, start

    def at(place: int) -> int:
        nonlocal seen, number
        number += line.count(" ", seen, place)
        seen = place
        return number

    return at


class Scanner:
    """Finds phrases word for word, and notices with errors, in a text's words."""

    def __init__(self, phrases: dict[str, str], notices: Sequence[tuple[str, str, int]], stretch: int = STRETCH) -> None:
        self.phrases, self.stretch = phrases, stretch
        self.notices = [Notice(*notice) for notice in notices]
        if any(len(n.text) <= n.edits for n in self.notices):
            raise ValueError("a notice needs more characters than it may have edits")
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(self.notices):
            for place, piece in notice.pieces():
                seeds.setdefault(piece, []).append((number, place))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if seeds:
            self.automaton.make_automaton()
        # Whole words only, with as few edits as the window allows.
        self.patterns = [
            regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(n.text, literal_spaces=True)}){{e<={n.edits}}}(?![^ ])")
            for n in self.notices
        ]
        long = [len(p.split()) for p in phrases] + [len(n.text) + n.edits for n in self.notices]
        self.margin = 2 * max(long, default=1)

    def scan(self, text: str) -> Findings:
        """What the whole text holds.

        A long text is worked on in stretches. Each answers for what starts in its own words and
        sees ``margin`` more on both sides, more than a notice with its errors has characters, so
        cuts change nothing.
        """
        found = Findings()
        before: list[str] = []
        waiting: list[str] = []  # words that no stretch has answered for
        for words in self._stretches(text):
            waiting += words
            own = len(waiting) - self.margin
            if own > 0:
                self._view(before, waiting, own, found)
                before = (before + waiting[:own])[-self.margin :]
                waiting = waiting[own:]
        self._view(before, waiting, len(waiting), found)
        return found

    def _stretches(self, text: str) -> Iterator[list[str]]:
        """The text's words, A-Z in lower case, some at a time; no word is cut."""
        start = 0
        while start < len(text):
            gap = _GAP.search(text, start + self.stretch)
            end = gap.start() if gap else len(text)
            # Bytes in lower case: only A-Z change.
            yield _WORD.findall(text[start:end].encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
            start = end

    def _view(self, before: list[str], words: list[str], own: int, found: Findings) -> None:
        """Adds what starts in the first ``own`` of ``words``."""
        if not own:
            return
        line = " ".join(before + words)
        first, end = found.words, found.words + own
        padded = f" {line} "
        for phrase, label in self.phrases.items():
            wanted, at = f" {phrase} ", -1
            word = _word_at(line, first - len(before))
            while (at := padded.find(wanted, at + 1)) >= 0:
                if first <= (place := word(at)) < end:
                    found.places += 1
                    found.first = place if found.first is None else min(found.first, place)
                    found.last = place if found.last is None else max(found.last, place)
                    found.labels.add(label)
        for number, spans in self._verified(line).items():
            word = _word_at(line, first - len(before))
            for start, stop, edits in spans:
                if first <= (place := word(start)) < end:
                    found.spans.append((number, place, line.count(" ", start, stop) + 1, edits, line[start:stop]))
        found.words = end

    def _verified(self, line: str) -> dict[int, list[tuple[int, int, int]]]:
        """For each notice the spans ``(start, end, edits)`` that hold it, in order."""
        spans: dict[int, set[tuple[int, int, int]]] = {}
        looked = set()
        for last, (size, uses) in self.automaton.iter(line) if len(self.automaton) else ():
            for number, place in uses:
                notice = self.notices[number]
                low = last + 1 - size - place - notice.edits
                if (number, low) in looked:
                    continue
                looked.add((number, low))
                high = low + len(notice.text) + 2 * notice.edits
                space = line.find(" ", high, high + notice.edits + 1)
                # To the end of a word, so that the window's end is not taken for one.
                high = space if space >= 0 else high + notice.edits + 1
                match = self.patterns[number].search(line, max(0, low), high)
                if match and (match.end() < high or high >= len(line) or line[high] == " "):
                    spans.setdefault(number, set()).add((match.start(), match.end(), sum(match.fuzzy_counts)))
        return {number: _best(found) for number, found in spans.items()}


def _best(spans: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that overlap none with fewer edits (of equally many, the first one stays)."""
    order = sorted(spans)
    kept = []
    for k, (start, end, edits) in enumerate(order):
        own = (edits, start, end)
        rivals = []
        for other in order[k + 1 :]:
            if other[0] >= end:
                break
            rivals.append(other)
        j = k - 1
        while j >= 0 and order[j][0] > start - 2 * (end - start) - 64:
            if order[j][1] > start:
                rivals.append(order[j])
            j -= 1
        if all((e, a, b) >= own for a, b, e in rivals):
            kept.append((start, end, edits))
    return kept


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<notice:string,label:string,first_word:long,n_words:long,edits:int,text:string>>"
)


def scan(
    documents: DataFrame, phrases: dict[str, str] = PHRASES, notices: Sequence[tuple[str, str, int]] = tuple(NOTICES),
    stretch: int = STRETCH,
) -> DataFrame:
    """One row for each row of ``documents(doc_id, text)``: ``doc_id`` and what its whole text holds.

    ``n_words``: words, A-Z in lower case, are runs of other characters than ASCII signs, white
    space and controls. ``n_base``, ``first_word``, ``last_word`` (from 0), ``base_labels``: where
    ``phrases`` stand word for word. ``spans``: notices with at most their edits, between word
    borders; of overlapping spans of a notice that with the fewest edits. ``labels``: of both, distinct,
    sorted, with commas. ``score``: 1 with a phrase, else the largest share of a found notice that
    is as it should be, 0 without any. Null and empty texts have no words, null places, empty labels
    and no spans. Ids may be null or repeat; each row counts for itself. Other columns are ignored;
    an empty table gives no rows.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *[part.strip().split(" ")[0] for part in SCHEMA.split("spans")[0].strip(", ").split(",")], "spans"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices, stretch)
        spans_type = pa.list_(pa.struct([
            ("notice", pa.string()), ("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()),
            ("edits", pa.int32()), ("text", pa.string()),
        ]))
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), spans_type]
        for batch in batches:
            for first, last in slices(batch, "text", BATCH):
                part = batch.slice(first, last - first)
                rows = [_row(scanner, scanner.scan(text or "")) for text in part.column("text").to_pylist()]
                columns = [pa.array(list(values), t) for values, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names)

    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def _row(scanner: Scanner, found: Findings) -> tuple:
    spans = [
        {"notice": n.text, "label": n.label, "first_word": first, "n_words": words, "edits": edits, "text": text}
        for number, first, words, edits, text in sorted(found.spans, key=lambda span: (span[1], span[0]))
        for n in [scanner.notices[number]]
    ]
    score = max([1.0 if found.places else 0.0, *[1 - s["edits"] / len(s["notice"]) for s in spans]])
    labels = found.labels | {s["label"] for s in spans}
    return (
        found.words, found.places, found.first, found.last, ",".join(sorted(found.labels)), ",".join(sorted(labels)), score, spans,
    )
