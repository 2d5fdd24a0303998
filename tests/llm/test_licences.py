"""The licence scan against searching word for word and an edit-distance table."""

import random
import re

import pytest

from cartulary.llm import licences

VOCABULARY = "the license under software mit gnu cc by nc 4 0 general public apache is free für naïve 日本 permission version".split()
SCANNER = licences.Scanner(licences.PHRASES, licences.NOTICES)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))


def fewest_edits(line, notice, most):
    """The fewest edits that make the notice of a part of the line between word borders."""
    found = []
    for start in [0, *[k + 1 for k, sign in enumerate(line) if sign == " "]]:
        row = list(range(len(notice) + 1))
        for end in range(start, min(len(line), start + len(notice) + most)):
            new = [row[0] + 1]
            for k, sign in enumerate(notice, 1):
                new.append(min(row[k] + 1, new[-1] + 1, row[k - 1] + (sign != line[end])))
            row = new
            if (end + 1 == len(line) or line[end + 1] == " ") and row[-1] <= most:
                found.append(row[-1])
    return min(found, default=None)


def made_up(draw):
    parts = []
    for _ in range(draw.randint(0, 4)):
        parts.append(" ".join(draw.choice(VOCABULARY) for _ in range(draw.randint(0, 9))))
        notice = draw.choice(licences.NOTICES)
        signs = list(notice[0])
        for _ in range(draw.randint(0, notice[2] + 2)):
            at, kind = draw.randrange(len(signs)), draw.random()
            if kind < 0.33:
                del signs[at]
            else:
                signs[at : at + (kind > 0.66)] = [draw.choice("abcdefgh e")]
        parts.append("".join(signs).title() if draw.random() < 0.3 else "".join(signs))
    return draw.choice([" ", ", ", "\n"]).join(parts)


def test_scan_equals_brute_force():
    draw, found = random.Random(11), 0
    for _ in range(25):
        text = made_up(draw)
        ours, words = SCANNER.scan(text), words_of(text)
        places = [
            (k, label) for phrase, label in licences.PHRASES.items() for k in range(len(words)) if words[k : k + phrase.count(" ") + 1] == phrase.split()
        ]
        assert (ours.words, ours.places, ours.labels) == (len(words), len(places), {label for _, label in places})
        assert (ours.first, ours.last) == ((min(places)[0], max(places)[0]) if places else (None, None))
        for number, (notice, _, most) in enumerate(licences.NOTICES):
            own = [span for span in ours.spans if span[0] == number]
            assert fewest_edits(" ".join(words), notice, most) == min((span[3] for span in own), default=None)
            for _, first, many, _, shown in own:
                assert shown.split(" ") == words[first : first + many]
            found += len(own)
    assert found > 30


@pytest.mark.parametrize("stretch", [1, 40, 700])
def test_stretches_change_nothing(stretch):
    draw, cut = random.Random(12), licences.Scanner(licences.PHRASES, licences.NOTICES, stretch)
    for _ in range(30):
        text = " ".join(made_up(draw) for _ in range(12))
        whole, parts = SCANNER.scan(text), cut.scan(text)
        assert sorted(parts.spans) == sorted(whole.spans)
        parts.spans = whole.spans
        assert parts == whole


def test_notices_with_errors():
    def labels(text):
        return {SCANNER.notices[span[0]].label for span in SCANNER.scan(text).spans}

    assert labels("Redistribution and use in source or binary forms, with or without modifications") == {"bsd"}
    assert labels("GNU Lesser General Public Licence") == {"lgpl"}
    assert labels("released under the BSD license") == labels("permit license") == labels("CC BY ND") == set()
    assert labels("Licensed under CC-BY-SA 4.0") == {"cc-by-sa"} and labels("licensed under cc by 4.0") == {"cc-by"}
    with pytest.raises(ValueError):
        licences.Scanner({}, [("ab", "x", 2)])
    assert licences.Scanner({}, []).scan("mit license").words == 2


def test_scan_of_awkward_rows(awkward, nothing):
    found = licences.scan(awkward).collect()
    rows = awkward.select("doc_id", "text").collect()
    assert sorted(str((r.doc_id, r.n_words, r.n_base, r.base_labels, r.labels, r.score)) for r in found) == sorted(
        str((r.doc_id, len(words_of(r.text or "")), 0, "", "", 0.0)) for r in rows
    )
    assert all(r.first_word is None and r.last_word is None and r.spans == [] for r in found)
    assert licences.scan(nothing).count() == 0


def test_scan_reports_places(spark):
    text = "Intro. Released under the MIT license; cc-by, CC BY NC. Again: the mit LICENSE"
    row = licences.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (15, 4, 4, 13)
    assert (row.base_labels, row.labels, row.score) == ("cc-by,mit", "cc-by,mit", 1.0)
    span = row.spans[0]
    assert (span.label, span.first_word, span.n_words, span.edits, span.text) == ("mit", 1, 5, 0, "released under the mit license")
