"""Main text of web pages: the contiguous region with the largest sum of scores.

A page is a sequence of words and tags. Words score by where they stand (in a link, a heading, a
paragraph, ...), tags score negative, both by weights learned from labelled pages; one linear scan
finds the best region. What is never content (menus, adverts, forms, scripts, comments of readers,
...) scores nothing and is left out, wherever it stands; but an element that holds the marked
content, or else most of a page's words with nothing that reads like a story beside it, is a wrapper
around the page, whatever its name.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import slices

#: Labelled pages from which weights are learned.
SAMPLE_PAGES = 400

# Names of elements.
RAW = "script|style|noscript|template|iframe|svg|math|object|textarea|title|xmp|noembed|noframes"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
NEVER = frozenset(
    "nav aside footer form head menu button select input label fieldset dialog search audio video canvas".split()
)
#: Those that are no wrapper, however many words they hold.
SMALL = NEVER - {"form", "fieldset", "aside"}
CONTENT = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
READERS = frozenset("comment comments commentlist disqus respond replies reply".split())
HINTS = READERS | frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promos promotion "
    "banner menu menus submenu nav navbar navigation breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar "
    "cookie cookies consent gdpr notice notices notification alert alerts popup modal overlay newsletter subscribe signup "
    "login share sharing social related recommended recommendations widget widgets toolbar pagination pager skip copyright".split()
)
#: Words of paragraphs that make a story, beside which nothing is a wrapper for its size alone.
STORY_WORDS = 8
#: Closed by a start tag of a block.
PARAGRAPHS = frozenset(("p",))
#: A start tag closes an open element of its own kind, up to the nearest list or table.
PLACES = (("p", ("p", "blockquote")), ("li", ("li",)), ("td", ("td",)))
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+>.*?(?:</\1\s*>|\Z)|<[!?][^>]*+(?:>|\Z)"
    # A tag that is never closed goes up to the end, as in browsers.
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME = re.compile(r"[a-z]+")
#: A name that tells what the page has or lacks, as in ``no-sidebar``.
_STATE = re.compile(r"(?:no|not|with|without|has|have)[^a-z]")


def _left_out(tag: str, attributes: str, in_content: bool) -> str | None:
    """Why an element is not content, unless it is a wrapper: ``reader`` for comments of readers,
    ``name`` if a whole name says so, or ``other``."""
    if attributes and tag not in ("html", "body"):
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        tokens = [x for x in f"{found.get('class', '')} {found.get('id', '')}".lower().split() if not _STATE.match(x)]
        names = set(_NAME.findall(" ".join(tokens)))
        if names & READERS and not (tag == "main" or tag == "article" and "comment" not in names and "reply" not in names):
            return "reader"
        if tag not in CONTENT and (names & HINTS or found.get("role", "").lower() in ROLES):
            return "name" if not names & HINTS or any(HINTS.issuperset(_NAME.findall(x) or [""]) for x in tokens) else "other"
        if "header" in names and tag not in CONTENT and tag not in HEADINGS and not in_content:
            return "other"
    if tag in NEVER or tag == "header" and not in_content:
        return "other"
    return None


class Page:
    """A page as pieces: ``(kind, where, text)``; kind is a tag's name, or empty for text.

    ``where`` is a text's place, or none for what is left out.
    """

    def __init__(self, source: str) -> None:
        lowered = source.lower()
        self.pieces: list[tuple[str, str | None, str]] = []
        # Elements in the order of their start tags: name, attributes, number of the one around it.
        self.elements: list[tuple[str, str, int]] = [("", "", 0)]
        self.places: list[int] = []  # the element that each piece counts to
        self.unclosed = {t for t in (*NEVER, "div", "section", "header", "ul") if lowered.count(f"</{t}") < lowered.count(f"<{t}")}
        # Open elements: name, why left out (inherited; wrappers too), whether within content, number.
        self.open: list[tuple[str, str | None, bool, int]] = []
        # Where open elements stand in it: by name, those of blocks, those that are left out.
        self.spots: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.out: list[int] = []
        at = 0
        for match in _TOKEN.finditer(source):
            if match.start() > at:
                self._text(source[at : match.start()])
            at = match.end()
            if match[3] and match[0][-1] == ">":
                name = match[3].lower()
                if match[2]:
                    self._end(name)
                else:
                    self._start(name, match[4])
        if at < len(source):
            self._text(source[at:])
        self._settle()

    def _state(self) -> tuple[str | None, bool]:
        return (self.open[-1][1], self.open[-1][2]) if self.open else (None, False)

    def _add(self, kind: str, where: str, text: str, element: int) -> None:
        self.pieces.append((kind, where, text))
        self.places.append(element)

    def _within(self, names: Iterable[str]) -> int:
        """Where the innermost open element of one of these names stands; -1 if there is none."""
        return max((self.spots[name][-1] for name in names if self.spots.get(name)), default=-1)

    def _push(self, name: str, why: str | None, inside: bool, number: int) -> None:
        place = len(self.open)
        self.open.append((name, why, inside, number))
        self.spots[name].append(place)
        if name in BLOCKS:
            self.blocks.append(place)
        if why:
            self.out.append(place)

    def _cut(self, place: int) -> None:
        """Closes all open elements from ``place`` on."""
        while len(self.open) > place:
            name, why, _, _ = self.open.pop()
            self.spots[name].pop()
            if name in BLOCKS:
                self.blocks.pop()
            if why:
                self.out.pop()

    def _text(self, text: str) -> None:
        if self.spots.get("a"):
            where = "link"
        elif self._within(HEADINGS) >= 0:
            where = "heading"
        else:
            where = next((w for w, names in PLACES if self._within(names) >= 0), "other")
        self._add("", where, text, self.open[-1][3] if self.open else 0)

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCKS and (place := self._within(PARAGRAPHS)) >= 0 and self.blocks[-1] <= place:
            self._cut(place)
        if name in SIBLINGS:
            place = self._within(("dt", "dd") if name in ("dt", "dd") else (name,))
            if place > self._within(SIBLINGS[name]):
                self._cut(place)
        out, inside = self._state()
        if out in ("name", "other") and name in CONTENT and self.open[self.out[0]][0] in self.unclosed:
            # A menu or an advert that is never closed ends where content begins.
            self._cut(self.out[0])
            out, inside = self._state()
        why = out or _left_out(name, attributes, inside)
        self.elements.append((name, attributes, self.open[-1][3] if self.open else 0))
        number = len(self.elements) - 1
        self._add(name, "tag", "", number)
        if name not in VOID and not attributes.endswith("/"):
            self._push(name, why, inside or name in CONTENT and not why, number)

    def _end(self, name: str) -> None:
        self._add(name, "tag", "", self.open[-1][3] if self.open else 0)
        if self.spots.get(name):
            self._cut(self.spots[name][-1])

    def _settle(self) -> None:
        """What is left out, now that all elements' words are known; and whether marks can be trusted."""
        size = len(self.elements)
        titled = [name in ("main", "h1") for name, _, _ in self.elements]
        for k in range(size - 1, 0, -1):
            titled[self.elements[k][2]] |= titled[k]
        # Words outside links: all but readers' and those of small elements; marked by main; by article.
        reader, small, marked = [False] * size, [False] * size, [""] * size
        # Under anything that may be left out; within a paragraph.
        doubtful, told = [False] * size, [False] * size
        for k in range(1, size):
            name, attributes, around = self.elements[k]
            reader[k] = reader[around] or not titled[k] and _left_out(name, attributes, False) == "reader"
            small[k] = small[around] or name in SMALL
            doubtful[k] = doubtful[around] or bool(_left_out(name, attributes, False))
            told[k] = told[around] or name in ("p", "blockquote")
            marked[k] = "main" if "main" in (name, marked[around]) else "article" if name == "article" else marked[around]
        words, by_main, by_article = [0] * size, [0] * size, [0] * size
        for (kind, where, text), k in zip(self.pieces, self.places, strict=True):
            if not kind and where != "link" and not reader[k]:
                many = len(text.split())
                words[k] += 0 if small[k] else many
                by_main[k] += many if marked[k] == "main" else 0
                by_article[k] += many if marked[k] else 0
        for held in (words, by_main, by_article):
            for k in range(size - 1, 0, -1):
                held[self.elements[k][2]] += held[k]
        by_mark = by_main if by_main[0] else by_article
        # A story beside all that is in doubt, and a first heading there.
        plain = [k for (kind, where, _), k in zip(self.pieces, self.places, strict=True) if not kind and where != "link" and told[k]]
        plain = {k for k in plain if not doubtful[k] and not marked[k]}
        beside = sum(len(text.split()) for (kind, _, text), k in zip(self.pieces, self.places, strict=True) if not kind and k in plain)
        headed = any(name == "h1" and not doubtful[k] for k, (name, _, _) in enumerate(self.elements))

        def wraps(k: int, why: str) -> bool:
            if why == "reader":
                return titled[k]
            if 2 * by_mark[k] > by_mark[0] and (by_main[0] or 4 * by_mark[k] >= words[0] - words[k]):
                return True
            if self.elements[k][0] in SMALL or words[k] * (10 if why == "name" else 2) <= words[0] * (9 if why == "name" else 1):
                return False
            # Size alone says nothing beside a story or marked content: a long notice is longer than both.
            if beside >= STORY_WORDS:
                return titled[k] and not headed
            return titled[k] or not by_mark[0]

        out, inside = [None] * size, [0] * size  # the content element that each is in
        for k in range(1, size):
            name, attributes, around = self.elements[k]
            why = _left_out(name, attributes, inside[around] > 0)
            out[k] = out[around] or (why if why and not wraps(k, why) else None)
            inside[k] = inside[around] or (k if name in CONTENT and not out[k] else 0)
        self.pieces = [(kind, None if out[k] else where, text) for (kind, where, text), k in zip(self.pieces, self.places, strict=True)]
        self.inside = [inside[k] > 0 for k in self.places]
        # Marks count if kept elements with words have them, and no cards beside a longer text.
        held = Counter()
        for (kind, where, text), k in zip(self.pieces, self.places, strict=True):
            if not kind and where:
                held[inside[k]] += len(text.split()) if where != "link" or inside[k] else 0
        unmarked = held.pop(0, 0)
        cards = [k for k in held if held[k]]
        main = any(self.elements[k][0] == "main" for k in cards)
        self.marked = bool(cards) and (main or (4 if len(cards) == 1 else 1) * sum(held.values()) >= unmarked)

    def scores(self, weights: Weights) -> list[float]:
        found = []
        for (kind, where, text), inside in zip(self.pieces, self.inside, strict=True):
            if not where:
                found.append(0.0)
            elif kind:
                found.append(weights.tags.get(kind, weights.other_tag))
            else:
                # A card beside a text that isn't marked scores as a link does.
                score = weights.words[where] if self.marked or not inside else weights.words["link"]
                if self.marked:
                    score += weights.words["inside" if inside else "outside"]
                found.append(score * len(text.split()))
        return found


class Weights:
    """Scores of a word by its place and of a tag by its name; learned, or these before learning."""

    def __init__(self) -> None:
        self.words = {"inside": 3.0, "outside": -3.0, "p": 1.0, "heading": 1.0, "li": 0.6, "td": 0.6, "other": 0.6, "link": -0.6}
        self.tags: dict[str, float] = {}
        self.other_tag = -0.1

    def learn(self, pages: Iterable[str]) -> Weights:
        """From labelled pages: those that mark their content by ``article`` or ``main``.

        The log of the odds that a word, or a tag, of a kind is content, as counted in the pages.
        """
        words: dict[bool, Counter[str]] = {True: Counter(), False: Counter()}
        tags: dict[bool, Counter[str]] = {True: Counter(), False: Counter()}
        for source in pages:
            marked, plain = Page(source), Page(re.sub(r"(?i)<(/?)(?:article|main)\b", r"<\1div", source))
            # Both have the same pieces, once with the label and once with the plain places.
            if not marked.marked:
                continue
            inside = False
            for (kind, where, text), label, (_, place, _) in zip(marked.pieces, marked.inside, plain.pieces, strict=True):
                if where and not kind:
                    inside = label
                    many = len(text.split())
                    words[inside]["inside" if inside else "outside"] += many
                    if place:
                        words[inside][place] += many
                elif where:
                    tags[inside][kind] += 1
        for place in words[True] | words[False]:
            odds = math.log((words[True][place] + 1) / (words[False][place] + 1))
            if place in ("inside", "outside"):
                self.words[place] = max(-3.0, min(3.0, odds))
            elif words[True][place] + words[False][place] >= 100:
                self.words[place] = max(-1.0, min(1.0, odds))
        for kind in tags[True] | tags[False]:
            odds = math.log((tags[True][kind] + 1) / (tags[False][kind] + 1))
            self.tags[kind] = max(-0.3, min(-0.05, odds - 1))
        return self


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and end of the contiguous range with the largest sum; empty if no sum is positive."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for place, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, place
        total += score
        if total > best:
            best, found = total, (start, place + 1)
    return found


def main_text(source: str, weights: Weights) -> str:
    """The blocks of the best region, parted by an empty line."""
    page = Page(source)
    pieces = page.pieces
    first, end = best_region(page.scores(weights))
    # Blocks are kept whole: a link at a block's end scores negative, but belongs to it.
    while first < end and first and pieces[first - 1][0] not in BLOCKS:
        first -= 1
    while first < end < len(pieces) and pieces[end][0] not in BLOCKS:
        end += 1
    blocks, now = [], []
    for kind, where, text in pieces[first:end]:
        if kind in BLOCKS:
            blocks.append(now)
            now = []
        elif kind == "br":
            now.append(" ")
        elif where and not kind:
            now.append(text)
    blocks.append(now)
    whole = (" ".join(html.unescape("".join(block)).split()) for block in blocks)
    return "\n\n".join(block for block in whole if block)


def labelled_sample(pages: DataFrame, most: int = SAMPLE_PAGES) -> list[str]:
    """At most ``most`` pages that mark their content, from a share of all pages that a hash picks.

    The share is for eight times as many pages, whatever the table's size, so that what tasks send is
    bounded too.
    """
    share = min(1.0, 8 * most / max(1, pages.count()))
    drawn = pages.where(F.pmod(F.xxhash64("page_id", "html"), F.lit(1 << 20)) < share * (1 << 20))
    marked = drawn.where(F.col("html").rlike(r"(?i)<(article|main)\b"))
    return [r["html"] for r in marked.orderBy(F.xxhash64("page_id", "html"), "html").select("html").limit(most).collect()]


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages(page_id, url, html)``.

    Null or empty html, and pages without content: empty text. Without labelled pages the weights
    are those set beforehand. Ids and addresses may be null or repeat. Other columns are ignored;
    an empty table gives no rows.
    """
    pages = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    weights = weights or Weights().learn(labelled_sample(pages))
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch, "html", 1 << 21):
                part = batch.slice(first, last - first)
                texts = [main_text(x, weights) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
