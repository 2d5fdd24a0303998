"""Pages, archives, vectors, toxicity and token counts against plain Python and exact searches."""

import hashlib
import math
import random
import time

import numpy as np
import public_tokenizers
import pytest

from cartulary.llm import counting, extraction, neighbours, toxicity, warc

# Main text


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="home sidebar-right">
<header><h1>Site</h1></header><div id="nav-bar" class="menu"><ul><li><a href=1>Home</a><li><a href=2>About</a></ul></div>
<div class="cookie-notice">We use cookies</div><!-- <p>hidden</p> --><div id="content"><h2>Story &amp; title</h2>
<p>First para with <a href=x>a link</a> and <b>bold</b>text.<p>Second&nbsp;para<br>line   two
<div class="ad">BUY</div><ul><li>one item here<li>two item here</ul><form><input name=a>Search</form><blockquote>quote it</blockquote>
<script>if(a<b){document.write("<p>x</p>")}</script></div><section id="comments"><p>I am a reader with a long comment about it</p></section>
<aside>Side</aside><footer>&copy; 2020</footer></body></html>"""


BLOCKS = ["Story & title", "First para with a link and boldtext.", "Second para line two", "one item here", "two item here", "quote it"]


def test_main_text():
    weights = extraction.Weights()
    assert extraction.main_text(PAGE, weights).split("\n\n") == BLOCKS
    assert extraction.main_text("", weights) == extraction.main_text("<nav>a b</nav>", weights) == ""
    assert extraction.main_text("just <i>text</i> &lt;b&gt; &#233;", weights) == "just text <b> é"
    assert extraction.main_text("<p>ends in <a title='x>y'>a link</a>", weights) == "ends in a link"
    unclosed = "<nav><a>Home</a><article><h1>Head</h1><p>Body text</article>"
    assert extraction.main_text(unclosed, weights) == "Head\n\nBody text"
    replies = "<main><p>Story</p><div class=comments><article><p>Reader</p></article></div></main>"
    assert extraction.main_text(replies, weights) == "Story"


SENTENCES = [f"Story sentence number {k} with some words in it." for k in range(6)]
STORY = "".join(f"<p>{x}</p>" for x in SENTENCES)
ASIDE = '<div class="sidebar widget"><p>Buy our things</p></div><footer><p>the small print</p></footer>'


@pytest.mark.parametrize("story", [f"<article>{STORY}</article>", f"<div>{STORY}</div>"])
@pytest.mark.parametrize(
    "wrapper",
    [
        'div class="layout no-sidebar"', 'div id="page" class="with-sidebar"', 'div class="page has-comments"', 'div id="site-widget-wrapper"',
        'div class="social-site"', 'section class="related-stories"', 'div class="widget"', 'form action="x" id="aspnetForm"',
    ],
)
def test_wrapper_around_the_page_is_kept(wrapper, story):
    page = f"<body><nav><a>Home</a></nav><{wrapper}><div class='menu'><a>Menu</a></div>{story}{ASIDE}</{wrapper.split()[0]}></body>"
    assert extraction.main_text(page, extraction.Weights()).split("\n\n") == SENTENCES


NOTICE = "".join(f"<p>We and our {k} partners keep data on your device and ask you to agree to that.</p>" for k in range(14))
BRIEF = "<p>Short news of the day, told in a few plain words and no more than that.</p>"


@pytest.mark.parametrize("first", [False, True])
@pytest.mark.parametrize("head", ["", "<h1>News</h1>"])
@pytest.mark.parametrize("content", ["article", "main", "div", "section class='text'"])
@pytest.mark.parametrize(
    "box", ['div class="site-cookie-wall"', "aside", 'div class="page-sidebar-left"', 'div class="cookie"', 'form action="/agree"', 'div role="dialog"'],
)
def test_a_notice_longer_than_the_story_is_left_out(box, content, head, first):
    """Five shapes of boxes, before or behind a story of a few words, marked or not."""
    story = f"<{content}>{head}{BRIEF}</{content.split()[0]}>"
    notice = f"<{box}>{NOTICE}</{box.split()[0]}>"
    page = f"<body><nav><a>Home</a></nav>{notice + story if first else story + notice}<footer><p>the small print</p></footer></body>"
    text = extraction.main_text(page, extraction.Weights())
    assert text.split("\n\n") == [x for x in (head and "News", BRIEF[3:-4]) if x]


def test_nested_and_broken_tags_take_linear_time():
    weights = extraction.Weights()
    started = time.monotonic()
    assert extraction.main_text("<div>" * 40_000 + "<p>deep text</p>" + "</div>" * 40_000, weights) == "deep text"
    assert extraction.main_text("<p>text</p>" + "<a" * 100_000, weights) == "text"
    assert extraction.main_text("<p>text</p>" + "</b>" * 100_000, weights) == "text"
    assert len(extraction.main_text("<ul>" + "<li>x" * 40_000, weights)) == 40_000 * 3 - 2
    extraction.main_text("<div class='widget'>" * 20_000 + "<article>" * 20_000 + "x", weights)
    extraction.main_text("<p>" + "<b>" * 40_000 + "<div>" * 10 + "<script " * 20_000 + "'" * 20_001, weights)
    assert time.monotonic() - started < 8


def test_what_holds_little_of_a_page_is_left_out():
    cards = "<article><p>Read this too</p></article>" * 3
    for part in (f"<aside class='related'>{cards}</aside>", "<form><p>Your name and address</p></form>", "<div class='page-notice'><p>We moved</p></div>"):
        for page in (f"<main>{STORY}{part}</main>", f"<main>{STORY}</main>{part}", f"<div>{part}{STORY}</div>"):
            if "article" not in page or "main" in page:
                assert extraction.main_text(page, extraction.Weights()).split("\n\n") == SENTENCES


@pytest.mark.parametrize("learned", [False, True])
def test_articles_that_are_not_the_story(learned):
    weights = extraction.Weights()
    if learned:
        weights.learn([f"<body><p>not content</p><article>{STORY}</article></body>"] * 50)
    cards = "".join(f"<article><h3><a href=x>Card {k}</a></h3><p>Teaser text {k}</p></article>" for k in range(2))
    for page in (
        f"<div>{STORY}</div><section class='comments'><article class='comment-body'><p>I am a reader</p></article></section>",
        f"<div>{STORY}</div><div><article class='comment-body'><p>I am a reader</p></article></div>",
        f"<div class='cards'>{cards}</div><div>{STORY}</div>",
        f"<aside class='related'>{cards}</aside><div>{STORY}</div>",
        f"<div>{STORY}</div><div class='cards'>{cards}</div>",
        f"<!-- <article> --><script>var a = '<main>'</script><div>{STORY}</div>",
        f"<main></main><div>{STORY}</div>",
    ):
        assert extraction.main_text(page, weights).split("\n\n") == SENTENCES
    short = "<div><p>Some words that stand beside it, more than it has.</p></div><article><p>One short story here.</p></article>"
    assert extraction.main_text(short, weights) == "One short story here."


def test_weights_come_from_labelled_pages():
    page = "<body><div><a>x y z</a></div><p>not content at all</p><article><p>one two three four</p></article></body>"
    weights = extraction.Weights().learn([page] * 50)
    assert weights.words["inside"] > 0 > weights.words["outside"]
    assert all(x < 0 for x in weights.tags.values())


def test_best_region_is_the_best():
    draw = random.Random(1)
    for _ in range(200):
        scores = [draw.randint(-5, 5) for _ in range(draw.randint(0, 12))]
        first, end = extraction.best_region(scores)
        best = max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=0)
        assert sum(scores[first:end]) == max(best, 0)


def test_extraction_of_awkward_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", None, "x", "y"), (None, None, "", "x", "y"), (2, "v", PAGE, "x", "y"), (2, "v", PAGE, "x", "y"), (3, "w", "<p>word " * 50_000, "x", "y")]
    found = extraction.extract(spark.createDataFrame(rows, schema)).collect()
    sizes = sorted((str(r.page_id), r.url, len(r.text) == r.n_chars, r.n_chars) for r in found)
    assert [s[3] for s in sizes] == [0, len("\n\n".join(BLOCKS)), len("\n\n".join(BLOCKS)), 50_000 * 6 - 2, 0]
    assert all(s[2] for s in sizes)
    assert extraction.extract(spark.createDataFrame([], schema)).count() == 0


# Archives


def test_archives_come_back(spark):
    trap = "<p>x</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello" * 3
    rows = [
        (1, "u\r\nv", trap), (2, None, trap), (3, "w", None), (None, "z", ""), (4, "q", "é" * 60), (5, "q", "é" * 60), (6, "r", "WARC/1.1\r\n"),
        (6, "r", "WARC/1.1\r\n"), (7, "r", "x\r\n\r\nWARC/1.1\r\n"), (8, "r", "x\r\n\r\n\r\n"), (9, "s", "y" * 300_000), (10, "s", "short"), (11, "s", "short"),
        (12, "t", "é" * 60),
    ]
    pages = spark.createDataFrame([(*r, "a", "b") for r in rows], "page_id long, url string, html string, type string, digest string")
    found = sorted(warc.captures(spark, pages.repartition(3)).collect(), key=str)
    expected = []
    for key, url, html in rows:
        raw = (html or "").encode()
        first = min((k for k, _, h in rows if h == html and k is not None), default=None)
        again = len(raw) >= 100 and key != first
        address = url.replace("\r", "%0D").replace("\n", "%0A") if url else None
        expected.append((key, address, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert warc.captures(spark, pages.limit(0)).count() == 0


def test_foreign_archives(spark, tmp_path):
    def record(kind, name, block, extra=""):
        return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {name}\r\n{extra}Content-Length: {len(block)}\r\n\r\n{block}\r\n\r\n"

    (tmp_path / "a.warc").write_text(
        record("warcinfo", "<i>", "software: x\r\n") + record("response", "<r>", "HTTP/1.1 200 OK\r\n\r\nbody")
        + record("request", "<q>", "GET / HTTP/1.1\r\n\r\n", "WARC-Concurrent-To: <r>\r\n"),
        newline="",
    )
    rows = warc.assemble(warc.read_records(spark, str(tmp_path), with_payload=True)).collect()
    assert [(r.capture_id, r.request.record_id, bytes(r.response.payload), r.metadata) for r in rows] == [("<r>", "<q>", b"body", None)]
    (tmp_path / "b.warc").write_text(record("response", "<r>", "HTTP/1.1 200 OK\r\n\r\nbody")[:-12], newline="")
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_records(spark, str(tmp_path)).count()


# Vectors


def exact(vectors, queries, nearest=10):
    found = {}
    for query, vector in queries:
        near = sorted((float(np.sqrt(((np.array(v) - np.array(vector)) ** 2).sum())), k) for k, v in vectors if k != query and len(v) == len(vector))
        found[query] = near[:nearest]
    return found


def test_vectors_found(spark):
    draw = np.random.default_rng(0)
    middles = draw.normal(0, 1, (30, 16))
    rows = [(k, (middles[k % 30] + draw.normal(0, 0.4, 16)).tolist()) for k in range(3000)] + [(3000 + k, [1.0] * 16) for k in range(800)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    router = neighbours.fit(neighbours.usable(table), parts=12)
    found = neighbours.search(spark, table, table.where("vec_id % 100 = 0"), router=router, block=300).collect()
    truth = exact(rows, [r for r in rows if r[0] % 100 == 0])
    scores = {r.query_id: {} for r in found}
    for r in found:
        scores[r.query_id][r.rank] = (r.score, r.vec_id)
    assert set(scores) == set(truth) and all(sorted(x) == list(range(1, 11)) for x in scores.values())
    hits = sum(len({v for _, v in scores[q].values()} & {v for _, v in truth[q]}) for q in truth)
    assert hits >= 0.9 * 10 * len(truth)
    assert [scores[3100][k][1] for k in range(1, 11)] == list(range(3000, 3010))  # ties by id


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]),
        (None, [1.0, 1.0]), (9, [1.0, 0.0]), (10, []),
    ]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, part string, rank int")
    assert neighbours.fit(neighbours.usable(table)) is None
    found = neighbours.search(spark, table, table).collect()
    near = {(r.query_id, r.rank): (r.vec_id, r.score) for r in found}
    assert near == {(1, 1): (9, 0.0), (1, 2): (2, 2**0.5), (2, 1): (1, 2**0.5), (2, 2): (9, 2**0.5), (9, 1): (1, 0.0), (9, 2): (2, 2**0.5)}
    assert neighbours.search(spark, table.limit(0), table).count() == neighbours.search(spark, table, table.limit(0)).count() == 0


def test_huge_and_tiny_components(spark):
    """Finite components whose squares overflow or vanish: all candidates come, in order."""
    rows = [
        (0, [1e160, 0.0]), (1, [1e160, 1e158]), (2, [-1e200, 1.0]), (3, [1e-200, 2e-200]), (4, [0.0, 1e-200]), (5, [1.0, 1.0]),
        (6, [1.7e308, -1.7e308]), (7, [1.0, 1.0 + 1e-9]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for row in neighbours.search(spark, table, table).collect():
        found.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    for query, vector in rows:
        exact = sorted(
            (math.hypot(*[a / 4 - b / 4 for a, b in zip(x, vector, strict=True)]), key) for key, x in rows if key != query
        )
        ours = sorted(found[query])
        assert [key for _, key, _ in ours] == [key for _, key in exact]
        assert all(math.isclose(score / 4, e, rel_tol=1e-12) or score == math.inf for (_, _, score), (e, _) in zip(ours, exact, strict=True))
    many = [(k, [float(k % 7), float(k % 11), k / 100]) for k in range(400)] + [(500, [1e300, 0.0, 0.0])]
    table = spark.createDataFrame(many, "vec_id long, embedding array<double>")
    router = neighbours.fit(neighbours.usable(table), parts=6)
    assert neighbours.search(spark, table, table.where("vec_id % 100 = 0"), router=router, probes=6, asks=2).count() == 4 * 10  # 0 is a zero vector


def test_a_few_vectors_of_other_lengths(spark):
    draw = np.random.default_rng(2)
    rows = [(k, draw.normal(0, 1, 8).tolist()) for k in range(1500)]
    rows += [(2000 + k, draw.normal(0, 1, 6 if k % 2 else 10).tolist()) for k in range(24)]  # 8 on average
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    router = neighbours.fit(neighbours.usable(table), sample=400, parts=12)
    assert router
    queries = [r for r in rows if r[0] % 100 == 0 or r[0] >= 2000]
    asked = table.where("vec_id % 100 = 0 or vec_id >= 2000").coalesce(1)
    found = {}
    for r in neighbours.search(spark, table, asked, router=router, probes=12).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    truth = exact(rows, queries)
    assert {q: [v for _, v in sorted(x)] for q, x in found.items()} == {q: [v for _, v in x] for q, x in truth.items()}


def test_parts_are_balanced():
    draw = np.random.default_rng(4)
    vectors = draw.normal(0, 1, (1000, 8))
    part = neighbours.balanced_parts(vectors, neighbours.neighbour_graph(vectors, 10), 10)
    assert np.bincount(part, minlength=10).max() <= 110


# Toxicity


@pytest.fixture(scope="module")
def judged(spark):
    draw = np.random.default_rng(6)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(600):
        toxic, good = int(k % 5 == 0), int(k % 3 > 0)
        text = list(draw.choice(words, 60)) + ["blockhead", "nitwit"][: 1 + k % 2] * toxic + ["###", "$$$"] * (1 - good)
        rows.append((k, " ".join(draw.permutation(text)), "x"))
        if k < 400:
            labels.append((k, good, toxic))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    return table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxic_documents_are_found(judged):
    table, labels = judged
    found = {r.doc_id: r.toxic for r in toxicity.classify(table, labels).collect()}
    unseen = [k for k in range(400, 600)]
    assert np.mean([found[k] == (k % 5 == 0) for k in unseen]) > 0.97


def test_toxicity_of_awkward_rows(spark, judged, awkward, nothing):
    table, labels = judged
    found = toxicity.classify(awkward, labels).collect()
    assert len(found) == awkward.count() and all(0 <= r.toxic_score <= 1 for r in found)
    none = toxicity.classify(table, labels.limit(0)).collect()
    assert {(r.quality_score, r.toxic_score, r.toxic) for r in none} == {(0.0, 0.0, False)}
    assert toxicity.classify(nothing, labels).count() == 0
    odd = spark.createDataFrame([(None, 1, 1), (1, None, 1), (2, 0, None)], "doc_id long, quality int, toxic int")
    assert toxicity.classify(awkward, odd).count() == awkward.count()


# Token counts


@pytest.fixture(scope="module")
def counter():
    return counting.Counter.of(str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def test_counts_follow_edits(counter):
    draw = random.Random(2)
    parts = ["a", "B", " ", "  ", "\n", "'s", "'re", "'", "12", "!", "é", "日本", "\t", "ll", "word", " the"]

    def text(most):
        return "".join(draw.choice(parts) for _ in range(draw.randint(0, most)))

    for _ in range(400):
        now = text(draw.choice([5, 60, 400]))
        tree = counting.CountTree(now, counter)
        for _ in range(draw.randint(1, 6)):
            start, length, new = draw.randint(-1, len(now) + 2), draw.choice([0, 0, 1, 2, 5, 30]), text(4)
            first = min(max(start, 0), len(now))
            now = now[:first] + new + now[first + length :]
            tree.replace(start, length, new)
            assert tree.text() == now
            assert tree.total == len(counter.encoding.encode_ordinary(now))


def test_edits_encode_little(counter):
    tree = counting.CountTree("some words and more " * 20_000, counter)
    tree.replace(200_000, 3, "new")
    assert tree.encoded < 100


def test_counting_awkward_rows(spark, awkward, nothing, counter):
    path, pattern = str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
    edits = spark.createDataFrame(
        [(6, 2, 5, 3, "later"), (6, 1, 0, 4, None), (None, 1, None, None, "x "), (99, 1, 0, 0, "nobody")],
        "doc_id long, seq int, start int, length int, replacement string",
    )
    found = counting.count(counting.with_edits(awkward, edits), path, pattern).collect()
    assert len(found) == awkward.count()
    for r in found:
        if r.doc_id == 6:
            text = next(x.text for x in awkward.where("doc_id = 6").collect())[4:]
            text = text[:5] + "later" + text[8:]
            assert (r.n_edits, r.n_tokens_after) == (2, len(counter.encoding.encode_ordinary(text)))
        elif r.doc_id is not None:
            assert (r.n_edits, r.n_tokens_after, r.n_encoded) == (0, r.n_tokens, 0)
        else:
            assert r.n_edits == 1 and r.n_tokens_after >= r.n_tokens + 1
    assert counting.count(counting.with_edits(nothing, edits), path, pattern).count() == 0
