"""Template deduction against a plain version, and pages that a reader must get through."""

import random
import time
from collections import defaultdict

import pytest

from chatloom.llm import html_extract
from chatloom.llm.html_extract import _Reader, main_text, page_blocks, story_of

COLUMNS = "page_id long, url string, html string"


def frame(spark, rows):
    return spark.createDataFrame([(i, url, html) for i, (url, html) in enumerate(rows)], COLUMNS)


def extracted(spark, rows):
    return {r.page_id: r.text for r in html_extract.extract_main(frame(spark, rows)).collect()}


def plain_classes(htmls, share=0.75, least_pages=4, least_tokens=3):
    """Classes of one host: vectors, order and nesting by direct comparison."""
    pages = {}
    for html in sorted(htmls, key=lambda h: html_extract._hash(h), reverse=True):
        page = _Reader(html).read()
        pages[story_of(page.blocks)] = page.tokens
    vectors = defaultdict(dict)
    for story, tokens in pages.items():
        for token in tokens:
            vectors[token][story] = vectors[token].get(story, 0) + 1
    grouped = defaultdict(set)
    for token, vector in vectors.items():
        if len(set(vector.values())) == 1 and len(vector) >= least_pages:
            grouped[frozenset(vector.items())].add(token)
    kept = [
        (vector, tokens)
        for vector, tokens in grouped.items()
        if len(tokens) >= least_tokens or len(vector) >= share * len(pages)
    ]
    bad = set()
    firsts = {s: {t: pages[s].index(t) for t in set(pages[s])} for s in pages}
    for k, (vector, tokens) in enumerate(kept):
        orders = {tuple(sorted(tokens, key=firsts[s].get)) for s, _ in vector}
        if len(orders) > 1:
            bad.add(k)
    for s in pages:
        at = {k: sorted(firsts[s][t] for t in tokens) for k, (v, tokens) in enumerate(kept) if s in dict(v)}
        listed = sorted((p, k) for k, places in at.items() for p in places)
        bad |= html_extract.crossing(listed)
    return {frozenset(tokens) for k, (_, tokens) in enumerate(kept) if k not in bad}


def shop(rng, i):
    """A page of one of two layouts, without any marked article."""
    words = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 99)) for _ in range(30))
    side = "".join(f"<li><a href=/{k}>more {k}</a></li>" for k in range(rng.randint(1, 4)))
    if i % 3:
        return (
            f"<body><div class=top><p>Our shop since 1990</p></div><div class=c><h1>Item {i}</h1><p>{words}</p>"
            f"<p>Second part {words[:40]}</p></div><ul>{side}</ul><div class=end><p>All rights reserved</p></div></body>"
        )
    return f"<body><table><tr><td>Journal of things</td></tr><tr><td>{words}</td></tr><tr><td>Write to us</td></tr></table></body>"


@pytest.mark.parametrize("seed", range(3))
def test_classes_equal_a_plain_version(spark, seed):
    rng = random.Random(seed)
    htmls = [shop(rng, i) for i in range(25)] + [shop(rng, 1)] * 2
    # Blocks that change places belong to no valid class.
    htmls += [f"<body><p>{a}</p><h2>{b}</h2><p>odd {i} page with a longer text</p></body>" for i, (a, b) in enumerate([("x", "y")] * 4)]
    rows = [("http://shop.org/", h) for h in htmls]
    got = defaultdict(set)
    for r in html_extract.template_classes(frame(spark, rows)).collect():
        got[r["class"]].add(r.token)
    want = plain_classes(htmls)
    assert {frozenset(t) for t in got.values()} == want and want


def test_templates_without_marked_articles(spark):
    rng = random.Random(7)
    rows = [("http://shop.org/", shop(rng, i)) for i in range(24)]
    got = extracted(spark, rows)
    for i, text in got.items():
        bare = main_text(rows[i][1], set())
        for fixed in ("Our shop since 1990", "All rights reserved", "Journal of things", "Write to us"):
            assert fixed not in text
            assert fixed not in rows[i][1] or fixed in bare  # without a template it stays
        if i % 3:
            assert text.startswith(f"Item {i}\n\n") and "Second part" in text and "more 1" not in text


def test_nothing_of_a_marked_article_is_lost(spark):
    inside = (
        '<article><h1>Title</h1><section id="related-work"><p>Related work text.</p></section>'
        '<p id="social-history">Social.</p><div class="share-price"><p>Up.</p></div>'
        "<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math>.</p><svg><text>Chart</text></svg><noscript><p>Still</p></noscript></article>"
    )
    page = f'<body><nav>Menu</nav>{inside}<div class="comments"><p>First!</p></div></body>'
    want = "Title\n\nRelated work text.\n\nSocial.\n\nUp.\n\nLet x=1.\n\nChart\n\nStill"
    assert main_text(page, set()) == want
    copies = [("http://a.org/", page.replace("Up.", f"Up {i}.")) for i in range(6)]
    assert extracted(spark, copies) == {i: want.replace("Up.", f"Up {i}.") for i in range(6)}


def test_adverts_and_comments_inside_an_article_go():
    page = '<article><p>One</p><div class="ad big">Buy</div><section id=comments><p>Hm</p></section><aside>By the way</aside><p>Two</p></article>'
    assert main_text(page, set()) == "One\n\nTwo"


def test_near_copies_do_not_vote_their_story_into_the_template(spark):
    story = "".join(f"<p>Paragraph {k} of one and the same long story.</p>" for k in range(5))
    rows = [("http://b.org/", f"<body><div>{story}<p>edit {i}</p></div></body>") for i in range(6)]
    got = extracted(spark, rows)
    assert all(text.count("Paragraph") == 5 and f"edit {i}" in text for i, text in got.items())


def test_templates_decide_in_marked_articles(spark):
    rng = random.Random(3)

    def story(i):
        words = [" ".join(f"{rng.choice('abcdef')}{rng.randint(0, 99)}" for _ in range(20)) for _ in range(2)]
        # Four of twelve quote one release: text of theirs, as most pages of the host lack it.
        quoted = "".join(f"<p>Release, part {k}.</p>" for k in range(3)) if i < 4 else ""
        html = (
            f"<body><article><p>Read this in our app</p><h1>Story {i}</h1><p>{words[0]}</p>{quoted}<h2>Details</h2>"
            f"<p>{words[1]}</p><p>Write to our desk</p><h3>More</h3></article></body>"
        )
        quotes = [f"Release, part {k}." for k in range(3)] if i < 4 else []
        return html, "\n\n".join([f"Story {i}", words[0], *quotes, "Details", words[1]])

    pages = [story(i) for i in range(12)]
    assert extracted(spark, [("http://n.org/", html) for html, _ in pages]) == dict(enumerate(t for _, t in pages))
    # Alone on its host, a page has no template and stays whole.
    alone = extracted(spark, [("http://o.org/", pages[0][0])])[0]
    assert alone.startswith("Read this in our app\n\nStory 0") and alone.endswith("Write to our desk\n\nMore")


BAD = {
    "open tags": '<a x="', "nested": "<div>x", "inline": "<b>", "ends": "</p>", "lists": "<li><ul><b>", "angles": "<",
    "quotes": "<a '\"x>", "comments": "<!-- ", "raw": "<title></titl", "entities": "&amp;&#x", "marks": "<!>",
}


@pytest.mark.parametrize("name", BAD)
def test_time_grows_with_the_length(name):
    def seconds(n):
        page = BAD[name] * (n // len(BAD[name])) + "<p>x" * (n // 40)
        begun = time.process_time()
        page_blocks(page)
        return time.process_time() - begun

    seconds(1000)
    short, long = max(min(seconds(60_000) for _ in range(2)), 0.01), seconds(480_000)
    assert long < 24 * short and long < 4
