"""The cut against all labellings, the extraction against pages with known text."""

import itertools
import os
import random
import re
import time
from html import unescape

import pytest

from venuemart.llm import html_cut


def cost(odds, links, keep):
    return sum(-x for x, k in zip(odds, keep) if k and x < 0) + sum(x for x, k in zip(odds, keep) if not k and x > 0) + sum(c for a, b, c in links if keep[a] != keep[b])


def test_cut_is_least():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randint(0, 9)
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        links = [(a, b, rng.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.4]
        keep = html_cut.source_side(odds, links)
        least = min(cost(odds, links, x) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(odds, links, keep) - least) < 1e-6


PLAIN = "One sentence of the story that goes on for quite a number of words. "


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("no markup at all, but a sentence that is long enough to count as text of its own.", "no markup at all, but a sentence that is long enough to count as text of its own."),
        ("<p>" + PLAIN, PLAIN.strip()),
        (f"<html><body><nav><a href='/'>Home</a></nav><article><h1>A  &amp;\n B</h1><p>{PLAIN}<p>x<br>y</p></article><footer>&copy; me</footer>", f"A & B\n{PLAIN.strip()}\nx y"),
        (f"<header><h1>Site</h1></header><main><article><header><h1>Story</h1></header><p>{PLAIN}</p><aside><p>{PLAIN}</p></aside><p>End.</p></article></main>", f"Story\n{PLAIN.strip()}\nEnd."),
        (f"<article><p>{PLAIN}</p><section id='comments'><article class='comment'><p>{PLAIN}</p></article></section></article>", PLAIN.strip()),
        (f"<article><p>{PLAIN}</p><form><label>Name</label><input name=a><button>Send</button></form></article>", f"{PLAIN.strip()}"),
        (f"<div class='cookie-notice'>{PLAIN}</div><div id='content'><p>{PLAIN}</p><p>Two.</p></div><div class='sidebar'><ul><li><a href='/x'>More</a></ul></div>", f"{PLAIN.strip()}\nTwo."),
        (f"<script>var x = '<p>no</p>';</script><style>p{{}}</style><div><p>{PLAIN}</p><div class=ad>{PLAIN}</div><p>{PLAIN}</p></div>", f"{PLAIN.strip()}\n{PLAIN.strip()}"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><pre> c  d </pre></article>", "one\ntwo\na\nb\nc d"),
        ("<article><p>1 < 2 &lt; 3 &#8364; &nbsp; &am</p><!-- no --><p hidden>no</p><p style='display: none'>no</p></art", "1 < 2 < 3 € &am"),
        ("<article><p>cut <b", "cut"),
        ("<ul>" + "<li><a href='/a'>Some link</a></li>" * 30 + "</ul>", ""),
        (f"<form id=aspnet><div class='post'><p>{PLAIN}</p></div></form>", ""),
    ],
)
def test_pages(html, text):
    assert html_cut.main_text(html) == text


@pytest.mark.parametrize("name", ["button", "select", "svg", "math", "object", "canvas", "audio", "video", "datalist", "template"])
def test_left_out_elements_end_with_their_parent(name):
    """Closed or not, with a later closed one or without, in a menu and inside the text."""
    story = f"<article><p>{PLAIN}</p><p>More of it, with <b>bold</b> words.</p></article>"
    want = f"{PLAIN.strip()}\nMore of it, with bold words."
    for menu in (f"<nav><{name}>Menu</nav>", f"<nav><div><{name} class=x>Menu<span>x</div></nav>", f"<nav><{name}>Menu</{name}></nav>"):
        assert html_cut.main_text(f"<body>{menu}{story}") == want
        assert html_cut.main_text(f"<body>{menu}{story}<form><{name}>Send</{name}></form>") == want
    assert html_cut.main_text(f"<body>{story.replace('</article>', f'<div><{name}>no <i>no</i></div><p>End.</p></article>')}") == want + "\nEnd."


def test_left_out_elements_in_a_line():
    assert html_cut.main_text("<article><p>a <svg><title>no</title><path d='x'/><g><text>no</text></g></svg> b <button><div>no</div></button> c</p></article>") == "a b c"
    for name in ("button", "select", "svg"):
        assert html_cut.main_text(f"<body><{name}>Menu<article><p>{PLAIN}</p></article>") == PLAIN.strip()
    assert html_cut.main_text("<article><p>a <button>no<button>no</button> b</p></article>") == "a b"


def test_long_and_deep_pages():
    deep = "<div>" * 20_000 + f"<article><p>{PLAIN}</p>" + "<p>a b</p>" * 3000
    assert html_cut.main_text(deep).count("\n") == 3000


@pytest.mark.parametrize("unit", ['<a href="', "<a href='", '<a href="x>', "<a b='c\" ", "<", "<a ", "<!-", "</a", '<p title="\'">', "<b>'"])
@pytest.mark.parametrize("tail", ["", ">", '">', "'>\""])
def test_broken_pages_take_linear_time(unit, tail):
    start = time.perf_counter()
    html_cut.main_text(unit * 60_000 + tail)
    assert time.perf_counter() - start < 4


def test_tags_end_as_the_pattern_says():
    """Against the plain pattern, which takes quadratic time on broken pages."""
    plain = re.compile(r"""<(/?)([a-zA-Z][^\s/>"']*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
    rng = random.Random(8)
    for _ in range(3000):
        html = "".join(rng.choices(["<a", "<b ", "</p", ">", '"', "'", " x=", "t", "/"], k=rng.randint(1, 14)))
        tags = html_cut.Tags(html)
        for at in [k for k, c in enumerate(html) if c == "<"]:
            name, want = html_cut._open.match(html, at), plain.match(html, at)
            assert (tags.end(name.end()) if name else -1) == (want.end() - 1 if want else -1), (html, at)


@pytest.mark.parametrize("name, kept", [("story banner-story", True), ("post promo-post", True), ("banner-story", False), ("story banner", False), ("post post-comment", False), ("comment-content content", False)])
def test_looks_of_an_article(name, kept):
    assert html_cut.main_text(f"<body><div class='{name}'><p>{PLAIN}</p><p>{PLAIN}</p></div>") == (f"{PLAIN.strip()}\n{PLAIN.strip()}" if kept else "")


def test_table(spark):
    rows = [(1, "u", "<article><p>text</p></article>", 5, "r"), (2, None, None, None, None), (1, "u", "<article><p>text</p></article>", 5, "r")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int, row string")
    assert sorted((r["row"]["page_id"], r["text"]) for r in html_cut.extract(pages).collect()) == [(1, "text"), (1, "text"), (2, "")]
    assert html_cut.extract(pages.limit(0)).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_article_of_every_test_page(spark):
    """Brute force for pages whose text is one article of h1, p, b and br."""
    for page in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", page.html, re.S)[1]
        parts = [" ".join(unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert html_cut.main_text(page.html) == "\n".join(x for x in parts if x)
