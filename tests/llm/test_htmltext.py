from __future__ import annotations

import re
from html import unescape

import pytest
from postlake.llm import htmltext as h

from tests.conftest import SMALL

PAGES = "page_id long, url string, html string, n_chars long, text string"

CASES = {
    "divs without sections": (
        "<html><body><div class=menu><a href=x>Home</a> <a href=y>About</a></div><div id=c><h1>Title &amp; more</h1>"
        "<div class='post-body'><p>First para, with <b>bold</b> text&#8217;s end. More here, really.</p>"
        "<p>Second\n para&nbsp;goes  on.<br>And on, and on, until it ends.</p><h2>Sub</h2><ul><li>one item<li>two</ul></div>"
        "<div class=comments><p>I like this article, very much so, I do.</p></div></div>"
        "<div class='sidebar'><p>Side text which is quite long, long, and so on.</p></div>"
        "<div id=cookie-notice>We use cookies.</div><footer>(c) 2024</footer></body></html>",
        "Title & more\nFirst para, with bold text’s end. More here, really.\n"
        "Second para goes on. And on, and on, until it ends.\nSub\none item\ntwo",
    ),
    "links above a table": (
        "<div><a href=1>One</a><a href=2>Two</a><a href=3>Three</a></div>"
        "<table><tr><td>Long text in a cell, with words and words. More words follow here.</td></tr></table>",
        "Long text in a cell, with words and words. More words follow here.",
    ),
    "article with parts to leave out": (
        "<header><h1>Site</h1></header><main><article><h1>News</h1><p>Short.</p><aside>See also</aside>"
        "<form><label>Name</label><input><button>Send</button></form><p>A second paragraph, longer than the first.</p>"
        "<section class='user comments'><p>First! A long comment, longer than all the rest of this page by far.</p></section>"
        "<script>if (a < b) document.write('<p>no</p>')</script><style>p > a {}</style></article></main>"
        "<div role=navigation>More</div><div hidden>Hidden words</div><div style='display: none'>None</div>",
        "News\nShort.\nA second paragraph, longer than the first.",
    ),
    "a class that names all": (
        "<body><div class='page has-sidebar'><h1>Title here</h1><p>The first paragraph, which is long enough.</p>"
        "<p>The second one, also of some length.</p></div></body>",
        "Title here\nThe first paragraph, which is long enough.\nThe second one, also of some length.",
    ),
    "an article's own header": (
        "<div class=site-header>Site</div><article><div class='entry-header'><h1>Title</h1></div>"
        "<p>Words, words and words.</p></article>",
        "Title\nWords, words and words.",
    ),
    "attribute with a bracket, open comment": ("<p>Un<i>closed <a title='x>y'>link</a> text <!-- never", "Unclosed link text"),
    "references": ("<p>&lt;p&gt; &amp;amp; &#x41;&#66; &copy &notareference; &a &am &amp</p>", "<p> &amp; AB © ¬areference; &a &am &"),
    "long tail": ("<p>" + "word " * 200_000 + "</p>", " ".join(["word"] * 200_000)),
    "a page within a form": (
        "<body><form id=aspnetForm action=x><div class=menu><a href=x>Home</a></div><input type=hidden>"
        "<div id=c><h1>Title</h1><p>The first paragraph, which is long enough.</p><p>The second, too.</p></div>"
        "<select><option>One</option></select></form></body>",
        "Title\nThe first paragraph, which is long enough.\nThe second, too.",
    ),
    "a form of fields stays out": (
        "<body><p>Short words.</p><form><label>Your name, in full, as it is written</label><input>"
        "<label>And your address, with all its parts, please</label></form></body>",
        "Short words.",
    ),
    "a standfirst beside the body": (
        "<body><div class=page><div class=lead><p>A standfirst, which says it all.</p></div><div class=text>"
        + "<p>A paragraph of the body, long enough to count, and so on.</p>" * 6 + "</div></div></body>",
        "\n".join(["A standfirst, which says it all."] + ["A paragraph of the body, long enough to count, and so on."] * 6),
    ),
    "a last section beside the body": (
        "<body><div><div class=text>" + "<p>A paragraph of the body, long enough to count, and so on.</p>" * 9
        + "</div><div class=end><p>The last section, which ends it, at last.</p></div></div></body>",
        "\n".join(["A paragraph of the body, long enough to count, and so on."] * 9 + ["The last section, which ends it, at last."]),
    ),
    "classes with a noise word that name content": (
        "<article><p>Words, words and words.</p><section class='social-history'><p>How it came about.</p></section>"
        "<div class='related-work'><p>What others did.</p></div><div class='related-posts'><p>More</p></div>"
        "<div class='site-footer-2'>End</div><div class='ad-300x250'>Buy</div><div class='ad-slot-mid'>Now</div></article>",
        "Words, words and words.\nHow it came about.\nWhat others did.",
    ),
    "a formula in a line": (
        "<article><p>Let <math><mi>x</mi><mo>=</mo><msup><mi>y</mi><mn>2</mn></msup></math> be given.</p></article>",
        "Let x=y2 be given.",
    ),
    "a list of links in an article": (
        "<article><p>Words, words and words, quite long.</p><ul><li><a href=1>First source</a><li><a href=2>Second</a></ul></article>",
        "Words, words and words, quite long.\nFirst source\nSecond",
    ),
    "none": ("<script>var a = 1;</script><nav>Home</nav>", ""),
    "deep": ("<div>" * 3000 + "<p>Deep text, far down.</p>", "Deep text, far down."),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    html, want = CASES[name]
    assert h.extract(html) == want


def test_generated_pages_against_their_articles(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    found = {r.page_id: r for r in h.extracted(pages).collect()}
    for row in pages.collect():
        article = row.html.split("<article>")[1].split("</article>")[0]
        article = re.sub("</?b>", "", article.replace("<br>", " "))
        blocks = [" ".join(unescape(x).split()) for x in re.split("</?(?:h1|p)>", article)]
        assert found[row.page_id].text == "\n".join(b for b in blocks if b)
        assert found[row.page_id].n_chars == len(found[row.page_id].text)


def test_hostile_pages_take_linear_time():
    import time

    start = time.perf_counter()
    n = 50_000
    assert h.extract("<div>" * n + "<p>Deep text, far down.</p>" * 100 + "</foo>" * n).count("Deep") == 100
    assert h.extract("<b>" * n + "words " * 10 + "</i>" * n) == " ".join(["words"] * 10)
    assert h.extract("<b>" * n + "<p>x</p>" * n).count("x") == n
    h.extract("<a href='" * n)
    h.extract("<p>x" * n)
    h.extract("<!-- x" * n)
    assert time.perf_counter() - start < 20


def test_path_scores_smooth_and_fuse():
    paths = [1, 1, 2, 1]
    blocks = ["A long block, with points. Yes.", "Another one, as long.", "Link", "The last block, too."]
    scores, links = h._path_scores(paths, blocks, [0, 0, 4, 0])
    assert links[2] == 1 and scores[2] == 0 and scores[1] > 10


def test_hard_rows(spark):
    rows = [(1, None, None, 1, "t"), (1, "u", "", 1, "t"), (None, "u", "<p>Some text here.", None, None), (2, "u", "<p>Some text here.", 1, "t")]
    got = {(r.page_id, r.url, r.text, r.n_chars) for r in h.extracted(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {(1, None, "", 0), (1, "u", "", 0), (None, "u", "Some text here.", 15), (2, "u", "Some text here.", 15)}
    assert h.extracted(spark.createDataFrame([], PAGES)).count() == 0
