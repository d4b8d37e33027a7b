"""HTML extraction on hand-made pages, and against the marked article of the test pages."""

from __future__ import annotations

import html
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from trackloom.llm import html_text as H

PAGES = [
    (None, ""), ("", ""), ("   ", ""), ("<nav>only a menu</nav>", ""), ("just text <b>bold</b>", "just text bold"), ("<article></article>", ""),
    ('<nav>a b</nav><div class="cookie-notice">we use</div><article><header><h1>T</h1></header><p>x y<br>z</p><aside>no</aside><div class="ad">buy</div><p>w &lt;&nbsp;q<ul><li>one<li>two</ul>'
     '<div id="comments"><p>hi</p></div></article><footer>f</footer>', "T\nx y z\nw < q\none\ntwo"),
    ("<div id=menu><a href=x>Home</a></div><div class=post><h1>Title here</h1><p>Some long text with many words in it.</p><p>More text a > b</p></div><div class='comments'><p>nice one</p></div><form>Send it</form>",
     "Title here\nSome long text with many words in it.\nMore text a > b"),
    ("<article><p>one<script>var a='</article>';</script> two<!-- no --><style>p{}</style></p><p title='a>b'>three &amp; &#233; cut <a hr", "one two\nthree & é cut"),
]


def marked(page: str) -> str:
    inner = re.sub(r"<[^>]*$", "", page.split("<article>", 1)[1].split("</article>")[0]) if "<article>" in page else ""
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", part.replace("<br>", " "))).split()) for part in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_hand_made(spark):
    rows = [(i, None, page, "clash") for i, (page, _) in enumerate(PAGES)]
    weights = H.train([p for p, _ in PAGES if p])
    got = H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), weights).collect()
    assert [(r["text"], r["n_chars"]) for r in sorted(got, key=lambda r: r["page_id"])] == [(t, len(t)) for _, t in PAGES]


def test_empty_table(spark):
    assert H.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_deep_nests_and_omitted_ends():
    weights = H.train([p for p, _ in PAGES if p])
    deep = "<div><article><p>one</p>" + "<div>" * 210 + "<aside>no</aside><p>two</p>" + "</div>" * 210 + "<p>three</p></article></div>"
    assert H.extract(deep, weights) == "one\ntwo\nthree"
    rows = "".join(f"<tr><td>a{i}<td>b{i}" for i in range(300))
    table = f"<article><table>{rows}<tr><td><aside>no</aside>end</table><dl>{'<dt>t<dd>d' * 300}</dl><nav>no</nav><p>last</p></article>"
    assert H.extract(table, weights).split() == [w for i in range(300) for w in (f"a{i}", f"b{i}")] + ["end"] + ["t", "d"] * 300 + ["last"]
    assert H.extract("<article>" + "<div id=x1>" * 30000 + "deep", weights) == "deep"
    *_, last = H.runs(table.replace("</article>", "").replace("<p>last</p>", "<p>last"))
    depth, place = 0, last.place
    while place is not None:
        depth, place = depth + 1, place.above
    assert depth == 3


BEYOND = "<div><p>" + "word " * 40 + "</p></div>" + "<nav><ul>" + "<li><a>go there now</a></li>" * 9 + "</ul></nav>" + "<div>late note</div><footer>f</footer>"


def test_scores_choose_the_region():
    """Texts that nothing marks as boilerplate go where the tags before them cost more than their words bring."""
    weights = H.train([f"<nav><ul><li>a b c</li></ul></nav><article><p>{'text here ' * 20}</p></article><footer>f g</footer>"] * 9)
    assert H.extract(BEYOND, weights).split() == ["word"] * 40
    assert H.extract(BEYOND, H.Weights()) != H.extract(BEYOND, weights)


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
def test_marks_are_labels_only():
    pages = [r["html"] for r in pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()]
    weights = H.train(pages[:60])
    for page in pages[60:]:
        renamed = re.sub(r"(</?)(article|main)\b", r"\1div", page)
        assert H.extract(renamed, weights) == H.extract(page, weights) == marked(page) != H.extract(page, H.Weights())


def test_long_pages_and_deep_nests():
    weights = H.train([p for p, _ in PAGES if p])
    for depth in (150, 250):
        page = "<div><article><p>hello</p>" + "<div>" * depth + "<aside>menu</aside>" + "</div>" * depth + "<p>end</p></article></div>"
        assert H.extract(page, weights) == "hello\nend"
    page = "<nav>no</nav><article>" + "<p>a long paragraph of text</p>" * 30000 + "</article>"
    assert H.extract(page, weights).count("\n") == 29999


def test_best_region():
    for scores in ([], [-1.0], [1, -2, 3, 3, -1, 1, -5, 6], [2, -1, 2], [0, 0]):
        lo, hi = H.best_region(scores)
        assert sum(scores[lo:hi]) == max([0, *(sum(scores[a:b]) for a in range(len(scores)) for b in range(a, len(scores) + 1))])


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
def test_whole_table(spark):
    path = "/root/testdata/sf0.001/pages.parquet"
    want = {r["page_id"]: marked(r["html"]) for r in pq.read_table(path).to_pylist()}
    assert {r["page_id"]: r["text"] for r in H.extract_pages(spark.read.parquet(path)).collect()} == want
