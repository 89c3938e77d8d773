import html
import itertools
import re

import numpy as np
import pytest

from auric.llm import html_pages as hp
from auric.llm import html_text as m
from tests.llm.conftest import PAGES, SF, table


@pytest.fixture(scope="module")
def field():
    return m.train()


def test_article_text_of_the_given_pages(spark):
    pages = {r.page_id: r.html for r in table(spark, "pages").collect()}
    rows = m.op9_html_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert r.text == want and r.n_chars == len(want)


def test_held_out_pages(field):
    pages = [m.blocks(p) for p in hp.labelled_pages(200, seed=42)]
    right = total = 0
    for p in pages:
        for got, b in zip(field.decode(m.features(p)), p):
            right += got == int(bool(b.label))
            total += 1
    assert total > 2000 and right / total > 0.98


def some_field(rng, names):
    f = m.Field()
    f.weight = {x: rng.normal() for x in names}
    f.pair = rng.normal(size=(2, 2))
    return f


def score(f, feats, y):
    s = f.scores(feats)
    return (sum(s[k] for k in range(len(y)) if y[k])
            + sum(f.pair[a, b] for a, b in zip(y, y[1:])))


def test_viterbi_and_marginals_against_all_labellings():
    rng = np.random.default_rng(1)
    for n in range(1, 7):
        f = some_field(rng, "abcde")
        feats = [list(rng.choice(list("abcde"), 2)) for _ in range(n)]
        every = list(itertools.product((0, 1), repeat=n))
        scores = np.array([score(f, feats, y) for y in every])
        assert abs(score(f, feats, f.decode(feats)) - scores.max()) < 1e-9
        p = np.exp(scores) / np.exp(scores).sum()
        got, pairs = f.marginals(feats)
        assert np.allclose(got, [sum(q for q, y in zip(p, every) if y[k]) for k in range(n)])
        want = np.zeros((2, 2))
        for q, y in zip(p, every):
            for a, b in zip(y, y[1:]):
                want[a, b] += q
        assert np.allclose(pairs, want)


@pytest.mark.parametrize("page, texts", [
    ("", []), ("plain &amp; text", ["plain & text"]),
    ("<p>a<b>b</b>c<br>d<p>e", ["abc d", "e"]),
    ("<script>var t='</p>x';</script><p>y</p><style>p{}</style>", ["y"]),
    ("<p>a<!-- <p>b</p> -->c</p><!-- open <p>d", ["ac"]),
    ("<div>x<p title='a>b'>y</p>z</div>", ["x", "y", "z"]),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]),
    ("<p>&nbsp; a \n\t b &lt;i&gt; &#x4e2d;&amp</p>", ["a b <i> 中&"]),
    ("<script>never closed <p>a</p>", []), ("<p>a <b", ["a"]), ("<p>1 < 2</p>", ["1 < 2"]),
    ("<title>t</title><textarea>x<p>y</textarea>z", ["x<p>y", "z"]),
    ("</div></p>a</body>b", ["a", "b"]),
    ("<p>Before <svg><text>in</text> it <p>After", ["Before in it", "After"]),
    ("<p>so <math><mi>x</mi>=1</math> holds</p>", ["so x=1 holds"]),
    ("<div>a<noscript>shown without scripts</noscript>b</div>", ["a", "shown without scripts", "b"]),
    ("<p>see <a href=\"x>more text here", ["see more text here"]),
    ("<p>see <a href='x>it</a> and <b class=\"y\">that</b>", ["see it and that"]),
    ("<p>a</p><b title=\"never closed", ["a"]),
    ("<table><tr><td>1<td>2<tr><td><p>3<table><tr><td>4</table>5</table>6",
     ["1", "2", "3", "4", "5", "6"]),
    ("<dl><dt>a<dd>b<p>c<dt>d</dl>", ["a", "b", "c", "d"]),
])
def test_blocks(page, texts):
    assert [b.text for b in m.blocks(page)] == texts


def test_deep_and_long_pages(field):
    deep = "<div class='content'>" * 3000 + "text here." + "</div>" * 3000
    assert [b.text for b in m.blocks(deep)] == ["text here."]
    long = "<article><h1>Title</h1>" + "<p>Some words in a sentence.</p>" * 5000 + "</article>"
    assert m.main_text(long, field).count("Some words") == 5000


@pytest.mark.parametrize("tag", ["blockquote", "form", "p><button", "li><ul", "figure"])
def test_work_grows_with_the_page(tag):
    """Four times the nesting: at most five times the work (counted, not timed)."""
    import sys

    def steps(n):
        page = f"<{tag}>" * n + "text" + "</b></i></h1>" * n
        count = 0

        def on_line(frame, event, arg):
            nonlocal count
            count += event == "line"
            return on_line
        old = sys.gettrace()
        sys.settrace(on_line)
        try:
            m.blocks(page)
        finally:
            sys.settrace(old)
        return count

    assert steps(1200) <= 5 * steps(300)


def test_chrome_goes_article_stays(field):
    page = ("<html><body><header><a href='/'>Site</a></header><nav><ul><li><a href='/a'>A</a></li>"
            "</ul></nav><div class='cookie-notice'>We use cookies.</div><main><h1>Head line</h1>"
            "<p>First paragraph of it.</p><p>Yes.</p></main><aside><h3>Related</h3></aside>"
            "<section class='comments'><p>I do not agree with this at all.</p></section>"
            "<form><label>Mail</label></form><footer>&copy; Site</footer></body></html>")
    assert m.main_text(page, field) == "Head line First paragraph of it. Yes."


def test_edges(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "   "), (2, "u", "   "),
            (3, "u", "<nav><a href=x>m</a></nav>")]
    pages = spark.createDataFrame([(i, u, h, "a", 1, 2, "t") for i, u, h in rows], PAGES)
    got = m.extract(pages).collect()
    assert len(got) == 5 and all(r.text == "" and r.n_chars == 0 for r in got)
    assert m.extract(pages.limit(0)).collect() == []
