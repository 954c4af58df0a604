import html
import re
import time
from itertools import product

import numpy as np
import pytest

from pluvia.llm import html_extract as H
from pluvia.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string"


def test_whole_pages_table_equals_the_marked_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op7_html_extract"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", body))).split())
        assert r.text == want and r.n_chars == len(want) and r.url == pages[r.page_id].url


def chain(seed, n=5):
    rng = np.random.default_rng(seed)
    crf = H.Crf(rng.standard_normal((len(H.FEATURES), 2)), rng.standard_normal((2, 2)))
    return (rng.random((n, len(H.FEATURES))) < 0.3).astype(float), rng.integers(0, 2, n), crf


def path_score(x, y, crf):
    e = x @ crf.state
    return sum(e[i, y[i]] for i in range(len(y))) + sum(crf.transition[a, b] for a, b in zip(y, y[1:]))


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_and_likelihood_equal_enumeration(seed):
    x, y, crf = chain(seed)
    scores = {p: path_score(x, p, crf) for p in product((0, 1), repeat=len(x))}
    assert tuple(H.viterbi(x, crf)) == max(scores, key=scores.get)
    z = np.log(sum(np.exp(s) for s in scores.values()))
    value, gw, gt = H.gradient(x, y, crf)
    assert value == pytest.approx(scores[tuple(y)] - z)
    for table, grad in ((crf.state, gw), (crf.transition, gt)):
        for i in [(0, 0), (1, 1)]:
            old = table[i]
            table[i] = old + 1e-5
            up = H.gradient(x, y, crf)[0]
            table[i] = old
            assert (up - value) / 1e-5 == pytest.approx(grad[i], abs=1e-3)


ODD = ('<html><head><title>T</title><style>p{}</style></head><body class="page"><header><p>Site of things, all of them.</p></header>'
       '<nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav><!-- <p>hidden</p> -->'
       '<{main}><h1>Big &amp; bold</h1><p>First para&nbsp;with <b>bo</b>ld words, enough of them to be read.'
       '<p title="a > b">Second   one\n\n goes on &lt;here&gt; for a while too.<br>After the break.</p>'
       '<script>document.write("<p>no</p>")</script><table><tr><td>Cell one is a sentence.<td>Cell two is a sentence.</table>'
       '<div class="ad-box"><p>Buy this now, it is cheap.</p></div>'
       '<form><label>Mail</label><button>Go</button></form>'
       '<section id="comments"><p>Reader: I do not agree with any of this at all.</p></section></{main}>'
       '<aside><p>See also these other pages of ours.</p></aside><footer>&copy; 2020 all rights</footer></body></html>')
WANT = ("Big & bold First para with bold words, enough of them to be read. Second one goes on <here> for a while too. "
        "After the break. Cell one is a sentence. Cell two is a sentence.")


@pytest.fixture(scope="module")
def crf(spark):
    return H.fit(spark.read.parquet(f"{SF}/pages.parquet"))


@pytest.mark.parametrize("main", ["article", "main", "div"])
def test_other_templates(crf, main):
    assert H.main_text(ODD.replace("{main}", main), crf)[0] == WANT


def test_awkward_pages(spark, crf):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "  \n "), (4, "u", "<p>"), (None, "u", ODD.replace("{main}", "article")),
            (5, "u", "<article>" + "<p>Some words stand in this very long page.</p>" * 4000 + "</article>"),
            (6, "u", "<a <b < c > \"quote <p>text</div></p></p>"), (6, "u", "<a <b < c > \"quote <p>text</div></p></p>"),
            (7, "u", "plain words without any markup, but quite a few of them, in one sentence."),
            (8, "u", "<div>" * 3000 + "deep"), (9, "u", "<script>only</script><style>x</style>")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], PAGES + ", text string").withColumnRenamed("text", "n_chars")
    got = H.extract(pages, crf).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == by[3] == by[4] == by[9] == ""
    assert by[None] == WANT and by[5].count("Some words") == 4000


@pytest.mark.parametrize("odd", ["<div>x", "<b>", "<a '", "<a \"'", "</ ", "<!--", "<a<a", "<p><a>", "<td>x", "<script ", "<q a='"])
def test_unclosed_markup_takes_linear_time(odd):
    start = time.process_time()
    H.blocks(odd * 200_000)
    assert time.process_time() - start < 20


def test_quotes_and_tags_that_never_end_are_text():
    text = lambda page: [b.text for b in H.blocks(page)]
    assert text("<p>a < b <c 'd</p>e") == ["a < b <c 'd", "e"]
    assert text("<p title='x > y'>a</p><p title=\"it's\">b</p>") == ["a", "b"]
    assert text("a <!-- b <p>c") == ["a"]
    assert text("a<script >b</p>c</SCRIPT >d") == ["ad"]
    assert text("<ul><li>a<li>b<table><tr><td>c<td>d<tr><td>e</table>f</ul>g") == ["a", "b", "c", "d", "e", "f", "g"]


def test_empty_table_and_unmarked_pages(spark):
    none = spark.createDataFrame([], PAGES)
    crf = H.fit(none)
    assert H.extract(none, crf).count() == 0
    page = "<nav><a href=x>Home</a></nav><div><p>One plain sentence stands here.</p></div>"
    pages = spark.createDataFrame([(1, "u", page)], PAGES)
    assert H.extract(pages, H.fit(pages)).first().text == "One plain sentence stands here."


@pytest.mark.parametrize("other", ["<p>a plain page of words</p>", "<!-- <article> --><p>a plain page of words</p>"])
def test_rare_marks_are_all_learned_from(spark, other):
    marked = "<nav><a href=x>home</a></nav><article><p>the text of the article itself</p></article><footer>end</footer>"
    rows = [(i, "u", marked if i == 7 else other) for i in range(400)] + [(None, None, None)]
    crf = H.fit(spark.createDataFrame(rows, PAGES), fit_pages=2)
    assert np.abs(crf.transition).max() > 0  # the hand-set signs have no transitions
