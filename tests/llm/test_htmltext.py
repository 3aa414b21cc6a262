"""Main text of pages: a maximum-scoring subsequence."""

import html
import random
import re

import pytest

from rankforge.llm import htmltext as H

SCHEMA = "page_id long, url string, html string, text int"


def plain(page):
    """The article of the test tables' pages by pattern."""
    m = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", re.sub("<br>", " ", re.sub("</?b>", "", m[1]))) if m else []
    texts = [" ".join(html.unescape(b).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_equals_the_marked_article_of_the_table(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    got = H.main_text(pages).collect()
    assert len(got) == len(want) and all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize("page,text", [
    ('<body><nav><a href=x>Home</a></nav><div id="content"><p>Hello big world of words.</p><p>Second &amp; third&nbsp;para '
     '<b>bold</b>.</p></div><div class="comments"><p>I think so too, says a reader</p></div><footer>c</footer>',
     "Hello big world of words.\n\nSecond & third para bold."),
    ("plain text only", "plain text only"),
    ("<p>a<p>b", "a\n\nb"),
    ('<article><header><h1>Title</h1></header><p>x y z</p><div class="ad">buy now</div><p>w</p><form>name <input></form></article>',
     "Title\n\nx y z\n\nw"),
    ('<header>Site</header><article><p>one<br>two\n  three</p></article><aside>side</aside>', "one two three"),
    ("<script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes", "yes"),
    ('<div class="sidebar"><article><p>kept</p></article></div>', "kept"),
    ('<p hidden>no</p><p style="display: none">no</p><p>yes</p>', "yes"),
    ("<a title='a>b'>z</a> t &lt;b&gt; &#233; &eacute;", "z t <b> é é"),
    ('<p class="', ""), ("<script>x", ""), ("<", "<"), ("", ""), ("<ul><li>one</li><li>two</li></ul>", "one\n\ntwo"),
])
def test_default_weights(page, text):
    assert H.extract(page, H.Weights()) == text


def test_region_is_the_best_run():
    rng = random.Random(6)
    for _ in range(300):
        s = [rng.choice([-3, -1, -0.5, 0, 1, 2]) for _ in range(rng.randint(0, 12))]
        a, b = H.region(s)
        best = max((sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=0)
        assert sum(s[a:b]) == max(best, 0)


def test_edges_keep_rows(spark):
    rows = [(1, None, None, 1), (2, "u", "", 2), (None, "u", "<p>hi there", 3), (2, "u", "", 2),
            (4, "u", "<article>" + "<p>word word" * 30000 + "</article>", 4)]
    found = H.main_text(spark.createDataFrame(rows, SCHEMA), H.Weights())
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id, r.text[:20], r.n_chars) for r in found.collect()), key=str)
    assert got == sorted([(1, "", 0), (2, "", 0), (2, "", 0), (None, "hi there", 8),
                          (4, "word word\n\nword word", 30000 * 11 - 2)], key=str)
    empty = spark.createDataFrame([], SCHEMA)
    assert H.main_text(empty).count() == 0


def test_weights_come_from_labelled_pages(spark):
    pages = [(k, "u", "<div class=box>promo promo</div><article><p>" + "good words " * 9 + "</article><div class=box>more</div>", 0)
             for k in range(10)]
    w = H.learn(spark.createDataFrame(pages, SCHEMA))
    assert w.word["article"] > 0 > w.word["div.box"] and all(v <= H.LEAST for v in w.tag.values())
    unlabelled = "<body><p>" + "good words " * 9 + "</p><div class=box>promo promo</div></body>"
    assert H.extract(unlabelled, w) == ("good words " * 9).strip()


_BODY = "<p>The first paragraph of this page has quite a few words.</p><ul><li>a point</li><li>another point</li></ul>"
_TEXT = "The first paragraph of this page has quite a few words.\n\na point\n\nanother point"


@pytest.mark.parametrize("page", [
    f"<body class='single no-sidebar'>{_BODY}</body>",
    f"<article class='post comments-open'>{_BODY}</article>",
    f"<div class='post with-comments'>{_BODY}</div>",
    f"<body class='ad-free'><main id='main-notice'>{_BODY}</main><div class='sidebar'>links links</div></body>",
    f"<div id='page' class='wrapper has-sidebar'><div class='content'>{_BODY}</div><div class='comments'>nice one</div></div>",
])
def test_names_of_a_page_or_wrapper_do_not_drop_it(page):
    assert H.extract(page, H.Weights()) == _TEXT


def test_furniture_stays_out_however_long_it_is():
    talk = "<p>a reader writes a very long reply indeed</p>" * 20
    page = f"<div class='content'>{_BODY}</div><div class='comments'>{talk}</div><div class='cookie notice'>{talk}</div>"
    assert H.extract(page, H.Weights()) == _TEXT


def test_words_of_an_element_with_negative_weight_stay_in_the_region():
    page = f"<article>{_BODY}<section><p>a part seen outside of articles mostly</p></section>{_BODY}</article>"
    found = H.extract(page, H.Weights(word={"section": -1.0}))
    assert found == f"{_TEXT}\n\na part seen outside of articles mostly\n\n{_TEXT}"


def test_formulas_and_fallback_text_stay():
    assert H.extract("<p>as <math><mi>x</mi></math> grows <object data=f>a picture of it</object></p>", H.Weights()) == (
        "as x grows a picture of it")
