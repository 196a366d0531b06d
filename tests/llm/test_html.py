import html
import re

import numpy as np
import pytest
from helpers import clashing

from orbita.llm import common, html_crf as H

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string"


def article(page):
    """The article of this table's layout, cut by patterns."""
    body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(p for p in parts if p)


@pytest.fixture(scope="module")
def chain(spark):
    return H.fit(common.table(spark, SF, "pages"))


def test_pages_that_were_not_trained_on(spark, chain):
    pages = common.table(spark, SF, "pages").toPandas()
    got = H.extract(common.table(spark, SF, "pages"), chain).toPandas().set_index("page_id")
    assert len(got) == len(pages)
    for i, page in zip(pages.page_id, pages.html):
        assert got.text[i] == article(page) and got.n_chars[i] == len(got.text[i])


def test_other_layouts(chain):
    p = "A sentence of the article, long enough to be one. " * 4
    for before, tag, after in [
        ("<header><a>Site</a></header><ul class='main-menu'><li><a>Home</a></li></ul>", "main", "<footer><p>All rights.</p></footer>"),
        ("<div class=cookie-banner><p>We use cookies, as all do.</p></div>", "article",
         f"<div class=reader-comments><p>{p}</p></div><form><p>Sign up for our letter.</p></form>"),
        ("<nav>Home News</nav><div class='sponsored'>Buy this now.</div>", "article", "<aside><p>Popular things, read now.</p></aside>"),
    ]:
        page = f"<html><body>{before}<{tag}><h1>Title here</h1><p>{p}</p><p>Second &amp; last, here.</p></{tag}>{after}</body></html>"
        assert H.main_text(chain, page) == f"Title here\n{p.strip()}\nSecond & last, here."


def test_viterbi_and_marginal_training_against_brute_force():
    rng = np.random.default_rng(4)
    chain = H.Chain(rng.normal(size=(H.FEATURES, 2)), rng.normal(size=(2, 2)))
    for n in range(1, 8):
        rows = [sorted(rng.choice(H.FEATURES, 3, replace=False).tolist()) for _ in range(n)]
        score = {}
        for code in range(2 ** n):
            path = [code >> k & 1 for k in range(n)]
            score[tuple(path)] = sum(chain.weights[r, y].sum() for r, y in zip(rows, path)) + sum(
                chain.pairs[a, b] for a, b in zip(path, path[1:]))
        assert tuple(chain.decode(rows)) == max(score, key=score.get)


def test_training_separates_labelled_pages():
    pages = H.labelled([])
    chain = H.train(pages)
    wrong = sum(a != b for rows, labels in pages for a, b in zip(chain.decode(rows), labels))
    assert wrong <= 0.01 * sum(len(y) for _, y in pages)


def test_blocks():
    blocks = H.leaf_blocks("<!DOCTYPE html><title>no</title><script>var t='</p>';</script><p>a\n  <b>b</b>c<br>d<p>e &lt; f<!-- no <p> -->"
                           "<ul><li>g<li><a href='x>y'>h</a></ul>tail<style>p{}")
    assert [b.text for b in blocks] == ["a bc d", "e < f", "g", "h", "tail"]
    assert blocks[3].linked == 1.0 and blocks[2].path == ["ul", "li"]
    assert [b.text for b in H.leaf_blocks("<p x=it's y='a>b' z>one</p><p title=\"q>r\">two 'quoted'</p>")] == ["one", "two 'quoted'"]
    for odd in ("<", "<p", "</", "<a href=\"", "<!--", "<![CDATA[x", "<script>x", "a<b", "&", "<p>&am", "</p></div>x"):
        H.leaf_blocks(odd)


def test_edges(spark, chain):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>Some text here, yes.</p></article>"),
            (3, "u", "<nav><a>Menu</a></nav>"), (3, "u", "<nav><a>Menu</a></nav>"), (4, "u", "<article><p>cut &am"),
            (5, "u", "<article>" + "<p>One sentence, again. </p>" * 20000 + "</article>")]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "text", "n_chars", "label")
    got = H.extract(df, chain).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == by[3].text == "" and by[None].text == "Some text here, yes."
    assert by[4].text == "cut &am" and by[5].text.count("\n") == 19999
    assert H.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_random_layouts_with_unseen_names(chain):
    rng = np.random.default_rng(8)
    words = [w for w in "the river ran over cold stones, and nobody knew why it was so slow in early spring".split()]

    def say(low, high):
        return " ".join(words[i] for i in rng.integers(0, len(words), rng.integers(low, high))) + "."

    other = ["<ul id='main-nav'><li><a href=x>{t}</a></li><li><a>{t}</a></li></ul>", "<div class=topnav><a>{t}</a></div>",
             "<div id=siteHeader><p>{s}</p></div>", "<div class='gdpr-banner'><p>{p}</p></div>", "<div role=alert>{s}</div>",
             "<div id='ad-slot-3'><a>{s}</a></div>", "<aside class=sponsoredLinks><p>{s}</p></aside>", "<div class=rightSidebar><p>{p}</p></div>",
             "<form class=loginForm><p>{t}</p></form>", "<ol class=commentlist><li>{p}</li><li>{s}</li></ol>",
             "<div class='user-comments'><article><p>{p}</p></article></div>", "<section id='reader-comments'><p>{s}</p></section>",
             "<div class='newsletter-signup'><h3>{t}</h3><p>{s}</p></div>", "<div id=pageFooter><p>{p}</p></div>", "<div hidden><p>{p}</p></div>"]
    wraps = ["article", "main", "div class=content", "div id='article-body'", "div class=post", "article class=story"]
    right = 0
    for _ in range(200):
        body = f"<h1>{say(1, 7)}</h1>" + "".join(f"<p>{say(6, 60)}</p>" for _ in range(rng.integers(1, 7)))
        put = [other[i].format(t=say(1, 5), s=say(6, 25), p=say(25, 80)) for i in rng.integers(0, len(other), 4)]
        wrap = wraps[rng.integers(len(wraps))]
        page = f"<body>{put[0]}{put[1]}<{wrap}>{body}</{wrap.split()[0]}>{put[2]}{put[3]}</body>"
        right += H.main_text(chain, page) == "\n".join(b.text for b in H.leaf_blocks(body))
    assert right >= 190


@pytest.mark.parametrize("outer", [
    'article style="overflow:hidden"', 'article title="The hidden costs"', 'article class="post has-sidebar"', 'article class="post tag-news"',
    'article class="post comment-open"', 'div class="story form-x"', "article class='hentry category-advertising status-publish' data-x='search'",
    "article id=post-77 class='no-comments with-ads'", "main class='layout is-footer-fixed'", 'article aria-label="share this" lang=en',
    "article data-menu='1' onclick=\"hidden()\"", "div class='entry-content sidebar-off'", "article hidden=until-found"])
def test_attributes_that_only_mention_things(chain, outer):
    p = "A sentence of the article, long enough to be one. " * 4
    page = (f"<html><body class='sidebar-right has-menu'><nav><a>Home</a></nav><{outer}><h1>Title here</h1><p>{p}</p><p>Second one, here.</p>"
            f"</{outer.split()[0]}><div class='site-sidebar'><p>Popular things, read now.</p></div><footer><p>All rights.</p></footer></body></html>")
    assert H.main_text(chain, page) == f"Title here\n{p.strip()}\nSecond one, here."


def test_names_are_whole_tokens():
    said = {"sidebar": "side", "main-nav": "menu", "reader-comments": "comment", "commentlist": "comment", "comment-body": "comment",
            "ad-slot-3": "ad", "rightSidebar": "side", "topnav": "menu", "sponsoredLinks": "ad", "siteHeader": "head", "entry-content": "main",
            "article-footer": "foot", "has-sidebar": None, "tag-news": None, "comment-open": None, "form-x": None, "lead": None, "": None,
            "no-comments": None, "discontented": None}
    assert {k: H.group(k) for k in said} == said
    assert H.attributes("div", ' hidden') == (("hide",), "") == H.attributes("p", " style='x:1; display: none'")
    assert H.attributes("div", ' title="hidden sidebar" data-class=menu') == ((), "")
    assert H.attributes("body", " class='menu sidebar'") == ((), "")


def test_drawings_formulas_and_the_rest_of_the_page(chain):
    page = ("<article><h1>Title here</h1><p>One sentence, before it all.</p>{}<p>Another sentence, after it all.</p></article>"
            "<footer><p>All rights.</p></footer>")
    for put, seen in [("<svg width=1/>", []), ("<svg/>", []), ("<math/>", []), ("<svg><path d='M0'/></svg>", []), ("<iframe src=x></iframe>", []),
                      ("<p>The label <svg><text>axis</text></svg> and <math><mi>x</mi><mo>=</mo><mn>1</mn></math> stay, here.</p>",
                       ["The label axis and x=1 stay, here."]),
                      ("<noscript><p>A picture of the river, in spring.</p></noscript>", ["A picture of the river, in spring."]),
                      ("<script/>if (a<b) {}</script><style>p{}</style><template><p>no</p></template>", [])]:
        want = ["Title here", "One sentence, before it all.", *seen, "Another sentence, after it all."]
        assert H.main_text(chain, page.format(put)) == "\n".join(want), put


def test_training_pages_are_whole():
    page = "<article>" + "<p>One sentence, again.</p>" * 100 + "</article><div class=comments><p>Not this.</p></div>"
    rows, labels = H.labelled([page])[-1]
    assert len(rows) == 101 and labels == [1] * 100 + [0]
    long = page.replace("</article>", "<p>One sentence, again.</p>" * 300 + "</article>")
    assert len(H.labelled([page, long])) == len(H.labelled([page]))
