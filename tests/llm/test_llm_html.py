import html
import re
import time

import numpy as np
import pytest
from helpers import empty_like, with_clashes

from curato.llm import html_extract as H
from curato.llm.common import table

TREE = H.train()


def test_tree_fits_its_table():
    rows = np.array([x.split() for x in H.LABELLED.strip().splitlines()], dtype=float)
    assert (((H.judge(TREE, rows[:, :-1]) >= 0.5) == rows[:, -1]).mean()) > 0.97


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<p></p>", ""), ("plain &lt;words&gt; here", "plain <words> here"),
    ("<article><p>One<b>two</b> three</p><p>four\n five</p></article>", "Onetwo three four five"),
    ("<article>a < b and c &amp;lt; d</article>", "a < b and c &lt; d"),
    ("<article><p>open <i>tags<p>never <b>closed", "open tags never closed"),
    ("</div></p><article></section>kept text</article></article>", "kept text"),
    ("<article><p title='a > b'>x</p><p data-x=\"</article>\">y</p></article>", "x y"),
    ("<article>t<script>var a = '<p>no</p>';</script>u<style>p{}</style>v<!-- <p>no --> w</article>", "tuv w"),
    ("<article>t<script>never closed <p>no</p></article>", "t"),
    ("<nav><a>menu</a></nav><article>x</article><footer>foot</footer>", "x"),
    ("<main><h1>Title</h1><p>y</p></main><aside><p>" + "side words " * 30 + "</p></aside>", "Title y"),
    ("<article>x<div class='comments'><p>" + "so true " * 40 + "</p></div>y</article>", "x y"),
    ("<div id=cookie-notice>" + "we use cookies " * 20 + "</div><article>z</article>", "z"),
    ("<article>q<form><label>Name</label><select><option>A</select></form>r</article>", "q r"),
    ("<div class='with sidebar'><article>in</article><p>out</p></div>", "in"),
    ("<article><p>&nbsp;a&#233;&eacute;&#x1F600;&unknown; </p></article>", "aéé😀&unknown;"),
])
def test_pages(page, text):
    assert H.main_text(page, TREE) == text


@pytest.mark.parametrize("page, text", [
    ("<article><p>one</p><svg class=\"i\"/><p>two</p></article>", "one two"),
    ("<article><p>one</p><svg class='i' data-x='a>b' /><p>two</p></article><svg><text>no</text></svg>", "one two"),
    ("<article><p>one</p><svg-icon></svg-icon><p>two</p><p>three</p></article>", "one two three"),
    ("<article><select-menu>a</select-menu><title-bar>b</title-bar><object-viewer>c</object-viewer></article>", "a b c"),
    ("<article><p>one</p><svg><path d=''><p>two</p></article>", "one two"),
    ("<article><p>one<svg><title/><g><svg><text>no</text></svg></g><text>no</text></svg>s</p><p>two</p></article>", "ones two"),
    ("<article><p>one</p><svg><foreignObject><p>no</p></foreignObject><desc>no</desc></svg><p>two</p></article>", "one two"),
    ("<main><article>one<object data=x>no</article>two<noscript>no</main>", "one two"),
    ("<article>one<object><object>no</object>no</object>two<template><div>no</div></template>three</article>",
     "onetwothree"),
    ("<article>one<noscript></noscript>two<script>no</script >three</article>", "onetwothree"),
    ("<article>one<iframe>no</article>", "one"),
])
def test_skipped_elements_end_where_html_ends_them(page, text):
    assert H.main_text(page, TREE) == text


@pytest.mark.parametrize("page, text", [
    ("<article><p class=\"ad\">buy<p>real text<p>more</article>", "real text more"),
    ("<article><p class=ad>buy<p>real</p>more</article>", "real more"),
    ("<article><p class=ad>buy<div>real</div></article>", "real"),
    ("<article><p class=ad>buy <b>now <span>here<h2>real</h2>text</article>", "real text"),
    ("<article><p class=ad>buy<button><p>no</p></button>no<p>real</article>", "real"),
    ("<article><p>one<noscript><p>no</p></noscript>s<p>two</article>", "ones two"),
    ("<article><ul><li class=ad>buy<li>one<li><p>two</ul>three</article>", "one two three"),
    ("<article><ul><li class=ad>buy<ul><li>no</li></ul>no<li>one</ul>two</article>", "one two"),
    ("<article><ul><li class=ad><div>buy<li>one</ul></article>", "one"),
    ("<article><dl><dt class=ad>buy<dd>one<dd class=ad>buy<dl><dd>no</dl>no<dt>two</dl></article>", "one two"),
    ("<article><table><tr><td class=ad>buy<td>one<tr class=ad><td>buy<tr><th>two</table></article>", "one two"),
    ("<article><table><tr><td class=ad>buy<table><tr><td>no<tr><td>no</table>no<td>one</table></article>", "one"),
    ("<article><table><thead class=ad><tr><td>buy<tbody><tr><td>one</table></article>", "one"),
    ("<article><datalist><option class=ad>buy<option>one</datalist></article>", "one"),
    ("<article><h2 class=ad>buy<h3>one</h3>two</article>", "one two"),
    ("<article><h2 class=ad>buy</h3>one</article>", "one"),
])
def test_implied_end_tags(page, text):
    assert H.main_text(page, TREE) == text


PROSE = "this paragraph has many plain words in it and goes on for a while"


@pytest.mark.parametrize("name", [
    "id=discussion", "id='related-work'", "id=legal-framework", "id=search-algorithms", "class='post no-comments'",
    "data-class=ad", "data-id='comments'", "title='a class=ad b'", "id=cookies", "class=discussion",
    "aria-label='Search and recommendations'"])
def test_article_text_in_named_elements_stays(name):
    page = f"<article><p>x</p><section {name}><h2>Work</h2><p>{PROSE}</p><p>short</p></section>y</article>"
    assert H.main_text(page, TREE) == f"x Work {PROSE} short y"
    page = f"<div {name}><p>{PROSE}</p><p>{PROSE}</p></div>"
    if name != "id=cookies":
        assert H.main_text(page, TREE) == f"{PROSE} {PROSE}"


@pytest.mark.parametrize("name", [
    "class=ad", "class='box comments'", "role=search", "role=complementary", "class=\"x\"id=y role=banner"])
def test_sure_names_veto_in_an_article(name):
    assert H.main_text(f"<article>x<div {name}><p>{PROSE}</p></div>y</article>", TREE) == "x y"


@pytest.mark.parametrize("name", ["id=related-posts", "class=related", "class='share-links'", "id=discussion"])
def test_links_under_a_name_in_doubt_are_left_out(name):
    page = f"<article><p>{PROSE}</p><div {name}><h3>More</h3><ul><li><a>one two</a><li><a>three</a></ul></div></article>"
    assert H.main_text(page, TREE) == PROSE
    page = f"<article><p>{PROSE}</p><div {name}><a>one two</a></div><p>{PROSE}</p></article>"
    assert H.main_text(page, TREE) == f"{PROSE} {PROSE}"


@pytest.mark.parametrize("name", ["id=cookie-notice", "class=comment-list", "id=ad-1", "class=newsletter-form"])
def test_sure_names_veto_outside_an_article(name):
    assert H.main_text(f"<div {name}><p>{PROSE}</p></div><div><p>{PROSE} too</p></div>", TREE) == f"{PROSE} too"


def test_implied_end_tags_take_linear_time():
    for inner in ("<div>", "</li>", "</p>", "<p>", "<li>", "<td>", "<h2>", "</h2>", "<x-y>"):
        page = "<article>x<ul><li><p><button>" + "<div>" * 50_000 + inner * 50_000
        assert H.main_text(page, TREE) == "x"


def test_unclosed_skipped_elements_take_linear_time():
    for tag in ("svg", "object", "noscript", "select", "template", "title"):
        assert H.main_text("<article>x</article>" + f"<{tag}>" * 50_000, TREE) == "x"
    assert H.main_text("<article>" + "<svg/>x" * 50_000, TREE) == "x" * 50_000


def test_page_without_article_by_words_and_links():
    prose = "this paragraph has many plain words in it and goes on for a while " * 2
    page = f"<ul><li><a href=1>a</a><li><a href=2>b</a></ul><div><p>{prose}</p><p>{prose}</p></div><ul><li><a>c</a><li><a>d</a></ul>"
    assert H.main_text(page, TREE) == " ".join([prose.strip()] * 2)


def test_long_and_deep_pages_take_linear_time():
    deep = "<article>" + "<div>" * 100_000 + "x" + "</div>" * 100_000 + "</article>"
    assert H.main_text(deep, TREE) == "x"
    flat = "<article>" + "<p>word</p>" * 50_000 + "</article>"
    assert len(H.main_text(flat, TREE)) == 5 * 50_000 - 1
    assert H.main_text("<a =\"" * 20_000, TREE) is not None


def test_query_on_the_table_and_odd_tables(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in table(spark, sf, "pages").collect()}
    rows = H.op9_html_extract(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: "" if "b>" in m[0] else " ", body)).split())
        assert r.text == want and r.n_chars == len(want)
    odd = spark.createDataFrame([(1, None, None), (None, "u", ""), (1, None, "<article>x</article>")],
                                "page_id long, url string, html string")
    got = H.extract_pages(with_clashes(odd, "text", "n_chars"), TREE).collect()
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0), ("", 0), ("x", 1)]
    assert H.extract_pages(empty_like(odd), TREE).count() == 0


@pytest.mark.parametrize("name", [
    "class=comment-list", "class=comments-area", "class=post-comments", "class=user-comments", "class=cookie-banner",
    "class=cookie-consent", "class=gdpr-notice", "class=ad-slot", "class=advert-box", "class=google-ad",
    "class=sponsored-content", "class=newsletter-signup", "class=share-buttons", "class=related-posts", "id=comments",
    "class=adsbygoogle", "class=werbung", "class=kommentare", "class='x user_comments'"])
def test_compound_names_are_left_out_inside_and_outside_an_article(name):
    other = " ".join(["words of somebody else that run on"] * 4)
    page = f"<article><p>{PROSE}</p><div {name}><p>{other}</p></div><p>{PROSE}</p></article>"
    assert H.main_text(page, TREE) == f"{PROSE} {PROSE}"
    page = f"<div><p>{PROSE}</p><p>{PROSE}</p></div><div {name}><p>{other}</p></div>"
    assert H.main_text(page, TREE) == f"{PROSE} {PROSE}"


@pytest.mark.parametrize("name", ["id=cookies", "id=advertising", "id=newsletter", "class=notice", "class=legal-notice",
                                  "class=ad-hoc-methods", "class=commented", "aria-label=comments"])
def test_names_that_passages_carry_keep_their_text(name):
    page = f"<article><p>{PROSE}</p><section {name}><p>{PROSE}</p></section><p>{PROSE}</p></article>"
    assert H.main_text(page, TREE) == " ".join([PROSE] * 3)


@pytest.mark.parametrize("page, text", [
    ("<form><nav><a>menu</a></nav><article><p>one</p><p>two</p></article></form>", "one two"),
    (f"<form id=aspnet><div><p>{PROSE}</p><p>{PROSE}</p></div></form>", f"{PROSE} {PROSE}"),
    (f"<article>{PROSE}<form><p>your mail address</p></form></article>", PROSE),
    (f"<div><p>{PROSE}</p><p>{PROSE}</p></div><form>sign in</form>", f"{PROSE} {PROSE}"),
    (f"<form>search</form><form><main>{PROSE}</main></form><form>mail</form>", PROSE),
    ("<form><form><article>x</article>", "x"),
])
def test_a_form_around_the_page_is_no_form_in_it(page, text):
    assert H.main_text(page, TREE) == text


@pytest.mark.parametrize("unit", ["<a x ", '<a ="', "<a b='", "<!-", "<a <b ", "</", "<p x=\">"])
@pytest.mark.parametrize("end", ["", ">", "\">", "'>"])
def test_tags_without_an_end_take_linear_time(unit, end):
    def seconds(n):
        began = time.perf_counter()
        H.main_text("<article>x</article>" + unit * n + end, TREE)
        return time.perf_counter() - began

    seconds(1000)
    times = [min(seconds(n) for _ in range(2)) for n in (20_000, 40_000, 80_000)]
    for a, b in zip(times, times[1:], strict=False):
        assert b < 3 * a + 0.05


def test_text_after_a_tag_without_end_is_read():
    assert H.main_text("<article><p>one</p><p>two <a href='x", TREE).startswith("one two")
    assert H.main_text("<article><p>one</p><p class=\"x>two</p><p>three</p></article>", TREE).startswith("one")
