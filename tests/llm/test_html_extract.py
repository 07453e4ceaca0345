import html as H
import re
import time

import pytest

from tessera.llm import html_extract as X


def test_articles_of_the_pages(table):
    rows = {r.page_id: r for r in X.op1_html_extraction(table("pages")).collect()}
    pages = table("pages").collect()
    assert len(rows) == len(pages)
    for p in pages:
        inside = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        parts = [" ".join(H.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:h1|p)>", inside)]
        text = "\n\n".join(x for x in parts if x)
        assert rows[p.page_id].text == text and rows[p.page_id].n_chars == len(text) and rows[p.page_id].url == p.url


PARAGRAPHS = ["First, a long paragraph with text; it goes on, and on, until it ends here.", "Second paragraph, also long enough, with some punctuation: yes, it has."]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)


@pytest.mark.parametrize("layout", [
    "<body><nav><a href=x>Home</a></nav><article>{}</article><footer>Copyright, all rights reserved.</footer></body>",
    "<body><header>Site name, and its motto.</header><main>{}</main><aside>Side text, not short at all, really.</aside></body>",
    "<div id=top-menu><ul><li><a>One</a><li><a>Two</a></ul></div><div class='post'>{}</div><div class='sidebar'><p>Popular posts, and more of them.</p></div>",
    "<div class=wrap><div class=content>{}</div><div id=comments><p>A reader's comment, which is long, and wordy, too.</p></div></div>",
    "<div class=wrap><div class=cookie-notice>We use cookies, as all do.</div>{}<form>Name <input> <button>Send, now</button></form></div>",
    "<div role=navigation>Menu, menu, menu</div><section>{}</section><div class='ad-banner'>Buy this, buy that, buy now!</div><script>if (a < b) '<p>no</p>'</script>",
    "<article class=comment><p>Short, but a comment.</p></article><article>{}<div class=share><a>Share</a> this, please.</div></article><style>p {{ x }}</style>",
    "<table><tr><td><a>Link</a></td><td><a>Link 2</a></td></tr></table><div>{}</div><div><a>more</a> <a>and more</a> <a>links here</a></div>",
])
def test_layouts(layout):
    assert X.main_text(layout.format(BODY)) == "\n\n".join(PARAGRAPHS)


LONGER = [" ".join([p] * 8) for p in PARAGRAPHS] * 3
WHOLE = "<!DOCTYPE html><html lang=en><head><title>T</title></head><body>{}</body></html>"


@pytest.mark.parametrize("layout", [
    "<div><p>Motto</p></div><div><div>{}</div><div>Right column text</div></div><div>Copyright 2024 Someone</div>",
    "<table><tr><td>Left column<td>{}<td>Right column</table><div>Copyright 2024 Someone</div>",
    "<app-root><div>{}</div><div>Copyright 2024 Someone</div></app-root>",
    "{}<div><div>All rights kept</div><div>Made with care</div><div>Version 4</div><div>Call us</div><div>Copyright 2024 Someone</div></div>",
])
def test_unnamed_boilerplate_in_whole_pages(layout):
    text = "".join(f"<p>{p}</p>" for p in LONGER)
    found = X.article_blocks(WHOLE.format(layout.format("<h1>Title</h1>" + text)))
    assert found[:7] == ["Title", *LONGER] and "Copyright 2024 Someone" not in found


def test_short_items_beside_content_stay():
    page = WHOLE.format("<div>" + "".join(f"<p>{p}</p>" for p in LONGER) + "<ul><li>one<li>two</ul><table><tr><td>a<td>b</table></div><div>" + "<div>Version 4</div>" * 6 + "</div>")
    assert X.article_blocks(page) == [*LONGER, "one", "two", "a b"]


@pytest.mark.parametrize("wrapper", [
    "<div class='site has-sidebar'>{}</div>", "<div id=page-header-fixed><div class=ad-free>{}</div></div>", "<form action=x>{}</form>", "<p>A cookie bar, here.</p><div class='side-by-side search'>{}</div>",
])
@pytest.mark.parametrize("element", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
def test_named_wrappers_do_not_swallow_the_article(wrapper, element):
    text = "".join(f"<p>{p} <b>Bold</b> end.</p>" for p in LONGER) + "<span class=share><a>Share</a> this</span>"
    inside = "<nav><a>Home</a></nav>" + element.format(text) + "<div class=sidebar><p>Popular posts, and more of them.</p></div><div id=comments><article><p>A comment, a long one.</p></article></div>"
    assert X.article_blocks(WHOLE.format(wrapper.format(inside))) == [f"{p} Bold end." for p in LONGER]


def test_named_parts_beside_the_article_go():
    cards = "".join(f"<article><p>{p}</p></article>" for p in PARAGRAPHS)
    page = WHOLE.format(f"<div class=post>{BODY * 3}</div><div class=sidebar>{cards}</div><aside class=related>{cards}</aside>")
    assert X.article_blocks(page) == PARAGRAPHS * 3


def test_articles_side_by_side_are_one_text():
    first, second = "".join(f"<p>{p}</p>" for p in LONGER[:3]), "".join(f"<p>{p}</p>" for p in LONGER[3:])
    page = WHOLE.format(f"<nav><a>Home</a></nav><div><article>{first}</article><article>{second}</article><article class=teaser><p>{LONGER[0]}</p></article></div><footer>End.</footer>")
    assert X.article_blocks(page) == LONGER


def test_link_lists_and_linked_quotations_of_the_article_stay():
    page = WHOLE.format(f"<article>{BODY * 3}<ul><li><a href=a>Source one</a><li><a href=b>Source two</a></ul><blockquote><a href=c>A quotation that is one link, all of it.</a></blockquote>{BODY}<ul class=share-buttons><li><a>Share</a></ul></article>")
    assert X.article_blocks(page) == [*PARAGRAPHS * 3, "Source one", "Source two", "A quotation that is one link, all of it.", *PARAGRAPHS]


def test_parts_named_by_ordinary_words_stay():
    parts = "".join(f"<section class='{c}'><p>{c} {LONGER[0]}</p></section>" for c in ("discussion", "share-price", "form-intro", "side-effects", "has-sidebar")) + f"<div id=related-work><p>id {LONGER[1]}</p></div>"
    noise = "<div class='share-this'><p>Share this</p></div><div class=comments-area><p>" + LONGER[0] + "</p></div><div class=share-things-now><a>Go</a></div>"
    for layout in ("<article>{}</article>", "<div>{}</div>"):
        found = X.article_blocks(WHOLE.format(layout.format(f"<p>{LONGER[0]}</p>" + parts + noise)))
        assert found == [LONGER[0], *(f"{c} {LONGER[0]}" for c in ("discussion", "share-price", "form-intro", "side-effects", "has-sidebar")), f"id {LONGER[1]}"]


@pytest.mark.parametrize("before, after", [
    ("<svg><path d=1>", ""), ("<svg><title>x</title><g>", "<p>More, at the end of it.</p><svg></svg>"), ("<select><option>a", ""), ("<audio src=x>", ""), ("<noscript>", ""), ("<iframe src=y>", "")])
def test_unclosed_embedded_elements_are_bounded(before, after):
    found = X.article_blocks(WHOLE.format(f"<article>{before}{BODY * 3}{after}</article>"))
    assert [p for p in found if p in PARAGRAPHS] == PARAGRAPHS * 3 and ("More, at the end of it." in found) == bool(after)


def test_formulas_keep_their_text():
    page = WHOLE.format(f"<article>{BODY}<p>It is <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation encoding=tex>E=m</annotation></math> there, as known.</p>{BODY}</article>")
    assert "It is E=m there, as known." in X.article_blocks(page)


def test_unclosed_inline_elements_take_time_in_proportion():
    started = time.process_time()
    page = "<font>" * 20_000 + "<p>x</p>" * 20_000
    assert len(X.Page(page).blocks) == 20_000
    assert time.process_time() - started < 5


def test_blocks_and_references():
    page = "<article><h2>A &amp; B</h2><p>one<br>two\n  three&nbsp;four <b>bold</b><i>er</i> &lt;tag&gt;</p><ul><li>x, a longer item<li>y, another item</ul><pre>a\n b</pre><!-- no --><p></p></article>"
    assert X.article_blocks(page) == ["A & B", "one two three four bolder <tag>", "x, a longer item", "y, another item", "a b"]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain", "plain"), ("<div><div>", ""), ("a < b", "a < b"), ("<p>x", "x"), ("<!-- never closed <p>x", ""), ("<script>x", ""),
    ("</div></p>stray<p>end", "stray\n\nend"), ("<a href='open>text", "text"), ("<p>x</p><p>x</p>", "x\n\nx"),
])
def test_broken_pages(page, text):
    assert X.main_text(page) == text


def test_long_pages_take_time_in_proportion():
    started = time.process_time()
    for page in ("<a " * 100_000, "<div>" * 30_000 + "x", '<a t="' * 50_000, "<p>" * 50_000, "<b>x" * 30_000, "&amp;" * 200_000):
        X.main_text(page)
    assert time.process_time() - started < 30


def test_path_ratios_prefer_text_to_links():
    page = X.Page("<ul><li><a>one</a><li><a>two</a></ul><div><p>Long text, with commas, and so on.</p><p>More, of the same, here.</p></div>")
    ratio, links, threshold = X.path_ratios(page.blocks)
    link, text = page.blocks[0].path, page.blocks[-1].path
    assert links[link] == 1 and links[text] == 0 and ratio[link] < threshold < ratio[text]


def test_awkward_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "x", "x"), (None, "u", "<p>a</p>", None, None), (1, "u", "", "x", "x"), (1, "u", "", "x", "x"), (2, "u", "<p>" + "word " * 200_000, "x", "x")]
    found = sorted(((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in X.op1_html_extraction(spark.createDataFrame(rows, schema)).collect()), key=str)
    long = ("word " * 200_000).strip()
    assert found == sorted([(1, "", "", 0), (0, "u", "a", 1), (1, "u", "", 0), (1, "u", "", 0), (2, "u", long, len(long))], key=str)
    assert X.op1_html_extraction(spark.createDataFrame([], schema)).count() == 0
