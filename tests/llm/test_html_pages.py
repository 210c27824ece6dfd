"""What hides an element of a page, and what a page's other elements swallow."""

import time

import pytest
from pyspark.sql import functions as F

from tenura.llm import html_extract

ARTICLE = "<article><p>The first paragraph, with some words. It goes on, and ends.</p><p>The second one, as long as the first. It ends too.</p></article>"
TEXT = "The first paragraph, with some words. It goes on, and ends. The second one, as long as the first. It ends too."


def main_text(source):
    return html_extract.main_texts(html_extract.train([]), [source])[0]


@pytest.mark.parametrize("attributes", [
    'class="overflow-hidden"', 'class="hidden-xs"', 'aria-hidden="false"', 'title="the hidden gem"', "data-state=hidden",
    'data-style="display:none"', 'style="overflow:hidden"', 'style="display:none;display:block"', 'aria-label="a hidden b"', "",
])
def test_visible_wrappers_keep_their_text(attributes):
    assert main_text(f"<html><body><div {attributes}>{ARTICLE}</div></body></html>") == TEXT


@pytest.mark.parametrize("attributes", [
    "hidden", "HIDDEN", 'class="a"hidden', 'hidden=""', "hidden='hidden'", 'aria-hidden="true"', "aria-hidden=TRUE",
    'style="display:none"', "style='color:red; DISPLAY : none !important;'", "style=display:none",
    'style="display:none!important;display:block"',
])
def test_hidden_wrappers_give_nothing(attributes):
    assert main_text(f"<html><body><div {attributes}>{ARTICLE}</div></body></html>") == ""


@pytest.mark.parametrize("tag", [
    '<svg class="i"/>', "<svg/>", "<svg />", '<svg aria-label="a > b"/>', "<svg class=i/>", '<SVG hidden\n/>', "<template/>", '<object data="x"/>', "<title/>", '<iframe src="x"/>',
    "<title-bar>", '<select-box class="x">', "<object-view></object-view>", "<svg-icon/>",
])
def test_self_closed_and_custom_elements_swallow_nothing(tag):
    name = tag.strip("<>").split()[0].split(">")[0].rstrip("/")
    assert main_text(f"<html><body>{tag}{ARTICLE}</body></html>") == TEXT
    assert main_text(f"<html><body>{tag}{ARTICLE}<{name}>x</{name}></body></html>").startswith(TEXT)


@pytest.mark.parametrize("element", [
    "<svg>words</svg>", '<svg class="i"><path d="m"/>words</svg>', "<script>if (a < b) words()</script>", '<iframe src="a/b">words</iframe>',
    '<select\nname="x"><option>words</option></select >', '<object data="/">words</object>', '<svg data-x="/>">words</svg>', "<TITLE>words</title>",
])
def test_whole_elements_are_still_left_out(element):
    assert main_text(f"<html><body>{element}{ARTICLE}</body></html>") == TEXT


@pytest.mark.parametrize("comment", ["<!-->", "<!--->", "<!-- a --!>", "<!-- a > b -->", "<!---->", "<!-- - -- >-->", "<!-- <p>no</p> -->"])
def test_comments_end_where_they_end(comment):
    assert main_text(f"<html><body>{comment}{ARTICLE}</body></html>") == TEXT


def test_open_comment_goes_to_the_end():
    assert main_text(f"<html><body>{ARTICLE}<!-- never closed <p>It isn't text.</p>") == TEXT


@pytest.mark.parametrize("attributes", [
    "class='a''", "class=\"a\"\"", "title='it''s'", "'", '"', "class=a'b", "a='x>y'", 'a = "x>y"', "href=/a?b='x", "a='b'c='d'", "=", "a==", "a=", 'a="b"/"', "a='<b>'",
])
def test_stray_quotes_stay_inside_the_tag(attributes):
    body = ARTICLE.replace("<p>", f"<p {attributes}>")
    assert main_text(f"<html><body>{body}</body></html>") == TEXT
    told = ARTICLE.replace("first", "author's").replace("<p>", f"<p {attributes}>")
    assert main_text(f"<html><body>{told}</body></html>") == TEXT.replace("first", "author's")


@pytest.mark.parametrize("page", [
    "<div>" * 20_000 + "</b>" * 20_000, "<p><div>" + "<i>" * 20_000 + "<p>" * 20_000, "<b>x" * 20_000, "<li><div>" * 20_000,
    '<a href="' * 20_000, "<a b='" * 20_001, "<!--" * 20_000, "<svg " * 20_000,
])
def test_parsing_takes_time_in_proportion(page):
    start = time.perf_counter()
    html_extract.parse(page)
    assert time.perf_counter() - start < 5


def test_closing_agrees_with_a_walk_up_the_stack():
    """The places kept for open elements give the same tree as looking at every open element."""
    import random

    rng = random.Random(5)
    names = ["p", "li", "ul", "div", "td", "tr", "table", "b", "dt", "dl", "section"]

    def walk(page, stack, places, tags, until, every=False):
        cut = None
        for depth in range(len(stack) - 1, 0, -1):
            name = page.tag[stack[depth]]
            if name in tags:
                cut = depth
                if not every:
                    break
            elif name in until:
                break
        if cut is not None:
            del stack[cut:]

    fast = html_extract._close
    for _ in range(300):
        source = "".join(f"<{rng.choice(['', '', '/'])}{rng.choice(names)}>x" for _ in range(rng.randrange(60)))
        got = html_extract.parse(source)
        try:
            html_extract._close = walk
            want = html_extract.parse(source)
        finally:
            html_extract._close = fast
        assert got == want


def test_odd_tables(spark):
    """Empty table, repeated rows, null ids and columns of clashing names; a page of two million characters."""
    words = "Some words of a sentence, and some more. "
    long = "<article><p>" + words * 50_000 + "</p></article>"
    rows = [(1, "u", ARTICLE, "t", 9), (1, "u", ARTICLE, "t", 9), (None, None, None, None, None), (2, "v", "", "t", 1), (3, "w", long, "t", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    model = html_extract.fit(pages)
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html_extract.extract(pages, model).collect()), key=repr)
    whole = (words * 50_000).strip()
    assert got == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0), (2, "v", "", 0), (3, "w", whole, len(whole))], key=repr)
    none = pages.where(F.lit(False))
    assert html_extract.extract(none, html_extract.fit(none)).count() == 0
