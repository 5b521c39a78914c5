"""Pages without end tags and with wrappers that are named after what they hold besides the article."""

import time

import pytest

from papyrine.llm import html_text

TEXT = "One sentence of the article that is long enough to be taken for text. Another one follows it here."
ARTICLE = f"<article><p>{TEXT}</p></article>"
BEFORE = ["<div class='page has-sidebar'>", "<div class='with-comments'>", "<div class=search-enabled>", "<div id=sidebar-layout>", "<form id=f>"]


@pytest.mark.parametrize(
    "page",
    [
        f"<!doctype html><head><title>T</title><body>{ARTICLE}",
        f"<!doctype html><head><title>T</title><script>x='<p>'</script>{ARTICLE}",
        f"<html><head><title>T</title></head><body>{ARTICLE}",
        *(f"<{name}>{ARTICLE}" for name in "video audio map canvas object noscript template svg".split()),
        f"<video src=a>{ARTICLE}<video>no video</video>",
        f"<article><video>no video</video><p>{TEXT}</p></article><canvas>no canvas</canvas>",
        *(f"{wrapper}{ARTICLE}<div class=comments><article class=comment><p>{TEXT}</p></article></div></div>" for wrapper in BEFORE),
        f"{BEFORE[0]}<main><p>{TEXT}</p><div class=sidebar><article><p>{TEXT}</p></article></div></main></div>",
        f"{BEFORE[0]}<p>{TEXT}</p></div>",
        f"{ARTICLE}<div hidden><article><p>{TEXT}</p></article></div>",
        f"{ARTICLE}<aside><article><p>{TEXT}</p></article></aside>",
    ],
)
def test_the_article_stays_and_nothing_else(page):
    assert html_text.main_text(page, html_text.train()) == TEXT


LONG = " ".join([TEXT] * 8)
WRAPPERS = ["<div class='post comments-open'>", "<div class='content ad-free'>", "<div class='layout sidebar-left'>", "<form action=/>", "<button>", "<section id=promo>"]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("inner", ["<h1>A title of it</h1><p>{0}</p><p>{0}</p>", "<article><h1>A title of it</h1><p>{0}</p><p>{0}</p></article>"])
def test_an_element_that_holds_the_page_is_no_part_of_it(wrapper, inner):
    page = f"<html><body><nav><a href=/>Home</a> <a href=/b>About us</a></nav>{wrapper}{inner.format(LONG)}</div></body></html>"
    assert html_text.main_text(page, html_text.train()) == f"A title of it {LONG} {LONG}"


@pytest.mark.parametrize("page", [f"<title>T<body><p>{LONG}</p>", f"<head><title>T<body>{ARTICLE.replace(TEXT, LONG)}", f"<title>T</title><p>{LONG}</p>"])
def test_a_title_without_an_end_leaves_the_page(page):
    assert html_text.main_text(page, html_text.train()) == LONG


@pytest.mark.parametrize("page", ["<p>Only one line.</p>", "Only one line.", "<nav><a href=/>Home</a></nav><p>Only one line.</p><footer>Owner</footer>", "<div>Only one line."])
def test_short_pages_keep_their_only_block(page):
    assert html_text.main_text(page, html_text.train()) == "Only one line."


@pytest.mark.parametrize("name", ["commentlist", "commentList", "comment-list", "post-comments", "comments-area", "discussionthread", "replies"])
@pytest.mark.parametrize("inner", ["<p>{0}</p><p>{0}</p>", "<article><p>{0}</p><p>{0}</p></article>"])
def test_reader_comments_are_left_out_however_long(name, inner):
    page = f"<body><h1>A title of it</h1>{inner.format(LONG)}<div class='{name}'>" + f"<p>{LONG} so say I</p>" * 9 + "</div>"
    assert "so say I" not in html_text.main_text(page, html_text.train()) and html_text.main_text(page, html_text.train()).endswith(f"{LONG} {LONG}")


def test_names_are_split_into_known_words():
    assert html_text._split("commentlist") == ("comment", "list") and html_text._split("articlebody") == ("article", "body")
    assert html_text._split("unknownname") == ("unknownname",) and html_text._split("navbar") == ("navbar",)
    assert html_text._split("x" * 10_000) == ("x" * 10_000,)


def test_unclosed_elements_take_linear_time():
    start = time.perf_counter()
    for page in ("<svg>" * 50_000, "<video><canvas>" * 30_000, "<svg '" * 50_000, "<head>" * 50_000):
        html_text.main_text(page, html_text.train())
    assert time.perf_counter() - start < 20
