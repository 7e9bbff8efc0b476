"""Ordinary markup around whole articles."""

from __future__ import annotations

import pytest

from wearline.llm import html_text

FIRST = "The river rose in the night and by the morning all of the lower town stood under brown water, the mayor said."
BODY = f"<h1>Flood</h1><p>{FIRST}</p><p>She left.</p>"
WANT = f"Flood\n{FIRST}\nShe left."


@pytest.mark.parametrize("name", ["content with-sidebar", "entry-content no-sidebar", "post tag-news", "post-content has-comments"])
def test_modifier_classes_are_no_surroundings(name):
    page = f"<body><nav><a href=x>Home</a></nav><div class='{name}'>{BODY}</div><footer>us</footer>"
    assert html_text.main_text(page) == WANT


def test_article_inside_an_element_named_as_surroundings():
    assert html_text.main_text(f"<body><div class='sidebar-layout'><div class='content'>{BODY}</div></div>") == WANT
    inner = f"<div class='content'>{BODY}<div class='comments'><div class='text'>{'Nice post. ' * 3}</div></div></div>"
    assert html_text.main_text(f"<body><div class='nav-page'>{inner}</div>").startswith(WANT)


def test_class_is_no_veto_for_long_text():
    text = "word " * 89 + "end."
    assert html_text.main_text(f"<body><div class='banner-page'><p>{text}</p></div>") == text
    for short in ("We use cookies. Accept them all?", "Long text in the sidebar that goes on and on."):
        assert html_text.main_text(f"<body><div class='sidebar'><p>{short}</p></div><article>{BODY}</article>") == WANT


def test_comments_stay_out():
    note = "I was there too and I can tell that the water came much faster than the mayor says it did."
    page = f"<article>{BODY}</article><div id='comments'><article class='comment-body'><p>{note}</p></article></div>"
    assert html_text.main_text(page) == WANT


@pytest.mark.parametrize("head", ["<head><title>T</title><body>", "<head><meta charset=x><title>T</title><script>a</script>",
                                  "<head><title>T</title></head><body>"])
def test_head_without_end(head):
    assert html_text.main_text(f"<html>{head}<article>{BODY}</article>") == WANT


def test_page_in_one_form():
    page = f"<body><form id=aspnetForm><input type=hidden><article>{BODY}</article></form><form><p>Your name</p><input></form>"
    assert html_text.main_text(page) == WANT
    assert html_text.main_text("<article><form><label>Name</label><p>Send it</p><select><option>a</select></form></article>") == ""


LONG = "word " * 70 + "end."


@pytest.mark.parametrize("mark", ["id='comments'", "class='comment-list'", "class='reader-comments'", "id='disqus_thread'",
                                  "class='cookie-notice'", "class='sidebar'", "class='ad-box'", "class='newsletter-signup'"])
def test_surroundings_of_any_length_stay_out(mark):
    part = f"<div {mark}><p>{LONG}</p><div class='text'><p>{LONG}</p></div></div>"
    assert html_text.main_text(f"<body><article>{BODY}</article>{part}") == WANT
    assert html_text.main_text(f"<body><article>{BODY}{part}</article>") == WANT


@pytest.mark.parametrize("around", ["<div class='legal'>{}</div>", "<div class='post search-results-story'>{}</div>",
                                    "<main id='main'><section class='related-work'>{}</section></main>"])
def test_names_that_describe_an_article(around):
    assert html_text.main_text(f"<body>{around.format(BODY)}") == WANT


@pytest.mark.parametrize(("inner", "want"), [
    ("where <math><mi>x</mi><mo>=</mo><mn>1</mn></math> is big", "where x=1 is big"),
    ("take <svg><g><path d=''></g></svg>it", "take it"), ("take <button>Go</button>it", "take it"),
    ("take <select><option>a</option></select>it", "take it"), ("take <script>if (a<b) c</script>it", "take it")])
def test_a_paragraph_stays_one_line(inner, want):
    assert html_text.main_text(f"<article><p>We {inner}, my friend.</p></article>") == f"We {want}, my friend."


@pytest.mark.parametrize("part", ["<div>a", "<b ", "<a \">\" ", "<form>a<p>", "<span>a", "<span></p>",
                                  "<div class='sidebar-layout'><div class='content'>a"])
def test_time_grows_with_the_page(part):
    import time
    start = time.process_time()
    html_text.main_text(part * 30_000 + "<p>end")
    assert time.process_time() - start < 15
