"""Pages whose main part looks like furniture by its class, and deep pages."""

from __future__ import annotations

import pytest

from emberlog.llm import html

STORY = "<h1>Title</h1><p>" + "Many words of a story that goes on and on. " * 6 + "</p><p>And it ends here.</p>"


def text(page: str) -> str:
    root = html.parse(page)
    return html.extract(root, None)


@pytest.mark.parametrize("opening, closing", [
    ('<div class="has-sidebar">', "</div>"), ('<div class="no-comments">', "</div>"), ('<div class="subscribe-wrap">', "</div>"), ('<div class="share-price">', "</div>"),
    ('<form id="aspnetForm">', "</form>"), ('<div class="page with-nav"><form><div id="side-by-side">', "</div></form></div>"),
    ('<div class="social"><main>', "</main></div>"), ('<div class="promo"><article>', "</article></div><p>x</p>" + "<p>tiny</p>"),
])
def test_main_parts_stay_whatever_their_class(opening, closing):
    page = f"<html><body><nav>Home</nav>{opening}{STORY}{closing}<footer>(c)</footer></body></html>"
    got = text(page)
    assert got.startswith("Title\n\nMany words") and "And it ends here." in got and "Home" not in got and "(c)" not in got


@pytest.mark.parametrize("extra", [
    '<div class="comments"><article>' + "<p>First! Great story, thanks. I agree with all of it and more.</p>" * 20 + "</article></div>",
    '<div class="sidebar"><p>Side</p></div>', '<section class="related"><article><p>Read this too</p></article></section>', '<form><p>Your mail</p><input></form>',
    '<div class="cookie-banner"><p>We use cookies</p></div>', '<div id="newsletterSignup"><p>Sign up</p></div>',
])
def test_furniture_goes(extra):
    plain = text(f"<html><body><article>{STORY}</article></body></html>")
    assert text(f"<html><body><article>{STORY}</article>{extra}</body></html>") == plain


@pytest.mark.parametrize("depth", [5, 13, 40])
def test_containers_of_deep_pages_have_paths_of_their_own(depth):
    page = "<body>" + "<div>" * depth + f'<div class="a"><div>{STORY}</div></div><div class="b"><div><p>A teaser of few words.</p></div></div>' + "</div>" * depth + "</body>"
    assert "teaser" not in text(page) and "And it ends here." in text(page)
    assert max(len(n.path) for n in html.walk(html.parse(page))) < 200


def test_a_page_of_some_megabytes():
    page = "<body><article>" + "<p>Words of a very long page.</p>" * 100_000 + "</article></body>"
    assert text(page).count("Words") == 100_000
    assert isinstance(text("<div class='ad'>" * 20_000 + "x"), str)
