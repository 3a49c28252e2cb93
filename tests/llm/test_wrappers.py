"""Layout names on elements that wrap a page's main part."""

from __future__ import annotations

import pytest

from wreckline.llm.html_text import hinted, main_blocks

BODY = "<h1>Head line</h1><p>First paragraph with enough words in it to count.</p><p>Ok.</p>"
BLOCKS = ["Head line", "First paragraph with enough words in it to count.", "Ok."]
ASIDE = "<div class='sidebar'><p>Side bar text that is about as long as a paragraph.</p></div>"
NAMES = ["page has-sidebar", "layout no-sidebar", "content-with-sidebar", "post no-comments", "layout-sidebar-left", "social", "post comments-open"]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("tag", ["article", "main", "section"])
def test_wrappers_keep_their_article(name, tag):
    for attribute in ("class", "id"):
        assert main_blocks(f"<body><div {attribute}='{name}'><{tag}>{BODY}</{tag}></div>") == BLOCKS
    assert main_blocks(f"<div class='{name}'><{tag}>{BODY}</{tag}>{ASIDE}</div><div class='ad'>Buy this now.</div>") == BLOCKS
    assert main_blocks(f"<div class=widget><div class='{name}'><{tag}>{BODY}</{tag}></div></div>") == BLOCKS


def test_a_page_under_a_hint_without_article_or_heading():
    assert main_blocks("<div class='main-menu-page'><p>Text of a page with words enough to count.</p><div class=ad>Buy.</div></div>") == [
        "Text of a page with words enough to count."]


def test_hinted_parts_still_go():
    comments = "<article class=comment><p>I think this comment is long enough to look like text.</p></article>" * 9
    for part in (ASIDE, f"<section class='comments'>{comments}</section>", "<div class=related><article><p>A teaser of another article.</p></article></div>"):
        assert main_blocks(f"<article>{BODY}</article>{part}") == BLOCKS
        assert main_blocks(f"<div>{BODY}</div>{part}") == BLOCKS[:1] + BLOCKS[1:]
    assert main_blocks("<nav class=has-menu><p>never text</p></nav>") == []


def test_names():
    assert all(hinted(x) for x in ("ad", "sidebar", "x comments", "sidebar-left", "has-menu share", "cookie-notice"))
    assert not any(hinted(x) for x in ("", "has-sidebar", "no-comments", "content-with-sidebar", "without_ads", "comments-closed", "shared"))


def test_unclosed_hints_are_read_in_linear_time():
    assert main_blocks("<div class=ad><p>x</p>" * 20_000 + f"<main>{BODY}</main>") == BLOCKS
