"""Names of page-wide elements, names that tell in part, raw and self-closing elements, attributes."""

import pytest

from stallbook.llm.html_text import main_text

PROSE = "The price of the share rose over the year and fell again in the winter when the firm sold its mill to others"


@pytest.mark.parametrize("open_, close", [
    ('<body class="has-sidebar">', "</body>"), ('<body class="single comments-open">', "</body>"), ('<html class="no-sidebar menu"><body>', "</body></html>"),
    ('<div id="no-sidebar-layout">', "</div>"), ('<form action="/page.aspx">', "</form>"), ('<div class="sidebar">', "</div>"),
])
@pytest.mark.parametrize("mark, end", [("<article>", "</article>"), ("<div>", "</div>")])
def test_names_of_page_wide_elements_say_nothing(open_, close, mark, end):
    assert main_text(f"{open_}<nav>Home</nav>{mark}<p>{PROSE}</p>{end}<footer>f</footer>{close}", {}) == PROSE


def test_names_that_tell_in_part_do_not_drop_running_text():
    for name in ("share-price", "search-guide"):
        page = f'<article><p>{PROSE}</p><div class="{name}"><p>{PROSE}</p></div><div class="share-buttons"><a href="/">Send</a></div></article>'
        assert main_text(page, {}) == f"{PROSE} {PROSE}"


def test_comments_marked_as_articles_stay_out():
    notes = '<article class="comment">I think so too</article>' * 30
    assert main_text(f'<article>{PROSE}</article><section id="comments">{notes}</section>', {}) == PROSE


@pytest.mark.parametrize("page, text", [
    ('<p>a</p><svg width="1" d="a>b"/><p>b</p>', "a b"), ("<p>a<math/></p><p>b</p>", "a b"), ("<p>a</p><svg><path/><text>no</text></svg><p>b", "a b"),
    ("<title-bar>a</title-bar><p>b</p>", "a b"), ("<select-box>a<p>b</p>", "a b"), ("<svg-icon></svg-icon>a", "a"),
    ('<p>x</p><script data-a="1>2">no</script ><p>y', "x y"), ('<p title="a class=ad hidden">x</p>', "x"), ("<p data-class='ad' data-hidden>x</p>", "x"),
])
def test_raw_and_empty_elements_and_attributes(page, text):
    assert main_text(page, {}) == text
