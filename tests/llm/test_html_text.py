import pytest

from stallbook.llm import html_text
from stallbook.llm.html_text import main_text

BODY = "<h1>Title of it</h1><p>First  paragraph\nwith <b>bold</b> and <a href='/x'>a link</a>.</p><ul><li>one</li><li>two</li></ul><p>Caf&eacute; &amp; more&nbsp;text here"
TEXT = "Title of it First paragraph with bold and a link. one two Café & more text here"
AROUND = (
    '<header><h2>Site name and slogan</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav>',
    '<div class="ad">Buy this now, it is cheap and good for everyone in the house</div>',
    '<aside class="sidebar"><p>Read these other pages about things</p></aside>',
    '<div class="cookie-notice">We use cookies on this page</div>',
    '<section id="comments"><p>I think that this is a very good article, thanks for it</p></section>',
    '<form action="/s"><label>Search</label><input name="q"><button>Go</button></form>',
    "<footer>&copy; 2020 the owner</footer>",
    '<script>var a = "</p><p>no text</p>";</script><style>p { color: red }</style><!-- <p>no</p> -->',
    '<div hidden><p>nothing to see in here at all</p></div><div style="display: none">nor here</div>',
)


@pytest.mark.parametrize("open_, close", [("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>"), ('<div class="post-content">', "")])
@pytest.mark.parametrize("inside", ["", *AROUND[1:]])
def test_the_article_and_nothing_else(open_, close, inside):
    before, after = "".join(AROUND[:4]), "".join(AROUND[4:])
    page = f"<!DOCTYPE html><html><head><title>Page title</title></head><body>{before}{open_}{BODY}</p>{inside}{close}{after}</body></html>"
    assert main_text(page, {}) == TEXT


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>", ""), ("just text", "just text"), ("a < b and c > d", "a < b and c > d"),
    ("<p>one<p>two<br>three", "one two three"), ("<p>un<b>bro</b>ken</p>", "unbroken"), ("<p>open <!-- never closed <p>x", "open"),
    ("<p>a</p><script>never closed", "a"), ("<p>&lt;b&gt; &amp;amp;</p>", "<b> &amp;"), ("<p title='a>b'>x</p>", "x"), ('<p title="open>x</p>', "x"),
    ("<nav>only a menu</nav>", ""), ("</p></div>stray<p>x", "stray x"), ("<article></article><footer>f</footer>", ""),
    ("<article>a<article class='comment'>no</article>b</article>", "a b"),
])
def test_odd_pages(page, text):
    assert main_text(page, {}) == text


def test_long_and_malformed_pages_take_linear_time():
    assert main_text("<p>" + "word " * 200_000, {}) == ("word " * 200_000).strip()
    assert main_text("<b><i>x" * 20_000 + "</u>" * 20_000, {}).count("x") == 20_000
    assert main_text("<div>" * 20_000 + "x", {}) == "x"


def test_names_are_learned_from_marked_pages(spark):
    marked = [(i, f"<body><div class='zq'>{'out ' * 30}</div><article><p class='tx'>{'in ' * 30}</p></article></body>", "u") for i in range(20)]
    pages = spark.createDataFrame(marked, "page_id long, html string, url string")
    weights = html_text.train(pages)
    assert weights[".zq"] < 0 and "p" not in weights and ".tx" not in weights
    page = f"<div class='zq'>{'out ' * 9}</div><div><p class='tx'>{'in ' * 9}</p></div>"
    assert main_text(page, weights) == ("in " * 9).strip()


def test_rows(spark):
    rows = [(1, "u", "<p>x</p>", 1), (1, "u", "<p>x</p>", 1), (None, None, None, None), (2, "v", "", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = html_text.extract(pages, html_text.train(pages)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0), (2, "v", "", 0)], key=repr)
    none = spark.createDataFrame([], pages.schema)
    assert html_text.extract(none, html_text.train(none)).collect() == []
