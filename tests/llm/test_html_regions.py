"""The region scan against all contiguous regions, learned weights without any list of names, bounds of the sample."""

import random
from collections import Counter

import pytest

from stallbook.llm import html_text
from stallbook.llm.html_text import best_region, count_names, learned, main_text, scored

IN, OUT = "the mill by the river was sold", "buy this at once"


def page(rng: random.Random, mark: bool = True) -> tuple[str, str]:
    """A page whose surroundings go by names that no list has, and its content."""
    text = " ".join(IN for _ in range(rng.randrange(1, 6)))
    before = "".join(f'<div class="zq{rng.randrange(2)}"><span>{OUT}</span></div>' for _ in range(rng.randrange(0, 4)))
    after = f"<xfoot>{OUT} <i>{OUT}</i></xfoot>" * rng.randrange(0, 3)
    tag = "article" if mark else "div"
    return f"<html><body>{before}<{tag}><p class='tx'>{text}</p></{tag}>{after}</body></html>", text


@pytest.fixture(scope="module")
def weights():
    rng, within, without = random.Random(5), Counter(), Counter()
    for _ in range(60):
        a, b, marked = count_names(page(rng)[0])
        assert marked
        within.update(a)
        without.update(b)
    return learned(within, without)


def test_scan_against_all_regions(weights):
    rng = random.Random(9)
    for _ in range(300):
        values = [rng.choice([-2.0, -0.5, -0.25, 0.0, 0.5, 1.0, 3.0]) for _ in range(rng.randrange(0, 25))]
        regions = [(sum(values[a:b]), a, b) for a in range(len(values)) for b in range(a + 1, len(values) + 1)]
        first, end = best_region(values)
        assert sum(values[first:end]) == max([0.0, *(r[0] for r in regions)])
        assert (first, end) == (0, 0) or values[first] > 0 and values[end - 1] > 0
    for _ in range(40):
        html, _ = page(rng)
        items, values = scored(html, weights)
        best = max(((sum(values[a:b]), -a) for a in range(len(values)) for b in range(a + 1, len(values) + 1)))
        first, end = best_region(values)
        assert abs(sum(values[first:end]) - best[0]) < 1e-9
        assert " ".join(" ".join(t for t, _, s in items[first:end] if t and s > 0).split()) == main_text(html, weights)


@pytest.mark.parametrize("mark", [True, False])
def test_weights_decide_where_no_list_helps(weights, mark):
    rng = random.Random(11)
    changed = 0
    for _ in range(50):
        html, text = page(rng, mark)
        assert main_text(html, weights) == text
        changed += main_text(html, {}) != text
    assert changed > 25


def test_the_mark_is_no_answer(weights):
    # Words that learned names speak against go, though they are marked.
    assert main_text(f"<article><p>{IN}</p><div class='zq1'>{OUT}</div><p>{IN}</p></article>", weights) == f"{IN} {IN}"
    assert main_text(f"<article></article><div><p>{IN}</p></div>", weights) == IN


def test_two_articles_stay_whole(weights):
    a, b, between = "one " * 30, "two " * 25, "out " * 80
    for gap in (f"<div class='zq0'>{between}</div>", f"<aside>{between}</aside>"):
        assert main_text(f"<article>{a}</article>{gap}<article>{b}</article>", weights) == f"{a}{b}".strip()


def test_evidence_outweighs_the_list():
    within, without = Counter({"": 50_000, ".social": 9_000}), Counter({"": 9_000, ".social": 10, ".nav": 40})
    got = learned(within, without)
    assert got[".social"] > 0.5 and got[".nav"] < -1
    html = f"<div><p>{IN}</p><div class='social'>{IN}</div></div>"
    assert main_text(html, got) == f"{IN} {IN}" and main_text(html, {}) == IN


def test_names_far_out_count():
    deep = "<div>" * 40
    within, without, _ = count_names(f"<article><p>{IN}</p></article><section class='far'>{deep}{OUT}{'</div>' * 40}</section>")
    assert without[".far"] == without["div"] == 4 and not within[".far"]


def test_sample_is_bounded_in_rows_and_bytes(spark):
    same = [(1, f"<article>{IN}</article>")] * 300
    rows = [*same, *[(1, f"<main>{IN} {k}</main>") for k in range(50)], (2, None), (3, f"<p>{IN}</p>"), (4, "<main>" + "x " * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "1 AS hash", "2L AS size", "3L AS total")
    for most, most_bytes in ((10, 10**9), (10**6, 10_000), (10**6, 2_000)):
        got = [r.html for r in html_text.sampled_pages(pages, "html", most, most_bytes).collect()]
        assert len(set(got)) == len(got) <= min(most, 52) and sum(map(len, got)) <= most_bytes
        assert all("<main" in g or "<article" in g for g in got)
    assert html_text.train(pages.limit(0)) == {}
