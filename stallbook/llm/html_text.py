"""Main text of web pages as the maximum-scoring run of a page's tokens.

A page is a sequence of words and tags. A word scores positive, or negative where the names of the
elements around it speak against it; a tag scores a little negative. One linear scan finds the
contiguous region with the highest sum, on every page alike, and the words of that region that did
not score negative are the text. Words against cost a region a sixteenth of their log odds each, so
that an advert inside an article doesn't cut it in two.

Weights come from labelled pages: pages that mark their content with <article> or <main>, which labels
each of their words as inside or outside. For every element name, class, id and role that occurs
around words, the log odds of lying inside are counted against those of all words, and for every tag
its share inside. The sample is bounded in pages and bytes (MAX_PAGES, SAMPLE_BYTES; distinct texts by
their hash). When a page is extracted the mark labels nothing: <article> and <main> have no weight.

Names that stand for menus, footers, adverts and the like have a prior: so many words outside
(PRIOR_WORDS), so that names the sample lacks, and pages without any labels, can be handled. Words below
such a name don't count for the names further in, as a list in a menu says nothing about lists. A
listed name is weighed against what its element holds: it says nothing on html and body, on an outermost
article, round most of the marked content, or round nearly the whole page; a name that does so in part
only (has-sidebar, share-price) says nothing round half of the page or round running text either. A
header belongs to the article it lies in.

Blocks are joined by one space, white space inside is one space, character references are
decoded, comments, scripts and styles are no text. Malformed markup is read leniently: unclosed
elements end with their parents, an unclosed comment or script reaches to the end.

Cases: null and empty pages and pages without words give the empty text; repeated rows are
worked off one by one, and learned from once; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallbook.llm.common import pieces, prepare, tidied
from stallbook.session import stage

# Pages and bytes that weights are learned from; a page of more than a hundredth of the bytes is not sampled.
MAX_PAGES = 500
SAMPLE_BYTES = 64_000_000
# Words outside of content that a listed name starts with.
PRIOR_WORDS = 2_000
# Words or tags from which on a name or a tag has a weight.
EVIDENCE = 20

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<empty>svg|math)(?=[\s/])(?:[^\"'>/]++|/(?!>)|\"[^\"]*+\"|'[^']*+')*+/>"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|noembed|noframes|xmp|svg|math|select|object)(?=[\s/>])"
    r"(?:(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>).*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|</?(?P<broken>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
PART = re.compile(r"[a-z]+|[0-9]+")

# Fixed values of HTML: elements without content, and inline elements (all others break the text into blocks).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CONTENT = frozenset(("article", "main"))
# Elements, and parts of classes, ids and roles, that stand for what surrounds an article.
AROUND = frozenset("head nav footer aside button dialog".split())
AROUND_NAMED = frozenset("form menu fieldset".split())
AROUND_PARTS = frozenset(
    "ad ads advert adverts advertisement advertising adslot banner breadcrumb breadcrumbs comment comments commentlist complementary "
    "consent contentinfo cookie cookies copyright disqus footer form gdpr login masthead menu modal nav navbar navigation newsletter "
    "notice notices notification pager pagination popup promo promoted promotion recommended related respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
# A header is part of the page outside of content, unless it is named as a part of an article.
ARTICLE_PARTS = frozenset("article content entry post story".split())
AGAINST = -4.0
WORD, TAG = 1.0, -0.05
# Log odds below which a name tells against words, what a unit of them costs a region, the least a word is worth, bounds of a tag.
DOUBT, COST, LEAST = -1.0, 1 / 16, 0.25
TAG_LOW, TAG_HIGH = -0.2, -0.01
# Shares of the page's or the marked words from which on a name says nothing, and words outside of links that make running text.
MOST, HALF, RUNNING = 0.9, 0.5, 20


def keys_of(tag: str, rest: str) -> tuple[list[str], list[list[str]], bool]:
    """(names an element goes by, the parts of each class, id and role, whether it is hidden)."""
    keys, groups, hidden = [tag], [], False
    if "=" in rest or "hidden" in rest:
        for name, a, b, c in ATTRIBUTE.findall(rest):
            name, value = name.lower(), a or b or c
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif name == "style":
                hidden = hidden or bool(HIDDEN.search(value))
            elif name in ("class", "id", "role"):
                for word in value.lower().split():
                    parts = PART.findall(word)
                    keys += [f".{p}" for p in parts]
                    groups.append([p for p in parts if p.isalpha()])
    return keys, groups, hidden


def against(tag: str, groups: list[list[str]], inside: bool) -> float:
    """How far an element's names stand for something else than an article's text: 0, HALF or 1."""
    if tag in ("html", "body"):
        return 0.0
    if tag in AROUND_NAMED:
        return 1.0
    header = not inside and ARTICLE_PARTS.isdisjoint(p for g in groups for p in g)
    worst = 0.0
    for parts in groups:
        found = [p in AROUND_PARTS or header and p == "header" for p in parts]
        if any(found):
            worst = max(worst, 1.0 if all(found) else HALF)
    return worst


def is_listed(name: str) -> bool:
    """Whether a name has a prior."""
    return name[1:] in AROUND_PARTS or name[1:] == "header" if name.startswith(".") else name in AROUND or name in AROUND_NAMED or name == "header"


class Element:
    """An element, with the words in it: those that no tag rules out, of these outside of links and in marked content; all inside, all outside."""

    __slots__ = ("up", "tag", "keys", "groups", "hidden", "out", "link", "content", "marked", "words")

    def __init__(self, up: Element | None, tag: str, keys: list[str], groups: list[list[str]], hidden: bool, words: list[int]):
        self.up, self.tag, self.keys, self.groups, self.words = up, tag, keys, groups, words
        inside = up is not None and up.content
        self.hidden = hidden or tag == "head" or up is not None and up.hidden
        self.out = self.hidden or tag in AROUND or tag == "header" and not inside or up is not None and up.out
        self.link = tag == "a" or up is not None and up.link
        self.content = inside or tag in CONTENT
        self.marked = up.marked if inside else tag in CONTENT and against(tag, groups, False) < 1

    def speaks_against(self, page: list[int], inside: bool) -> bool:
        """Whether its names count, given the words of the whole page."""
        if self.tag in CONTENT and not inside:
            return False
        degree = against(self.tag, self.groups, inside)
        if not degree:
            return False
        words, plain, marked = self.words[:3]
        if not inside and marked and marked >= HALF * page[2]:
            return False
        if degree == 1:
            return not words or words < MOST * page[0]
        return words < HALF * page[0] and (plain < RUNNING or 3 * plain < 2 * words)

    def listed(self, page: list[int]) -> list[str]:
        """Its names that have a prior and that count here."""
        inside = self.up.content
        names = [self.tag] if self.tag in AROUND or self.tag == "header" and not inside else []
        if self.speaks_against(page, inside):
            names += [self.tag] if self.tag in AROUND_NAMED else []
            names += [k for k in self.keys[1:] if is_listed(k) and (k != ".header" or not inside)]
        return names

    def plain_names(self) -> list[str]:
        """Its names without a prior: what an element is called tells more than its kind; the kind counts where it has no name."""
        if self.tag in CONTENT or self.tag in ("html", "body") or self.tag in INLINE and len(self.keys) == 1:
            return []
        return [k for k in self.keys[1:] or [self.tag] if not is_listed(k)]

    def score(self, page: list[int], weights: dict[str, float]) -> float:
        """What a word in it is worth, as far as its own names tell."""
        if self.hidden:
            return AGAINST
        own = [weights[k] for k in self.plain_names() if k in weights]
        return min([WORD, *own, *(weights.get(k, AGAINST) for k in self.listed(page))])


def parsed(page: str) -> tuple[list[tuple], list[Element]]:
    """((text or None for a tag, block break, element around it, name of the tag, whether it opens) in page order, elements in page order)."""
    count = [0, 0, 0, 0, 0]
    root = Element(None, "", [""], [], False, [0, 0, 0, 0, 0])
    stack, elements, events = [root], [root], []
    opened: Counter[str] = Counter()

    def close() -> str:
        top = stack.pop()
        top.words = [b - a for a, b in zip(top.words, count)]
        opened[top.tag] -= 1
        return top.tag

    for m in TOKEN.finditer(page):
        kind = m.lastgroup
        text = m["text"]
        if text is not None:
            top = stack[-1]
            if not top.hidden and (n := len(text.split())):
                if not top.out:
                    count[0] += n
                    count[1] += 0 if top.link else n
                    count[2] += n if top.marked else 0
                count[3 if top.content else 4] += n
            events.append((text, False, top, "", False))
            continue
        tag = (m["tag"] or m["broken"] or "").lower()
        if not tag:
            if m["raw"] and m["raw"].lower() not in INLINE:
                breaks = m["raw"].lower() not in ("script", "style", "svg", "math", "noscript", "template")
                events.append((None, breaks, stack[-1], m["raw"].lower(), False))
            continue
        ends = bool(m["end"]) if kind != "broken" and m["tag"] else page.startswith("</", m.start())
        breaks = tag not in INLINE
        if ends:
            if opened[tag]:
                while close() != tag:
                    pass
        elif tag not in VOID:
            if breaks and opened["p"] and tag != "p" or tag == "p" and opened["p"]:
                while close() != "p":  # a paragraph ends where the next block begins
                    pass
            if not (m["rest"] or "").rstrip().endswith("/") or tag in CONTENT:
                stack.append(Element(stack[-1], tag, *keys_of(tag, m["rest"] or ""), list(count)))
                elements.append(stack[-1])
                opened[tag] += 1
        events.append((None, breaks, stack[-1], tag, not ends))
    while stack:
        close()
    return events, elements


def count_names(page: str) -> tuple[Counter, Counter, bool]:
    """Words inside and outside marked content by the names around them, tags likewise, and whether the page marks any.

    A name counts a word once, however many elements of that name are around it. "" counts all words.
    """
    events, elements = parsed(page)
    within, without = Counter(), Counter()
    whole = elements[0].words
    # Names of the elements that are open, and elements below a listed name.
    stack, names, below = [], Counter(), set()
    for e in elements:
        while stack and stack[-1][0] is not e.up:
            names.subtract(stack.pop()[1])
        own = {""} if e.up is None else set()
        if e.up is not None and (e.hidden or e.up in below):
            below.add(e)
        elif e.up is not None:
            listed = e.listed(whole)
            own = {*e.plain_names(), *listed}
            if listed:
                below.add(e)
        stack.append((e, own))
        for name in own:
            if not names[name]:
                within[name] += e.words[3]
                without[name] += e.words[4]
        names.update(own)
    for text, _, e, tag, opens in events:
        if text is None and opens and e not in below and tag not in CONTENT:
            (within if e.content else without)[f"<{tag}>"] += 1
    return within, without, any(e.tag in CONTENT for e in elements)


def learned(within: Counter, without: Counter, prior: float = PRIOR_WORDS, least: int = EVIDENCE) -> dict[str, float]:
    """Weights of names and tags with enough evidence, where they differ from those of unknown ones."""
    base = math.log((within[""] + 1) / (without[""] + 1))
    out = {}
    for name in within.keys() | without.keys():
        a, b = within[name], without[name]
        if not name or a + b < least:
            continue
        if name.startswith("<"):
            out[name] = min(TAG_HIGH, max(TAG_LOW, math.log((a + 0.5) / (a + b + 1)) / 4))
            continue
        known = is_listed(name)
        b += prior if known else 0
        odds = math.log((a + 0.5) / (b + 0.5)) - base
        value = max(AGAINST, odds) if odds < DOUBT and a <= b else min(WORD, max(LEAST, WORD + odds))
        if known or value < WORD:
            out[name] = value
    return out


def best_region(values: list[float]) -> tuple[int, int]:
    """(first, end) of the contiguous run with the greatest positive sum, the first of equals; (0, 0) without any."""
    best, total, start, region = 0.0, 0.0, 0, (0, 0)
    for place, value in enumerate(values):
        total += value
        if total <= 0:
            total, start = 0.0, place + 1
        elif total > best:
            best, region = total, (start, place + 1)
    return region


def scored(page: str, weights: dict[str, float]) -> tuple[list[tuple], list[float]]:
    """((text or None for a tag, block break, score of a word) in page order, what each adds to a region)."""
    events, elements = parsed(page)
    worth = {elements[0]: WORD}
    for e in elements[1:]:
        worth[e] = min(worth[e.up], e.score(elements[0].words, weights)) if worth[e.up] > AGAINST else AGAINST
    items, values = [], []
    for text, breaks, e, tag, _ in events:
        score = worth[e]
        items.append((text, breaks, score))
        values.append(weights.get(f"<{tag}>", TAG) if text is None else len(text.split()) * (score if score > 0 else score * COST))
    return items, values


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The words of the best region of a page."""
    if not page:
        return ""
    items, values = scored(page, weights)
    first, end = best_region(values)
    parts = []
    for text, breaks, score in items[first:end]:
        if text is None:
            if breaks:
                parts.append(" ")
        elif score > 0:
            parts.append(unescape(text) if "&" in text else text)
    return " ".join("".join(parts).split())


def sampled_pages(pages: DataFrame, html: str, most: int, most_bytes: int) -> DataFrame:
    """`html` of at most so many distinct pages that mark their content, with at most so many bytes in all."""
    size = F.octet_length(html).cast("long")
    marked = pages.where(F.col(html).rlike("(?i)<(article|main)[\\s>]") & (size <= most_bytes // 100))
    marked = marked.select(F.xxhash64(html).alias("hash"), size.alias("size"), F.col(html).alias("html"))
    sizes = marked.groupBy("hash").agg(F.max("size").alias("size"))
    first = stage(sizes.orderBy(F.xxhash64("hash"), "hash").limit(most), "page-sample")
    # At most `most` short rows, in one window and in one broadcast.
    before = Window.orderBy(F.xxhash64("hash"), "hash").rowsBetween(Window.unboundedPreceding, 0)
    chosen = first.withColumn("total", F.sum("size").over(before)).where(F.col("total") <= most_bytes).select("hash")
    return marked.join(F.broadcast(chosen), "hash").dropDuplicates(["hash"]).select("html")


def train(pages: DataFrame, html: str = "html", most: int = MAX_PAGES, most_bytes: int = SAMPLE_BYTES, prior: float = PRIOR_WORDS) -> dict[str, float]:
    """Weights of names and tags, learned in one task from a bounded sample of the pages that mark their content."""
    prepare(pages.sparkSession)

    def learn(batches):
        within, without = Counter(), Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                a, b, marked = count_names(page)
                if marked:
                    within.update(a)
                    without.update(b)
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(learned(within, without, prior))])], names=["weights"])

    row = sampled_pages(pages, html, most, most_bytes).repartition(1).mapInArrow(tidied(learn), "weights string").first()
    return json.loads(row["weights"]) if row else {}


def extract(pages: DataFrame, weights: dict[str, float], key: str = "page_id", html: str = "html") -> DataFrame:
    """key, url, text, n_chars of every page."""
    shared = prepare(pages.sparkSession).sparkContext.broadcast(weights)

    def run(batches):
        for batch in pieces(batches, html):
            texts = [main_text(page, shared.value) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[key, "url", "text", "n_chars"])

    rows = pages.select(F.col(key).cast("long").alias(key), F.col("url").cast("string").alias("url"), html)
    return rows.mapInArrow(tidied(run), f"{key} long, url string, text string, n_chars long")
