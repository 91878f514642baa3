"""Main text of web pages by the maximum-scoring subsequence.

A page is read as a sequence of words and tags. A word scores by its surroundings (the
elements around it, and whether it is a link), a tag by its name; the scores are log odds of
standing in the content rather than outside, counted on labelled pages and smoothed by a
prior in which plain words are positive and tags and boilerplate negative. One linear scan
finds the contiguous region with the largest sum. Inside it, elements that are boilerplate
of their own (adverts, forms, notices, comments of readers) are left out, and the rest is
joined block by block.

Labelled pages are those that mark their content with ``article`` or ``main``: about
``SAMPLE_PAGES`` of them, by the hash of their id. What stands aside takes no part in the scan, so that
an advert inside an article cannot end it. Null, empty and wordless pages
give the empty text. Repeated rows give a row each; an empty table gives none. Broken markup
is read as far as it goes; unclosed elements end with their parent.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 2_000

NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
# The rest of a tag; quotes hold only behind an equals sign. Nothing is tried twice.
REST = re.compile(r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
PART = re.compile(r"[a-z]+")

# Fixed values of HTML.
DROPPED = frozenset("script style noscript template svg math iframe object textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY = {
    "li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
}
CONTENT = ("article", "main")
# Elements and words in class, id or role that say what an element is for.
ASIDE_TAGS = frozenset("nav footer aside form button select option input label fieldset menu dialog head".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements banner sponsor sponsored promo promotion promotions nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs sidebar side aside footer comment comments reply replies respond "
    "disqus cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup login search "
    "share sharing social related recommended recommendations widget toolbar pagination pager complementary "
    "contentinfo dialog".split()
)
LEAST = -6.0


class Element:
    __slots__ = ("aside", "kind", "link", "name", "own")

    def __init__(self, name: str, attributes: str, parent: Element | None):
        self.name = name
        parts: set[str] = set()
        hidden = False
        for key, *values in ATTRIBUTE.findall(attributes) if "=" in attributes else ():
            key, value = key.lower(), "".join(values).lower()
            if key in ("class", "id", "role"):
                parts.update(PART.findall(value))
            hidden |= key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", "")
        content = parent is not None and parent.kind is not None and not parent.aside
        named = name in ASIDE_TAGS or (name == "header" and not content)
        self.own = bool(named or hidden or re.search(r"\bhidden\b", attributes) or parts & ASIDE_WORDS and name not in ("html", "body", *CONTENT))
        self.aside = self.own or (parent is not None and parent.aside)
        self.kind = name if name in CONTENT else (parent.kind if parent else None)
        self.link = name == "a" or (parent is not None and parent.link)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): "t" with a text, "<" and "/" with the name of a tag, in page order.

    One pass. Comments, declarations and elements without readable text are skipped, to the end of the
    page where they are not closed. A tag that the page breaks off is no text. A tag whose quotes swallow
    the page ends at its first ``>``, and so do all behind it.
    """
    at, quoted = 0, True
    size = len(page)
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            break
        name = NAME.match(page, begin + 1)
        if name is None and not page.startswith(("<!", "<?"), begin):
            # A lone sign is text, up to the next one.
            following = page.find("<", begin + 1)
            begin = size if following < 0 else following
            yield "t", page[at:begin], ""
            at = begin
            continue
        if begin > at:
            yield "t", page[at:begin], ""
        if name is None:
            for opening, closing in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<", ">")):
                if page.startswith(opening, begin):
                    end = page.find(closing, begin + len(opening))
                    at = size if end < 0 else end + len(closing)
                    break
            continue
        rest = REST.match(page, name.end()) if quoted else None
        if rest is None:
            quoted = False
            end = page.find(">", name.end())
            if end < 0:
                return
            inside, at = page[name.end() : end], end + 1
        else:
            inside, at = rest.group(1), rest.end()
        tag = name.group(2).lower()
        if not name.group(1) and tag in DROPPED:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I).search(page, at)
            at = close.end() if close else size
            continue
        yield name.group(1) or "<", tag, inside
    if at < size:
        yield "t", page[at:], ""


def sequence(page: str | None) -> list[tuple[str, str, Element | None]]:
    """(kind, value, element): text pieces as "t", tags as their names, in page order.

    ``element`` is the one that holds the text, is opened, or is closed.
    """
    out: list[tuple[str, str, Element | None]] = []
    stack: list[Element] = []
    depth: Counter = Counter()

    def close(count: int) -> None:
        for element in stack[len(stack) - count :]:
            depth[element.name] -= 1
        del stack[len(stack) - count :]

    for kind, name, rest in tokens(page or ""):
        if kind == "t":
            out.append(("t", name, stack[-1] if stack else None))
        elif kind == "/":
            # Looked for only if it is open, so stray ends cost nothing.
            if depth[name]:
                count = next(n for n, e in enumerate(reversed(stack), 1) if e.name == name)
                out.append(("/" + name, "", stack[-count]))
                close(count)
            else:
                out.append(("/" + name, "", stack[-1] if stack else None))
        else:
            closes = CLOSED_BY.get(name)
            if closes and stack and stack[-1].name in closes:
                close(1)
            element = Element(name, rest, stack[-1] if stack else None)
            out.append((name, "", element))
            if name not in VOID and not rest.endswith("/"):
                stack.append(element)
                depth[name] += 1
    return out


def surroundings(element: Element | None) -> str:
    if element is None:
        return "top"
    if element.aside:
        return "aside"
    return ("content " if element.kind else "") + ("link" if element.link else "text")


def tag_kind(name: str, element: Element | None = None) -> str:
    bare = name.lstrip("/")
    if element is not None and element.kind and bare not in CONTENT:
        return "tag content"
    return f"tag {name}" if bare in CONTENT or bare in ASIDE_TAGS else ("tag inline" if bare in INLINE else "tag block")


def counts(page: str | None) -> dict[str, tuple[int, int]]:
    """Words and tags by their surroundings: (inside the marked content, outside); empty without marks."""
    inside, outside = Counter(), Counter()
    marked = False
    depth = 0
    for kind, value, element in sequence(page):
        if kind in CONTENT:
            marked, depth = True, depth + 1
        elif kind.startswith("/") and kind[1:] in CONTENT:
            depth -= 1
        if element is not None and element.aside:
            continue
        if kind == "t":
            held = element is not None and element.kind is not None and not element.aside
            (inside if held else outside)[surroundings(element)] += len(value.split())
        else:
            (inside if depth > 0 and kind not in CONTENT else outside)[tag_kind(kind, element)] += 1
    return {k: (inside[k], outside[k]) for k in inside.keys() | outside.keys()} if marked else {}


def prior(key: str) -> float:
    """Score of what the labelled pages do not tell."""
    if key.startswith("tag"):
        return {"tag content": -0.01, "tag inline": -0.1, "tag block": -0.5}.get(key, -2.0)
    return {"aside": LEAST, "top": 0.2, "text": 1.0, "link": -1.0, "content text": 2.0, "content link": 1.0}[key]


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> dict[str, float]:
    """Scores by surroundings, from at most ``sample_pages`` labelled pages."""

    @F.udf("map<string,array<long>>")
    def counted(page):
        return {k: list(v) for k, v in counts(page).items()}

    marked = pages.filter(F.col("html").rlike("(?i)<(?:article|main)[\\s>]") & F.col("page_id").isNotNull())
    size = 1 << 40
    share = int(size * min(1.0, sample_pages / max(1, marked.count())))
    # By the hash of the id; copies of a page count once.
    sample = marked.filter(F.pmod(F.xxhash64("page_id"), F.lit(size)) < share).groupBy("page_id").agg(F.min("html").alias("html"))
    rows = (
        sample.repartition(8, "page_id").select(F.explode(counted("html")).alias("key", "n")).groupBy("key")
        .agg(F.sum(F.col("n")[0]).alias("inside"), F.sum(F.col("n")[1]).alias("outside")).collect()
    )
    weights = {}
    words = ("top", "aside", "text", "link", "content text", "content link")
    for key in {*words, *(r.key for r in rows)}:
        row = next((r for r in rows if r.key == key), None)
        seen = row.inside + row.outside if row else 0
        odds = math.log((row.inside + 1.0) / (row.outside + 1.0)) if row else 0.0
        # The prior weighs as much as twenty words or tags.
        weight = (20 * prior(key) + seen * odds) / (20 + seen)
        # Tags never gain and boilerplate never counts as content.
        top = -0.01 if key.startswith("tag") else (-0.5 if key == "aside" else 4.0)
        weights[key] = min(max(weight, LEAST), top)
    # A word in unmarked text is content when no better region is marked.
    weights["text"] = max(weights["text"], 0.5)
    return weights


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """Text of the best region; of equal regions the first and shortest."""
    items = sequence(page)
    if not any(kind in CONTENT for kind, _, _ in items):
        # Nothing is marked, so plain text weighs as it does where the mark is hidden.
        weights = weights | {key: weights["content text"] for key in ("text", "top")}
    best = (0.0, 0, 0)
    total, begin = 0.0, 0
    for k, (kind, value, element) in enumerate(items):
        if element is not None and element.aside:
            continue  # neither content nor a reason to end it
        if kind == "t":
            score = weights[surroundings(element)] * len(value.split())
        else:
            key = tag_kind(kind, element)
            score = weights.get(key, min(prior(key), -0.01))
        if total <= 0:
            total, begin = 0.0, k
        total += score
        if total > best[0]:
            best = (total, begin, k + 1)
    blocks: list[str] = []
    current: list[str] = []

    def close() -> None:
        text = " ".join(html.unescape("".join(current)).split())
        if text:
            blocks.append(text)
        current.clear()

    for kind, value, element in items[best[1] : best[2]]:
        if kind == "t":
            if surroundings(element) != "aside":
                current.append(value)
        elif kind.lstrip("/") not in INLINE:
            close()
    close()
    return " ".join(blocks)


def extracted(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    weights = fit(pages) if weights is None else weights

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield pd.Series([main_text(v, weights) for v in values], dtype=object)

    def whole(text: Column) -> Column:
        return F.char_length(text).cast("long")

    done = pages.select("page_id", "url", text_of("html").alias("text"))
    return done.select("page_id", "url", "text", whole(F.col("text")).alias("n_chars"))
