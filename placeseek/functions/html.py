"""Reading stored HTML with string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeseek.functions import kernels
from placeseek.functions import text as tx

# Named entities decoded without leaving the JVM, ``&amp;`` last.
ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
)
OTHER_ENTITY = r"&(?!(?:lt|gt|quot|#39|copy|middot|amp);)[#A-Za-z]"

INVISIBLE = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
PARAGRAPH_OPEN = r"(?i)<p(?:\s[^>]*)?>"
PARAGRAPH_CLOSE = r"(?i)</p>"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
TAG = r"\s*<[^>\x01]*>\s*"
# Paragraphs travel as one text, kept apart by a control character.
BREAK = "\x01"


_unescape_batch = F.pandas_udf(kernels.unescape, T.StringType())


def decode(text: Column) -> Column:
    """Replace character references.

    Texts that hold only the common ones are decoded by string replacement; the others
    go to Python in Arrow batches, whole, so nothing is decoded twice.
    """
    simple = text
    for entity, char in ENTITIES:
        simple = F.replace(simple, F.lit(entity), F.lit(char))
    rare = F.when(text.rlike(OTHER_ENTITY), text)
    return F.coalesce(_unescape_batch(rare), simple)


def strip_tags(markup: Column) -> Column:
    """Text pieces, each trimmed, joined with nothing between them."""
    return F.regexp_replace(markup, TAG, "")


def _title(markup: Column) -> Column:
    return F.when(markup.rlike(TITLE), F.regexp_extract(markup, TITLE, 1))


def title_raw(markup: Column) -> Column:
    """Markup inside the first title as a parser writes it back; null if absent.

    Character references are decoded, and then only ``&``, ``<`` and ``>`` are escaped.
    """
    out = decode(_title(markup))
    for char, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(reference))
    return out


def title_text(markup: Column) -> Column:
    """Title as readable text; null if absent."""
    return tx.strip(decode(strip_tags(_title(markup))))


def paragraph_markup(markup: Column) -> Column:
    """Paragraphs without tags as one string, separated by ``BREAK``; empty if none.

    A paragraph runs to its end tag or to the next paragraph, whichever comes first.
    """
    visible = F.regexp_replace(F.replace(markup, F.lit(BREAK), F.lit("")), INVISIBLE, "")
    pieces = F.split(visible, PARAGRAPH_OPEN)
    inner = F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))),
        lambda piece: F.get(F.split(piece, PARAGRAPH_CLOSE, 2), 0),
    )
    return strip_tags(F.array_join(inner, BREAK))


def trimmed_paragraphs(text: Column) -> Column:
    between = F.regexp_replace(text, rf"[{tx.SPACE_SET}]*\x01[{tx.SPACE_SET}]*", BREAK)
    return tx.strip(between)


def longer_paragraphs(paragraphs: Column, than: int = 30) -> Column:
    """Paragraphs of more than ``than`` characters, one per line."""
    kept = F.filter(F.split(paragraphs, BREAK), lambda p: F.char_length(p) > than)
    return F.array_join(kept, "\n")


def _tag(markup: Column, name: str, attribute: str, value: str) -> Column:
    """The first ``name`` tag whose attribute has exactly this value, or ''."""
    pattern = rf"""(?is)<{name}\b[^>]*?\s{attribute}\s*=\s*["']?{value}["'\s/>][^>]*>?"""
    return F.regexp_extract(markup, pattern, 0)


def _attribute(tag: Column, attribute: str) -> Column:
    """Value of an attribute inside a tag text; '' when it has none."""
    pattern = rf"""(?is)\s{attribute}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return decode(
        F.concat(*[F.coalesce(F.regexp_extract(tag, pattern, i), F.lit("")) for i in (1, 2, 3)])
    )


def _meta(markup: Column, attribute: str, value: str) -> Column:
    return _tag(markup, "meta", attribute, value)


def description(markup: Column) -> Column:
    """``og:description``, or an empty string."""
    return _attribute(_meta(markup, "property", "og:description"), "content")


def description_older(markup: Column) -> Column:
    """``og:description``, else the plain description, trimmed; null if neither exists."""
    og = _meta(markup, "property", "og:description")
    plain = _meta(markup, "name", "description")
    tag = F.when(og != "", og).when(plain != "", plain)
    return F.when(tag.isNotNull(), tx.strip(_attribute(tag, "content")))


def author(markup: Column) -> Column:
    """First author tag present, even if empty; only then the visible author marks."""
    tags = [
        _meta(markup, "name", "author"),
        _meta(markup, "property", "article:author"),
        _meta(markup, "name", "article:author"),
    ]
    first = F.lit("")
    for tag in reversed(tags):
        first = F.when(tag != "", tag).otherwise(first)
    from_meta = _attribute(first, "content")
    span = _element(markup, "span", "class", "author")
    link = _element(markup, "a", "rel", "author")
    return F.coalesce(F.nullif(from_meta, F.lit("")), span, link, F.lit(""))


def author_older(markup: Column) -> Column:
    first = _meta(markup, "property", "author")
    second = _meta(markup, "name", "author")
    tag = F.when(first != "", first).when(second != "", second)
    return F.when(tag.isNotNull(), tx.strip(_attribute(tag, "content")))


def _element(markup: Column, name: str, attribute: str, value: str) -> Column:
    """Text of the first element carrying ``value`` among the words of an attribute."""
    pattern = (
        rf"""(?is)<{name}\b[^>]*?\s{attribute}\s*=\s*(?:"(?:[^"]*\s)?{value}(?:\s[^"]*)?"|"""
        rf"""'(?:[^']*\s)?{value}(?:\s[^']*)?'|{value}(?=[\s>]))[^>]*>(.*?)</{name}>"""
    )
    return F.when(
        markup.rlike(pattern), tx.strip(decode(strip_tags(F.regexp_extract(markup, pattern, 1))))
    )


def sitemap_links(body: Column) -> Column:
    """Array of page addresses: the first ``loc`` of each ``url``, in order."""
    entries = F.regexp_extract_all(body, F.lit(r"(?is)<url(?:\s[^>]*)?>(.*?)</url>"), F.lit(1))
    loc = r"(?is)<loc(?:\s[^>]*)?>(.*?)</loc>"
    with_loc = F.filter(entries, lambda e: e.rlike(loc))
    return F.transform(with_loc, lambda e: F.regexp_extract(e, loc, 1))
