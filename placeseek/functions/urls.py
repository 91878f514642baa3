"""URL rules. Parts are cut by pattern, so malformed URLs never fail a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The general URI grammar, with a group for the path and one for the query.
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
QUERY = r"^[^?#]*\?([^#]*)"
PARAMS = r";[^/]*$"
ROOT = r"^https?://[^/]+"

# Path parts, path endings and words that mark a page as no article.
REJECTED_PARTS = ("/page/", "/category/", "/tag/", "/author/", "/feed/", "wp-json", "wp-admin")
REJECTED_ENDINGS = (".jpg", ".png", ".gif", ".pdf", ".xml", ".zip")
BANNED_WORDS = ("privacy", "about", "contact", "terms", "policy", "wp-json")


def path(url: Column) -> Column:
    """Lower-case path without parameters."""
    return F.lower(F.regexp_replace(F.regexp_extract(url, PATH, 1), PARAMS, ""))


def query_string(url: Column) -> Column:
    return F.regexp_extract(url, QUERY, 1)


def is_usable(url: Column) -> Column:
    """True for URLs that look like an article: a clean path that ends in a slash."""
    where = path(url)
    ok = where.endswith("/") & (query_string(url) == "")
    for part in REJECTED_PARTS:
        ok = ok & ~where.contains(part)
    for ending in REJECTED_ENDINGS:
        ok = ok & ~where.endswith(ending)
    return ok


def has_no_banned_word(url: Column) -> Column:
    return ~F.lower(url).rlike("|".join(BANNED_WORDS))


def site_root(url: Column) -> Column:
    """Scheme and host, or an empty string when the URL has none."""
    return F.regexp_extract(url, ROOT, 0)
