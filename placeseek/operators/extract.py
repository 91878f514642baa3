"""Stored pages to posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeseek.functions import html as hx
from placeseek.functions import text as tx
from placeseek.functions import urls as ux
from placeseek.operators.topk import top_k

# Where a site may keep its sitemap, in order of preference.
SITEMAP_PATHS = ("post-sitemap.xml", "sitemap-1.xml", "sitemap.xml", "sitemap_index.xml")
SITEMAP_PATHS_OLDER = ("sitemap-1.xml", "sitemap.xml")
PAGES_PER_SITE = 40


def chosen_sitemaps(
    responses: DataFrame,
    paths: Sequence[str] = SITEMAP_PATHS,
    accepted: tuple[int, int] = (200, 299),
) -> DataFrame:
    """Best usable sitemap response per site from (site, path, status, body).

    The smallest (preference, body) pair is kept by a running minimum, so a site with
    very many responses costs no more than one row per task.
    """
    place = F.array_position(F.array(*[F.lit(p) for p in paths]), F.col("path"))
    return (
        responses.withColumn("_place", place)
        .filter((F.col("_place") > 0) & F.col("status").between(*accepted))
        .groupBy("site")
        .agg(F.min(F.struct("_place", "path", "status", "body")).alias("_best"))
        .select("site", "_best.path", "_best.status", "_best.body")
    )


def listed_pages(sitemaps: DataFrame) -> DataFrame:
    """One row per listed page with its position: (site, ..., pos, url)."""
    others = [c for c in sitemaps.columns if c != "body"]
    return sitemaps.select(
        *others, F.posexplode_outer(hx.sitemap_links(F.col("body"))).alias("pos", "url")
    ).filter(F.col("pos").isNotNull())


def first_pages(pages: DataFrame, n: int = PAGES_PER_SITE, order: str = "pos") -> DataFrame:
    """The first n pages of each site, in order."""
    return top_k(pages, ["site"], [F.asc(order)], n, order, rank="place")


# Each step below is a column of its own. Later steps use it more than once, and as a
# column it is still computed once.


def with_paragraphs(pages: DataFrame, markup: str = "html", out: str = "paragraphs") -> DataFrame:
    """Add the readable paragraphs as one text."""
    return (
        pages.withColumn("_stripped", hx.paragraph_markup(F.col(markup)))
        .withColumn("_decoded", hx.decode(F.col("_stripped")))
        .withColumn(out, hx.trimmed_paragraphs(F.col("_decoded")))
        .drop("_stripped", "_decoded")
    )


def with_clean_body(pages: DataFrame, markup: str = "html", out: str = "content") -> DataFrame:
    """Every paragraph cleaned, joined by a space, and the whole cleaned again."""
    return (
        with_paragraphs(pages, markup, "_paragraphs")
        .withColumn("_each", tx.clean_text(F.col("_paragraphs")))
        .withColumn("_joined", F.replace("_each", F.lit(hx.BREAK), F.lit(" ")))
        .withColumn(out, tx.clean_text(F.col("_joined")))
        .drop("_paragraphs", "_each", "_joined")
    )


def with_long_body(pages: DataFrame, markup: str = "html", out: str = "content") -> DataFrame:
    """Longer paragraphs, one per line."""
    return (
        with_paragraphs(pages, markup, "_paragraphs")
        .withColumn(out, hx.longer_paragraphs(F.col("_paragraphs")))
        .drop("_paragraphs")
    )


def served(pages: DataFrame, status: str = "status") -> DataFrame:
    """Pages that were served and have text."""
    return with_long_body(pages.filter(F.col(status) == 200)).filter(F.col("content") != "")


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, blog_url, page_url, page_title, page_description, page_author, content)
    for usable pages with a title; a page that cannot be read yields no row.

    The URL rule comes first, so bodies of rejected pages are never parsed.
    """
    url, markup = F.col("url"), F.col("html")
    usable = pages.filter(ux.is_usable(url) & markup.isNotNull())
    return (
        with_clean_body(usable)
        .select(
            "page_id",
            ux.site_root(url).alias("blog_url"),
            url.alias("page_url"),
            hx.title_raw(markup).alias("page_title"),
            hx.description(markup).alias("page_description"),
            hx.author(markup).alias("page_author"),
            "content",
        )
        .filter(F.col("page_title").isNotNull())
    )


def scraped(pages: DataFrame) -> DataFrame:
    """Older record form, six text fields, for pages that have paragraphs."""
    url, markup = F.col("url"), F.col("html")
    wanted = pages.filter(ux.has_no_banned_word(url) & (ux.site_root(url) != ""))
    return (
        with_long_body(wanted)
        .filter(F.col("content") != "")
        .select(
            "url",
            hx.title_text(markup).alias("title"),
            hx.description_older(markup).alias("description"),
            hx.author_older(markup).alias("author"),
            "content",
            ux.site_root(url).alias("base_domain"),
        )
    )
