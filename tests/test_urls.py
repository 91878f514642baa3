"""URL rules and page fields."""

from urllib.parse import urlparse

from pyspark.sql import functions as F

from placeseek.functions import html as hx
from placeseek.functions import urls as ux
from placeseek.operators import extract

URLS = {
    "https://a.org/post-one/": True,
    "https://a.org/2024/05/Trip/": True,
    "https://a.org/": True,
    "https://a.org": False,
    "https://a.org/post-one": False,
    "https://a.org/post-one/?p=1": False,
    "https://a.org/post-one/?": True,
    "https://a.org/post-one/#top": True,
    "https://a.org/page/2/": False,
    "https://a.org/Category/x/": False,
    "https://a.org/tag/x/": False,
    "https://a.org/author/me/": False,
    "https://a.org/feed/": False,
    "https://a.org/wp-json/v2/": False,
    "https://a.org/x-wp-admin-y/": False,
    "https://a.org/a.jpg": False,
    "https://a.org/a.jpg/": True,
    "https://a.org/page": False,
    "not a url/": True,
    "https://a.org/bad[path/": True,
}


def test_usable(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    got = {r[0]: r[1] for r in df.select("u", ux.is_usable(F.col("u"))).collect()}
    assert got == URLS


def test_path_and_query_as_a_url_parser_sees_them(spark):
    df = spark.createDataFrame([(u,) for u in [*URLS, "https://h/a;p/b/;x=1", "//h/p/?q#f?g"]], "u string")
    for url, path, query in df.select("u", ux.path(F.col("u")), ux.query_string(F.col("u"))).collect():
        parsed = urlparse(url)
        assert (path, query) == (parsed.path.lower(), parsed.query), url


def test_banned_and_root(spark):
    df = spark.createDataFrame([("https://a.org/About-us/",), ("http://b.org/x",), ("ftp://c/",)], "u string")
    rows = df.select(ux.has_no_banned_word(F.col("u")), ux.site_root(F.col("u"))).collect()
    assert [tuple(r) for r in rows] == [(False, "https://a.org"), (True, "http://b.org"), (True, "")]


AUTHORS = [
    ('<meta name="author" content="Ann">', "Ann", "Ann"),
    ('<meta content="Bo &amp; Co" property="article:author">', "Bo & Co", None),
    ("<meta name='article:author' content='Cy'>", "Cy", None),
    # The first tag present is taken even if a later one has text.
    ('<meta name="author" content=""><meta property="article:author" content="No"><span class="author">Di</span>', "Di", ""),
    ('<span class="author"> Ed </span><a rel="author">No</a>', "Ed", None),
    ('<span class="authors">No</span><a href="/x" rel="me author"><b>Fi</b></a>', "Fi", None),
    ('<meta property="author" content=" Gi "><meta name="author" content="Hu">', "Hu", "Gi"),
    ("<p>nobody</p>", "", None),
]


def test_author_chain(spark):
    df = spark.createDataFrame([(i, a[0]) for i, a in enumerate(AUTHORS)], "i int, h string")
    rows = df.select("i", hx.author(F.col("h")), hx.author_older(F.col("h"))).orderBy("i").collect()
    assert [(r[1], r[2]) for r in rows] == [(a[1], a[2]) for a in AUTHORS]


def test_description_and_title(spark):
    both = '<TITLE>A &amp; B</TITLE><meta name="description" content="d"><meta property="og:description" content=" og ">'
    df = spark.createDataFrame([(1, both), (2, '<meta name=description content=plain>'), (3, "x")], "i int, h string")
    h = F.col("h")
    rows = df.select(hx.title_raw(h), hx.title_text(h), hx.description(h), hx.description_older(h)).collect()
    assert tuple(rows[0]) == ("A &amp; B", "A & B", " og ", "og")
    assert tuple(rows[1]) == (None, None, "", "plain")
    assert tuple(rows[2]) == (None, None, "", None)


def test_sitemaps(spark):
    body = "<urlset><url><loc>u1</loc></url><url><lastmod>1</lastmod></url><URL><loc>u2</loc><loc>no</loc></URL></urlset>"
    rows = [
        ("s1", "sitemap.xml", 200, body), ("s1", "post-sitemap.xml", 404, "x"), ("s1", "sitemap_index.xml", 200, "y"),
        ("s2", "robots.txt", 200, "z"), ("s3", "sitemap-1.xml", 204, "<url><loc>a</loc></url>"),
    ]
    df = spark.createDataFrame(rows, "site string, path string, status long, body string")
    chosen = extract.chosen_sitemaps(df)
    assert {(r["site"], r["path"]) for r in chosen.collect()} == {("s1", "sitemap.xml"), ("s3", "sitemap-1.xml")}
    pages = extract.listed_pages(chosen)
    assert [(r["pos"], r["url"]) for r in pages.filter("site = 's1'").orderBy("pos").collect()] == [(0, "u1"), (1, "u2")]
    older = extract.chosen_sitemaps(df, extract.SITEMAP_PATHS_OLDER, (200, 200))
    assert [r["site"] for r in older.collect()] == ["s1"]
