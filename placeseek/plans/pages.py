"""Pages to posts: queries B1 to B24."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeseek.functions import html as hx
from placeseek.functions import text as tx
from placeseek.functions import urls as ux
from placeseek.functions import values as vx
from placeseek.operators import build, extract, gazetteer
from placeseek.plans import shared
from placeseek.plans.registry import query
from placeseek.sources.tables import dealt_out, posts_from_documents, table

STOP_WORDS = ("the", "of", "and", "de", "la", "der", "und")

PATH = f"lower(regexp_replace(regexp_extract(url, '{ux.PATH}', 1), '{ux.PARAMS}', ''))"
USABLE = " AND ".join(
    [f"{PATH} LIKE '%/'", f"regexp_extract(url, '{ux.QUERY}', 1) = ''"]
    + [f"NOT contains({PATH}, '{part}')" for part in ux.REJECTED_PARTS]
    + [f"NOT ends_with({PATH}, '{ending}')" for ending in ux.REJECTED_ENDINGS]
)
ROOT = f"regexp_extract(url, '{ux.ROOT}', 0)"
UNBANNED = f"NOT regexp_matches(lower(url), '{'|'.join(ux.BANNED_WORDS)}')"
TITLE_RAW = f"CASE WHEN regexp_matches(html, '{hx.TITLE}') THEN regexp_extract(html, '{hx.TITLE}', 1) END"


def sql_decode(x: str) -> str:
    for entity, char in hx.ENTITIES:
        x = f"replace({x}, '{entity}', {shared.sql_text(char)})"
    return x


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '\s*<[^>]*>\s*', '', 'g')"


PARAGRAPHS = f"""list_transform(
  (string_split_regex(regexp_replace(html, '{hx.INVISIBLE}', '', 'g'), '{hx.PARAGRAPH_OPEN}'))[2:],
  lambda p: regexp_replace({sql_decode(sql_strip(f"string_split_regex(p, '{hx.PARAGRAPH_CLOSE}')[1]"))}, '^{tx.SPACES}|{tx.SPACES}$', '', 'g'))"""
BODY_CLEAN = shared.sql_clean(
    f"array_to_string(list_transform({PARAGRAPHS}, lambda q: {shared.sql_clean('q')}), ' ')"
)
BODY_LONG = f"array_to_string(list_filter({PARAGRAPHS}, lambda q: length(q) > 30), chr(10))"


def _pages(spark, folder):
    return dealt_out(table(spark, folder, "pages"), "page_id")


@query("b1_usable_urls", f"SELECT page_id, url, ({USABLE}) AS usable FROM pages")
def usable_urls(spark, folder):
    return _pages(spark, folder).select("page_id", "url", ux.is_usable(F.col("url")).alias("usable"))


@query(
    "b1_usable_post_urls",
    f"WITH {shared.POSTS} SELECT id, page_url FROM (SELECT id, page_url, page_url AS url FROM posts) WHERE {USABLE}",
)
def usable_post_urls(spark, folder):
    posts = posts_from_documents(spark, folder, ("id", "page_url"))
    return posts.filter(ux.is_usable(F.col("page_url")))


@query("b2_banned_words", f"SELECT page_id, url FROM pages WHERE {UNBANNED}")
def banned_words(spark, folder):
    return _pages(spark, folder).filter(ux.has_no_banned_word(F.col("url"))).select("page_id", "url")


@query("b3_site_root", f"SELECT page_id, {ROOT} AS site FROM pages WHERE {ROOT} <> ''")
def site_root(spark, folder):
    rows = _pages(spark, folder).select("page_id", ux.site_root(F.col("url")).alias("site"))
    return rows.filter(F.col("site") != "")


# Stored sitemap responses, made of the pages: the path and the status vary with the
# length of the URL, the body lists the page.
STATUSES = (200, 404, 204, 500, 200, 301, 403)
RESPONSE_PATHS = extract.SITEMAP_PATHS + ("robots.txt",)
SITEMAP_BODY = (
    "'<urlset><url><loc>' || url || '</loc><loc>second</loc></url><url><lastmod>x</lastmod></url></urlset>'"
)
RESPONSES = f"""
responses AS (
  SELECT {ROOT} AS site, {list(RESPONSE_PATHS)}[length(html) % 5 + 1] AS path,
         {list(STATUSES)}[length(url) % 7 + 1] AS status, {SITEMAP_BODY} AS body
  FROM pages)"""


def _responses(spark, folder):
    def pick(values, turn):
        return F.element_at(F.lit(list(values)), (turn + 1).cast("int"))

    body = F.concat(
        F.lit("<urlset><url><loc>"), F.col("url"),
        F.lit("</loc><loc>second</loc></url><url><lastmod>x</lastmod></url></urlset>"),
    )
    return _pages(spark, folder).select(
        ux.site_root(F.col("url")).alias("site"),
        pick(RESPONSE_PATHS, F.char_length("html") % 5).alias("path"),
        pick(STATUSES, F.char_length("url") % 7).cast("long").alias("status"),
        body.alias("body"),
    )


CHOSEN = f"""
chosen AS (
  SELECT site, path, status, body FROM (
    SELECT *, row_number() OVER (PARTITION BY site ORDER BY list_position({list(extract.SITEMAP_PATHS)}, path), path, status, body) AS n
    FROM responses WHERE path IN {extract.SITEMAP_PATHS} AND status BETWEEN 200 AND 299)
  WHERE n = 1)"""


@query("b4_sitemap_choice", f"WITH {RESPONSES}, {CHOSEN} SELECT * FROM chosen")
def sitemap_choice(spark, folder):
    return extract.chosen_sitemaps(_responses(spark, folder))


@query(
    "b4_sitemap_choice_older",
    f"""WITH {RESPONSES} SELECT site, path, status, body FROM (
    SELECT *, row_number() OVER (PARTITION BY site ORDER BY list_position({list(extract.SITEMAP_PATHS_OLDER)}, path), path, status, body) AS n
    FROM responses WHERE path IN {extract.SITEMAP_PATHS_OLDER} AND status = 200) WHERE n = 1""",
)
def sitemap_choice_older(spark, folder):
    return extract.chosen_sitemaps(
        _responses(spark, folder), extract.SITEMAP_PATHS_OLDER, (200, 200)
    )


@query(
    "b5_sitemap_links",
    """WITH numbered AS (
  SELECT page_id // 100 AS block, url, row_number() OVER (PARTITION BY page_id // 100 ORDER BY page_id) - 1 AS pos FROM pages)
SELECT block, pos, url FROM numbered""",
)
def sitemap_links(spark, folder):
    """Sitemaps of at most a hundred neighbouring pages each, taken apart again."""
    entries = _pages(spark, folder).select(
        F.floor(F.col("page_id") / 100).alias("block"),
        "page_id",
        F.concat(
            F.lit("<url>\n<loc>"), F.col("url"), F.lit("</loc><lastmod>2024</lastmod></url><url><x/></url>")
        ).alias("entry"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("page_id", "entry")))
    body = F.array_join(F.transform(ordered, lambda e: e["entry"]), "\n")
    sitemaps = entries.groupBy("block").agg(
        F.concat(F.lit('<?xml version="1.0"?><urlset>'), body, F.lit("</urlset>")).alias("body")
    )
    return extract.listed_pages(sitemaps).select("block", F.col("pos").cast("long").alias("pos"), "url")


@query(
    "b6_pages_per_site",
    f"""SELECT site, id, place FROM (
  SELECT source AS site, doc_id AS id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place FROM documents)
WHERE place <= {extract.PAGES_PER_SITE}""",
)
def pages_per_site(spark, folder):
    posts = posts_from_documents(spark, folder, ("id", "blog_url")).withColumnRenamed("blog_url", "site")
    return extract.first_pages(posts, order="id").select("site", "id", "place")


@query(
    "b7_title_raw",
    f"""SELECT page_id, replace(replace(replace({sql_decode(TITLE_RAW)}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS title
FROM pages WHERE {TITLE_RAW} IS NOT NULL""",
)
def title_raw(spark, folder):
    rows = _pages(spark, folder).select("page_id", hx.title_raw(F.col("html")).alias("title"))
    return rows.filter(F.col("title").isNotNull())


@query("b8_title_text", f"SELECT page_id, trim({sql_decode(sql_strip(TITLE_RAW))}) AS title FROM pages")
def title_text(spark, folder):
    return _pages(spark, folder).select("page_id", hx.title_text(F.col("html")).alias("title"))


# Pages made of the documents, with description and author marks in every known form.
def _marked_pages(spark, folder):
    posts = posts_from_documents(spark, folder, ("id", "blog_url", "page_description"))

    def escaped(c):
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            c = F.replace(c, F.lit(char), F.lit(entity))
        return c

    description = escaped(F.col("page_description"))
    who = F.concat(F.col("blog_url"), F.lit(" &amp; co"))
    form = F.col("id") % 6
    size = F.col("id") % 3
    head = F.concat(
        F.when(size == 0, F.concat(F.lit('<meta property="og:description" content="'), description, F.lit('"/>')))
        .when(size == 1, F.concat(F.lit('<META content="'), description, F.lit('" name="description">')))
        .otherwise(""),
        F.when(form == 0, F.concat(F.lit("<meta name='author' content='"), who, F.lit("'>")))
        .when(form == 1, F.concat(F.lit('<meta content="'), who, F.lit('" property="article:author" >')))
        .when(form == 2, F.concat(F.lit('<meta name="article:author" content="'), who, F.lit('">')))
        .when(form == 3, F.lit('<meta name="author" content="">'))
        .when(form == 4, F.lit('<meta property="author" content=" editor ">'))
        .otherwise(""),
    )
    body = F.when(
        form == 3, F.concat(F.lit('<span id="x" class="by author big">'), F.lit("<i> "), who, F.lit(" </i></span>"))
    ).when(form == 4, F.concat(F.lit('<a href="/a" rel="author">'), who, F.lit("</a>"))).otherwise("<span>x</span>")
    markup = F.concat(F.lit("<html><head>"), head, F.lit("</head><body>"), body, F.lit("</body></html>"))
    return posts.select("id", markup.alias("html"))


@query(
    "b9_description",
    f"""WITH {shared.POSTS} SELECT id, CASE WHEN id % 3 = 0 THEN page_description ELSE '' END AS description,
CASE WHEN id % 3 < 2 THEN trim(page_description) END AS older FROM posts""",
)
def description(spark, folder):
    return _marked_pages(spark, folder).select(
        "id", hx.description(F.col("html")).alias("description"), hx.description_older(F.col("html")).alias("older")
    )


@query(
    "b10_author",
    f"""WITH {shared.POSTS} SELECT id, CASE WHEN id % 6 < 5 THEN blog_url || ' & co' ELSE '' END AS author,
CASE id % 6 WHEN 4 THEN 'editor' WHEN 0 THEN blog_url || ' & co' WHEN 3 THEN '' END AS older FROM posts""",
)
def author(spark, folder):
    return _marked_pages(spark, folder).select(
        "id", hx.author(F.col("html")).alias("author"), hx.author_older(F.col("html")).alias("older")
    )


@query("b11_body_clean", f"SELECT page_id, {BODY_CLEAN} AS content FROM pages")
def body_clean(spark, folder):
    return extract.with_clean_body(_pages(spark, folder)).select("page_id", "content")


@query("b12_body_long_paragraphs", f"SELECT page_id, {BODY_LONG} AS content FROM pages")
def body_long_paragraphs(spark, folder):
    return extract.with_long_body(_pages(spark, folder)).select("page_id", "content")


@query(
    "b13_served_pages",
    f"""SELECT page_id, content FROM (SELECT page_id, url, {BODY_LONG} AS content FROM pages)
WHERE length(url) % 5 <> 0 AND content <> ''""",
)
def served_pages(spark, folder):
    status = F.when(F.char_length("url") % 5 == 0, 404).otherwise(200)
    pages = _pages(spark, folder).withColumn("status", status)
    return extract.served(pages).select("page_id", "content")


@query(
    "b13_scraped_records",
    f"""SELECT * FROM (
  SELECT url, trim({sql_decode(sql_strip(TITLE_RAW))}) AS title, CAST(NULL AS VARCHAR) AS description,
         CAST(NULL AS VARCHAR) AS author, {BODY_LONG} AS content, {ROOT} AS base_domain
  FROM pages WHERE {UNBANNED}) WHERE content <> '' AND base_domain <> ''""",
)
def scraped_records(spark, folder):
    return extract.scraped(_pages(spark, folder))


@query("b14_clean_text", f"SELECT doc_id AS id, {shared.sql_clean('text')} AS cleaned FROM documents")
def clean_text(spark, folder):
    return posts_from_documents(spark, folder, ("id", "content"), busy=True).select(
        "id", tx.clean_text(F.col("content")).alias("cleaned")
    )


@query(
    "b14_clean_conversations",
    f"SELECT conv_id, turn, {shared.sql_clean('text')} AS cleaned FROM conversations",
)
def clean_conversations(spark, folder):
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", tx.clean_text(F.col("text")).alias("cleaned")
    )


@query(
    "b15_clean_text_stop_words",
    f"""SELECT doc_id AS id, array_to_string(list_filter(string_split({shared.sql_clean('text')}, ' '),
lambda w: w <> '' AND w NOT IN {STOP_WORDS}), ' ') AS cleaned FROM documents""",
)
def clean_text_stop_words(spark, folder):
    return posts_from_documents(spark, folder, ("id", "content"), busy=True).select(
        "id", tx.clean_text_without(F.col("content"), STOP_WORDS).alias("cleaned")
    )


def sql_found(source: str) -> str:
    """CTEs up to ``found(id, location_name)`` for rows (id, page_title, page_description)."""
    pieces = " UNION ALL ".join(
        f"SELECT id, {n} AS source, regexp_extract_all(lower({c}), '{gazetteer.WORD_OR_MARK}') AS w, "
        f"regexp_extract_all({c}, '{gazetteer.WORD_OR_MARK}') AS o FROM {source}"
        for n, c in enumerate(("page_title", "page_description"))
    )
    return f"""{shared.GAZETTEER},
pieces AS ({pieces}),
starts AS (SELECT *, unnest(range(1, len(w) + 1)) AS s FROM pieces),
known AS (SELECT DISTINCT string_split(name, ' ') AS g FROM gnames),
matches AS (
  SELECT id, source, s, len(g) AS len, array_to_string(list_slice(o, s, s + len(g) - 1), ' ') AS shown
  FROM starts JOIN known ON w[s] = g[1] AND list_slice(w, s, s + len(g) - 1) = g),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY source, s, len DESC) AS n FROM matches) WHERE n = 1),
nexts AS (
  SELECT id, arg_max(m.shown, m.len) AS shown FROM firsts f JOIN matches m USING (id)
  WHERE m.source = f.source AND m.s = f.s + 1 GROUP BY id),
found AS (
  SELECT f.id, CASE WHEN f.len = 1 AND n.shown IS NOT NULL THEN f.shown || ', ' || n.shown ELSE f.shown END AS location_name
  FROM firsts f LEFT JOIN nexts n USING (id))"""


KEY = f"array_to_string(regexp_extract_all(lower(location_name), '{gazetteer.WORD_OR_MARK}'), ' ')"


def _found(spark, folder):
    posts = posts_from_documents(spark, folder, ("id", "page_title", "page_description"), busy=True)
    return gazetteer.place_names(posts, shared.gazetteer(spark, folder), ["id"])


@query("b16_place_names", f"WITH {shared.POSTS}, {sql_found('posts')} SELECT * FROM found")
def place_names(spark, folder):
    return _found(spark, folder)


@query(
    "b17_coordinates",
    f"""WITH {shared.POSTS}, {sql_found('posts')}
SELECT id, location_name, lat AS latitude, lon AS longitude FROM found LEFT JOIN gazetteer ON name = {KEY}""",
)
def coordinates(spark, folder):
    return gazetteer.with_coordinates(_found(spark, folder), shared.gazetteer(spark, folder))


@query(
    "b18_placed_posts",
    f"""WITH {shared.POSTS}, {sql_found('posts')}
SELECT p.id, f.location_name FROM posts p JOIN found f USING (id)""",
)
def placed_posts(spark, folder):
    posts = posts_from_documents(spark, folder, ("id",)).join(_found(spark, folder), "id", "left")
    return gazetteer.placed_only(posts)


NUMBERS = f"""WITH {shared.POSTS}
SELECT id, CASE WHEN length(content) % 4 = 0 THEN 'NaN'::DOUBLE ELSE latitude / 7 END AS v FROM posts"""


def _numbers(spark, folder):
    """Latitudes as fractions, with NaN where the text has a certain length."""
    posts = posts_from_documents(spark, folder, ("id", "latitude", "content"))
    value = F.when(F.char_length("content") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("latitude") / 7)
    return posts.select("id", value.alias("v"))


@query(
    "b19_without_nan",
    f"SELECT id, round(CASE WHEN isnan(v) THEN NULL ELSE v END, 6) AS v FROM ({NUMBERS})",
)
def without_nan(spark, folder):
    return _numbers(spark, folder).select("id", F.round(vx.without_nan(F.col("v")), 6).alias("v"))


@query(
    "b20_exact_decimal",
    """SELECT o_orderkey, CAST(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38, 18)) AS VARCHAR) AS price FROM orders""",
)
def exact_decimal(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", vx.exact_decimal(F.col("o_totalprice")).cast("string").alias("price")
    )


@query(
    "b21_search_text",
    f"""WITH {shared.POSTS} SELECT id, md5(page_title || ' ' || page_description || ' ' || content) AS digest FROM posts""",
)
def search_text(spark, folder):
    docs = shared.searchable(spark, folder)
    return docs.select(F.col("doc_id").alias("id"), F.md5("text").alias("digest"))


@query(
    "b22_short_search_text",
    f"""WITH {shared.POSTS} SELECT id, md5(page_title || ' ' || content) AS digest, md5(coalesce(nullif(content, ''), '')) AS encoder
FROM posts""",
)
def short_search_text(spark, folder):
    posts = posts_from_documents(spark, folder, ("id", "page_title", "content"))
    emptied = F.nullif(F.col("content"), F.lit(""))
    return posts.select(
        "id",
        F.md5(tx.search_text_short(F.col("page_title"), F.col("content"))).alias("digest"),
        F.md5(tx.encoder_text(emptied)).alias("encoder"),
    )


@query(
    "b23_record_keys",
    """SELECT event_id, CASE WHEN length(CAST(k AS VARCHAR)) >= 6 THEN CAST(k AS VARCHAR) ELSE lpad(CAST(k AS VARCHAR), 6, '0') END AS record_key
FROM (SELECT event_id, event_id * 997 AS k FROM events)""",
)
def record_keys(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", tx.record_key(F.col("event_id") * 997).alias("record_key")
    )


@query(
    "b24_pages_to_posts",
    f"""WITH src AS (
  SELECT page_id AS id, {ROOT} AS blog_url, url AS page_url, {TITLE_RAW} AS page_title, '' AS page_description,
         '' AS page_author, {BODY_CLEAN} AS content
  FROM pages WHERE {USABLE} AND {TITLE_RAW} IS NOT NULL),
{sql_found('src')},
placed AS (
  SELECT s.*, location_name, lat AS latitude, lon AS longitude,
         row_number() OVER (PARTITION BY page_url ORDER BY s.id) AS n
  FROM src s JOIN found f USING (id) LEFT JOIN gazetteer ON name = {KEY})
SELECT id, blog_url, page_url, page_title, page_description, page_author, location_name, latitude, longitude, content
FROM placed WHERE n = 1""",
)
def pages_to_posts(spark, folder):
    return build.placed_posts(_pages(spark, folder), shared.gazetteer(spark, folder))
