"""Corpus statistics: queries F1 to F6 and F10 to F22."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeseek.functions import values as vx
from placeseek.operators import stats
from placeseek.plans import shared
from placeseek.plans.registry import query
from placeseek.session import stored
from placeseek.sources.tables import posts_from_documents, table

STOP_WORDS = ("the", "of", "and", "de", "la", "le", "les", "et", "der", "die", "das", "und", "el", "que")

WORDS = (
    f"CASE WHEN {shared.sql_squeeze('content')} = '' THEN 0 ELSE "
    f"len(string_split({shared.sql_squeeze('content')}, ' ')) END"
)


def _posts(spark, folder, *columns):
    return posts_from_documents(spark, folder, columns, busy="content" in columns)


PLACE = ("location_name", "latitude", "longitude")


@query("f1_row_count", "SELECT count(*) AS posts FROM documents")
def row_count(spark, folder):
    return _posts(spark, folder, "id").agg(F.count("id").alias("posts"))


OVERVIEW = """SELECT count(*) AS total_posts, count(DISTINCT location_name) AS unique_locations,
count(DISTINCT blog_url) AS unique_blogs, count(DISTINCT page_author) AS unique_authors FROM posts"""


@query("f2_distinct_counts", f"WITH {shared.POSTS} {OVERVIEW}")
def distinct_counts(spark, folder):
    return stats.overview(_posts(spark, folder, "location_name", "blog_url", "page_author"))


PLACES = """SELECT location_name, latitude, longitude, count(*) AS cnt FROM posts
WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL"""


@query("f3_posts_per_place", f"WITH {shared.POSTS} {PLACES}")
def posts_per_place(spark, folder):
    return stats.places(_posts(spark, folder, *PLACE))


@query(
    "f4_statistics_payload",
    f"WITH {shared.POSTS}, o AS ({OVERVIEW}), p AS ({PLACES}) SELECT p.*, o.* FROM p, o",
)
def statistics_payload(spark, folder):
    return stats.payload(_posts(spark, folder, *PLACE, "blog_url", "page_author"))


@query(
    "f5_count_classes",
    f"""WITH {shared.POSTS}, p AS ({PLACES}) SELECT location_name, latitude, longitude, cnt,
CASE WHEN cnt <= 20 THEN 'red' WHEN cnt <= 40 THEN 'yellow' ELSE 'green' END AS count_class FROM p""",
)
def count_classes(spark, folder):
    return stats.with_count_class(stats.places(_posts(spark, folder, *PLACE)))


@query(
    "f5_count_classes_customers",
    """SELECT c_nationkey, c_mktsegment, count(*) AS cnt, CASE WHEN count(*) <= 20 THEN 'red'
WHEN count(*) <= 40 THEN 'yellow' ELSE 'green' END AS count_class FROM customer GROUP BY ALL""",
)
def count_classes_customers(spark, folder):
    grouped = table(spark, folder, "customer").groupBy("c_nationkey", "c_mktsegment")
    return stats.with_count_class(grouped.agg(F.count(F.lit(1)).alias("cnt")))


@query(
    "f6_map_centre",
    f"""WITH {shared.POSTS}, p AS ({PLACES})
SELECT round(avg(latitude), 6) AS centre_lat, round(avg(longitude), 6) AS centre_lon FROM p""",
)
def map_centre(spark, folder):
    centre = stats.map_centre(stats.places(_posts(spark, folder, *PLACE)))
    return centre.select(*[F.round(c, 6).alias(c) for c in centre.columns])


TEXT_COLUMNS = ("blog_url", "page_url", "page_title", "page_description", "page_author", "location_name", "content")


def _sql_describe_text(c):
    return f"""SELECT '{c}' AS name, count({c}) AS cnt, count(DISTINCT {c}) AS "unique",
(SELECT {c} FROM posts WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
(SELECT count(*) FROM posts WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS freq FROM posts"""


@query(
    "f10_describe_text",
    f"WITH {shared.POSTS} " + " UNION ALL ".join(_sql_describe_text(c) for c in TEXT_COLUMNS),
)
def describe_text(spark, folder):
    return stats.describe_text(_posts(spark, folder, *TEXT_COLUMNS), TEXT_COLUMNS)


def sql_describe(source: str, c: str) -> str:
    return f"""SELECT '{c}' AS name, count({c}) AS cnt, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
CAST(min({c}) AS DOUBLE) AS min_value, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
round(quantile_cont({c}, 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS max_value FROM {source}"""


def _described(df, columns):
    out = stats.describe_numbers(df, columns)
    rounded = ("mean", "std", "q25", "q50", "q75")
    return out.select(*[F.round(c, 4).alias(c) if c in rounded else F.col(c) for c in out.columns])


@query(
    "f10_describe_numbers",
    f"WITH {shared.POSTS} "
    + " UNION ALL ".join(sql_describe("posts", c) for c in ("id", "latitude", "longitude")),
)
def describe_numbers(spark, folder):
    return _described(_posts(spark, folder, "id", "latitude", "longitude"), ("id", "latitude", "longitude"))


ORDER_VALUES = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "f10_describe_lineitem",
    " UNION ALL ".join(sql_describe("lineitem", c) for c in ORDER_VALUES),
)
def describe_lineitem(spark, folder):
    return _described(table(spark, folder, "lineitem"), ORDER_VALUES)


POST_TYPES = (
    ("id", "bigint"), ("blog_url", "string"), ("page_url", "string"), ("page_title", "string"),
    ("page_description", "string"), ("page_author", "string"), ("location_name", "string"),
    ("latitude", "double"), ("longitude", "double"), ("content", "string"),
)


@query(
    "f11_non_null_counts",
    f"WITH {shared.POSTS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM posts" for c, t in POST_TYPES
    ),
)
def non_null_counts(spark, folder):
    return stats.non_null_counts(posts_from_documents(spark, folder))


def _sql_top(n):
    return f"""WITH {shared.POSTS} SELECT location_name, count(*) AS cnt FROM posts
GROUP BY location_name ORDER BY cnt DESC, location_name LIMIT {n}"""


@query("f12_top_locations_20", _sql_top(20))
def top_locations_20(spark, folder):
    return stats.top_values(_posts(spark, folder, "location_name"), "location_name", 20)


@query("f12_top_locations_15", _sql_top(15))
def top_locations_15(spark, folder):
    return stats.top_values(_posts(spark, folder, "location_name"), "location_name", 15)


@query("f13_word_count", f"WITH {shared.POSTS} SELECT id, {WORDS} AS word_count FROM posts")
def word_count(spark, folder):
    return stats.with_word_count(_posts(spark, folder, "id", "content")).select(
        "id", F.col("word_count").cast("long").alias("word_count")
    )


LENGTHS = f"""lengths AS (SELECT id, length(page_title) AS title_len, length(page_description) AS desc_len,
{WORDS} AS word_count FROM posts)"""
FEATURES = ("title_len", "desc_len", "word_count")


def _lengths(spark, folder):
    """Three numbers a post, stored: the texts are measured once."""
    posts = _posts(spark, folder, "id", "page_title", "page_description", "content")
    return stored(stats.with_text_lengths(stats.with_word_count(posts)).select("id", *FEATURES), "lengths")


@query(
    "f14_describe_word_count",
    f"WITH {shared.POSTS}, {LENGTHS} {sql_describe('lengths', 'word_count')}",
)
def describe_word_count(spark, folder):
    return _described(_lengths(spark, folder), ("word_count",))


@query(
    "f14_describe_lengths",
    f"WITH {shared.POSTS}, {LENGTHS} " + " UNION ALL ".join(sql_describe("lengths", c) for c in FEATURES),
)
def describe_lengths(spark, folder):
    return _described(_lengths(spark, folder), FEATURES)


@query(
    "f15_text_lengths",
    f"WITH {shared.POSTS}, {LENGTHS} SELECT id, title_len, desc_len FROM lengths",
)
def text_lengths(spark, folder):
    return _lengths(spark, folder).select(
        "id", F.col("title_len").cast("long").alias("title_len"), F.col("desc_len").cast("long").alias("desc_len")
    )


def sql_histogram(source: str, c: str, bins: int) -> str:
    return f"""SELECT CAST(CASE WHEN high > low THEN least(floor(({c} - low) / ((high - low) / {bins})), {bins} - 1) ELSE 0 END AS INTEGER) AS bin,
count(*) AS cnt FROM {source}, (SELECT CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high FROM {source}) GROUP BY 1"""


@query(
    "f16_histogram_word_count",
    f"WITH {shared.POSTS}, {LENGTHS} {sql_histogram('lengths', 'word_count', 100)}",
)
def histogram_word_count(spark, folder):
    return stats.histogram(_lengths(spark, folder), "word_count", 100)


@query("f16_histogram_prices", sql_histogram("orders", "o_totalprice", 100))
def histogram_prices(spark, folder):
    return stats.histogram(table(spark, folder, "orders"), "o_totalprice", 100)


@query(
    "f17_length_correlations",
    f"WITH {shared.POSTS}, {LENGTHS} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS first, '{b}' AS second, round(corr({a}, {b}), 6) AS corr FROM lengths"
        for a, b in (("title_len", "desc_len"), ("title_len", "word_count"), ("desc_len", "word_count"))
    ),
)
def length_correlations(spark, folder):
    pairs = stats.correlations(_lengths(spark, folder), FEATURES)
    return pairs.select("first", "second", F.round("corr", 6).alias("corr"))


def _sql_box(name, south, north, west, east):
    lon = "" if west is None else f" AND longitude BETWEEN {west} AND {east}"
    return f"WHEN latitude BETWEEN {south} AND {north}{lon} THEN '{name}'"


CONTINENT = "CASE " + " ".join(_sql_box(*box) for box in vx.CONTINENTS) + " ELSE 'Unknown' END"


@query("f18_continent", f"WITH {shared.POSTS} SELECT id, {CONTINENT} AS continent FROM posts")
def continent(spark, folder):
    return stats.with_continent(_posts(spark, folder, "id", "latitude", "longitude")).select("id", "continent")


@query(
    "f19_posts_per_continent",
    f"WITH {shared.POSTS} SELECT {CONTINENT} AS continent, count(*) AS cnt FROM posts GROUP BY 1",
)
def posts_per_continent(spark, folder):
    return stats.per_continent(_posts(spark, folder, "latitude", "longitude"))


@query(
    "f20_top_words",
    f"""SELECT word, count(*) AS cnt FROM (SELECT unnest({shared.sql_tokens('text')}) AS word FROM documents)
WHERE word NOT IN ({', '.join(shared.sql_text(w) for w in STOP_WORDS)}) GROUP BY word ORDER BY cnt DESC, word LIMIT 30""",
)
def top_words(spark, folder):
    return stats.top_words(_posts(spark, folder, "content"), 30, STOP_WORDS)


TONES = f"""{shared.LEXICON},
tones AS (
  SELECT d.doc_id AS id, coalesce(avg(weight), 0) AS tone
  FROM documents d
  LEFT JOIN (SELECT doc_id, unnest({shared.sql_tokens('text')}) AS term FROM documents) t ON t.doc_id = d.doc_id
  LEFT JOIN lexicon USING (term) GROUP BY d.doc_id)"""


def _tones(spark, folder):
    tones = stats.tone(_posts(spark, folder, "id", "content"), shared.lexicon(spark, folder))
    return tones.select("id", F.round("tone", 6).alias("tone"))


@query("f21_tone", f"WITH {TONES} SELECT id, round(tone, 6) AS tone FROM tones")
def tone(spark, folder):
    return _tones(spark, folder)


@query(
    "f16_histogram_tone",
    f"WITH {TONES}, rounded AS (SELECT round(tone, 6) AS tone FROM tones) {sql_histogram('rounded', 'tone', 30)}",
)
def histogram_tone(spark, folder):
    # The histogram reads its input twice; the tones are worth storing once.
    return stats.histogram(stored(_tones(spark, folder), "tones"), "tone", 30)


@query(
    "f22_coverage_points",
    f"""WITH {shared.POSTS} SELECT round(latitude) AS lat, round(longitude) AS lon, count(*) AS cnt FROM posts
WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2""",
)
def coverage_points(spark, folder):
    return stats.coverage_points(_posts(spark, folder, "latitude", "longitude"))


@query(
    "f22_post_points",
    f"WITH {shared.POSTS} SELECT id, latitude, longitude FROM posts",
)
def post_points(spark, folder):
    return _posts(spark, folder, "id", "latitude", "longitude")
