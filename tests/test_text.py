"""Text rules against plain Python, on texts chosen to hurt."""

import html
import re
import sys
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placeseek.functions import html as hx
from placeseek.functions import text as tx
from placeseek.functions import values as vx
from placeseek.operators import extract, rerank

TEXTS = [
    "",
    "  Hello,   WORLD!  ",
    "“Quoted” ‘text’ – with — dashes - and (marks) 100% & @home #1_a",
    "ﬁne ½ ² Ⅷ ａｂｃ ﹘ x\u2009y\u00a0z\u3000w",
    "tab\tnew\nline\r\x0bpage\x0c end\x1c\x1f.",
    "Île-de-France, ÉTÉ; naïve café e\u0301 Straße İstanbul",
    "don't 'quote' \"double\" a/b\\c *x* <y> + = ~ ^ | # _ % ? ; :",
    "東京 と 京都 カタカナ ﾊﾝｶｸ",
    "x﹘y z—w",
]


def plain_clean(text, normalise=True):
    for curly, straight in zip("“”‘’–—", "\"\"''--"):
        text = text.replace(curly, straight)
    if normalise:
        text = unicodedata.normalize("NFKC", text)
    text = "".join(c for c in text if c not in "()/*\\><+=~^|#_%'\",.!?;:")
    text = text.replace("&", "and").replace("@", "at").replace("-", " ")
    return " ".join(text.lower().split())


def column(spark, texts, *exprs):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *exprs).orderBy("i").collect()]


def test_clean_text(spark):
    got = column(spark, TEXTS, tx.clean_text(F.col("t")), tx.clean_text(F.col("t"), False))
    assert got == [(plain_clean(t), plain_clean(t, False)) for t in TEXTS]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=60, max_size=60))
def test_clean_text_any(spark, texts):
    texts = [t for t in texts if not any(0xD800 <= ord(c) < 0xE000 for c in t)]
    got = column(spark, texts, tx.clean_text(F.col("t")))
    for text, (out,) in zip(texts, got):
        # Lower-casing and normal forms follow the Unicode version of each platform.
        if all(unicodedata.category(c) not in ("Cn", "Lu", "Lt", "Mn") for c in text):
            assert out == plain_clean(text)


def test_cleaning_twice_changes_nothing(spark):
    # Not so for the small em dash, which normalisation turns into a dash after that step.
    texts = [t for t in TEXTS if "﹘" not in t]
    once = [r[0] for r in column(spark, texts, tx.clean_text(F.col("t")))]
    twice = [r[0] for r in column(spark, once, tx.clean_text(F.col("t")))]
    assert twice == once


def test_stable_characters_survive_normalisation():
    stable = re.compile("[" + re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", tx.NFKC_STABLE) + "]")
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if stable.match(char):
            assert unicodedata.normalize("NFKC", char) == char
            assert unicodedata.combining(char) == 0
    accents = "".join(chr(c) for c in range(0x300, 0x370))
    assert not stable.search(accents)


def test_tokens_follow_word_characters(spark):
    texts = TEXTS[:5] + TEXTS[6:7]
    got = column(spark, texts, tx.tokens(F.col("t")))
    assert [r[0] for r in got] == [re.findall(r"\b\w+\b", t.lower()) for t in texts]


def test_null_has_no_tokens_and_no_words(spark):
    df = spark.createDataFrame([(None,)], "t string")
    row = df.select(tx.tokens(F.col("t")), tx.word_count(F.col("t"))).first()
    assert list(row[0]) == [] and row[1] == 0


def test_word_count(spark):
    got = column(spark, TEXTS, tx.word_count(F.col("t")))
    assert [r[0] for r in got] == [len(t.split()) for t in TEXTS]


def test_stop_words(spark):
    got = column(spark, ["The cat and THE dog, don't!"], tx.clean_text_without(F.col("t"), ["the", "and", "don't"]))
    assert got == [("cat dog dont",)]


def test_term_bag_counts_every_token(spark):
    df = spark.createDataFrame([(1, "b a b c_1 B"), (2, ""), (3, None)], "id long, t string")
    rows = {r["id"]: r for r in tx.with_term_bag(df, F.col("t"), ["id"]).collect()}
    assert {(e["term"], e["tf"]) for e in rows[1]["bag"]} == {("b", 3), ("a", 1), ("c_1", 1)}
    assert rows[1]["dl"] == 5
    assert rows[2]["dl"] == rows[3]["dl"] == 0 and list(rows[2]["bag"]) == []


def test_preview_marks_only_longer_texts(spark):
    got = column(spark, ["a" * 300, "b" * 301], F.length(tx.preview(F.col("t"))), F.length(tx.snippet(F.col("t"))))
    assert got == [(300, 303), (303, 303)]


def test_record_key(spark):
    df = spark.createDataFrame([(7,), (1234567,)], "i long")
    assert [r[0] for r in df.select(tx.record_key(F.col("i"))).collect()] == ["000007", "1234567"]


@pytest.mark.parametrize(
    "text", ["a &amp;lt; b", "&eacute;&nbsp;x &#8217; &amp; &copy;", "&quot;q&quot; & y", "&copy 2024 &#x41;"]
)
def test_references_are_decoded_once(spark, text):
    assert column(spark, [text], hx.decode(F.col("t"))) == [(html.unescape(text),)]


@pytest.mark.parametrize(
    ("lat", "lon", "name"),
    [
        (0, 20, "Africa"), (37, -18, "Africa"), (36, 0, "Africa"), (48, 2, "Europe"), (35.5, 139, "Asia"),
        (40, -100, "North America"), (10, -70, "North America"), (-20, -60, "South America"),
        (-30, 140, "Oceania"), (-75, 0, "Antarctica"), (-58, 100, "Unknown"), (90, 0, "Unknown"),
    ],
)
def test_continent(spark, lat, lon, name):
    df = spark.createDataFrame([(float(lat), float(lon))], "lat double, lon double")
    assert df.select(vx.continent(F.col("lat"), F.col("lon"))).first()[0] == name


def test_country(spark):
    texts = ["Paris, France", "Rome", "A, B, C ", ""]
    assert column(spark, texts, vx.country(F.col("t"))) == [("France",), ("",), ("C",), ("",)]


def test_exact_decimal(spark):
    df = spark.createDataFrame([(0.1,), (float("nan"),), (None,), (-179.5,)], "x double")
    got = [r[0] for r in df.select(vx.exact_decimal(F.col("x"))).collect()]
    assert [None if g is None else float(g) for g in got] == [0.1, None, None, -179.5]
    assert str(got[0]).startswith("0.100000000000000000")


def test_chunks_cover_every_word(spark):
    df = spark.createDataFrame([(1, " ".join(map(str, range(23)))), (2, "one"), (3, "  ")], "id long, content string")
    rows = rerank.chunks(df, 10, 6).orderBy("id", "chunk").collect()
    assert [len(r["text"].split()) for r in rows if r["id"] == 1] == [10, 10, 10, 5]
    assert {w for r in rows if r["id"] == 1 for w in r["text"].split()} == set(map(str, range(23)))
    assert [r["text"] for r in rows if r["id"] == 2] == ["one"] and not [r for r in rows if r["id"] == 3]


def test_phrases_match_whole_words_even_side_by_side(spark):
    df = spark.createDataFrame([(1, "Underrated, underrated! understated hidden gem")], "id long, content string")
    got = {(r["cue"], r["n"]) for r in rerank.cue_counts(df).collect()}
    assert got == {("underrated", 2), ("hidden gem", 1)}


def test_body_of_a_page(spark):
    page = (
        "<p class='a'> One <b>two</b> three.<P>Second &ndash; “x”<!-- <p>no --><script>'<p>no'</script></p>tail"
        "<pre>no</pre><p></p><p>Last one is a rather long paragraph</p>"
    )
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    assert extract.with_clean_body(df).first()["content"] == "onetwothree second x last one is a rather long paragraph"
    assert extract.with_long_body(df).first()["content"] == "Last one is a rather long paragraph"


def test_has_token_finds_whole_tokens_only(spark):
    from pyspark.sql import functions as F

    words = ["the", "été", "a-b", "x_1", "", "\U00010400", "q.e"]
    texts = ["The end", "other", "bathe", "ÉTÉ", "a-b", "x_1", "x_12", "", None, "the\u0301", "\U00010400", "-the-", "qxe the_", "9the"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    listed = F.array(*[F.lit(w) for w in words])
    rows = df.select("id", tx.has_token(F.col("t"), words).alias("got"), F.arrays_overlap(tx.tokens(F.col("t")), listed).alias("want"))
    for r in rows.collect():
        assert r["got"] == r["want"], texts[r["id"]]
    assert not any(r[0] for r in df.select(tx.has_token(F.col("t"), [])).collect())
