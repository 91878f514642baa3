"""Ranking against a direct calculation."""

import math
import random
import re
from collections import Counter

import pytest

from placeseek import sizing
from placeseek.operators import lexical
from placeseek.session import work_path
from placeseek.sizing import join_checked


def brute(texts, query, k, form):
    """(rank, id, score) straight from the formulas."""
    bags = [Counter(re.findall(r"\w+", t.lower())) for t in texts]
    n, lengths = len(texts), [sum(b.values()) for b in bags]
    mean = sum(lengths) / n
    df = Counter(t for b in bags for t in b)
    plain = {t: math.log(n - d + 0.5) - math.log(d + 0.5) for t, d in df.items()}
    floor = 0.25 * sum(plain.values()) / len(plain)
    scores = []
    for bag, length in zip(bags, lengths):
        s = 0.0
        for t in re.findall(r"\w+", query.lower()):
            if t in df:
                if form == "smoothed":
                    idf = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
                else:
                    idf = floor if plain[t] < 0 else plain[t]
                s += idf * bag[t] * 2.5 / (bag[t] + 1.5 * (0.25 + 0.75 * length / mean))
        scores.append(round(s, 6) + 0.0)
    order = sorted(range(n), key=lambda i: (-scores[i], i))[:k]
    return [(r, i, scores[i]) for r, i in enumerate(order, start=1)]


def index_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return lexical.build_index(docs, work_path(spark, "test-index"))


def found(spark, index, queries, k, form):
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id long, query string")
    rows = lexical.search(index, asked, k, form).orderBy("query_id", "rank").collect()
    out = {i: [] for i in range(len(queries))}
    for r in rows:
        out[r["query_id"]].append((r["rank"], r["doc_id"], r["score"]))
    return out


def close(got, want):
    assert [(r, i) for r, i, _ in got] == [(r, i) for r, i, _ in want]
    assert [s for _, _, s in got] == pytest.approx([s for _, _, s in want], abs=2e-6)


CORPUS = [
    "kyoto temples and shrines", "the dolomites offer mountain landscapes", "the the the sea", "", None,
    "small towns near the sea", "small towns near the sea", "mountain lake mountain hut", "kyoto kyoto food",
]
QUERIES = ["mountain sea", "the the", "kyoto", "nosuchword", "SMALL towns, towns!", "the sea unknown"]


@pytest.mark.parametrize("form", [lexical.FLOORED, lexical.SMOOTHED])
@pytest.mark.parametrize("k", [1, 4, 50])
def test_ranking(spark, form, k):
    got = found(spark, index_of(spark, CORPUS), QUERIES, k, form)
    for i, query in enumerate(QUERIES):
        close(got[i], brute([t or "" for t in CORPUS], query, k, form))


def test_random_corpus_with_a_hot_term(spark):
    draw = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(["hot"] * draw.randint(0, 3) + draw.choices(words, k=draw.randint(0, 30))) for _ in range(400)]
    texts += texts[:130]  # a large share of copies
    queries = [" ".join(draw.choices(words + ["hot"], k=4)) for _ in range(25)]
    index = index_of(spark, texts)
    for form in (lexical.FLOORED, lexical.SMOOTHED):
        got = found(spark, index, queries, 10, form)
        for i, query in enumerate(queries):
            close(got[i], brute(texts, query, 10, form))


def test_two_texts_without_common_words_score_zero_but_are_returned(spark):
    texts = ["Kyoto is known for temples and shrines.", "The Dolomites offer dramatic mountain landscapes."]
    got = found(spark, index_of(spark, texts), ["cities in italy", "kyoto"], 5, lexical.FLOORED)
    assert got[0] == [(1, 0, 0.0), (2, 1, 0.0)]
    assert got[1] == [(1, 0, 0.0), (2, 1, 0.0)]


def test_negative_mean_weight_still_fills_from_every_document(spark):
    texts = ["a b c"] * 30 + ["", "zzz"]
    got = found(spark, index_of(spark, texts), ["a", "zzz a"], 5, lexical.FLOORED)
    close(got[0], brute(texts, "a", 5, lexical.FLOORED))
    close(got[1], brute(texts, "zzz a", 5, lexical.FLOORED))


def test_blank_queries_find_nothing(spark):
    got = found(spark, index_of(spark, CORPUS), ["", "   ", "?!", "kyoto"], 3, lexical.FLOORED)
    assert not got[0] and not got[1] and not got[2] and len(got[3]) == 3


def test_batch_equals_one_by_one(spark):
    index = index_of(spark, CORPUS)
    batch = found(spark, index, QUERIES, 3, lexical.FLOORED)
    for i, query in enumerate(QUERIES):
        assert found(spark, index, [query], 3, lexical.FLOORED)[0] == batch[i]


def test_large_batches_take_the_shuffled_way(spark, monkeypatch):
    index = index_of(spark, CORPUS)
    want = found(spark, index, QUERIES, 4, lexical.FLOORED)
    monkeypatch.setattr(lexical, "localised", lambda df, max_rows=0: (df, None))
    monkeypatch.setattr(lexical, "fits", lambda df: False)
    monkeypatch.setattr(sizing, "HOT_ROWS", 2)
    assert found(spark, index, QUERIES, 4, lexical.FLOORED) == want


@pytest.mark.parametrize("hot", [1, 1000])
def test_lookup_by_text(spark, hot, monkeypatch):
    monkeypatch.setattr(sizing, "HOT_ROWS", hot)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "b", "a", "a", "b"])], "doc_id long, text string")
    rows = {r[0]: r[1] for r in lexical.resolve_by_text(docs).collect()}
    assert rows == {0: 0, 1: 1, 2: 0, 3: 0, 4: 1}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how, monkeypatch):
    monkeypatch.setattr(sizing, "HOT_ROWS", 100)
    key = "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 5 = 0 THEN NULL ELSE id % 50 END AS k"
    large = spark.range(2000).selectExpr("id", key)
    small = spark.range(0, 30).selectExpr("id AS k", "id * 2 AS v")
    want = sorted(map(str, large.join(small, "k", how).collect()))
    got = sorted(map(str, join_checked(large, small, "k", how, spread="id", small_fits=False).collect()))
    assert got == want


def grown(spark, texts, cuts, range_docs=2):
    """An index built by appending slices of ``texts``."""
    path = work_path(spark, "grown")
    docs = list(enumerate(texts))
    for begin, end in zip([0, *cuts], [*cuts, len(docs)]):
        part = spark.createDataFrame(docs[begin:end], "doc_id long, text string").repartition(3)
        index = lexical.append_index(part, path, range_docs=range_docs)
    return index


def contents(index):
    return [
        sorted(map(tuple, index.postings.select("term", "doc_id", "tf", "dl").collect())),
        sorted(map(tuple, index.terms.select("bucket", "term", "df").collect())),
        sorted(map(tuple, index.documents.collect())),
        [round(x, 12) for x in index.corpus.first()],
    ]


def random_texts(seed, n=240):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(80)]
    weights = [1 / (i + 1) for i in range(80)]
    texts = [" ".join(draw.choices(words, weights, k=draw.randint(0, 25))) for _ in range(n)]
    return texts + [texts[3]] * (n // 3), draw, words


@pytest.mark.parametrize("form", [lexical.FLOORED, lexical.SMOOTHED])
def test_skipping_ranges_gives_the_same_hits(spark, form, monkeypatch):
    texts, draw, words = random_texts(11)
    monkeypatch.setattr(lexical, "FIRST_LOOK", 2)
    index = grown(spark, texts, [100, 170], range_docs=4)
    assert index.ranges.count() > 40
    queries = [" ".join(draw.choices(words, k=draw.randint(1, 5))) for _ in range(12)] + ["nosuchword", "", texts[3]]
    got = found(spark, index, queries, 3, form)
    for i, query in enumerate(queries):
        close(got[i], brute(texts, query, 3, form) if query else [])


def test_few_ranges_are_read(spark, monkeypatch):
    texts = [f"common filler{i}" for i in range(200)] + ["rare rare common"] * 3
    index = grown(spark, texts, [], range_docs=4)
    read = []
    scored = lexical._scored

    def counting(index, heads, wanted, *rest, **more):
        read.append(wanted.count())
        return scored(index, heads, wanted, *rest, **more)

    monkeypatch.setattr(lexical, "_scored", counting)
    monkeypatch.setattr(lexical, "FIRST_LOOK", 1)
    close(found(spark, index, ["rare common"], 3, lexical.SMOOTHED)[0], brute(texts, "rare common", 3, "smoothed"))
    assert read[0] == 3 and read[1] == 0 and index.ranges.count() > 50


@pytest.mark.parametrize("form", [lexical.FLOORED, lexical.SMOOTHED])
def test_negative_mean_weight_over_many_ranges(spark, form, monkeypatch):
    monkeypatch.setattr(lexical, "FIRST_LOOK", 1)
    texts = ["a b c"] * 30 + ["", "zzz", "a"] + ["b a c"] * 9
    index = grown(spark, texts, [20], range_docs=2)
    for query in ("a", "zzz a", "b c", "nosuchword"):
        close(found(spark, index, [query], 5, form)[0], brute(texts, query, 5, form))


def test_an_index_in_three_appends_equals_one(spark):
    texts, draw, words = random_texts(12, 90)
    whole = grown(spark, texts, [], range_docs=16)
    parts = grown(spark, texts, [40, 77], range_docs=16)
    assert len(parts.segments) == 3 and contents(parts) == contents(whole)
    merged = lexical.compact(spark, parts.path, fan=2, range_docs=16)
    assert len(merged.segments) == 1 and contents(merged) == contents(whole)
    assert merged.ranges.agg({"n": "max"}).first()[0] <= 32
    # Readers of the earlier version are not disturbed.
    assert contents(parts) == contents(whole) and contents(lexical.load_index(spark, parts.path, 2)) == contents(whole)
    queries = [" ".join(draw.choices(words, k=3)) for _ in range(5)]
    assert found(spark, merged, queries, 4, lexical.FLOORED) == found(spark, whole, queries, 4, lexical.FLOORED)


def test_empty_parts_of_an_index(spark):
    texts = ["kyoto temples", "sea"]
    index = grown(spark, texts, [0, 1, 2])
    close(found(spark, index, ["sea"], 2, lexical.SMOOTHED)[0], brute(texts, "sea", 2, "smoothed"))
    nothing = grown(spark, [], [])
    assert found(spark, nothing, ["sea"], 2, lexical.SMOOTHED) == {0: []}


@pytest.mark.parametrize("range_docs", [2, 4096])
def test_ranking_inside_a_filtered_set(spark, range_docs, monkeypatch):
    monkeypatch.setattr(lexical, "FIRST_LOOK", 3)
    texts, draw, words = random_texts(13, 120)
    index = grown(spark, texts, [50], range_docs=range_docs)
    allowed = [i for i in range(len(texts)) if i % 7 == 3]
    frame = spark.createDataFrame([(i,) for i in [*allowed, 10_000]], "doc_id long")
    queries = [" ".join(draw.choices(words, k=3)) for _ in range(6)] + ["nosuchword"]
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id long, query string")
    rows = lexical.search(index, asked, 5, allowed=frame).orderBy("query_id", "rank").collect()
    for i, query in enumerate(queries):
        want = [(d, s) for _, d, s in brute(texts, query, len(texts), "floored") if d in allowed][:5]
        got = [(r.doc_id, r.score) for r in rows if r.query_id == i]
        assert [d for d, _ in got] == [d for d, _ in want]
        assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=2e-6)
    none = lexical.search(index, asked, 5, allowed=frame.limit(0))
    assert none.count() == 0


def test_large_batches_over_many_ranges(spark, monkeypatch):
    texts, draw, words = random_texts(14, 60)
    index = grown(spark, texts, [30], range_docs=4)
    queries = [" ".join(draw.choices(words, k=3)) for _ in range(9)]
    want = found(spark, index, queries, 3, lexical.FLOORED)
    monkeypatch.setattr(lexical, "FIRST_LOOK", 3)
    monkeypatch.setattr(lexical, "localised", lambda df, max_rows=0: (df, None))
    monkeypatch.setattr(lexical, "fits", lambda df: False)
    monkeypatch.setattr(lexical, "QUERY_PART", 2)
    assert found(spark, index, queries, 3, lexical.FLOORED) == want


def exchanged(frame):
    """The shuffles in the plan of a frame."""
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_postings_meet_their_documents_without_a_shuffle(spark):
    texts, _, _ = random_texts(15, 60)
    index = grown(spark, texts, [30], range_docs=4)
    want = sorted((t, i, n, sum(Counter(text.split()).values())) for i, text in enumerate(texts) for t, n in Counter(text.split()).items())
    assert sorted(map(tuple, index.postings.collect())) == want
    assert exchanged(index.postings) == 0


def test_postings_of_an_index_too_large_to_broadcast(spark, monkeypatch):
    texts, _, _ = random_texts(15, 60)
    index = grown(spark, texts, [30], range_docs=4)
    want = contents(index)
    monkeypatch.setattr(lexical, "fits", lambda df: False)
    assert contents(index) == want


@pytest.mark.parametrize("most", [1, 7, 40, 10_000])
def test_ranges_end_by_words_and_by_documents(spark, most, monkeypatch):
    texts, _, _ = random_texts(16, 90)
    texts += ["long " * 300, "", "long tail"]
    want = contents(grown(spark, texts, [], range_docs=16))
    monkeypatch.setattr(lexical, "RANGE_WORDS", most)
    monkeypatch.setattr(lexical, "_classes", None)  # an append groups no postings
    index = grown(spark, texts, [50], range_docs=16)
    for r in index.ranges.collect():
        assert 1 <= r["n"] <= 16 and (sum(r["dls"]) <= most or r["n"] == 1 or sum(d > 0 for d in r["dls"]) == 1)
    assert contents(index) == want


def test_a_merge_shuffles_only_blocks_of_joined_ranges(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b{i % 5} c{i}") for i in range(64)], "doc_id long, text string").coalesce(1)
    path = work_path(spark, "full")
    for part in range(2):
        lexical.append_index(docs.filter(f"doc_id % 2 = {part}"), path, range_docs=8)
    want, grouped, run = contents(lexical.load_index(spark, path)), [], lexical._classes
    monkeypatch.setattr(lexical, "_classes", lambda rows, places: grouped.append(rows.count()) or run(rows, places))
    merged = lexical.compact(spark, path, fan=2, range_docs=8)
    assert contents(merged) == want and merged.ranges.count() == 8 and grouped == [0]
