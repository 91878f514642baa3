"""Order, storage, places and whole searches."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeseek.operators import gazetteer, hits, lexical, positions, search, semantic, stats
from placeseek.operators.topk import top_k
from placeseek.schema import POST
from placeseek.session import work_path
from placeseek.sources import files, store, tables
from placeseek.streaming import ingest


def post(i, url="u", title="t", content="c", place="P, Q", lat=1.0, lon=2.0, author=None, description="d"):
    return (i, "b", url, title, description, author, place, lat, lon, content)


def posts(spark, rows):
    return spark.createDataFrame(rows, POST)


def test_running_total_and_parts(spark):
    ids = [7 * i % 1009 for i in range(1000)]
    df = spark.createDataFrame([(i, i % 5 + 1) for i in ids], "id long, w int")
    rows = positions.with_running_total(df, ["id"], F.col("w"), "total").orderBy("id").collect()
    assert [r["total"] for r in rows] == list(np.cumsum([r["w"] for r in rows]))
    parts = positions.with_part_number(df, "id", 300).orderBy("id").collect()
    assert [r["part"] for r in parts] == [i // 300 + 1 for i in range(1000)]


def test_quantiles_are_exact_with_a_hot_value(spark):
    rng = np.random.default_rng(1)
    a = np.r_[np.full(400, 3.0), rng.normal(size=601)]
    df = spark.createDataFrame([(float(x), float(i)) for i, x in enumerate(a)], "a double, b double")
    rows = {r["name"]: r for r in stats.describe_numbers(df, ["a", "b"]).collect()}
    for p, c in ((25, "q25"), (50, "q50"), (75, "q75")):
        assert rows["a"][c] == pytest.approx(np.percentile(a, p))
        assert rows["b"][c] == pytest.approx(np.percentile(np.arange(len(a)), p))
    assert rows["a"]["std"] == pytest.approx(a.std(ddof=1)) and rows["a"]["cnt"] == len(a)


def test_histogram_of_one_value_and_of_none(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    assert [tuple(r) for r in stats.histogram(df, "x", 10).collect()] == [(0, 2)]
    assert stats.histogram(df.filter("x > 9"), "x", 10).count() == 0


def test_top_k_beyond_the_group_limit(spark):
    df = spark.range(5000).selectExpr("id", "id % 2 AS g", "hash(id) AS v")
    got = top_k(df, ["g"], [F.desc("v"), F.asc("id")], 1500, "id").collect()
    for g in (0, 1):
        mine = sorted((r for r in df.collect() if r["g"] == g), key=lambda r: (-r["v"], r["id"]))[:1500]
        assert [r["id"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["rank"])] == [r["id"] for r in mine]


def test_append_keeps_the_first_row_of_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    store.append_new(posts(spark, [post(2, "a"), post(1, "a", title="first"), post(3, "b")]), path)
    store.append_new(posts(spark, [post(4, "a"), post(5, "c"), post(6, "c")]), path)
    rows = sorted((r["id"], r["page_url"]) for r in tables.read_posts(spark, path).collect())
    assert rows == [(1, "a"), (3, "b"), (5, "c")]
    store.check_key(tables.read_posts(spark, path))
    with pytest.raises(ValueError):
        store.check_key(posts(spark, [post(1, "a"), post(2, "a")]))


def test_stream_equals_batch_and_repeats_change_nothing(spark, tmp_path):
    folder, table = str(tmp_path / "in"), str(tmp_path / "t")
    rows = [post(i, f"u{i % 7}") for i in range(40)]
    for part in range(4):
        posts(spark, rows[part * 10 : part * 10 + 10]).write.mode("append").parquet(folder)
    for _ in range(2):
        stream = ingest.arriving_posts(spark, folder, files_per_batch=2)
        ingest.ingest(stream, table, str(tmp_path / f"progress{_}")).awaitTermination()
        assert sorted(r["page_url"] for r in tables.read_posts(spark, table).collect()) == [f"u{i}" for i in range(7)]


def test_create_table_twice(spark, tmp_path):
    for _ in range(2):
        store.create_table(spark, "posts_for_test", str(tmp_path / "posts"))
    assert spark.table("posts_for_test").columns == POST.names
    spark.sql("DROP TABLE posts_for_test")


def test_files_round_trip(spark, tmp_path):
    odd = [
        post(1, "a", 'He said "hi", twice', "line one\nline two\r\n, and \\ more", author=""),
        post(2, "b", " blanks ", "é東\t'x'", place=None, lat=None, author=None, description=""),
        post(3, "c", "x" * 50_000, "", author="\\"),
    ]
    df = posts(spark, odd)
    files.write_csv(df, str(tmp_path / "csv"))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "csv")).collect())) == odd
    files.write_json(df, str(tmp_path / "json"))
    assert sorted(map(tuple, files.read_json(spark, str(tmp_path / "json"), POST).collect())) == odd
    assert any("東" in p.read_text("utf-8") for p in (tmp_path / "json").glob("*.json"))
    (tmp_path / "q.json").write_text(json.dumps({"queries": ["first, one", "second"]}))
    got = files.read_query_set(spark, str(tmp_path / "q.json")).collect()
    assert [tuple(r) for r in got] == [(0, "first, one"), (1, "second")]


def test_json_parts_hold_exactly_their_rows(spark, tmp_path):
    files.write_json_parts(posts(spark, [post(i * 3, f"u{i}") for i in range(25)]), str(tmp_path / "p"), size=10)
    back = spark.read.json(str(tmp_path / "p")).groupBy("part").agg(F.count("*"), F.min("id")).orderBy("part")
    assert [tuple(r) for r in back.collect()] == [(1, 10, 0), (2, 10, 30), (3, 5, 60)]


def test_place_names(spark):
    names = spark.createDataFrame(
        [("Paris", 1.0, 2.0), ("France", 3.0, 4.0), ("New York", 5.0, 6.0), ("York", 7.0, 8.0), ("Texas", 9.0, 9.0),
         ("Isle of Man", 1.0, 1.0), ("The Old Town of the Port and the Hill", 2.0, 2.0), ("santa  cruz de la sierra", 3.0, 3.0),
         ("", 0.0, 0.0), (None, 0.0, 0.0)],
        "name string, lat double, lon double",
    )
    cases = [
        (1, "A day in Paris, France", "", "Paris"),
        (2, "Paris France by train", "", "Paris, France"),
        (3, "From New York Texas", "", "New York"),
        (4, "Nothing here", "but paris", "paris"),
        (5, "No", "none", None),
        (6, "York then Paris", "", "York"),
        (7, None, "Texas", "Texas"),
        (8, "On the Isle of Man by sea", "", "Isle of Man"),
        (9, "in The Old Town of the Port and the Hill, Texas", "", "The Old Town of the Port and the Hill"),
        (10, "the old town of Paris", "", "Paris"),
        (11, "Santa Cruz de la Sierra", "", "Santa Cruz de la Sierra"),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "id long, page_title string, page_description string")
    got = {r["id"]: r["location_name"] for r in gazetteer.place_names(df, names, ["id"]).collect()}
    assert got == {c[0]: c[3] for c in cases if c[3]}
    located = gazetteer.with_coordinates(gazetteer.place_names(df, names, ["id"]), names)
    at = {r["id"]: (r["latitude"], r["longitude"]) for r in located.collect()}
    assert at[1] == (1.0, 2.0) and at[2] == (None, None) and at[3] == (5.0, 6.0)


@pytest.fixture(scope="module")
def whole(spark):
    rows = [
        post(1, "u1", "Kyoto", "temples of kyoto " * 40, "Kyoto, Japan", 35.0, 135.0, "ann"),
        post(2, "u2", "Dolomites", "mountain huts", "Dolomites", 0.0, 11.8, None, ""),
        post(3, "u3", "Sea", "quiet sea towns", None, None, None),
    ]
    table = posts(spark, rows)
    docs = table.select(F.col("id").alias("doc_id"), F.concat_ws(" ", "page_title", "content").alias("text"))
    vectors = semantic.encode_hashed(docs, "text", ["doc_id"]).withColumnRenamed("doc_id", "id")
    index = lexical.build_index(docs, work_path(spark, "whole"))
    return search.Collection(table, index, vectors, search.encode_queries)


def asked(spark, *rows):
    return spark.createDataFrame(list(rows), "query_id long, query string, model string, k int, explain boolean")


def test_responses(spark, whole):
    queries = asked(
        spark, (1, "kyoto temples", "bm25", 2, True), (2, "mountain huts", "faiss", 1, False),
        (3, "  ", "faiss", 3, True), (4, "sea", "other", 3, True),
    )
    rows = {r["query_id"]: r for r in search.responses(whole, queries).collect()}
    assert set(rows) == {1, 2, 3}
    first = rows[1]
    assert [r["destination"] for r in first["results"]] == ["Kyoto, Japan", "Dolomites"]
    best = first["results"][0]
    assert best["country"] == "Japan" and best["distance"] is None and best["score"] > 0
    assert best["why"]["model"] == "BM25" and best["context_cues"] == {} and best["trend_delta"] is None
    assert len(best["snippets"]) == 2 and best["snippets"][1].endswith("...")
    assert first["results"][1]["lat"] is None and len(first["explanations"]) == 2
    assert [r["id"] for r in rows[2]["results"]] == [2] and rows[2]["results"][0]["lat"] == 0.0
    assert rows[2]["explanations"] == [] and rows[3]["results"] == []
    assert [r["query_id"] for r in search.rejected(queries).collect()] == [4]


def test_place_missing_reads_unknown_for_text_search_only(spark, whole):
    found = search.lexical_hits(whole, asked(spark, (1, "quiet sea", "bm25", 1, False)))
    assert found.first()["destination"] == "Unknown"
    near = search.semantic_hits(whole, asked(spark, (1, "quiet sea towns", "faiss", 3, False)))
    assert sorted(r["id"] for r in near.collect()) == [1, 2]


def test_failed_explanations_get_a_fixed_text(spark, whole):
    queries = asked(spark, (1, "kyoto", "bm25", 3, True))
    shaped = search.lexical_hits(whole, queries)
    out = hits.explained(shaped, queries, lambda prompt: F.lit(None).cast("string")).collect()
    assert [r["explanation"] for r in out] == [hits.FALLBACK] * 3


def test_colours_and_summary(spark):
    df = spark.createDataFrame(
        [(1, 1, "a", "", 1.0, 1.0, None, 0.2), (1, 2, "b", "", 1.0, 1.0, None, 0.6), (1, 3, "c", "", None, 1.0, None, 0.4),
         (2, 4, "d", "", 1.0, 1.0, 5.0, None)],
        "query_id long, id long, destination string, country string, lat double, lon double, score double, distance double",
    )
    rows = {r["id"]: (r["red"], r["green"]) for r in hits.coloured(hits.mappable(df)).collect()}
    assert rows == {1: (0, 255), 2: (255, 0), 4: (255, 0)}
    totals = {r["query_id"]: tuple(r)[1:] for r in hits.summary(df).collect()}
    assert totals[1][:2] == (3, None) and totals[1][2] == pytest.approx(0.4) and totals[2] == (1, 5.0, None)


def test_long_rankings_meet_posts_below_their_joins(spark, monkeypatch):
    from placeseek.operators import hits as hx

    docs = spark.createDataFrame([(i, f"u{i}") for i in range(40)], "id long, page_url string")
    marks = spark.createDataFrame([(i, i * 2) for i in range(0, 40, 3)], "id long, mark long")
    posts = docs.join(marks, "id", "left")
    ranked = spark.createDataFrame([(1, n, i) for n, i in enumerate([3, 4, 39, 3, 77], start=1)], "query_id long, rank int, doc_id long")
    want = sorted(map(str, hx.attach_posts(ranked, posts).collect()))
    monkeypatch.setattr(hx, "PUSHED_IDS", 0)
    found = hx.attach_posts(ranked, posts)
    assert sorted(map(str, found.collect())) == want and len(want) == 4
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftOuter") < plan.index("LeftSemi")  # the outer join reads what the semi join leaves
