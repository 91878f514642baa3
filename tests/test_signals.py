"""Quantiles, spellings, variety, trends, stores and exports on hand-made rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeseek.operators import hits, rerank, semantic, stats, variety
from placeseek.session import work_path
from placeseek.sources import files, store, tables
from placeseek.sources import vectors as vs
from tests.test_tables import post, posts


@pytest.mark.parametrize("left", [5, 10_000])
def test_exact_quantiles(spark, left, monkeypatch):
    monkeypatch.setattr(stats, "LEFT_VALUES", left)
    monkeypatch.setattr(stats, "ACCURACY", 20)
    pick = np.random.default_rng(1)
    columns = {
        "normal": pick.normal(size=3000), "two": pick.integers(5, 7, 3000).astype(float), "one": np.ones(3000),
        "skew": np.where(pick.random(3000) < 0.4, 3.0, pick.exponential(size=3000)),
    }
    rows = [tuple(float(c[k]) for c in columns.values()) + (None,) for k in range(3000)]
    frame = spark.createDataFrame([*rows, (None,) * 5], ", ".join(f"{c} double" for c in (*columns, "nothing"))).repartition(7)
    got = stats.exact_quantiles(frame, [*columns, "nothing"], (0.25, 0.5, 0.75, 0.999))
    for name, values in columns.items():
        assert got[name] == pytest.approx(np.quantile(values, (0.25, 0.5, 0.75, 0.999)).tolist()), name
    assert got["nothing"] == [None] * 4
    assert stats.describe_numbers(frame.limit(0), ["normal"]).first()["cnt"] == 0


def test_describe_text_of_ties_and_single_values(spark):
    rows = [("b", "x", None), ("a", "y", None), ("b", "z", None), ("a", "w", None), ("c", None, None)]
    frame = spark.createDataFrame(rows, "s string, u string, n string")
    got = {r["name"]: tuple(r)[1:] for r in stats.describe_text(frame, ["s", "u", "n"]).collect()}
    assert got == {"s": (5, 3, "a", 2), "u": (4, 4, "w", 1)}


def test_places_of_several_spellings(spark):
    names = ["Köln, Germany", "Koln, Germany", "KOLN,  Germany", "Kolnn, Germany", "Bonn", "Born", "Paris", "Pari", "Parix", "Oslo", "Osla", None, "Köln, Germany"]
    frame = spark.createDataFrame([(n,) for n in names], "location_name string")
    got = {r["location_name"]: r["place"] for r in variety.places_alike(frame).collect()}
    cologne = {got[n] for n in names if n and n.lower().startswith("k")}
    assert len(cologne) == 1 and got["Bonn"] != got["Born"] and got["Oslo"] != got["Osla"]
    assert got["Paris"] == got["Parix"] and got["Pari"] != got["Paris"]
    assert variety.places_alike(frame.limit(0)).count() == 0


def test_places_alike_against_all_pairs(spark):
    draw = random.Random(3)
    names = {"".join(draw.choices("abc", k=draw.randint(4, 7))) for _ in range(120)}

    def near(a, b):
        if min(len(a), len(b)) < 5 or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        a, b = sorted((a, b), key=len)
        return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    place = {n: n for n in names}
    while True:
        after = {n: min(place[m] for m in names if m == n or near(n, m)) for n in names}
        if after == place:
            break
        place = after
    got = variety.places_alike(spark.createDataFrame([(n,) for n in names], "location_name string"))
    assert {r["location_name"]: r["place"] for r in got.collect()} == place


def test_varied_hits_against_a_plain_loop(spark):
    pick = np.random.default_rng(5)
    rows = [(q, i, float(pick.integers(0, 20)), pick.normal(size=4).tolist(), f"p{i % 5}") for q in (1, 2) for i in range(30)]
    frame = spark.createDataFrame(rows, "query_id long, id long, score double, embedding array<double>, place string")
    got = [tuple(r) for r in variety.varied(frame, 6, candidates=20).orderBy("query_id", "rank").collect()]
    want = []
    for q in (1, 2):
        mine = sorted((r for r in rows if r[0] == q), key=lambda r: (-r[2], r[1]))[:20]
        top, taken = mine[0][2], []

        def likeness(a, b):
            x, y = np.array(a[3]), np.array(b[3])
            return 1.0 if a[4] == b[4] else float(x @ y / np.linalg.norm(x) / np.linalg.norm(y))

        while len(taken) < 6:
            rest = [r for r in mine if r not in taken]
            gain = {r[1]: round(0.7 * r[2] / top - 0.3 * max([0.0, *(likeness(r, t) for t in taken)] if not taken else [likeness(r, t) for t in taken]), 6) for r in rest}
            best = min(rest, key=lambda r: (-gain[r[1]], r[1]))
            taken.append(best)
            want.append((q, len(taken), best[1]))
    assert got == want


def test_trend_falls_to_nothing_and_ends_with_the_data(spark):
    rows = [("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 11:00:00"), ("a", "2024-01-03 09:00:00"), ("b", "2024-01-02 09:00:00")]
    events = spark.createDataFrame(rows, "k string, t string").withColumn("t", F.to_timestamp("t"))
    got = {(r[0], str(r[1])[:10]): (r[2], r[3]) for r in rerank.activity_change(events, "t", "k", "1 day").collect()}
    assert got == {
        ("a", "2024-01-01"): (2, 2), ("a", "2024-01-02"): (0, -2), ("a", "2024-01-03"): (1, 1),
        ("b", "2024-01-02"): (1, 1), ("b", "2024-01-03"): (0, -1),
    }


def test_a_batch_reads_only_buckets_that_may_hold_it(spark, tmp_path):
    path = str(tmp_path / "t")
    store.append_new(posts(spark, [post(i, f"u{i}") for i in range(200)]), path, buckets=8)
    fresh = posts(spark, [post(900, "new1"), post(901, "new2"), post(902, "u7")])
    held = [r["page_url"] for r in store.taken(fresh, path, 8).collect()]
    assert held == ["u7"]
    # A failure between the bitmaps and the posts: the batch is repeated and arrives once.
    before = sorted(r["id"] for r in tables.read_posts(spark, path).collect())
    bits = fresh.select(store._bucket(8), F.explode(F.array(*store._bits())).alias("_bit"))
    lost = bits.groupBy("bucket").agg(F.bitmap_construct_agg("_bit").alias("bits")).withColumn("buckets", F.lit(8))
    lost.write.mode("append").parquet(f"{path}/_filters")
    for _ in range(2):
        store.append_new(fresh, path)
        assert sorted(r["id"] for r in tables.read_posts(spark, path).collect()) == [*before, 900, 901]


def test_only_new_texts_are_encoded(spark, tmp_path):
    path = str(tmp_path / "v")
    seen = []

    def encode(rows):
        seen.append(sorted(r["text"] for r in rows.collect()))
        return rows.withColumn("embedding", F.array(F.char_length("text").cast("float")))

    def vectors(rows):
        frame = spark.createDataFrame(rows, "id long, text string")
        return sorted((r["id"], r["embedding"][0]) for r in vs.upsert_vectors(frame, path, encode).collect())

    rows = [(1, "a"), (2, "bb"), (3, "a"), (4, None), (5, "")]
    assert vectors(rows) == [(1, 1.0), (2, 2.0), (3, 1.0), (4, 0.0), (5, 0.0)]
    assert vectors(rows) == [(1, 1.0), (2, 2.0), (3, 1.0), (4, 0.0), (5, 0.0)]
    assert vectors([(1, "a"), (2, "ccc")]) == [(1, 1.0), (2, 3.0)]
    assert seen == [["", "a", "bb"], [], ["ccc"]]


def test_export_keeps_queries_apart(spark, tmp_path):
    rows = [(q, i, float(i % 4), "p", 1.0, 2.0, f"t, {i}") for q in (7, 8) for i in range(6)]
    frame = spark.createDataFrame(rows, "query_id long, id long, score double, location_name string, longitude double, latitude double, page_title string")
    files.write_ranked(frame.repartition(3), str(tmp_path / "r"))
    back = files.read_ranked(spark, f"{tmp_path}/r").filter("query_id = 8").collect()
    assert [r["Score"] for r in back] == [3.0, 2.0, 1.0, 1.0, 0.0, 0.0] and back[0]["Page Title"] == "t, 3"
    assert len(list((tmp_path / "r" / "query_id=7").glob("*.csv"))) == 1


def test_failing_generator(spark):
    def generate(prompt):
        if "bad" in prompt:
            raise ValueError("no")
        return prompt[:3]

    frame = spark.createDataFrame([("good",), ("bad",), (None,)], "p string")
    got = [r[0] for r in frame.select(hits.generator(generate)(F.col("p"))).collect()]
    assert got == ["goo", None, None]


def test_posts_without_vectors_are_an_error(spark):
    from placeseek.operators import lexical, search

    table = posts(spark, [post(1, "u1", "Kyoto", "temples"), post(2, "u2", "Sea", "quiet")])
    docs = table.select(F.col("id").alias("doc_id"), F.col("content").alias("text"))
    vectors = semantic.encode_hashed(docs.filter("doc_id = 1"), "text", ["doc_id"]).withColumnRenamed("doc_id", "id")
    index = lexical.build_index(docs, work_path(spark, "lost"))
    with pytest.raises(semantic.MissingVectors):
        search.Collection(table, index, vectors, search.encode_queries)


def test_blank_is_white_space_of_any_kind(spark):
    from placeseek.functions import text as tx
    from placeseek.functions import values as vx

    frame = spark.createDataFrame([("\t\n",), ("　 ",), ("",), (None,), (" a b\t\n",), ("x, \tÉire\n",)], "t string")
    got = [tuple(r) for r in frame.select(tx.is_blank(F.col("t")), tx.strip(F.col("t")), vx.country(F.col("t"))).collect()]
    assert [g[0] for g in got] == [True, True, True, True, False, False]
    assert [g[1] for g in got] == ["", "", "", None, "a b", "x, \tÉire"] and got[5][2] == "Éire"
