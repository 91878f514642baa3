"""Vectors against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeseek.functions import values as vx
from placeseek.operators import semantic
from placeseek.session import work_path
from placeseek.sources import vectors as vs


def frame(spark, key, matrix):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{key} long, embedding array<float>")


def brute(stored, queries, k):
    stored, queries = stored.astype(np.float32).astype(float), queries.astype(np.float32).astype(float)
    out = []
    for q, vector in enumerate(queries):
        gaps = np.round(((stored - vector) ** 2).sum(axis=1), 6)
        order = sorted(range(len(stored)), key=lambda i: (gaps[i], i))[:k]
        out += [(q, r, i, gaps[i]) for r, i in enumerate(order, start=1)]
    return out


def rows_of(df):
    return [tuple(r) for r in df.orderBy("query_id", "rank").collect()]


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=2e-6)


@pytest.mark.parametrize("k", [1, 7, 500])
def test_nearest(spark, k):
    rng = np.random.default_rng(3)
    stored = rng.normal(size=(300, 16))
    stored[100:200] = stored[5]  # a third are copies
    queries = np.vstack([stored[5], stored[7], rng.normal(size=16)])
    got = rows_of(semantic.nearest(frame(spark, "id", stored).repartition(6), frame(spark, "query_id", queries), k))
    same(got, brute(stored, queries, k))
    assert len(got) == 3 * min(k, 300)


def test_nearest_in_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(semantic, "QUERY_BLOCK", 10)
    rng = np.random.default_rng(4)
    stored, queries = rng.normal(size=(80, 4)), rng.normal(size=(45, 4))
    got = rows_of(semantic.nearest(frame(spark, "id", stored), frame(spark, "query_id", queries), 3))
    same(got, brute(stored, queries, 3))


def test_no_queries(spark):
    empty = frame(spark, "query_id", [[1.0]]).limit(0)
    assert semantic.nearest(frame(spark, "id", [[1.0]]), empty, 3).count() == 0


def test_unit_vectors_and_distance_bounds(spark):
    rng = np.random.default_rng(5)
    units = frame(spark, "id", rng.normal(size=(50, 8))).select("id", vx.unit(F.col("embedding")).alias("embedding"))
    near = semantic.nearest(units, units.withColumnRenamed("id", "query_id"), 50)
    low, high = near.agg(F.min("distance"), F.max("distance")).first()
    assert 0.0 <= low and high <= 4.0
    zero = spark.createDataFrame([(1, [0.0, 0.0])], "id long, embedding array<double>")
    assert list(zero.select(vx.unit(F.col("embedding"))).first()[0]) == [0.0, 0.0]


def test_mean_pool(spark):
    rows = [("a", [1.0, 2.0], 1), ("a", [3.0, 4.0], 1), ("a", [9.0, 9.0], 0), ("b", [5.0, 5.0], 0)]
    df = spark.createDataFrame(rows, "g string, v array<float>, m int")
    got = {r["g"]: list(r["embedding"]) for r in semantic.mean_pool(df, ["g"], "v", F.col("m")).collect()}
    assert got == {"a": [2.0, 3.0], "b": [0.0, 0.0]}


def test_missing_vector_is_an_error(spark):
    posts = spark.createDataFrame([(1,), (2,)], "id long")
    vectors = frame(spark, "id", [[1.0], [2.0]])
    with pytest.raises(semantic.MissingVectors):
        semantic.with_vectors(posts, vectors)
    assert semantic.with_vectors(posts, vectors, strict=False).count() == 1


def test_user_encoder_runs_in_batches(spark):
    def make():
        import numpy

        def predict(texts):
            assert len(texts) <= 32
            return numpy.array([[float(len(t)), 1.0] for t in texts], dtype=numpy.float32)

        return predict

    df = spark.createDataFrame([(i, "x" * i if i else None) for i in range(100)], "id long, text string")
    rows = semantic.encode_with(df, "text", make).collect()
    assert {r["id"]: list(r["embedding"]) for r in rows} == {i: [float(i), 1.0] for i in range(100)}


def test_hashed_encoder_uses_the_whole_text(spark):
    long = " ".join(f"word{i}" for i in range(3000))
    df = spark.createDataFrame([(1, long), (2, long + " tail"), (3, "")], "id long, text string")
    rows = {r["id"]: np.array(r["embedding"]) for r in semantic.encode_hashed(df, "text", ["id"]).collect()}
    assert np.linalg.norm(rows[1]) == pytest.approx(1.0)
    assert not np.allclose(rows[1], rows[2]) and not rows[3].any()


def test_both_store_layouts(spark, tmp_path):
    vectors = frame(spark, "id", np.arange(20.0).reshape(10, 2))
    vs.write_vectors(vectors, str(tmp_path / "v"))
    want = sorted((r[0], list(r[1])) for r in vectors.collect())
    assert sorted((r[0], list(r[1])) for r in vs.read_vectors(spark, str(tmp_path / "v")).collect()) == want
    blocks = vs.pack_blocks(vectors, rows=4)
    assert blocks.count() == 3
    assert sorted((r[0], list(r[1])) for r in vs.unpack_blocks(blocks).collect()) == want


def clustered(seed, n=600, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim)) * 10
    stored = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * 0.2
    stored[: n // 3] = stored[5]  # a third are copies
    return stored, np.vstack([stored[5], stored[-1], centres[:6] + 0.1, rng.normal(size=(3, dim))])


@pytest.mark.parametrize("k", [1, 9, 700])
def test_nearest_by_pivots(spark, k):
    stored, queries = clustered(8)
    index = semantic.build_pivots(frame(spark, "id", stored).repartition(5), work_path(spark, "pivots"), 16, 20)
    asked = frame(spark, "query_id", queries)
    same(rows_of(semantic.nearest(index, asked, k)), brute(stored, queries, k))
    if k == 9:
        assert semantic.skipped_share(index, asked, k) > 0.5


def test_nearest_by_pivots_in_blocks_and_scans(spark, monkeypatch):
    monkeypatch.setattr(semantic, "QUERY_BLOCK", 4)
    monkeypatch.setattr(semantic, "PUSHED_UNITS", 2)
    stored, queries = clustered(9, 200)
    index = semantic.build_pivots(frame(spark, "id", stored).repartition(5), work_path(spark, "pivots"), 6, 10)
    same(rows_of(semantic.nearest(index, frame(spark, "query_id", queries), 5)), brute(stored, queries, 5))


@pytest.mark.parametrize("pivots", [True, False])
def test_nearest_inside_a_filtered_set(spark, pivots):
    stored, queries = clustered(10, 300)
    rows = frame(spark, "id", stored).repartition(5)
    searched = semantic.build_pivots(rows, work_path(spark, "pivots"), 8, 10) if pivots else rows
    allowed = [i for i in range(300) if i % 11 == 2]
    frame_of = spark.createDataFrame([(i,) for i in [*allowed, 9999]], "id long")
    got = rows_of(semantic.nearest(searched, frame(spark, "query_id", queries), 4, frame_of))
    want = [(q, i, d) for q, _, i, d in brute(stored, queries, 300) if i in allowed]
    for q in range(len(queries)):
        mine = [w for w in want if w[0] == q][:4]
        assert [r[2] for r in got if r[0] == q] == [w[1] for w in mine]
    assert semantic.nearest(searched, frame(spark, "query_id", queries), 4, frame_of.limit(0)).count() == 0


def test_pivots_of_an_empty_table(spark):
    index = semantic.build_pivots(frame(spark, "id", [[1.0]]).limit(0), work_path(spark, "pivots"))
    assert semantic.nearest(index, frame(spark, "query_id", [[1.0]]), 3).count() == 0


def test_large_lengths_lose_no_neighbour(spark):
    rng = np.random.default_rng(3)
    stored = rng.normal(size=(120, 4)) + 1e6
    index = semantic.build_pivots(frame(spark, "id", stored), work_path(spark, "pivots"), 8, 6)
    got = rows_of(semantic.nearest(index, frame(spark, "query_id", stored[:5]), 3))
    plain = rows_of(semantic.nearest(frame(spark, "id", stored), frame(spark, "query_id", stored[:5]), 3))
    assert got == plain


def test_hashed_vectors_count_each_word_with_its_sign(spark):
    import hashlib

    texts = ["sea sea SEA hut", "", None, "Été x_1 ω", "a " * 5000 + "b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string").coalesce(1)
    for dim in (64, 10):
        rows = {r["id"]: list(r["embedding"]) for r in semantic.encode_hashed(df, "t", ["id"], dim).collect()}
        for i, text in enumerate(texts):
            sums = np.zeros(dim)
            for word in (text or "").lower().split():
                h = hashlib.md5(word.encode()).hexdigest()
                sums[int(h[:8], 16) % dim] += 1 if int(h[8], 16) < 8 else -1
            assert rows[i] == (sums / max(np.sqrt((sums**2).sum()), 1e-12)).tolist()


def test_a_filter_is_run_once(spark):
    from pyspark.sql import functions as F

    vectors = frame(spark, "id", np.random.default_rng(3).normal(size=(60, 4)).tolist())
    index = semantic.build_pivots(vectors, work_path(spark, "pivots"), pivots=4, unit_rows=8)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def costly(i):
        seen.add(1)
        return i % 3 == 0

    allowed = spark.range(60).select("id").filter(costly.asNondeterministic()("id"))
    queries = frame(spark, "query_id", [[0.0, 0.0, 1.0, 0.0]])
    rows = semantic.nearest(index, queries, 5, allowed).collect()
    assert len(rows) == 5 and all(r["id"] % 3 == 0 for r in rows) and seen.value == 60
