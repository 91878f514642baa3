"""Resampling, clustering and word tokens against brute force and the tokenizers library."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from placeseek.llm import centroids, resampling, word_bpe
from placeseek.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, database

FOLDER = "/root/testdata/sf0.001"
CLASH = "doc_id long, text string, weight long, score long, rank long, n_words string, buckets string, ids string"


def drawn_by_hand(docs, target, percent=25, seed=7, buckets=10_000):
    def features(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        return words, [zlib.crc32(f.encode()) % buckets for f in words + pairs]

    corpus, wanted = [0] * buckets, [0] * buckets
    for counts, texts in ((corpus, [t for _, t in docs]), (wanted, target)):
        for text in texts:
            for b in features(text)[1]:
                counts[b] += 1
    all_corpus, all_target = sum(corpus), sum(wanted)
    out, open_to = {}, []
    for n, (doc_id, text) in enumerate(docs):
        words, found = features(text)
        gains = [
            math.floor(1000 * math.log((wanted[b] + 1) * (all_corpus + buckets) / ((corpus[b] + 1) * (all_target + buckets))))
            for b in found
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[n] = (doc_id, len(found), weight, score)
        if len(words) >= 20:
            open_to.append(n)
    order = sorted(open_to, key=lambda n: (-out[n][3], out[n][0], out[n][1]))[: percent * len(open_to) // 100]
    ranks = {n: k for k, n in enumerate(order, 1)}
    return sorted((*row, ranks.get(n) or 0) for n, row in out.items())


def rows(df, *columns):
    return sorted(tuple(0 if v is None and c == "rank" else v for c, v in zip(columns, r)) for r in df.select(*columns).collect())


DRAW = ("doc_id", "n_features", "weight", "score", "rank")


def test_resampling_of_the_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = rows(QUERIES["op11_importance_resampling"](spark, FOLDER), *DRAW)
    assert got == drawn_by_hand(docs, target)


def test_resampling_to_the_last_key_with_copies(spark):
    pick = random.Random(5)
    words = "alpha BETA gamma Delta É über 12 x-y z".split()
    texts = [" ".join(pick.choice(words) for _ in range(pick.randrange(0, 40))) for _ in range(300)]
    # A third of all rows are copies under one id.
    docs = [(k, t) for k, t in enumerate(texts)] + [(1000, " ".join(words * 4))] * 150 + [(-3, None), (-4, ""), (-5, "?!")]
    pick.shuffle(docs)
    frame = spark.createDataFrame([(*d, 1, 2, 3, "n", "b", "i") for d in docs], CLASH).repartition(7)
    target = spark.createDataFrame([("beta beta über",), (None,)], "text string")
    for percent in (0, 25, 100):
        done = resampling.resampled(frame, target, percent, left_keys=0)
        assert rows(done, *DRAW) == drawn_by_hand(docs, ["beta beta über", None], percent), percent


def test_resampling_without_ids_target_or_rows(spark):
    text = "one two three " * 10
    docs = spark.createDataFrame([(None, text), (1, text)], "doc_id long, text string")
    empty = spark.createDataFrame([], "doc_id long, text string")
    got = rows(resampling.resampled(docs, empty, 100).filter("doc_id is not null"), *DRAW)
    assert got[0][4] == 1
    assert resampling.resampled(docs, empty, 100).filter("doc_id is null and score is null and rank is null").count() == 1
    assert resampling.resampled(empty, docs).count() == 0


def test_cutoff_is_the_wanted_key(spark):
    keys = [(random.Random(k).randrange(40), k % 90) for k in range(2000)]
    frame = spark.createDataFrame(keys, "score long, doc_id long").repartition(6)
    order = sorted(keys, key=lambda r: (-r[0], r[1]))
    for wanted in (1, 777, 2000):
        assert resampling.cutoff(frame, wanted, left_keys=0) == order[wanted - 1]
    assert resampling.cutoff(frame, 0) is None


def clusters_by_hand(vectors, k=8, rounds=10, seed=3):
    kept = [
        (i, tuple(math.floor(1024 * x) for x in v)) for i, v in vectors
        if i is not None and v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return []

    def digest(row):
        return hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest(), np.array(row[1], "<i4").tobytes()

    centers = [v for _, v in sorted(kept, key=digest)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for n in range(len(centers)):
            held = [v for (_, v), (_, c) in zip(kept, own) if c == n]
            if held:
                centers[n] = tuple(sum(x) // len(held) for x in zip(*held))
    own = assign()
    sums = [sum(d for d, c in own if c == n) for n in range(len(centers))]
    return sorted((i, c, d, sums[c], sum(sums), list(centers[c])) for (i, _), (d, c) in zip(kept, own))


CLUSTER = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def cluster_frame(spark, vectors):
    schema = "vec_id long, embedding array<float>, cluster string, distance string, row string, vector string"
    return spark.createDataFrame([(i, v, "c", "d", "r", "v") for i, v in vectors], schema).repartition(5)


def test_clusters_equal_brute_force(spark):
    pick = np.random.default_rng(4)
    centers = pick.normal(size=(5, 64)) * 2
    vectors = [(k, (centers[k % 5] + pick.normal(size=64)).astype("f4").tolist()) for k in range(160)]
    vectors += [(900, vectors[0][1])] * 80  # a third of all rows are one vector
    vectors += [(901, [0.0] * 64), (902, None), (903, [1.0] * 63), (904, [float("nan")] * 64), (905, [None] * 64)]
    vectors += [(906, [float("inf")] + [0.0] * 63), (907, []), (None, [0.5] * 64), (-1, [-1e-9] * 64), (908, [3e4] * 64)]
    got = rows(centroids.clustered(cluster_frame(spark, vectors)), *CLUSTER)
    assert got == clusters_by_hand(vectors)


def test_clusters_of_few_or_no_vectors(spark):
    few = [(k, [float(k)] * 64) for k in range(3)]
    assert rows(centroids.clustered(cluster_frame(spark, few)), *CLUSTER) == clusters_by_hand(few)
    assert centroids.clustered(cluster_frame(spark, [])).count() == 0
    assert centroids.clustered(cluster_frame(spark, [(1, None)])).count() == 0


def test_clusters_equal_sql(spark):
    name = "op12_centroid_clusters"
    problem, n, _ = compare(spark, database(FOLDER), FOLDER, name, QUERIES[name], ORACLES[name])
    assert problem is None and n > 0, problem


def test_intervals_hold_the_distances_and_decide_most():
    pick = np.random.default_rng(6)
    middle = pick.integers(-2000, 2000, (8, 64))
    values = (middle[pick.integers(0, 8, 500)] + pick.integers(-300, 300, (500, 64))).astype(np.int64)
    low, high = values.min(axis=0), values.max(axis=0)
    begins = np.linspace(low, high, 17).astype(np.int64).T[:, :16]
    ends = np.maximum(np.concatenate([begins[:, 1:] - 1, high[:, None]], axis=1), begins)
    cells = centroids.cells_of(values, begins)
    assert (centroids.unpacked(centroids.packed(cells, 4), 64, 4) == cells).all()
    tables = centroids.Tables(begins, ends, middle)
    best, gap = centroids.nearest(values, middle)
    dims = np.arange(64)[None, :]
    assert (tables.least[dims, cells].sum(axis=1)[np.arange(500), best] <= gap).all()
    assert (tables.most[dims, cells].sum(axis=1)[np.arange(500), best] >= gap).all()
    decided = tables.decided(cells)
    assert ((decided == best) | (decided < 0)).all()
    assert (decided >= 0).mean() > 0.9


def test_components_beyond_a_long_are_an_error(spark):
    with pytest.raises(Exception, match="squared distances"):
        centroids.clustered(cluster_frame(spark, [(1, [1e30] * 64)])).count()


def odd_texts():
    pick = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz" * 3 + "éßΣσς'’ \n0123456789!?=-_<|>ªº́ẞ\x1c\x85　͸"
    out = ["".join(pick.choice(letters) for _ in range(pick.randrange(0, 60))) for _ in range(3000)]
    out += ["x<|endoftext|>y <|startoftext|><|ENDOFTEXT|>a<|endoftext|", "<|endoftext|>", "a" * 5000, "=" * 3000]
    out += ["aaa aaaa aaaaa", "", "   ", "don't we'LL 'S", "e<|endoftext|>́", "ΑΣ ΑΣΑ İ ǅ ﬁ ½ Ⅷ 漢字かな", "a\x00b"]
    out += ["".join(pick.choice("aeinorst") for _ in range(n)) for n in (511, 512, 513, 900, 20_000)]
    return out


def test_word_tokens_equal_the_library():
    library = Tokenizer.from_file(word_bpe.default_path())
    own = word_bpe.WordBpe(word_bpe.default_path())
    texts = odd_texts()
    for text, ids in zip(texts, own.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text[:80]
        assert own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_word_tokens_of_every_code_point():
    library = Tokenizer.from_file(word_bpe.default_path())
    own = word_bpe.WordBpe(word_bpe.default_path())
    texts = [f"a{chr(c)}b {chr(c)}" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [t for t, w, g in zip(texts, want, own.encode(texts)) if w.ids != g.tolist()] == []


def test_word_tokens_query(spark):
    library = Tokenizer.from_file(word_bpe.default_path())

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for row in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        want.append((row.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert rows(QUERIES["op13_word_bpe"](spark, FOLDER), *columns) == sorted(want)


def test_word_tokens_of_odd_rows(spark):
    path = word_bpe.default_path()
    docs = [(1, "Hello hello"), (1, "Hello hello"), (2, None), (3, ""), (None, "x"), (4, "word " * 50_000)]
    frame = spark.createDataFrame([(*d, 1, 2, 3, "n", "b", "i") for d in docs], CLASH)
    got = word_bpe.decoded(word_bpe.encoded(frame, path), path).collect()
    found = sorted((r.doc_id or 0, len(r.ids), r.text[:22]) for r in got)
    assert found == [(0, 1, "x</w>"), (1, 2, "hello</w> hello</w>"), (1, 2, "hello</w> hello</w>"), (2, 0, ""), (3, 0, ""), (4, 50_000, "word</w> word</w> word")]
    assert word_bpe.encoded(frame.limit(0), path).count() == 0
    unknown = spark.createDataFrame([(1, [320, 999_999]), (2, None)], "doc_id long, ids array<int>")
    assert [r.text for r in word_bpe.decoded(unknown, path).orderBy("doc_id").collect()] == ["a</w>", ""]
