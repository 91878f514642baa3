"""The operators against brute-force versions and on hand-made rows."""

import html
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from placeseek.llm import (
    components,
    decontamination,
    html_main,
    licenses,
    line_templates,
    matrices,
    ngram_join,
    one_bit_search,
    packing,
    queries,
    secrets,
    tokens,
    toxicity,
)
from placeseek.llm.registry import table
from placeseek.session import stored

FOLDER = "/root/testdata/sf0.001"

# Nulls, empty and very long texts, ties, repeated rows; the columns clash with inner names.
ODD = [
    (1, None, "s", 1),
    (2, "", "s", 2),
    (3, "   \n\t ", None, 3),
    (4, "one two three", "s", None),
    (5, "one two three", "s", 5),
    (5, "one two three", "s", 5),
    (6, "word " * 30_000, "s", 6),
    (7, "a  b\n\nc\t<|endoftext|> don't 3.5km", "s", 7),
    (8, "x" * 50_000, "s", 8),
]
ODD_SCHEMA = "doc_id long, text string, source string, n_chars long, template string, sig long, pos int, key long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "t", 1, 2, 3) for r in ODD], ODD_SCHEMA)


@pytest.fixture(scope="module")
def texts(spark):
    rows = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


@pytest.fixture(scope="module")
def ids_of():
    tokenizer = Tokenizer.from_file(tokens.default_path())
    return lambda text: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# -- packing ------------------------------------------------------------------------------


def assert_packed(rows, texts, ids_of):
    lengths, places = defaultdict(int), defaultdict(list)
    for r in rows:
        part = ids_of(texts[r.doc_id])[r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        assert r.length == 1024 or r.piece == 0
        lengths[r.doc_id] += r.length
        places[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in texts.items():
        assert lengths[doc_id] % len(ids_of(text)) == 0 and lengths[doc_id]
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(places), -(-sum(lengths.values()) // 1024)


def test_packing_whole_table(spark, texts, ids_of):
    rows = queries.QUERIES["op9_best_fit_packing"](spark, FOLDER).collect()
    used, least = assert_packed(rows, texts, ids_of)
    assert used <= 1.02 * least + 1


def test_packing_odd_rows(odd, ids_of):
    rows = packing.packed(odd, tokens.default_path()).collect()
    assert_packed(rows, {r[0]: r[1] for r in ODD}, ids_of)
    assert sum(r.doc_id == 5 for r in rows) == 2


def test_packing_in_several_groups(spark, ids_of):
    rng = random.Random(3)
    texts = ["w " * rng.randint(1, 900) for _ in range(300)]
    cut = packing.stored(packing.pieces(docs_of(spark, texts), tokens.default_path()), "t")
    rows = packing.pack(cut, group_pieces=40).collect()
    used, least = assert_packed(rows, dict(enumerate(texts)), ids_of)
    assert used <= 1.1 * least + 2


def test_local_search_empties_bins():
    lengths = np.array([6, 3, 5, 4, 2])
    # 6+3 | 5+4 | 2: moving nothing fits; exchanging 3 for 2 and moving makes two full bins impossible,
    # but 6+4 | 5+3+2 is full.
    bins = packing.improve([[0, 1], [2, 3], [4]], lengths, 10)
    assert len(bins) == 2
    assert sorted(i for b in bins for i in b) == [0, 1, 2, 3, 4]
    assert all(lengths[b].sum() <= 10 for b in bins)


def test_best_fit_trees_agree():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 100, 500)
    by_tree = matrices.best_fit_tree(lengths.tolist(), 100)
    by_bits = packing.best_fit(lengths, 100)
    assert sorted(map(sorted, by_tree)) and len(by_tree) == len(by_bits)
    assert all(lengths[b].sum() <= 100 for b in by_tree)


def test_matrices_round_trip(spark, odd, texts, ids_of, tmp_path):
    for df, want in (
        (table(spark, FOLDER, "documents"), texts),
        (odd.dropDuplicates(["doc_id"]), {r[0]: r[1] for r in ODD}),
    ):
        packed = matrices.packed_matrices(df, tokens.default_path(), window=64)
        got = defaultdict(dict)
        for r in packed.collect():
            ids = np.frombuffer(r.ids, dtype="<u2")
            assert len(ids) == r.n_ids <= 1024 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_ids
            assert r.position_resets == r.cu_seqlens[:-1]
            for k, (a, b) in enumerate(zip(r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True)):
                got[r.doc_ids[k]][r.starts[k]] = ids[a:b]
        for doc_id, text in want.items():
            assert np.array_equal(np.concatenate([p for _, p in sorted(got[doc_id].items())]), ids_of(text))
    matrices.write_packed(packed, str(tmp_path / "m"))
    row = spark.read.parquet(str(tmp_path / "m")).first()
    positions = np.frombuffer(row.positions, dtype="<u2").reshape(row.n_rows, 1024)
    for k, borders in enumerate(row.cu_seqlens):
        assert all(positions[k, a] == 0 and positions[k, b - 1] == b - a - 1 for a, b in zip(borders, borders[1:]))


# -- similarity ---------------------------------------------------------------------------


def brute_components(texts):
    sets = {}
    for doc_id, text in texts.items():
        words = (text or "").encode().lower().split()
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        sets[doc_id] = grams or ({tuple(words)} if words else set())
    label = {d: d for d in texts}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(d for d in texts if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {d: (d, len(sets[d]), root(d)) for d in texts}


def linked_rows(df, **params):
    return {r.doc_id: (r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.linked(df, **params).collect()}


def test_ngram_join_whole_table(spark, texts):
    rows = queries.QUERIES["op6_ngram_jaccard_join"](spark, FOLDER).collect()
    assert {r.doc_id: tuple(r)[:3] for r in rows} == brute_components(texts)


@pytest.mark.parametrize("hot", [2, 5, 1000])
def test_ngram_join_hot_buckets(spark, hot):
    """Groups of edited copies, some far from the group's leading sets, and a passage that all share."""
    rng = random.Random(hot)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    passage = [word() for _ in range(12)]
    texts = []
    for _ in range(4):
        base = [word() for _ in range(60)]
        for _ in range(12):
            copy = list(base)
            for at in rng.sample(range(60), rng.choice([0, 1, 2, 3])):
                copy[at] = word()
            texts.append(" ".join(copy))
    texts += [" ".join(passage + [word() for _ in range(rng.randint(0, 9))]) for _ in range(30)]
    texts += [texts[0]] * 5 + ["", None, "one two", "One TWO", "one two three"]
    want = brute_components(dict(enumerate(texts)))
    assert linked_rows(docs_of(spark, texts), hot=hot, block=4) == want


def test_ngram_join_edited_copies_do_not_all_meet(spark, monkeypatch):
    """Copies of one text with edits of their own share its buckets, but only those that may be similar meet in blocks."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    base = [word() for _ in range(60)]
    texts = []
    for _ in range(60):
        copy = list(base)
        for at in rng.sample((8, 16, 24, 32, 40, 48), 4):
            copy[at] = word()
        texts.append(" ".join(copy))
    met = []

    def recorded(df, name):
        kept = stored(df, name)
        if name == "apart":
            met.append(kept.filter("_hot").agg(F.coalesce(F.sum("_blocks"), F.lit(0))).first()[0])
        return kept

    monkeypatch.setattr(ngram_join, "stored", recorded)
    assert linked_rows(docs_of(spark, texts), hot=4, block=4) == brute_components(dict(enumerate(texts)))
    assert met[0] > 1_000 and met[-1] == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_hot_buckets_of_many_sizes(spark, seed):
    """Parts of one text, whose sizes are in several bands and differ by just as much as similar sets may."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    base = [word() for _ in range(64)]
    texts = [" ".join(base[:n]) for n in rng.sample(range(10, 65), 12)]
    for _ in range(40):
        begin = rng.randint(0, 20)
        part = base[begin : begin + rng.randint(20, 44)]
        for _ in range(rng.choice([0, 0, 1, 2])):
            part[rng.randrange(len(part))] = word()
        texts.append(" ".join(part + [word() for _ in range(rng.choice([0, 0, 3, 6]))]))
    want = brute_components(dict(enumerate(texts)))
    assert linked_rows(docs_of(spark, texts), hot=2, block=3) == want


def test_ngram_join_odd_rows(spark, odd):
    want = brute_components({r[0]: r[1] for r in ODD})
    assert linked_rows(odd) == want
    assert ngram_join.linked(odd.limit(0)).count() == 0


def test_trie_finds_what_sets_find():
    rng = np.random.default_rng(2)
    probe = np.sort(rng.choice(10_000, 300, replace=False).astype(np.uint64))
    others = []
    for keep in (300, 280, 260, 255, 200, 10):
        others.append(np.concatenate([probe[:keep], np.arange(20_000, 20_000 + 300 - keep, dtype=np.uint64)]))
    found = ngram_join.similar(probe.tobytes(), [o.tobytes() for o in others])
    want = [k for k, o in enumerate(others) if 4 * len(set(o) & set(probe)) >= 3 * len(set(o) | set(probe))]
    assert sorted(found) == want


def test_components_of_a_chain(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


# -- lines --------------------------------------------------------------------------------


def test_line_templates(spark, odd):
    log = "user {} logged in from host {} at port {}"
    prose = "the quick brown fox jumps over the lazy dog again today"
    texts = [
        "\n".join([log.format("anna", "alpha", 1), prose, "short line"]),
        "\n".join([log.format("anna", "alpha", 22), "a line that stands in this document only once", "short line"]),
        "\n".join([log.format("anna", "beta", 3), prose]),
        "another text that nobody shares with anyone at all\n\nlast",
    ]
    rows = {r.doc_id: r for r in line_templates.deduplicated(docs_of(spark, texts)).collect()}
    assert rows[0].text == texts[0] and rows[0].n_dropped == 0
    # Digits are fields from the start; another host differs in one place of nine.
    assert rows[1].text == "a line that stands in this document only once\nshort line"
    assert rows[2].text == "" and rows[2].n_dropped == 2
    assert rows[3].text == texts[3] and rows[3].n_lines == 3
    out = line_templates.deduplicated(odd)
    assert out.columns[: len(odd.columns)] == odd.columns
    assert out.filter("doc_id = 1").first().text is None and out.filter("doc_id = 2").first().text == ""
    assert out.count() == len(ODD) and line_templates.deduplicated(odd.limit(0)).count() == 0


def test_repeated_passage_goes_and_lines_of_one_document_stay(spark):
    rng = random.Random(1)
    passage = " ".join("".join(rng.choices("abcdef", k=5)) for _ in range(55))
    own = [" ".join("".join(rng.choices("ghijkl", k=5)) for _ in range(20)) for _ in range(30)]
    texts = [f"{line}\n{passage}\n{line}" for line in own]
    rows = line_templates.deduplicated(docs_of(spark, texts)).collect()
    for r in rows:
        kept = f"{own[r.doc_id]}\n{own[r.doc_id]}"
        assert r.text == (texts[0] if r.doc_id == 0 else kept)


# -- benchmark ----------------------------------------------------------------------------


def test_decontamination(spark, odd):
    item = "If Anna buys 12 apples for 3 dollars in Rome, how many apples can Anna buy for 30 dollars there?"
    changed = "If Bob buys 15 apples for 4 euros in Oslo, how many apples can Bob buy for 44 euros there?"
    mixed = "If Bob buys 15 apples for 4 euros in Oslo, how many apples can Carl buy for 44 euros there?"
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, "too short")], "item_id long, text string")
    texts = [
        "some words before. " + item + " and some behind.",
        "Some words before. " + item.upper(),
        "a text in front.\n" + changed,
        "how many apples can one buy in a market on a sunny day in spring",
        None,
    ]
    found = {r.doc_id: r for r in decontamination.contaminated(docs_of(spark, texts), benchmark).collect()}
    assert {0, 2} <= set(found) and not {3, 4} & set(found)
    assert found[0].n_changed == 0 and found[2].n_changed > 0 and found[2].consistency == 1.0
    strict = decontamination.contaminated(docs_of(spark, [mixed, changed]), benchmark, consistent=1.0).collect()
    assert [r.doc_id for r in strict] == [1]
    assert decontamination.contaminated(odd, benchmark).count() == 0
    kept = decontamination.without_benchmark(docs_of(spark, texts), benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({0, 1, 2, 3, 4} - set(found))


def test_decontamination_finds_all_verbatim_items(spark, texts):
    words = lambda t: re.findall(r"\w+", t.lower())
    items = {r.item_id: " ".join(words(r.text)) for r in table(spark, FOLDER, "benchmark").collect()}
    want = {
        (d, i) for d, t in texts.items() for i, x in items.items() if len(x.split()) >= 9 and x in " ".join(words(t))
    }
    rows = queries.QUERIES["op2_benchmark_templates"](spark, FOLDER).collect()
    assert want and {(r.doc_id, r.item_id) for r in rows} == want


# -- toxicity -----------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    plain = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(300)]
    rows, labels = [], []
    for k in range(600):
        words = rng.choices(plain, k=rng.randint(5, 80))
        toxic = k % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["VILE", "rotten", "filth"])
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    known = spark.createDataFrame(labels[:300], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(docs, known).collect()}
    held_out = labels[300:]
    assert sum(got[d].toxic == bool(t) for d, _, t in held_out) >= 0.98 * len(held_out)
    assert not got[900].toxic and not got[901].toxic
    kept = {r.doc_id for r in toxicity.without_toxic(docs, known).collect()}
    assert kept == {d for d, r in got.items() if not r.toxic}


def test_toxicity_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.scored(odd, none).collect()
    assert len(rows) == len(ODD) and not any(r.toxic and r.p_toxic < 0.5 for r in rows)


def test_later_category_uses_the_earlier():
    rng = np.random.default_rng(0)
    y = (rng.random(400) < 0.5).astype(float)
    bias, weights, earlier = toxicity.fit_logistic(
        np.empty(0, dtype=int), np.empty(0, dtype=int), np.where(y > 0, 2.0, -2.0)[:, None], y, 0
    )
    assert earlier[0] > 0.5


# -- pages --------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><a href="/">Site</a></header><nav><ul><li><a href="/a">Menu one</a></li></ul></nav>
<div class="cookie-notice">We use cookies here</div><aside class="sidebar">Side words</aside>
<article><h1>Head &amp; title</h1><p>First <b>bold</b>ness&nbsp;is
 here.<p>Second<br>line <script>var t="</p>";</script>&copy; end</p><div class="ad">Buy this now</div>
<form><input name="q"><label>Search</label></form><p>Third &lt;tag&gt;.</p>
<section id="comments"><p>A reader says something long and useless about it all</p></section></article>
<footer>Foot words &middot; more</footer></body></html>"""


def test_main_text_of_a_rich_page(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p>broken <b>page"), (5, "u", "<nav><a>x</a></nav>")]
    pages = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string")
    got = {r.page_id: r for r in html_main.extracted(pages).collect()}
    assert got[1].text == "Head & title First boldness is here. Second line © end Third <tag>."
    assert (got[2].text, got[2].n_chars, got[3].text, got[5].text) == ("", 0, "", "")
    assert got[4].text == "broken page"


def test_main_text_whole_table(spark):
    rows = {r.page_id: r for r in queries.QUERIES["op5_html_main_text"](spark, FOLDER).collect()}
    for page in table(spark, FOLDER, "pages").collect():
        inside = re.search(r"<article>(.*?)</article>", page.html, re.S).group(1)
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub("</?b>", "", inside))).split())
        assert rows[page.page_id].text == want and rows[page.page_id].n_chars == len(want)


# -- vectors ------------------------------------------------------------------------------


def test_one_bit_search_recall(spark):
    data = {r.vec_id: np.array(r.embedding, dtype=float) for r in table(spark, FOLDER, "embeddings").collect()}
    got = defaultdict(list)
    for r in queries.QUERIES["op8_one_bit_search"](spark, FOLDER).orderBy("query_id", "rank").collect():
        assert r.score == pytest.approx(float(data[r.query_id] @ data[r.vec_id]), abs=1e-12)
        got[r.query_id].append(r.vec_id)
    hits = total = 0
    for q in (i for i in data if i % 20 == 0):
        best = sorted((i for i in data if i != q), key=lambda i: (-float(data[q] @ data[i]), i))[:20]
        hits, total = hits + len(set(best) & set(got[q])), total + 20
        assert len(got[q]) == 20
    assert hits / total >= 0.97


def test_one_bit_search_odd_vectors(spark):
    rows = [(k, [1.0, 0.0, 0.5]) for k in range(0, 60)]
    rows += [(100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, float("nan"), 0.0]), (160, []), (180, [1.0, 2.0])]
    rows += [(200, [None, 1.0, 1.0]), (220, [float("inf"), 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    indexed = one_bit_search.index(df).cache()
    found = one_bit_search.nearest(indexed, indexed.filter("vec_id % 20 = 0"), group_rows=16, query_block=2).collect()
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r.vec_id)
    assert set(got) == {0, 20, 40}
    assert got[0] == list(range(1, 21)) and got[20] == list(range(20))
    assert one_bit_search.index(df.limit(0)).count() == 0


# -- licences and secrets -----------------------------------------------------------------


def test_licenses(spark, odd):
    full = (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT."
    )
    parts = full.split("\n\n")
    texts = [
        "prose without an end\nLicensed under CC BY-NC 4.0.",
        "Text. This work is licensed under the GNU General Public\nLicense, version 3.",
        full,
        "\n\n".join([parts[2], parts[0], parts[1]]),  # wrong order
        "SPDX-License-Identifier: MIT",
        "All rights reserved.",
        "nobody was licensed to drive",
    ]
    got = {(r.doc_id, r.rule_id) for r in licenses.recognised(docs_of(spark, texts)).collect()}
    assert got == {
        (0, "grant-CC-BY-NC-4.0"), (1, "grant-GPL-3.0"), (2, "mit-text"), (4, "spdx-MIT"), (5, "all-rights-reserved"),
    }
    assert licenses.recognised(odd).count() == 0


def test_every_known_sentence_has_a_trigger():
    assert all(any(t in s for t in licenses.TRIGGERS) for s in licenses.known())


def test_secrets(spark, odd):
    rng = random.Random(9)
    hexes = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    texts = []
    for k in range(120):
        texts.append(f'prose here and token = "{hexes(40)}" more prose' if k % 2 else f"order number {rng.randint(10**15, 10**16 - 1)} was sent")
    docs = docs_of(spark, texts)
    some = docs.filter("doc_id < 80").select("doc_id")
    got = {r.doc_id: r for r in secrets.findings(docs, some).collect()}
    assert len(got) == 120 and all(got[k].secret == bool(k % 2) for k in range(80, 120))
    assert got[81].candidate in texts[81]
    assert secrets.findings(odd, odd).count() == 0


# -- pipeline -----------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = packing.stored(stage(spark, before, FOLDER), name)
        assert docs.columns == columns and docs.count() <= before.count()
        if name == "near_duplicates":
            labels = brute_components({r.doc_id: r.text for r in before.collect()})
            assert {r.doc_id for r in docs.collect()} == {d for d, _, c in labels.values() if d == c}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert packed.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 1024


# -- contracts of op5, op8 and op9 -----------------------------------------------------------


def test_text_around_adverts_of_any_length(spark):
    words = " ".join(f"advert{i}" for i in range(400))
    page = f"<body><article><p>Before it.</p><div class='ad'><p>{words}</p></div><aside>{words}</aside><p>After.</p>"
    page += "<figure><img><img></figure>" * 50 + "<p>Last one.</p></article><footer>Foot</footer></body>"
    plain = "<body><nav><a href='/'>Home</a></nav><h1>Head</h1><p>One two three.</p><p>Four five six.</p><footer>Foot</footer></body>"
    broken = "<article><p>Fine text here</p><p title=it's>and more don't stop</p><a href='never closed>tail</p></article>"
    rows = [(1, "u", page), (2, "u", plain), (3, "u", broken), (4, "u", "<article>a < b &amp; c<!-- no --> end <b")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {r.page_id: r.text for r in html_main.extracted(pages).collect()}
    assert got == {
        1: "Before it. After. Last one.", 2: "Head One two three. Four five six.",
        3: "Fine text here and more don't stop tail", 4: "a < b & c end",
    }
    assert html_main.extracted(pages.limit(0)).count() == 0


def test_broken_markup_is_read_in_linear_time():
    weights = {k: html_main.prior(k) for k in ("top", "aside", "text", "link", "content text", "content link")}
    begun = time.monotonic()
    for page in ('<a title="' + '"x' * 10_000, "<a " * 300_000, '<a ="' * 200_000 + '">x', "<!-- " * 200_000, "<a =" * 200_000 + ">"):
        html_main.main_text(page, weights)
    assert time.monotonic() - begun < 5


def test_search_among_vectors_of_any_length(spark):
    rng = np.random.default_rng(2)
    rows = [(k, (rng.normal(size=16) * s).tolist()) for k, s in enumerate([1e30] * 40 + [1e-200] * 40 + [1.0] * 40 + [1e150] * 20)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    indexed = stored(one_bit_search.index(frame), "codes")
    got = [tuple(r) for r in one_bit_search.nearest(indexed, indexed.filter("vec_id % 20 = 0")).collect()]
    want = []
    for q, x in rows[::20]:
        scores = [(-float((np.array(v) * np.array(x)).sum()), i) for i, v in rows if i != q]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:20], 1)]
    found = {(q, i) for q, _, i, _ in got}
    assert len(got) == len(want) and len(found & {(q, i) for q, _, i, _ in want}) >= 0.97 * len(want)


def test_marker_strings_are_markers_as_in_the_plain_call(spark):

    library = Tokenizer.from_file(tokens.default_path())
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x <|endoftext|", "plain words here"]
    got = [np.frombuffer(x, "<u4").tolist() for x in tokens.encoder(tokens.default_path()).encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_new_words_go_straight_to_the_merges(monkeypatch):
    """Pieces of Latin letters are not cut by the pattern again; ids are those of the plain call."""
    library = Tokenizer.from_file(tokens.default_path())
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCXYZäöüßéèñçÓÈÉœøŁıʼnſƒªºµ"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 14))) for _ in range(3_000)]
    odd = ["don't", "'s", "x1", "12", "привет", "日本", "e\u0301", "\u0250", "a\u00adb", "\u00a0", "straße,", "über-all", "Ġx", "×", "ʰ"]
    texts = [" ".join(rng.choices(words, k=40)) + "\n" + " ".join(rng.choices(words + odd * 20, k=40)) for _ in range(60)]
    texts += ["", None, "é", " é", "é é\né"]
    encoder = tokens.Encoder(tokens.default_path())
    sent = []
    pieces = encoder._encode_pieces
    monkeypatch.setattr(encoder, "_encode_pieces", lambda some, lead: sent.extend(some) or pieces(some, lead))
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert not set(sent) & {w for w in words if w.isascii()} and "привет" in sent


# -- licences and lines ----------------------------------------------------------------------


def test_longer_rules_versions_and_expressions(spark):
    bsd2 = (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.\n"
    )
    bsd3 = bsd2 + (
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.\n"
    )
    cases = [
        (bsd2, {"BSD-2-Clause"}), (bsd3, {"BSD-3-Clause"}),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", {"MPL-2.0"}),
        ('Licensed under the Apache License, Version 2.0 (the "License")', {"Apache-2.0"}),
        ("Licensed under MIT or Apache-2.0.", {"MIT", "Apache-2.0"}),
        ("Released under the MIT License (MIT).", {"MIT"}),
        ("SPDX-License-Identifier: MIT OR Apache-2.0", {"MIT", "Apache-2.0"}),
        ("// SPDX-License-Identifier: GPL-3.0-or-later\nint x;", {"GPL-3.0-or-later"}),
        ("SPDX-License-Identifier: GPL-2.0+", {"GPL-2.0-or-later"}),
        ("SPDX-License-Identifier: LGPL-2.1-only", {"LGPL-2.1"}),
        ("He was licensed under or over the mit license bridge.", set()),
    ]
    docs = spark.createDataFrame(
        [(k, text, "m", "r") for k, (text, _) in enumerate(cases)], "doc_id long, text string, m string, rule_id string"
    )
    got = defaultdict(set)
    for row in licenses.recognised(docs).collect():
        got[row.doc_id].add(row.license_id)
    assert [got[k] for k in range(len(cases))] == [want for _, want in cases]


def test_lines_beside_columns_of_the_same_names(spark):
    line = "this line stands in every one of them"
    rows = [(k, f"own words {k}\n{line}", "x", "y", k) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, n_dropped string, template long")
    got = line_templates.deduplicated(docs)
    assert sorted(got.columns) == sorted(["doc_id", "text", "template", "n_lines", "n_dropped"])
    assert sum(r.n_dropped for r in got.collect()) == 5
    assert line_templates.deduplicated(docs.limit(0)).count() == 0


def test_workers_keep_no_pieces_of_a_packed_table(spark):
    texts = [f"word{k} some{k % 7} text.\nNext line{k}" for k in range(200)]
    packing.pieces(docs_of(spark, texts), tokens.default_path()).collect()
    matrices.packed_matrices(docs_of(spark, texts), tokens.default_path()).collect()

    def kept(batches):
        for batch in batches:
            sizes = [len(v) for e in tokens._encoders.values() for v in vars(e).values() if isinstance(v, dict)]
            yield pa.RecordBatch.from_pydict({"n": pa.array([sum(sizes)] * batch.num_rows, pa.int64())})

    assert {r.n for r in spark.range(0, 64, 1, 16).mapInArrow(kept, "n long").collect()} == {0}


def test_a_batch_looks_up_each_distinct_piece_once():
    encoder = tokens.Encoder(tokens.default_path())
    asked = []

    class Seen(dict):
        def __getitem__(self, piece):
            asked.append(piece)
            return super().__getitem__(piece)

    texts = ["same words again, and again,\nsame words again"] * 50 + [None, "", "two  blanks", "tab\there", "é. ß"]
    want = [encoder.whole(t or "") for t in texts]
    assert encoder.encode(texts) == want
    for name, value in list(vars(encoder).items()):
        if isinstance(value, dict):
            setattr(encoder, name, Seen(value))
    assert encoder.encode(texts) == want
    assert len(asked) == len(set(asked)) < 20
