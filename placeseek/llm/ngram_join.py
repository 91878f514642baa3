"""Similarity join on word n-grams: shared prefixes, stars of their buckets, tries of ordered sets.

The global order of shingles is that of their 64-bit hashes, the same at every size of the
corpus. Two sets with 4 * common >= 3 * union differ in at most (|x| + |y|) / 7 shingles.

1. Each task gives the first shingles of every set, once per set: those that prefix filtering asks
   for and ``n // EXTRA`` more. Similar sets then share not one but :func:`least` of them.
2. A shingle counts for a set where another set of possible size has it, too. Sets with fewer
   of these than ``least`` have no partner and go; few stay, as texts that share a passage share
   only that.
3. What is left gets exact document frequencies and is ordered anew, rare shingles first: of m
   shared shingles the first m - least + 1 are enough to meet every partner in a bucket.
4. A bucket gives the pairs of one leading set with the others, so rows grow with the sets.
   Pairs whose parity bitmaps differ in too many bits go; the sets that are left to one probe
   are stored in a trie in the global order and walked: overlaps of shared branches are
   counted once, and branches are left when the shingles that remain cannot reach the
   needed overlap. The links make components.
5. Buckets whose other sets still are in several components give the pairs of the smaller ones with all
   others, large buckets in blocks of bounded size, and what the bitmaps allow is verified in the
   same way. A pair inside one component cannot change it, so no component is lost. Before sets of large
   buckets meet, all their shingles are counted that sets of other components hold, by the holder's size:
   a set for which no size gives enough has no partner there and goes, so that the edited copies of one
   text, or the texts around one passage, do not all meet each other.

Null and empty texts and texts without words have empty sets, which link with nothing. With
fewer words than n the whole sequence is the only shingle. Equal sets always link. A
repeated doc_id is one document whose rows must not differ. An empty table gives no rows;
other columns are not read. Sets are told apart by 128 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeseek.llm.components import components
from placeseek.llm.tokens import text_batches
from placeseek.session import stored
from placeseek.sizing import fits

WORDS = 5
# One more shingle in so many is sent beyond the plain prefix.
EXTRA = 8
# Buckets of more sets are compared in blocks of BLOCK sets where components cross.
HOT = 64
BLOCK = 256
TRIE_STEP = 128
# Sizes of one band differ by up to this factor; bands of similar sets differ by up to REACH.
BAND = 1.1
REACH = math.ceil(math.log(4 / 3) / math.log(BAND))
# Entries of the caches that a worker keeps.
CACHED = 1_000_000

MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a whole text."""
    # bytes.lower() and bytes.split() know A-Z and \x20 \x09-\x0D only, as wanted.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(_words) > CACHED:
        _words.clear()
    hashes = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total = mixed(total + hashes[k : len(words) - width + 1 + k]) * MIX
    return np.unique(total)


def set_key(values: np.ndarray) -> tuple[int, int]:
    """128 bits of a whole set, as two signed numbers."""
    key = xxhash.xxh3_128_intdigest(values.tobytes())
    return (key >> 64) - (1 << 63), (key & ((1 << 64) - 1)) - (1 << 63)


def needed(size_a, size_b):
    """Least overlap of two sets with 4 * common >= 3 * union."""
    return (3 * (size_a + size_b) + 6) // 7


def prefix(size):
    """How many of a set's first shingles are sent."""
    return np.minimum(size, size - (3 * size + 3) // 4 + 1 + size // EXTRA)


@lru_cache(maxsize=100_000)
def least(size: int) -> int:
    """How many shingles the prefixes of two similar sets share, whatever the size of the other.

    Of the prefix that ends first in the global order, all shingles that both sets hold are in both
    prefixes, and its set has at most |set| - needed shingles that the other lacks.
    """
    others = np.arange((3 * size + 3) // 4, 4 * size // 3 + 1)
    both = needed(size, others)
    shared = np.minimum(prefix(size) - (size - both), prefix(others) - (others - both))
    return max(1, int(shared.min()))


def parity(values: np.ndarray) -> bytes:
    """Bitmap of a set, two to four bits a shingle: whether an odd number of shingles falls on a bit."""
    length = max(64, 2 << int(len(values) - 1).bit_length())
    counts = np.bincount((values & np.uint64(length - 1)).astype(np.int64), minlength=length)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def folded(bits: np.ndarray, length: int) -> np.ndarray:
    """Rows of bitmaps as they are at a shorter length (a power of two, in bytes)."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, length), axis=1)


def differing(size_a, size_b):
    """Most shingles that only one of two similar sets holds."""
    return size_a + size_b - 2 * needed(size_a, size_b)


def _batches(batches: Iterator[pa.RecordBatch]):
    """(ids, texts) in pieces of bounded text; the task's word hashes and batches do not stay in its worker."""
    try:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for begin, texts in text_batches(batch.column(1).to_pylist()):
                yield ids[begin : begin + len(texts)], texts
    finally:
        _words.clear()
        pa.default_memory_pool().release_unused()


def describe(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """(doc_id, size, k1, k2) of every document: the size and key of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _batches(batches):
            sets = [shingles(t, n) for t in texts]
            keys = np.array([set_key(s) for s in sets], dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, pa.int64()),
                    "size": pa.array([len(s) for s in sets], pa.int64()),
                    "k1": pa.array(keys[:, 0]),
                    "k2": pa.array(keys[:, 1]),
                }
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, size long, k1 long, k2 long")


def prefixes(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """(sig, k1, k2, size, least): the prefix of each set, once per set and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[int, int]] = set()
        for _, texts in _batches(batches):
            sigs, keys, sizes = [], [], []
            for text in texts:
                values = shingles(text, n)
                key = set_key(values)
                if not len(values) or key in known:
                    continue
                if len(known) > CACHED:
                    known.clear()
                known.add(key)
                sigs.append(values[: prefix(len(values))].astype(np.int64))
                keys.append(key)
                sizes.append(len(values))
            if sigs:
                times = [len(s) for s in sigs]
                pair = np.repeat(np.array(keys, dtype=np.int64), times, axis=0)
                columns = [
                    np.concatenate(sigs), pair[:, 0], pair[:, 1],
                    np.repeat(np.array(sizes, dtype=np.int32), times),
                    np.repeat(np.array([least(s) for s in sizes], dtype=np.int32), times),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["sig", "k1", "k2", "size", "least"]
                )

    return docs.select(F.lit(None).cast("long").alias("doc_id"), "text").mapInArrow(
        run, "sig long, k1 long, k2 long, size int, least int"
    )


def shared(rows: DataFrame) -> DataFrame:
    """The rows of :func:`prefixes` whose shingle another set of possible size has in its prefix, too.

    In a bucket sorted by size the nearest size lies beside a row, so a task looks at one row
    before and one behind, and holds no bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last rows so far: one that is decided and one that waits for its next.
        held: list[np.ndarray] | None = None
        decided = 0

        def decide(part: list[np.ndarray], first: int, last: int) -> pa.RecordBatch:
            near = (part[0][1:] == part[0][:-1]) & (4 * part[3][:-1].astype(np.int64) >= 3 * part[3][1:].astype(np.int64))
            ok = np.r_[False, near] | np.r_[near, False]
            return pa.RecordBatch.from_arrays(
                [pa.array(c[first:last][ok[first:last]]) for c in part], names=["sig", "k1", "k2", "size", "least"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            new = [c.to_numpy() for c in batch.columns]
            part = new if held is None else [np.concatenate([h, c]) for h, c in zip(held, new, strict=True)]
            again = np.logical_and.reduce([c[1:] == c[:-1] for c in part[:3]])
            part = [c[np.r_[True, ~again]] for c in part]
            yield decide(part, decided, len(part[0]) - 1)
            decided = min(1, len(part[0]) - 1)
            held = [c[-2:] for c in part]
        if held is not None:
            yield decide(held, decided, len(held[0]))

    dealt = rows.repartition("sig").sortWithinPartitions("sig", "size", "k1", "k2")
    return dealt.mapInArrow(run, "sig long, k1 long, k2 long, size int, least int")


def buckets(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(sig, doc, size, lead, lead_size) of the sets that may have partners: the buckets in which they meet them.

    The leading set of a bucket is the one with the largest part of its shingles held by others.
    """
    alive = (
        rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("_n"), F.first("least").alias("_least"))
        .filter("_n >= _least").join(classes, ["k1", "k2"]).select("k1", "k2", "doc")
    )
    left = stored(rows.join(alive, ["k1", "k2"]).select("sig", "doc", "size", "least"), "alive")
    counts = left.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    own = Window.partitionBy("doc")
    placed = left.join(counts, "sig").select(
        "sig", "doc", "size", "least", F.count(F.lit(1)).over(own).alias("_n"),
        F.row_number().over(own.orderBy("df", "sig")).alias("_place"),
    )
    found = placed.filter("_place <= _n - least + 1").select(
        "sig", "doc", "size", (F.col("_n") * 1000 / F.col("size")).cast("int").alias("held")
    )
    leading = found.groupBy("sig").agg(
        F.min(F.struct(-F.col("held"), "doc", "size")).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    return found.join(leading.filter("_n > 1"), "sig").select(
        "sig", "doc", "size", F.col("_first.doc").alias("lead"), F.col("_first.size").alias("lead_size")
    )


def alike(one: str, two: str) -> Column:
    return 4 * F.least(one, two) >= 3 * F.greatest(one, two)


def stars(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each bucket's leading set with the rest."""
    met = members.filter((F.col("doc") != F.col("lead")) & alike("size", "lead_size"))
    return met.select(F.col("lead").alias("a"), F.col("doc").alias("b")).distinct()


def sets_of(docs: DataFrame, wanted: DataFrame, n: int = WORDS) -> DataFrame:
    """(doc, size, bits, shingles) of the documents in ``wanted`` (doc), shingles in the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _batches(batches):
            sets = [shingles(t, n) for t in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc": pa.array(ids, pa.int64()),
                    "size": pa.array([len(s) for s in sets], pa.int32()),
                    "bits": pa.array([parity(s) for s in sets], pa.binary()),
                    "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
                }
            )

    names = wanted.select(F.col("doc").alias("doc_id"))
    kept = docs.select(F.col("doc_id").cast("long"), "text").join(
        F.broadcast(names) if fits(names) else names, "doc_id", "left_semi"
    )
    return kept.mapInArrow(run, "doc long, size int, bits binary, shingles binary")


def plausible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose bitmaps differ in no more bits than similar sets may."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, size_a, size_b = (c.to_numpy() for c in batch.columns[:4])
            ok = np.zeros(batch.num_rows, dtype=bool)
            most = differing(size_a.astype(np.int64), size_b.astype(np.int64))
            for k, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                length = min(len(x), len(y))
                one, two = (folded(np.frombuffer(v, dtype=np.uint8)[None], length) for v in (x, y))
                ok[k] = int(np.bitwise_count(one ^ two).sum()) <= most[k]
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])

    def side(name: str) -> DataFrame:
        return sets.select(F.col("doc").alias(name), F.col("size").alias(f"s_{name}"), F.col("bits").alias(f"m_{name}"))

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "s_a", "s_b", "m_a", "m_b").mapInArrow(run, "a long, b long")


class TrieNode:
    __slots__ = ("children", "ends", "longest", "shortest")

    def __init__(self) -> None:
        self.children: dict[bytes, TrieNode] = {}
        self.ends: list[int] = []
        self.longest = 0
        self.shortest = 1 << 60


def trie_of(sets: list[bytes], step: int = TRIE_STEP) -> TrieNode:
    """Trie over ordered sets; an edge holds up to ``step`` shingles."""
    root = TrieNode()
    for k, values in enumerate(sets):
        size = len(values) // 8
        node = root
        for at in range(0, len(values), 8 * step):
            node = node.children.setdefault(values[at : at + 8 * step], TrieNode())
            node.longest = max(node.longest, size)
            node.shortest = min(node.shortest, size)
        node.ends.append(k)
    return root


def similar(probe: bytes, sets: list[bytes], step: int = TRIE_STEP) -> list[int]:
    """Positions of the sets that are similar enough to ``probe``, by one walk over their trie."""
    own = np.sort(np.frombuffer(probe, dtype=np.uint64))
    found: list[int] = []
    stack = [(trie_of(sets, step), 0, 0)]
    while stack:
        node, depth, common = stack.pop()
        for k in node.ends:
            if 4 * common >= 3 * (len(own) + depth - common):
                found.append(k)
        for edge, child in node.children.items():
            values = np.frombuffer(edge, dtype=np.uint64)
            at = np.minimum(np.searchsorted(own, values), len(own) - 1)
            now = common + int((own[at] == values).sum())
            below = depth + len(values)
            most = now + min(child.longest - below, len(own) - now)
            if most >= needed(len(own), child.shortest):
                stack.append((child, below, now))
    return found


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough; each moves the set of b to that of a."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            probes, others = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            left, right = batch.column(2), batch.column(3).to_pylist()
            borders = np.flatnonzero(np.r_[True, probes[1:] != probes[:-1]]).tolist() if len(probes) else []
            a, b = [], []
            for begin, end in zip(borders, [*borders[1:], len(probes)], strict=True):
                for k in similar(left[begin].as_py(), right[begin:end]):
                    a.append(probes[begin])
                    b.append(others[begin + k])
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def side(name: str) -> DataFrame:
        return sets.select(F.col("doc").alias(name), F.col("shingles").alias(f"set_{name}")).hint("merge")

    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    return joined.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def shingle_rows(sets: DataFrame) -> DataFrame:
    """(sig, doc, size, component) of every shingle of ``sets`` (doc, size, component, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values = np.frombuffer(b"".join(part.column(3).to_pylist()), dtype=np.int64)
                times = part.column(1).to_numpy()
                columns = [values, *(np.repeat(c.to_numpy(), times) for c in part.columns[:3])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["sig", "doc", "size", "component"]
                )

    dealt = sets.select("doc", "size", "component", "shingles").repartition("doc")
    return dealt.mapInArrow(run, "sig long, doc long, size int, component long")


def partnered(sets: DataFrame) -> DataFrame:
    """(doc) of the ``sets`` (doc, size, component, shingles) that may have a partner in another component.

    A partner holds at least :func:`needed` of the set's shingles, and so do all holders of the
    partner's band of sizes that are in other components.
    """
    width = math.log(BAND)
    rows = shingle_rows(sets).withColumn("band", F.floor(F.log("size") / width).cast("int"))
    holders = Window.partitionBy("sig").orderBy("band")
    by = range(-REACH, REACH + 1)

    def elsewhere(k: int) -> Column:
        frame = holders.rangeBetween(k, k)
        first, last = F.min("component").over(frame), F.max("component").over(frame)
        held = (first != F.col("component")) | (last != F.col("component"))
        return F.coalesce(held, F.lit(False)).cast("int").alias(f"_{k + REACH}")

    def enough(k: int) -> Column:
        # Sizes are whole numbers, so rounding the border down names no size that is too large.
        border = F.floor(F.exp((F.col("band") + k) * width)).cast("long")
        other = F.greatest(border, F.floor((3 * F.col("size") + 3) / 4))
        return F.col(f"_{k + REACH}") >= F.floor((3 * (F.col("size") + other) + 6) / 7)

    marked = rows.select("doc", "size", "band", *[elsewhere(k) for k in by])
    counted = marked.groupBy("doc", "size", "band").agg(*[F.sum(f"_{k + REACH}").alias(f"_{k + REACH}") for k in by])
    return counted.filter(reduce(or_, [enough(k) for k in by])).select("doc")


def apart(known: DataFrame, hot: int, block: int) -> DataFrame:
    """The rows (sig, doc, size, component) of buckets in several components, with what their comparison needs.

    ``minor`` rows are outside of the bucket's largest component; ``_hot`` buckets have more than ``hot`` sets,
    ``_blocks`` blocks of them and ``_small`` blocks of minor ones.
    """
    main = (
        known.groupBy("sig", "component").agg(F.count(F.lit(1)).alias("_c"))
        .groupBy("sig").agg(F.sum("_c").alias("_n"), F.max(F.struct("_c", "component")).alias("_main"))
        .filter("_main._c < _n")
        .select(
            "sig", F.col("_main.component").alias("_main"), (F.col("_n") > hot).alias("_hot"),
            F.ceil(F.col("_n") / block).cast("int").alias("_blocks"),
            F.ceil((F.col("_n") - F.col("_main._c")) / block).cast("int").alias("_small"),
        )
    )
    return stored(known.join(main, "sig").withColumn("minor", F.col("component") != F.col("_main")), "apart")


def crossing(
    members: DataFrame, labels: DataFrame, sets: DataFrame, hot: int = HOT, block: int = BLOCK
) -> DataFrame:
    """Pairs (a, b) of sets that share a bucket, are in different components and have bitmaps that allow it.

    The sets of a bucket's largest component meet the others only; leading sets have met all. In buckets
    of more than ``hot`` sets, those without a possible partner go first (:func:`partnered`), and where more
    than ``hot`` are left, rows are repeated once per block of the side they meet.
    """
    rest = members.filter("doc <> lead")
    known = rest.join(labels, rest["doc"] == labels["node"], "left").select(
        "sig", "doc", "size", F.coalesce("component", "doc").alias("component")
    )
    dealt = apart(known, hot, block)
    few, many = dealt.filter("not _hot"), dealt.filter("_hot")
    if many.limit(1).count():
        among = sets.select("doc", "size", "shingles").join(many.select("doc", "component").distinct(), "doc")
        left = many.join(partnered(among), "doc", "left_semi").select("sig", "doc", "size", "component")
        again = apart(left, hot, block)
        few, many = few.unionByName(again.filter("not _hot")), again.filter("_hot")

    one = few.filter("minor").select("sig", *[F.col(c).alias(f"{c}_") for c in ("doc", "size", "component")])
    near = few.join(one, "sig").filter(
        (F.col("component") != F.col("component_")) & alike("size", "size_") & (~F.col("minor") | F.expr("doc > doc_"))
    )
    near = near.select(F.least("doc", "doc_").alias("a"), F.greatest("doc", "doc_").alias("b")).distinct()
    pairs = plausible(near, sets)
    if not many.limit(1).count():
        return pairs
    place = F.xxhash64("doc")

    def every(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

    holders = many.select(
        "sig", "doc", "component", "minor", F.lit(False).alias("probe"),
        F.pmod(place, F.col("_blocks")).cast("int").alias("_i"), every("_small").alias("_j"),
    )
    probes = many.filter("minor").select(
        "sig", "doc", "component", "minor", F.lit(True).alias("probe"),
        every("_blocks").alias("_i"), F.pmod(place, F.col("_small")).cast("int").alias("_j"),
    )
    spread = holders.unionByName(probes).join(sets.select("doc", "size", "bits"), "doc")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        near = rows[~rows["probe"]]
        by_length = []
        for length, part in near.groupby(near["bits"].str.len()):
            bits = np.frombuffer(b"".join(part["bits"]), dtype=np.uint8).reshape(len(part), length)
            columns = (part[c].to_numpy() for c in ("doc", "component", "minor"))
            by_length.append((length, bits, part["size"].to_numpy().astype(np.int64), *columns))
        a, b = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        far = rows[rows["probe"]]
        for doc, label, size, own in zip(far["doc"], far["component"], far["size"], far["bits"], strict=True):
            mine = np.frombuffer(own, dtype=np.uint8)[None]
            for length, bits, sizes, docs, labels_, minor in by_length:
                close = 4 * np.minimum(sizes, size) >= 3 * np.maximum(sizes, size)
                ok = np.flatnonzero((labels_ != label) & close & (~minor | (docs > doc)))
                if not len(ok):
                    continue
                short = min(length, mine.shape[1])
                apart = np.bitwise_count(folded(bits[ok], short) ^ folded(mine, short)).sum(axis=1, dtype=np.int64)
                ok = ok[apart <= differing(sizes[ok], size)]
                a.append(np.minimum(docs[ok], doc))
                b.append(np.maximum(docs[ok], doc))
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return pairs.unionByName(spread.groupBy("sig", "_i", "_j").applyInPandas(run, "a long, b long")).distinct()


def linked(docs: DataFrame, n: int = WORDS, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    owned = stored(describe(docs, n), "sets")
    classes = owned.filter("size > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("doc")).filter("doc is not null")
    met = stored(shared(prefixes(docs, n)), "shared")
    members = stored(buckets(met, classes), "buckets")
    sets = stored(sets_of(docs, members.select("doc").distinct(), n), "ordered")
    if sets.groupBy("doc").count().filter("count > 1").limit(1).count():
        sets = stored(sets.dropDuplicates(["doc"]), "ordered")

    def links_of(pairs: DataFrame) -> DataFrame:
        return stored(verified(stored(pairs, "pairs"), sets), "links")

    links = links_of(plausible(stars(members), sets))
    labels = components(links)
    more = links_of(crossing(members, labels, sets, hot, block))
    if more.limit(1).count():
        labels = components(links.unionByName(more))
    labelled = classes.join(labels, classes["doc"] == labels["node"], "left").select(
        "k1", "k2", F.coalesce("component", "doc").alias("component_id")
    )
    # Classes of very many copies: the small side is spread over all tasks by the adaptive join.
    return owned.join(labelled, ["k1", "k2"], "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
