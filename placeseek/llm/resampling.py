"""Importance resampling of documents towards the word statistics of a target.

1. One pass turns each whole text into the array of its hashed features (single words and
   pairs of neighbours, repeats counted) and writes it as two bytes a feature.
2. Both corpora are counted over ``BUCKETS`` fixed buckets: an array of counts per task,
   added up per bucket. The gain of a bucket is the floored thousandfold log odds of target
   against corpus.
3. A document's weight is the floored mean gain over its array; with seeded Gumbel noise it
   becomes a score, and the documents of highest score are a draw without replacement with
   probabilities that follow the weights.
4. The exact cutoff is found by selection: every partition reports the median of the keys that
   remain in it, the median of these medians weighted by the remaining sizes is counted
   against, and the side that cannot hold the cutoff is dropped, at least a quarter of the keys a
   round. Medians do not depend on how rows are dealt, so a lost executor changes nothing.
5. Only the drawn rows are put in order, by ranges.

Null, empty and wordless texts have no features and weight 0. A repeated doc_id is a document per row.
Rows of one key are ranked by their feature count and then in any order. A row without doc_id has no
score and is never drawn, but its words count. Empty tables: no document gives no row, no target text
leaves the target counts 0. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeseek.llm.tokens import text_batches
from placeseek.operators.positions import with_running_total
from placeseek.session import stored

BUCKETS = 10_000
PERCENT = 25
LEAST_WORDS = 20
SEED = 7
# The selection ends in the driver once this many keys are left.
LEFT_KEYS = 4_096

# On UTF-8 bytes: digits, small letters, and every byte of a letter beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text: bytes | None, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """(number of words, bucket of every feature) of a whole text."""
    # bytes.lower() knows A-Z only, as wanted.
    words = WORD.findall(text.lower()) if text else []
    single = list(map(crc32, words))
    # The checksum of a pair goes on from that of its first word and the blank.
    pairs = map(crc32, words[1:], map(crc32, repeat(b" "), single))
    sums = np.array([*single, *pairs], dtype=np.uint32)
    return len(words), (sums % buckets).astype("<u2")


def hashed(docs: DataFrame, key: str | None = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, buckets) of every document; without ``key`` ids are null."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("a bucket has two bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_batches(batch.column(1).to_pylist()):
                found = [features(t, buckets) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, len(texts)),
                        pa.array([n for n, _ in found], pa.int64()),
                        pa.array([len(b) for _, b in found], pa.int64()),
                        pa.array([b.tobytes() for _, b in found], pa.binary()),
                    ],
                    names=["doc_id", "n_words", "n_features", "buckets"],
                )

    doc_id = F.col(key) if key else F.lit(None)
    return docs.select(doc_id.cast("long").alias("doc_id"), F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, n_words long, n_features long, buckets binary"
    )


def counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all documents: ``buckets`` numbers, whatever the corpus."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            data = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(data, dtype="<u2"), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    added = rows.select("buckets").mapInArrow(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in added.collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of each of the B buckets."""
    all_corpus, all_target = (float(int(c.sum()) + len(c)) for c in (corpus, target))
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * all_corpus / ((s + 1.0) * all_target)))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def noise(doc_id: int, seed: int) -> int:
    """Floored thousandfold Gumbel noise of a document, the same in every run."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) from the feature arrays."""
    held = rows.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n_words, n_features, data = batch.columns
            lengths = n_features.to_numpy(zero_copy_only=False)
            flat = np.frombuffer(b"".join(data.to_pylist()), dtype="<u2")
            sums = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(held.value[flat])])
            ends = np.cumsum(lengths)
            weight = (sums[ends] - sums[ends - lengths]) // np.maximum(lengths, 1)
            score = [None if d is None else w + noise(d, seed) for d, w in zip(ids.to_pylist(), weight.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [ids, n_words, n_features, pa.array(weight), pa.array(score, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


Key = tuple[int, int]


def _first(key: Key, strictly: bool = True) -> Column:
    """Whether a row comes before ``key`` (score, doc_id) in the order of the draw."""
    score, doc_id = (F.lit(k) for k in key)
    tie = F.col("doc_id") < doc_id if strictly else F.col("doc_id") <= doc_id
    return (F.col("score") > score) | ((F.col("score") == score) & tie)


def _medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(n, score, doc_id): size and lower median of the keys in this partition."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if parts:
        score, doc_id = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((doc_id, -score))
        middle = order[(len(order) - 1) // 2]
        yield pa.RecordBatch.from_pydict({"n": [len(order)], "score": [int(score[middle])], "doc_id": [int(doc_id[middle])]})


def cutoff(keys: DataFrame, wanted: int, left_keys: int = LEFT_KEYS) -> Key | None:
    """The ``wanted``-th key (score, doc_id) in the order of the draw, exactly; none for 0.

    ``keys`` are stored rows, at least ``wanted`` of them. Two narrow passes a round; the driver
    sees one median per partition and at most ``left_keys`` keys at the end.
    """
    if wanted <= 0:
        return None
    held = remaining = keys.select("score", "doc_id")
    after = until = size = held_size = None
    while True:
        if size is not None and size <= left_keys:
            last = sorted(remaining.collect(), key=lambda r: (-r.score, r.doc_id))
            return tuple(last[wanted - 1])
        if held_size and 4 * size <= held_size:
            held = remaining = stored(remaining, "keys")
            held_size = size
        medians = remaining.mapInArrow(_medians, "n long, score long, doc_id long").collect()
        medians.sort(key=lambda r: (-r.score, r.doc_id))
        size, seen = sum(r.n for r in medians), 0
        held_size = held_size or size
        for row in medians:
            seen += row.n
            if 2 * seen >= size:
                break
        pivot = (row.score, row.doc_id)
        before, upto = remaining.agg(
            F.count_if(_first(pivot)), F.count_if(_first(pivot, strictly=False))
        ).first()
        if before < wanted <= upto:
            return pivot
        if wanted <= before:
            until, size = pivot, before
        else:
            after, size, wanted = pivot, size - upto, wanted - upto
        remaining = held
        if until:
            remaining = remaining.filter(_first(until))
        if after:
            remaining = remaining.filter(~_first(after, strictly=False))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    left_keys: int = LEFT_KEYS,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text).

    ``rank`` is the place in the draw of floor(percent of the documents with at least
    ``least_words`` words), null for those that were not drawn. ``target`` has ``text``.
    """
    rows = stored(hashed(docs, buckets=buckets), "features")
    gain = gains(counts(rows, buckets), counts(hashed(target, None, buckets), buckets))
    done = stored(scored(rows, gain, seed), "scores")
    open_to = done.filter((F.col("n_words") >= least_words) & F.col("score").isNotNull())
    wanted = percent * open_to.count() // 100
    last = cutoff(open_to, wanted, left_keys)
    if last is None:
        return done.withColumn("rank", F.lit(None).cast("long"))
    drawn = (F.col("n_words") >= least_words) & F.coalesce(_first(last, strictly=False), F.lit(False))
    winners = done.filter(drawn).withColumn("_down", -F.col("score")).withColumn("_row", F.monotonically_increasing_id())
    placed = with_running_total(winners, ["_down", "doc_id", "n_features", "_row"], F.lit(1), "rank")
    # Equal keys at the cutoff may be more than were wanted.
    placed = placed.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return placed.select(*done.columns, "rank").unionByName(
        done.filter(~drawn).withColumn("rank", F.lit(None).cast("long"))
    )
