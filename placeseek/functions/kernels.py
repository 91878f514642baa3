"""Code that runs inside Python tasks: numpy and pandas on Arrow batches, no Spark.

Functions of this module are sent to the workers by value, so executors need not have
the package installed.
"""

from __future__ import annotations

import hashlib
import html
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

DISTANCE_DIGITS = 6


def nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def unescape(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else html.unescape(t))


def signed_counts(dim: int):
    """Vectors of signed counts: each word adds or takes one in the slot that its hash names."""

    def run(words: pa.Array) -> pa.Array:
        document = np.repeat(np.arange(len(words)), words.value_lengths().to_numpy(zero_copy_only=False))
        coded = words.flatten().dictionary_encode()
        hashes = [hashlib.md5(w.encode()).digest() for w in coded.dictionary.to_pylist()]
        slots = np.array([int.from_bytes(h[:4], "big") % dim for h in hashes], dtype=np.int64)
        signs = np.array([1.0 if h[4] < 128 else -1.0 for h in hashes])
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sums = np.bincount(document * dim + slots[codes], weights=signs[codes], minlength=len(words) * dim)
        return pa.ListArray.from_arrays(np.arange(0, len(sums) + 1, dim, dtype=np.int32), sums)

    return run


def _range_rows(at: int, ids: list, words: list) -> Iterator[pa.RecordBatch]:
    """The row of a range and then its blocks, in parts of 65,536 terms."""
    lengths = np.concatenate([w.value_lengths().to_numpy(zero_copy_only=False) for w in words]).astype(np.int64)
    n = len(lengths)
    coded = pa.concat_arrays([w.flatten() for w in words]).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # A posting is a stretch of equal (term, place); a class of equal (term, frequency).
    pairs = np.sort(codes * n + np.repeat(np.arange(n), lengths))
    starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(pairs) else np.empty(0, np.int64)
    tf = np.diff(np.r_[starts, len(pairs)])
    term, place = np.divmod(pairs[starts], n)
    order = np.lexsort((tf, term))
    term, place, tf = term[order], place[order].astype(np.int32), tf[order].astype(np.int32)
    fresh_term = np.r_[True, term[1:] != term[:-1]][: len(term)]
    first = np.flatnonzero(fresh_term | np.r_[True, tf[1:] != tf[:-1]][: len(term)])
    dls = lengths.astype(np.int32)
    least = np.minimum.reduceat(dls[place], first) if len(first) else np.empty(0, np.int32)
    places = pa.ListArray.from_arrays(np.r_[first, len(term)].astype(np.int32), pa.array(place))
    classes = pa.StructArray.from_arrays([pa.array(tf[first]), pa.array(least), places], names=["tf", "dl", "places"])
    heads = np.flatnonzero(fresh_term[first])
    lists = pa.ListArray.from_arrays(np.r_[heads, len(first)].astype(np.int32), classes)
    terms = coded.dictionary.take(pa.array(term[first[heads]])).cast(pa.string())

    def batch(term: pa.Array, classes: pa.Array, doc_ids: pa.Array, dls: pa.Array) -> pa.RecordBatch:
        where = pa.array(np.full(len(term), at, dtype=np.int64))
        return pa.RecordBatch.from_arrays([term, where, classes, doc_ids, dls], names=["term", "range", "classes", "doc_ids", "dls"])

    def whole(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), values)

    yield batch(pa.nulls(1, pa.string()), pa.nulls(1, lists.type), whole(pa.concat_arrays(ids)), whole(pa.array(dls)))
    step = 65_536
    for begin in range(0, len(terms), step):
        part = terms[begin : begin + step]
        none = pa.nulls(len(part), pa.list_(pa.int64())), pa.nulls(len(part), pa.list_(pa.int32()))
        yield batch(part, lists[begin : begin + step], *none)


def blocks_of_ranges(range_docs: int, range_words: int):
    """Task function: (_at, doc_id, words) to the ranges of a task's documents and their blocks.

    A range ends at ``range_docs`` documents or before its words exceed ``range_words``; a longer document
    is a range of its own. Its number is that of its first document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, words, docs, held = 0, [], [], 0, 0
        for batch in batches:
            upto = np.r_[0, np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))]
            begin = 0
            while begin < batch.num_rows:
                room = int(np.searchsorted(upto, upto[begin] + range_words - held, side="right")) - 1
                end = min(batch.num_rows, begin + range_docs - docs, max(room, begin + (docs == 0)))
                if end > begin:
                    if not docs:
                        at = batch.column(0)[begin].as_py()
                    ids.append(batch.column(1)[begin:end])
                    words.append(batch.column(2)[begin:end])
                    docs, held = docs + end - begin, held + int(upto[end] - upto[begin])
                if end < batch.num_rows or docs == range_docs:
                    yield from _range_rows(at, ids, words)
                    ids, words, docs, held = [], [], 0, 0
                begin = end
        if docs:
            yield from _range_rows(at, ids, words)

    return run


def fold(texts: pd.Series) -> pd.Series:
    """Without accents: marks of the decomposed form are dropped."""

    def plain(text: str) -> str:
        return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))

    return texts.map(lambda t: None if t is None else plain(t))


def marginal(k: int, share: float):
    """Task function: k hits of one query, each the most relevant of those least like the ones before."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id").reset_index(drop=True)
        most = rows["value"].max()
        worth = rows["value"].to_numpy() / most if most > 0 else np.zeros(len(rows))
        vectors = np.stack([np.asarray(v, dtype=np.float64) for v in rows["embedding"]])
        vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        like = np.round(vectors @ vectors.T, DISTANCE_DIGITS)
        place = rows["place"].to_numpy()
        like[(place[:, None] == place[None, :]) & pd.notna(place)[:, None]] = 1.0
        nearest, chosen = np.zeros(len(rows)), []
        while len(chosen) < min(k, len(rows)):
            gain = np.round(share * worth - (1 - share) * nearest, DISTANCE_DIGITS)
            gain[chosen] = -np.inf
            chosen.append(int(gain.argmax()))
            nearest = like[:, chosen].max(axis=1)
        return pd.DataFrame(
            {"query_id": rows["query_id"].iloc[0], "rank": np.arange(1, len(chosen) + 1), "id": rows["id"].to_numpy()[chosen]}
        )

    return run


def guarded(function):
    """Texts of ``function``, null where it fails."""

    def run(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                return None if text is None else function(text)
            except Exception:  # noqa: BLE001 - a user's model may fail in any way
                return None

        return texts.map(one)

    return run


def keep_best(columns: np.ndarray, distances: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest (distance, id) pairs of each column."""
    order = np.lexsort((ids, distances, columns))
    sorted_columns = columns[order]
    starts = np.flatnonzero(np.r_[True, sorted_columns[1:] != sorted_columns[:-1]])
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[place < k]


def vectors_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def squared_gaps(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances, rows x queries, rounded so that equal vectors tie."""
    gaps = (rows**2).sum(axis=1)[:, None] + (queries**2).sum(axis=1)[None, :] - 2.0 * rows @ queries.T
    return np.round(np.maximum(gaps, 0.0), DISTANCE_DIGITS)


class Best:
    """The k nearest rows seen so far, per query number."""

    def __init__(self, k: int):
        self.k = k
        self.columns, self.distances, self.ids = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)

    def add(self, gaps: np.ndarray, ids: np.ndarray, numbers: np.ndarray) -> None:
        if len(gaps) > self.k:
            bound = np.partition(gaps, self.k - 1, axis=0)[self.k - 1]
            row, column = np.nonzero(gaps <= bound[None, :])
        else:
            row, column = np.nonzero(np.ones_like(gaps, dtype=bool))
        columns = np.r_[self.columns, numbers[column]]
        distances, ids = np.r_[self.distances, gaps[row, column]], np.r_[self.ids, ids[row]]
        best = keep_best(columns, distances, ids, self.k)
        self.columns, self.distances, self.ids = columns[best], distances[best], ids[best]

    def rows(self, query_ids: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(query_ids[self.columns]), pa.array(self.ids), pa.array(self.distances)],
            names=["query_id", "id", "distance"],
        )


def nearest_in_batches(blocks: list, k: int):
    """Task function: the k nearest of a task's own rows for the queries of all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in blocks]
        for batch in batches:
            if batch.num_rows:
                ids, rows = batch.column(0).to_numpy(zero_copy_only=False), vectors_of(batch.column(1))
                for held, block in zip(best, blocks, strict=True):
                    held.add(squared_gaps(rows, block.value[1]), ids, np.arange(len(block.value[0])))
        for held, block in zip(best, blocks, strict=True):
            yield held.rows(block.value[0])

    return run


def distances(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Distances from differences, which keep their digits when vectors are near."""
    out = np.empty((len(rows), len(others)))
    for k, other in enumerate(others):
        out[:, k] = np.sqrt(((rows - other) ** 2).sum(axis=1))
    return out


def nearest_pivot(pivots: np.ndarray):
    """Task function: adds the nearest pivot, the distance to it and the squared length."""

    halves = (pivots**2).sum(axis=-1) / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = vectors_of(batch.column(1))
                # The product finds a pivot, differences give the distance to it; any near pivot would do.
                pivot = (halves[None, :] - rows @ pivots.T).argmin(axis=1)
                gap = np.sqrt(((rows - pivots[pivot]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(list(rows), pa.list_(pa.float64())), pa.array(pivot.astype(np.int32)),
                        pa.array(gap), pa.array((rows**2).sum(axis=1)),
                    ],
                    names=["id", "embedding", "pivot", "gap", "reach"],
                )

    return run


def least_squares(to_pivots: np.ndarray, queries: np.ndarray, units: pd.DataFrame) -> np.ndarray:
    """Least squared distance from each query to a member of each unit, queries x units.

    By the triangle inequality a member lies at least as far as the query's distance to the pivot
    differs from those of the unit. Rounding of the compared distances is taken off.
    """
    pivot, low, high, reach = (units[c].to_numpy() for c in ("pivot", "low", "high", "reach"))
    to_unit = to_pivots[:, pivot]
    least = np.maximum(0.0, np.maximum(to_unit - high, low - to_unit)) * (1 - 1e-9)
    rough = 10.0**-DISTANCE_DIGITS + 1e-12 * ((queries**2).sum(axis=1)[:, None] + reach[None, :])
    return least**2 - rough


def _few(queries: np.ndarray, step: int = 64):
    for at in range(0, len(queries), step):
        yield slice(at, at + step)


def first_units(known, k: int):
    """Task function: per query the units of least bound that hold k vectors together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, units = known.value
        number, size, middle = units["unit"].to_numpy(), units["n"].to_numpy(), (units["low"] + units["high"]).to_numpy() / 2
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, queries = batch.column(0).to_numpy(zero_copy_only=False), vectors_of(batch.column(1))
            for part in _few(queries):
                to_pivots = distances(queries[part], pivots)
                bounds = least_squares(to_pivots, queries[part], units)
                # Of units around the query, the one whose ring is next to it.
                ring = np.abs(to_pivots[:, units["pivot"].to_numpy()] - middle)
                own, chosen = [], []
                for q, (bound, near, far) in enumerate(zip(bounds, ring, to_pivots[:, units["pivot"].to_numpy()], strict=True)):
                    order = np.lexsort((near, far, np.maximum(bound, 0)))
                    upto = int(np.searchsorted(np.cumsum(size[order]), k)) + 1
                    chosen.append(number[order[:upto]])
                    own.append(np.full(len(chosen[-1]), ids[part][q]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(own)), pa.array(np.concatenate(chosen))], names=["query_id", "unit"]
                )

    return run


def seen_units(known):
    """Task function: (units within the floor, all units) of the queries, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, units = known.value
        seen = total = 0
        for batch in batches:
            if batch.num_rows:
                queries, floor = vectors_of(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False)
                for part in _few(queries):
                    within = least_squares(distances(queries[part], pivots), queries[part], units) <= floor[part, None]
                    seen, total = seen + int(within.sum()), total + within.size
        yield pa.RecordBatch.from_pydict({"seen": [seen], "units": [total]})

    return run


def units_within(block: tuple, pivots: np.ndarray, units: pd.DataFrame) -> list[int]:
    """Numbers of the units that some query of a block has still to look at."""
    ids, queries, looks, floor = block
    wanted = np.zeros(len(units), dtype=bool)
    place = pd.Series(np.arange(len(ids)), index=ids)
    seen = place.loc[looks["query_id"].to_numpy()].to_numpy(), units["unit"].searchsorted(looks["unit"].to_numpy())
    for part in _few(queries):
        within = least_squares(distances(queries[part], pivots), queries[part], units) <= floor[part, None]
        mine = (seen[0] >= part.start) & (seen[0] < part.stop)
        within[seen[0][mine] - part.start, seen[1][mine]] = False
        wanted |= within.any(axis=0)
    return units["unit"].to_numpy()[wanted].tolist()


def nearest_in_units(blocks: list, known, k: int, first: bool):
    """Task function: the k nearest rows in the first units of each query, or in the others within its floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, units = known.value
        meta = units.set_index("unit")
        held = []
        for block in blocks:
            ids, queries, looks, floor = block.value
            place = pd.Series(np.arange(len(ids)), index=ids)
            number = place.loc[looks["query_id"].to_numpy()].to_numpy()
            by_unit = {u: number[rows] for u, rows in looks.groupby("unit").indices.items()}
            held.append((ids, queries, by_unit, floor, distances(queries, pivots), Best(k)))
        for batch in batches:
            if not batch.num_rows:
                continue
            unit_of, row_ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            rows = vectors_of(batch.column(2))
            for unit in np.unique(unit_of).tolist():
                mine = np.flatnonzero(unit_of == unit)
                for _, queries, by_unit, floor, to_pivots, best in held:
                    looked = by_unit.get(unit, np.empty(0, dtype=np.int64))
                    if first:
                        wanted = looked
                    else:
                        within = least_squares(to_pivots, queries, meta.loc[[unit]])[:, 0] <= floor
                        within[looked] = False
                        wanted = np.flatnonzero(within)
                    if len(wanted):
                        gaps = squared_gaps(rows[mine], queries[wanted])
                        best.add(gaps, row_ids[mine], wanted)
        for ids, *_, best in held:
            yield best.rows(ids)

    return run


def best_of_range(k: int, avgdl: float, k1: float, b: float, digits: int):
    """Task function: the k best documents of a range for each of its queries.

    ``left`` holds the blocks of the range and one row without a term for its documents; ``right``
    a row per query with its words, their weights and the score that a hit must reach.
    """
    none = pd.DataFrame({"query_id": np.empty(0, "i8"), "doc_id": np.empty(0, "i8"), "score": np.empty(0)})

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        plain = left["term"].isna().to_numpy()
        if not plain.any() or not len(right):
            return none
        home = left[plain].iloc[0]
        ids = np.asarray(home["doc_ids"], dtype=np.int64)
        lengths = np.asarray(home["dls"], dtype=np.float64)
        damp = k1 * (1 - b + b * (lengths / avgdl if avgdl > 0 else 0.0 * lengths))
        free = np.ones(len(ids), dtype=bool)
        if home["bits"] is not None:
            free = np.unpackbits(np.frombuffer(home["bits"], dtype=np.uint8), bitorder="little")[: len(ids)] == 1
        blocks: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for term, *lists in left.loc[~plain, ["term", "tfs", "sizes", "places"]].itertuples(index=False):
            tfs, sizes, places = (np.asarray(x) for x in lists)
            tf = np.repeat(tfs.astype(np.float64), sizes)
            blocks[term] = places, tf * (k1 + 1) / (tf + damp[places])
        asked, found, scores = [], [], []
        for query, floor, terms, weights in zip(
            right["query_id"], right["floor"], right["terms"], right["weights"], strict=True
        ):
            total = np.zeros(len(ids))
            for term, weight in zip(terms, weights, strict=True) if terms is not None else ():
                if term in blocks:
                    places, amount = blocks[term]
                    total[places] += weight * amount
            total = np.round(total, digits) + 0.0
            at = np.flatnonzero(free if floor is None or np.isnan(floor) else free & (total >= floor))
            if len(at) > k:
                least = np.partition(total[at], -k)[-k]
                at = at[total[at] >= least]
            at = at[np.lexsort((ids[at], -total[at]))[:k]]
            asked.append(np.full(len(at), query))
            found.append(ids[at])
            scores.append(total[at])
        columns = [np.concatenate(c) for c in (asked, found, scores)]
        return pd.DataFrame(dict(zip(("query_id", "doc_id", "score"), columns, strict=True)))

    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])
