"""Packed id matrices: best-fit-decreasing with a segment tree over free room.

Each task packs the documents it reads, so nothing is shuffled. Pieces gather in a window
of bounded size; a full window is packed best-fit-decreasing, full sequences leave, and
what is badly filled is packed again with the next window. Documents longer than a
sequence are split without loss.

Null or empty text is the end id alone. Repeated rows are packed as rows of their own; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeseek.llm import tokens
from placeseek.llm.packing import CAPACITY, END_ID, piece_bounds

WINDOW_PIECES = 8_192
KEPT_OPEN = 0.9

SCHEMA = (
    "sequence_id long, ids binary, n_ids int, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<long>, pieces array<int>, starts array<long>"
)


class RoomTree:
    """Segment tree over free room: how many open bins have it, found by least fitting room."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def least(self, room: int) -> int:
        """Smallest room of an open bin that is at least ``room``; -1 without one."""
        node = room + self.size
        if self.count[node]:
            return room
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return -1


def best_fit_tree(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions, best-fit-decreasing."""
    tree = RoomTree(capacity)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        room = tree.least(lengths[item])
        if room < 0:
            chosen, room = len(bins), capacity
            bins.append([item])
        else:
            tree.add(room, -1)
            chosen = open_bins[room].pop()
            bins[chosen].append(item)
        tree.add(room - lengths[item], 1)
        open_bins[room - lengths[item]].append(chosen)
    return bins


def packed_matrices(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    window: int = WINDOW_PIECES,
) -> DataFrame:
    """One row per sequence.

    ``ids`` holds the sequence as little-endian unsigned 16-bit ids, ``cu_seqlens`` the
    borders of its pieces from 0 to ``n_ids``, ``position_resets`` the places where
    positions start again at 0; ``doc_ids``, ``pieces`` and ``starts`` name the piece in
    each segment and its place in the document's ids.
    """
    if capacity > 65_535:
        raise ValueError("capacity is kept in 16 bits")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer)
        if encoder.tokenizer.get_vocab_size() > 65_536:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        sequence = TaskContext.get().partitionId() << 36
        end = np.array([end_id], dtype="<u4").tobytes()
        held: list[tuple[int, int, int, bytes]] = []

        def flush(last: bool) -> pa.RecordBatch | None:
            nonlocal held, sequence
            lengths = [len(p[3]) // 2 for p in held]
            rows, again = [], []
            for items in best_fit_tree(lengths, capacity):
                used = sum(lengths[i] for i in items)
                if not last and used < KEPT_OPEN * capacity:
                    again += [held[i] for i in items]
                    continue
                borders = [0, *np.cumsum([lengths[i] for i in items]).tolist()]
                docs_, pieces_, starts_ = zip(*(held[i][:3] for i in items), strict=True)
                ids = b"".join(held[i][3] for i in items)
                rows.append((sequence, ids, used, borders, borders[:-1], docs_, pieces_, starts_))
                sequence += 1
            # A window in which nothing fills would never shrink.
            if not last and len(again) > window // 2:
                held = again
                return flush(True)
            held = again
            if not rows:
                return None
            kinds = [pa.int64(), pa.binary(), pa.int32(), *[pa.list_(pa.int32())] * 2]
            kinds += [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            names = [part.split()[0] for part in SCHEMA.split(", ")]
            columns = zip(zip(*rows, strict=True), kinds, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names=names)

        with encoder:
            for batch in batches:
                doc_ids = batch.column(0).to_pylist()
                for begin, texts in tokens.text_batches(batch.column(1).to_pylist()):
                    for k, ids in enumerate(encoder.encode(texts)):
                        narrow = np.frombuffer(ids + end, dtype="<u4").astype("<u2").tobytes()
                        for piece, (a, b) in enumerate(piece_bounds(len(narrow) // 2, capacity)):
                            held.append((doc_ids[begin + k], piece, a, narrow[2 * a : 2 * b]))
                            if len(held) >= window and (out := flush(False)) is not None:
                                yield out
        if held and (out := flush(True)) is not None:
            yield out

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, SCHEMA)


def write_packed(packed: DataFrame, path: str, capacity: int = CAPACITY, pad_id: int = 0, rows: int = 512) -> None:
    """Write matrices of up to ``rows`` sequences each as Parquet rows under ``path``.

    A row has ``ids`` and ``positions`` (n_rows x capacity, unsigned 16 bits, row by row,
    padded with ``pad_id`` and 0), and per sequence its id, cumulative segment lengths and
    position resets.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows).to_pydict()
                n = len(part["ids"])
                ids = np.full((n, capacity), pad_id, dtype="<u2")
                positions = np.zeros((n, capacity), dtype="<u2")
                for k, borders in enumerate(part["cu_seqlens"]):
                    ids[k, : borders[-1]] = np.frombuffer(part["ids"][k], dtype="<u2")
                    for a, b in zip(borders[:-1], borders[1:], strict=True):
                        positions[k, a:b] = np.arange(b - a)
                yield pa.RecordBatch.from_pydict(
                    {
                        "n_rows": pa.array([n], pa.int32()),
                        "ids": pa.array([ids.tobytes()], pa.binary()),
                        "positions": pa.array([positions.tobytes()], pa.binary()),
                        "sequence_ids": pa.array([part["sequence_id"]], pa.list_(pa.int64())),
                        "cu_seqlens": pa.array([part["cu_seqlens"]], pa.list_(pa.list_(pa.int32()))),
                        "position_resets": pa.array([part["position_resets"]], pa.list_(pa.list_(pa.int32()))),
                    }
                )

    schema = (
        "n_rows int, ids binary, positions binary, sequence_ids array<long>, "
        "cu_seqlens array<array<int>>, position_resets array<array<int>>"
    )
    packed.mapInArrow(build, schema).write.mode("overwrite").parquet(path)
