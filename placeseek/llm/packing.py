"""Packing of documents into sequences by best fit and swap-based local search.

Every document becomes token ids and an end id. Documents longer than a sequence are cut
into full pieces, the first of which may be shorter, so that one piece per document at most
is not full. Full pieces are sequences of their own. The others are dealt evenly into
groups of bounded size; each group is packed best-fit-decreasing and then improved: pieces
move or are exchanged one for one, two for one or one for two between underfull bins,
whenever this makes the sum of squared fills grow, until bins empty. Bins that stay badly
filled are opened again and packed together with those of other groups, in ever fewer
groups. Nothing but one bounded group is ever in one task.

Null or empty text is the end id alone. Repeated rows are packed as rows of their own; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeseek.llm import tokens
from placeseek.session import stored

CAPACITY = 1024
END_ID = 2
GROUP_PIECES = 16_384
# Bins with less than this share filled are opened again in the next round.
SETTLED = 0.98

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long"
PLACED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"


def piece_bounds(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a document; only the first may be below capacity."""
    first = length % capacity or capacity
    if length <= capacity:
        return [(0, length)]
    return [(0, first)] + [(at, at + capacity) for at in range(first, length, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, uid) of every document."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer)
        uid = TaskContext.get().partitionId() << 36
        with encoder:
            for batch in batches:
                doc_ids = batch.column(0).to_pylist()
                for begin, texts in tokens.text_batches(batch.column(1).to_pylist()):
                    rows = []
                    for k, ids in enumerate(encoder.encode(texts)):
                        ids += end
                        for piece, (a, b) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                            crc = zlib.crc32(ids[4 * a : 4 * b])
                            rows.append((doc_ids[begin + k], piece, a, b - a, crc, uid))
                            uid += 1
                    columns = list(zip(*rows, strict=True))
                    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                    names = ["doc_id", "piece", "start", "length", "ids_crc32", "uid"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
                    )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE_SCHEMA)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of positions, best-fit-decreasing; open bins are found by their free room."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while some bin has r free
    bins: list[list[int]] = []
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[chosen].append(item)
        else:
            chosen, room = len(bins), capacity
            bins.append([item])
        left = room - size
        by_room[left].append(chosen)
        rooms |= 1 << left
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int, rounds: int = 4) -> list[list[int]]:
    """Empty bins by moves and exchanges that increase the sum of squared fills.

    The emptiest bin is the giver. Each of its pieces goes into a fuller bin: alone, for one
    smaller piece, for two smaller ones, or together with another piece for one. A giver
    without any such step is set aside. Ends when the bins are as few as the total allows,
    or after ``rounds`` passes over all givers.
    """
    fill = np.array([int(lengths[b].sum()) for b in bins], dtype=np.int64)
    home = np.empty(len(lengths), dtype=np.int64)
    for k, b in enumerate(bins):
        home[b] = k
    least = -(-int(lengths.sum()) // capacity)
    sets = [set(b) for b in bins]
    alive = len(bins)

    def put(item: int, to: int) -> None:
        sets[home[item]].discard(item)
        fill[home[item]] -= lengths[item]
        sets[to].add(item)
        fill[to] += lengths[item]
        home[item] = to

    def step(giver: int) -> bool:
        # Only underfull bins that are at least as full take part, so squares grow.
        usable = (fill < capacity) & (fill >= fill[giver])
        usable[giver] = False
        room = np.where(usable, capacity - fill, 0)
        own = sorted(sets[giver], key=lambda i: -lengths[i])
        if not room.any():
            return False
        for item in own:
            fits = np.flatnonzero(room >= lengths[item])
            if len(fits):
                put(item, int(fits[np.argmin(room[fits])]))
                return True
        others = np.flatnonzero(room[home] > 0)
        gain_room = room[home[others]]
        for item in own:
            gain = lengths[item] - lengths[others]
            ok = np.flatnonzero((gain > 0) & (gain <= gain_room))
            if len(ok):
                other = int(others[ok[np.argmax(gain[ok])]])
                to = int(home[other])
                put(other, giver)
                put(item, to)
                return True
        for a, item in enumerate(own[:32]):
            for second in own[a + 1 : 32]:
                gain = lengths[item] + lengths[second] - lengths[others]
                ok = np.flatnonzero((gain > 0) & (gain <= gain_room))
                if len(ok):
                    other = int(others[ok[np.argmax(gain[ok])]])
                    to = int(home[other])
                    put(other, giver)
                    put(item, to)
                    put(second, to)
                    return True
        for item in own[:8]:
            for to in np.flatnonzero(room > 0)[:64].tolist():
                inside = sorted(sets[to], key=lambda i: lengths[i])[:8]
                for a, one in enumerate(inside):
                    for two in inside[a + 1 :]:
                        gain = lengths[item] - lengths[one] - lengths[two]
                        if 0 < gain <= room[to]:
                            put(one, giver)
                            put(two, giver)
                            put(item, to)
                            return True
        return False

    for _ in range(rounds):
        if alive <= least:
            break
        changed = False
        for giver in np.argsort(fill, kind="stable")[: 4 * (alive - least) + 8].tolist():
            if not sets[giver]:
                continue
            for _step in range(4 * capacity):
                if not sets[giver] or not step(giver):
                    break
                changed = True
            if not sets[giver]:
                fill[giver] = 0
                alive -= 1
                if alive <= least:
                    break
        if not changed:
            break
        # Emptied bins stay empty: mark them as full.
        fill[[k for k, s in enumerate(sets) if not s]] = capacity
    return [sorted(s, key=lambda i: (-lengths[i], i)) for s in sets if s]


def pack_group(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, fill of the bin) of each length."""
    bins = improve(best_fit(lengths, capacity), lengths, capacity)
    where, offset, fill = (np.zeros(len(lengths), dtype=np.int64) for _ in range(3))
    for k, items in enumerate(bins):
        ends = np.cumsum(lengths[items])
        where[items] = k
        offset[items] = ends - lengths[items]
        fill[items] = ends[-1]
    return where, offset, fill


def _placing(first: int, capacity: int):
    """Packs one group; sequence ids start at those of group ``first``."""

    def place(key, rows):
        rows = rows.sort_values(["length", "uid"], ascending=[False, True], kind="stable")
        where, offset, fill = pack_group(rows["length"].to_numpy(), capacity)
        return rows.drop(columns="_group").assign(
            sequence_id=((first + int(key[0])) << 24) + where, offset=offset, fill=fill
        )

    return place


def pack(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Place every row of :func:`pieces` (stored rows: they are read more than once)."""
    full = cut.filter(F.col("length") >= capacity).select(
        "*", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = cut.filter(F.col("length") < capacity)
    placed: list[DataFrame] = [full]
    taken = 0
    while True:
        count = rest.count()
        if not count:
            break
        groups = -(-count // group_pieces)
        dealt = rest.withColumn("_group", F.pmod(F.xxhash64("uid"), F.lit(groups)))
        done = stored(
            dealt.groupBy("_group").applyInPandas(_placing(taken, capacity), PLACED_SCHEMA + ", fill long"), "packed"
        )
        taken += groups
        if groups == 1:
            placed.append(done.drop("fill"))
            break
        settled = F.col("fill") >= int(SETTLED * capacity)
        placed.append(done.filter(settled).drop("fill"))
        again = done.filter(~settled).select(*cut.columns)
        left = again.count()
        if left == count:  # nothing settles at this size: keep what there is
            placed.append(done.filter(~settled).drop("fill"))
            break
        rest = again
    out = placed[0]
    for df in placed[1:]:
        out = out.unionByName(df)
    return out


def packed(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    cut = stored(pieces(docs, tokenizer, capacity, end_id), "pieces")
    return pack(cut, capacity).drop("uid")
