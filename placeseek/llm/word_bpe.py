"""Encoding and decoding with a byte pair vocabulary of words, in batched merge rounds.

A text is cut at the marker tokens, put into composed form and lower case, and split into
runs of letters, single digits, runs of marks and a few English endings. Each distinct piece
of a batch is encoded once: the symbols of all pieces lie in one flat array, and every round
looks all neighbouring pairs up by binary search over the sorted keys of the merge table,
takes the lowest rank of each piece, and merges all its pairs of that rank at once. Pieces
that have no pair left leave the array. Pieces above ``LONG`` symbols, which would need too
many rounds, are merged one pair at a time from a heap, with the same result.

Decoding looks the ids up and joins their tokens by one blank, as a vocabulary without a
decoder asks for; ids outside the vocabulary are left out.

Null and empty texts have no ids and decode to the empty text. Texts of any length are
encoded whole. Rows with a null or repeated doc_id give a row each; an empty table gives
none; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeseek.llm.tokens import text_batches

LONG = 512
CACHED = 400_000
NO_RANK = np.int64(1) << 40

# White space of Unicode, the endings that are pieces of their own.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"

PIECE_ASCII = re.compile(rf"{ENDINGS}|[a-z]+|[0-9]|[^\t\n\x0b\x0c\r a-z0-9]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


PIECE = regex.compile(rf"{ENDINGS}|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")


def ranges(letters: Sequence[str]) -> str:
    """A character class body that holds exactly ``letters``."""
    codes = np.array(sorted(map(ord, letters)))
    parts = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1)
    return "".join(f"\\U{p[0]:08x}-\\U{p[-1]:08x}" for p in parts if len(p))


def late_letters() -> tuple[list[str], dict[str, str]]:
    """Code points that the pattern library or Python know by a later or earlier standard.

    (letters and digits of the pattern library that are none in the vocabulary's library,
    lower case forms that only the latter has). Tables differ in code points without a
    category in Python's own.
    """
    from tokenizers import Regex, normalizers, pre_tokenizers

    unknown = "".join(
        c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn"
    )
    split = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]+"), "removed", invert=True)
    theirs = set("".join(part for part, _ in split.pre_tokenize_str(unknown)))
    ours = "".join(regex.findall(r"[\p{L}\p{N}]+", unknown))
    # All forms of such letters have one code point.
    forms = zip(unknown, normalizers.Lowercase().normalize_str(unknown), strict=True)
    return [c for c in ours if c not in theirs], {c: form for c, form in forms if form != c}


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else one above U+0100."""
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printing else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Vocabulary and merge table of one file; use one per worker process."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model = stored["model"]
        vocabulary: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        self.markers: dict[str, int] = {t["content"]: t["id"] for t in stored["added_tokens"]}
        # The marker that begins first is taken; of several at one place, the longest.
        marks = sorted(self.markers, key=len, reverse=True)
        self.marker = re.compile("|".join(map(re.escape, marks))) if marks else None
        self.names: dict[int, str] = {i: t for t, i in (vocabulary | self.markers).items()}
        letters = byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], dtype=np.int64)
        self.last = np.array([vocabulary[c + end] for c in letters], dtype=np.int64)
        self.base = max(self.names) + 1
        merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            merges[vocabulary[left] * self.base + vocabulary[right]] = (rank, vocabulary[left + right])
        self.keys = np.array(sorted(merges), dtype=np.int64)
        self.ranks = np.array([merges[k][0] for k in self.keys.tolist()], dtype=np.int64)
        self.joined = np.array([merges[k][1] for k in self.keys.tolist()], dtype=np.int64)
        self._check_order()
        self.known: dict[str, bytes] = {}
        marks, forms = late_letters()
        body = ranges(marks)
        self.late = frozenset(marks) | forms.keys()
        self.forms = str.maketrans(forms)
        self.late_piece = regex.compile(
            rf"{ENDINGS}|(?:(?![{body}])\p{{L}})+|(?![{body}])\p{{N}}|(?:[^{WHITE}\p{{L}}\p{{N}}]|[{body}])+"
        ) if marks else PIECE

    def _check_order(self) -> None:
        """Merging all pairs of one rank at once is right if no part is made after its use."""
        made = np.full(self.base, -1, dtype=np.int64)
        np.maximum.at(made, self.joined, self.ranks)
        if (np.maximum(made[self.keys // self.base], made[self.keys % self.base]) >= self.ranks).any():
            raise ValueError("merges are not in the order of their making")

    # -- pieces ----------------------------------------------------------------------

    def pieces(self, text: str) -> list[str]:
        if text.isascii():
            return PIECE_ASCII.findall(text.lower())
        # Letter by letter, a capital sigma has one lower form wherever it stands.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if self.late.isdisjoint(text):
            return PIECE.findall(text)
        return self.late_piece.findall(text.translate(self.forms))

    def cut(self, text: str) -> list[str | int]:
        """Pieces of a text, and the ids of markers between them."""
        if self.marker is None or "<" not in text and not self.marker.search(text):
            return self.pieces(text)
        out: list[str | int] = []
        at = 0
        for found in self.marker.finditer(text):
            out += self.pieces(text[at : found.start()])
            out.append(self.markers[found.group()])
            at = found.end()
        return out + self.pieces(text[at:])

    # -- merging ---------------------------------------------------------------------

    def symbols(self, piece: bytes) -> np.ndarray:
        values = np.frombuffer(piece, dtype=np.uint8)
        out = self.inner[values]
        out[-1] = self.last[values[-1]]
        return out

    def found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, place in the merge table) of pairs; ``NO_RANK`` where they do not merge."""
        wanted = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK), at

    def rounds(self, pieces: Sequence[bytes]) -> list[np.ndarray]:
        """Ids of each piece, all merged together."""
        if not pieces:
            return []
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        values = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        symbol = self.inner[values]
        final = np.cumsum(lengths) - 1
        symbol[final] = self.last[values[final]]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        done_symbol, done_owner = [], []
        while len(symbol):
            # The last symbol of a piece pairs with none.
            inside = np.r_[owner[1:] == owner[:-1], False]
            rank, at = self.found(symbol, np.r_[symbol[1:], 0])
            rank[~inside] = NO_RANK
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, starts)
            least = np.repeat(best, np.diff(np.r_[starts, len(owner)]))
            over = least == NO_RANK
            done_symbol.append(symbol[over])
            done_owner.append(owner[over])
            merging = (rank == least) & ~over
            # Of pairs that overlap (a a a) the first, third, ... are merged.
            place = np.arange(len(merging))
            begins = merging & ~np.r_[False, merging[:-1]]
            run = np.maximum.accumulate(np.where(begins, place, 0))
            merging &= (place - run) % 2 == 0
            symbol = np.where(merging, self.joined[at], symbol)
            kept = ~over & ~np.r_[False, merging[:-1]]
            symbol, owner = symbol[kept], owner[kept]
        symbol, owner = np.concatenate(done_symbol), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        borders = np.searchsorted(owner[order], np.arange(1, len(pieces)))
        return np.split(symbol[order].astype("<i4"), borders)

    def one_by_one(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece: the lowest pair first, the leftmost of equal ones."""
        symbol = self.symbols(piece)
        after = list(range(1, len(symbol) + 1))
        before = list(range(-1, len(symbol) - 1))
        rank, at = self.found(symbol[:-1], symbol[1:])
        heap = [
            (r, k, a) for k, (r, a) in enumerate(zip(rank.tolist(), at.tolist(), strict=True)) if r != NO_RANK
        ]
        heapq.heapify(heap)
        symbols = symbol.tolist()
        pairs = {k: (r, j) for k, r, j in zip(self.keys.tolist(), self.ranks.tolist(), range(len(self.keys)), strict=True)}
        keys, joined = self.keys, self.joined
        while heap:
            _, k, a = heapq.heappop(heap)
            n = after[k]
            if symbols[k] < 0 or n >= len(symbols) or symbols[k] * self.base + symbols[n] != keys[a]:
                continue
            symbols[k] = int(joined[a])
            symbols[n] = -1
            after[k] = after[n]
            if after[n] < len(symbols):
                before[after[n]] = k
            for left, right in ((before[k], k), (k, after[k])):
                if left >= 0 and right < len(symbols):
                    pair = pairs.get(symbols[left] * self.base + symbols[right])
                    if pair:
                        heapq.heappush(heap, (pair[0], left, pair[1]))
        return np.array([s for s in symbols if s >= 0], dtype="<i4")

    # -- texts -----------------------------------------------------------------------

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text; null is the empty text."""
        cut = [self.cut(text) if text else [] for text in texts]
        if len(self.known) > CACHED:
            self.known.clear()
        distinct = set().union(*cut).difference(self.known)
        new = [p for p in distinct if isinstance(p, str)]
        data = [p.encode("utf-8", "surrogatepass") for p in new]
        short = [k for k, p in enumerate(data) if len(p) <= LONG]
        for k, ids in zip(short, self.rounds([data[k] for k in short]), strict=True):
            self.known[new[k]] = ids.tobytes()
        for k, piece in enumerate(data):
            if len(piece) > LONG:
                self.known[new[k]] = self.one_by_one(piece).tobytes()
        look_up = self.known.__getitem__
        out = []
        for parts in cut:
            try:
                ids = b"".join(map(look_up, parts))
            except KeyError:  # markers stand for themselves
                ids = b"".join(look_up(p) if isinstance(p, str) else np.int32(p).tobytes() for p in parts)
            out.append(np.frombuffer(ids, dtype="<i4"))
        return out

    def decode(self, ids: Sequence[int]) -> str:
        names = self.names
        try:
            return " ".join([names[i] for i in ids])
        except KeyError:
            return " ".join([names[i] for i in ids if i in names])


_models: dict[str, WordBpe] = {}


def model(path: str) -> WordBpe:
    """The vocabulary of this worker process."""
    if path not in _models:
        _models[path] = WordBpe(path)
    return _models[path]


def _lists(values: Sequence[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate(values) if values else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_batches(batch.column(1).to_pylist()):
                ids = batch.column(0).slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([ids, _lists(model(path).encode(texts))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` (doc_id, ids) with ``text``, what their ids stand for; null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            # In slices, as a token may be much longer than its id.
            for begin in range(0, batch.num_rows, 1024):
                part = ids.slice(begin, 1024)
                texts = [model(path).decode(x or ()) for x in part.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, 1024), part, pa.array(texts, pa.string())],
                    names=["doc_id", "ids", "text"],
                )

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
