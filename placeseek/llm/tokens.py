"""Token ids of whole texts, with a bounded cache of short pieces.

A byte-level BPE never merges across the borders that its splitting pattern draws, and a
single blank between two non-blanks is always such a border. Texts are therefore cut at
blanks and line ends, and each distinct piece is encoded once per task; a batch looks up its
distinct pieces only and puts the ids of all its texts together in one step. Texts with other
white space (runs, tabs, leading or trailing blanks) or with the string of a marker token are
encoded whole by the tokenizer. The pattern keeps a run of letters together, so a new piece of Latin
letters alone goes straight to the tokenizer's merges.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARKS = '.,;:!?#$%&*()"|-'
CACHE_ENTRIES = 800_000
# Letters below are letters in every version of Unicode that the pattern may know.
LATIN_END = "\u0250"


def byte_alphabet() -> dict[int, str]:
    """The character by which a byte-level tokenizer writes each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTES = byte_alphabet()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Runs:
    """Runs of ids by number; number 0 is the empty run."""

    def __init__(self) -> None:
        self.ids = np.empty(1 << 12, dtype="<u4")
        self.borders = np.zeros(1 << 10, dtype=np.int64)
        self.count = 1

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> range:
        """Numbers of the runs that lie behind each other in ``ids``."""
        first, last = self.count, self.count + len(lengths)
        used = int(self.borders[first])
        if used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:used], np.empty(used + 2 * len(ids), dtype="<u4")])
        if last >= len(self.borders):
            self.borders = np.concatenate([self.borders[: first + 1], np.zeros(2 * last, dtype=np.int64)])
        self.ids[used : used + len(ids)] = ids
        self.borders[first + 1 : last + 1] = used + np.cumsum(lengths)
        self.count = last
        return range(first, last)

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these runs behind each other, and the length of each run."""
        begins = self.borders[numbers]
        lengths = self.borders[numbers + 1] - begins
        ends = np.cumsum(lengths)
        at = np.repeat(begins - ends + lengths, lengths)
        at += np.arange(len(at))
        return self.ids[at], lengths


class Encoder:
    """Texts to little-endian unsigned 32-bit ids; use one per worker process."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.markers = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.entries = cache_entries
        self.newline = np.frombuffer(self.whole("\n"), dtype="<u4")
        cutter = self.tokenizer.pre_tokenizer
        cutting = json.loads(cutter.__getstate__()) if cutter else {}
        self.direct = (
            self.tokenizer.normalizer is None and cutting.get("type") == "ByteLevel"
            and cutting.get("use_regex", True) and not cutting["add_prefix_space"]
        )
        self.forget()

    def __enter__(self) -> Encoder:
        return self

    def __exit__(self, *error) -> None:
        # An idle worker would keep pieces and batches while other stages need the memory.
        self.forget()
        pa.default_memory_pool().release_unused()

    def forget(self) -> None:
        """Drop all pieces."""
        self.runs = Runs()
        # Runs of pieces behind a blank, and of line ends with the piece behind them; -1: not by pieces.
        self.numbers: dict[str, int] = {}
        self.tails: dict[str, int] = {}
        self.line_end = self.runs.add(self.newline, np.array([len(self.newline)]))[0]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _encode_pieces(self, pieces: Sequence[str], lead: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces without white space inside, encoded in one text, a line each; and their lengths."""
        ids, lengths = [np.empty(0, dtype="<u4")], [np.empty(0, dtype=np.int64)]
        for at in range(0, len(pieces), 4096):
            text = lead + ("\n" + lead).join(pieces[at : at + 4096])
            found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
            ends = found == self.newline[0]
            ids.append(found[~ends])
            lengths.append(np.diff(np.flatnonzero(np.r_[True, ends, True])) - 1)
        return np.concatenate(ids), np.concatenate(lengths)

    def _encode_words(self, words: Sequence[str], lead: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of Latin letters alone, each of which the pattern leaves in one part; and their lengths."""
        merged = self.tokenizer.model.tokenize
        lead = lead.translate(BYTES)
        ids: list[int] = []
        lengths: list[int] = []
        for word in words:
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(BYTES)
            own = [token.id for token in merged(lead + shown)]
            ids += own
            lengths.append(len(own))
        return np.array(ids, dtype="<u4"), np.array(lengths, dtype=np.int64)

    def _pairs(self, first: Sequence[int], second: Sequence[int]) -> range:
        """Numbers of new runs, each of two known ones."""
        ids, lengths = self.runs.joined(np.column_stack([first, second]).astype(np.int64).ravel())
        return self.runs.add(ids, lengths.reshape(-1, 2).sum(axis=1))

    def _latin(self, letters: str) -> bool:
        return self.direct and (letters.isascii() or max(letters) < LATIN_END)

    def _learn(self, missing: list[str], head: str, lead: str) -> None:
        """Number new pieces; marks behind a word are encoded apart, as the pattern parts them too.

        Their names begin with ``head``. Pieces that are empty or hold white space have no ids of their own:
        their text is encoded whole.
        """
        plain, parted, stems, tails = [], [], [], []
        numbers, fresh = self.numbers, set(missing)
        words = [p for p in missing if p.isalpha() and self._latin(p)]

        def sort(piece: str) -> None:
            (words if piece.isalpha() and self._latin(piece) else plain).append(piece)

        for piece in fresh.difference(words):
            stem = piece.rstrip(MARKS)
            if not piece or piece.split() != [piece]:
                numbers[head + piece] = -1
            elif stem and len(stem) < len(piece) and stem[-1].isalnum():
                parted.append(head + piece)
                stems.append(head + stem)
                tails.append(piece[len(stem) :])
                if stem not in fresh and head + stem not in numbers:
                    fresh.add(stem)
                    sort(stem)
            else:
                plain.append(piece)
        for pieces, made in ((words, self._encode_words(words, lead)), (plain, self._encode_pieces(plain, lead))):
            found = self.runs.add(*made)
            if head:
                found = self._pairs([self.line_end] * len(found), found)
            numbers.update(zip([head + p for p in pieces] if head else pieces, found, strict=True))
        new = list(set(tails).difference(self.tails))
        self.tails.update(zip(new, self.runs.add(*self._encode_pieces(new, "")), strict=True))
        ends = self._pairs([numbers[s] for s in stems], [self.tails[t] for t in tails])
        numbers.update(zip(parted, ends, strict=True))

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text as bytes; null is the empty text."""
        if len(self.numbers) + len(self.tails) > self.entries:
            self.forget()
        out = [b""] * len(texts)
        cut: list[int] = []
        for k, text in enumerate(texts):
            if text and any(marker in text for marker in self.markers):
                out[k] = self.whole(text)
            elif text:
                cut.append(k)
        if not cut:
            return out
        # A line end goes with the piece behind it, and one stands before each text.
        lines = pa.array(["\n" + texts[k].replace("\n", " \n") for k in cut], pa.large_string())
        parts = pc.split_pattern(lines, " ")
        distinct = parts.flatten().dictionary_encode()
        pieces = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        missing = [p for p in pieces if p not in self.numbers]
        self._learn([p for p in missing if p[:1] != "\n"], "", " ")
        self._learn([p[1:] for p in missing if p[:1] == "\n"], "\n", "")
        numbers = np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces))[distinct.indices.to_numpy()]
        places = parts.offsets.to_numpy()
        apart = np.unique(np.searchsorted(places, np.flatnonzero(numbers < 0), side="right") - 1)
        ids, lengths = self.runs.joined(np.maximum(numbers, 0))
        data = ids.tobytes()
        ends = (4 * np.r_[0, np.cumsum(lengths)][places]).tolist()
        for k, begin, end in zip(cut, ends[:-1], ends[1:], strict=True):
            out[k] = data[begin + self.newline.nbytes : end]
        for k in apart.tolist():
            out[cut[k]] = self.whole(texts[cut[k]])
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def text_batches(values: Sequence[str | None], chars: int = 2_000_000):
    """Slices of ``values`` of about ``chars`` characters, so that memory stays bounded."""
    begin, size = 0, 0
    for k, value in enumerate(values):
        size += len(value or "") + 1
        if size >= chars:
            yield begin, values[begin : k + 1]
            begin, size = k + 1, 0
    if begin < len(values):
        yield begin, values[begin:]
