"""Packing documents into windows of equal length by the sum-of-squares rule.

A document goes online, as it comes, into the window fill level that keeps the sum of squared
counts of partly filled windows smallest.  Each task packs the documents it reads with its own
array of levels, so nothing is shuffled and no group meets in one place.
"""

from __future__ import annotations

import os
import unicodedata
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW, END_ID = 2048, 1

#: Above this many partly filled windows in a task they are topped up by cutting documents.
MOST_OPEN = 4096

#: Bytes of ids in a batch that leaves a task, and words whose ids a task remembers.
BATCH_BYTES, MOST_WORDS = 4 << 20, 300_000

#: New words that go through the tokenizer at once: what it keeps of a word takes far more than its ids.
AT_ONCE = 4000

#: ASCII characters that are neither letters, digits, white space nor apostrophe.
PUNCTUATION = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'


def ends_in_letter(word: bytes) -> bool:
    """Whether the last character stays a letter when normalised and lower-cased."""
    if word[-1] < 128:
        return word[-1:].isalpha()
    return unicodedata.normalize("NFC", word.decode()[-1]).lower().isalpha()


class WordEncoder:
    """Encodes texts word by word and remembers the ids of words.

    Right for tokenizers that lower-case, drop white space, never join pieces across it, part
    letters from the punctuation behind them and mark the last piece of a word with ``</w>``:
    the ids of a text are then those of its words in turn, and those of a word end where the
    letters end.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.end = np.array([end_id], "<u4").tobytes()
        self.ids: dict[bytes, bytes] = {}

    def __call__(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of each text and the end id, as little-endian unsigned 32-bit numbers."""
        if len(self.ids) > MOST_WORDS:
            self.ids.clear()
        # A special token is known by its case, so a text that may hold one keeps it.
        split = [(text if b"<|" in text else text.lower()).split() for text in texts]
        self.learn(set(chain.from_iterable(split)).difference(self.ids))
        for words in split:
            yield b"".join([*map(self.ids.__getitem__, words), self.end])

    def learn(self, words: set[bytes]) -> None:
        ended, parts = [], set()
        for word in words:
            if word[-1] in PUNCTUATION and b"<|" not in word:
                letters = word.rstrip(PUNCTUATION)
                if letters and ends_in_letter(letters):
                    ended.append((word, letters, word[len(letters) :]))
                    parts.update(ended[-1][1:])
                    continue
            parts.add(word)
        new = [part.decode() for part in parts.difference(self.ids)]
        for begin in range(0, len(new), AT_ONCE):
            self.encode(new[begin : begin + AT_ONCE])
        for word, letters, rest in ended:
            self.ids[word] = self.ids[letters] + self.ids[rest]

    def encode(self, parts: list[str]) -> None:
        """Words of letters go through the tokenizer as one text, others each by itself."""
        plain, others = [], []
        for part in parts:
            (plain if part.isalpha() else others).append(part)
        (found,) = self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) == len(plain):
            data, begin = ids.tobytes(), 0
            for part, end in zip(plain, (4 * ends).tolist(), strict=True):
                self.ids[part.encode()] = data[begin:end]
                begin = end
        else:  # lower-casing made something else of a letter
            self.encode_each(plain)
        self.encode_each(others)

    def encode_each(self, parts: list[str]) -> None:
        for part, found in zip(parts, self.tokenizer.encode_batch_fast(parts, add_special_tokens=False), strict=True):
            self.ids[part.encode()] = np.array(found.ids, "<u4").tobytes()


class Piece:
    """Ids ``start`` and following of a document."""

    __slots__ = ("doc_id", "start", "ids", "doc_tokens")

    def __init__(self, doc_id, start: int, ids: bytes, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def __len__(self) -> int:
        return len(self.ids) // 4

    def part(self, begin: int, end: int | None = None) -> Piece:
        ids = self.ids[4 * begin : None if end is None else 4 * end]
        return Piece(self.doc_id, self.start + begin, ids, self.doc_tokens)


class LevelPacker:
    """Partly filled windows by fill level; full ones are given out as lists of pieces."""

    def __init__(self, window: int, most_open: int = MOST_OPEN):
        self.window, self.most_open = window, most_open
        self.counts = np.zeros(window + 1, np.int64)  # the level array
        self.at: list[list[list[Piece]]] = [[] for _ in range(window)]

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        whole = len(piece) // self.window * self.window
        for begin in range(0, whole, self.window):
            yield [piece.part(begin, begin + self.window)]
        if whole == len(piece):
            return
        piece = piece.part(whole)
        level = self.best_level(len(piece))
        pieces = self.at[level].pop() if level else []
        self.counts[level] -= level > 0
        pieces.append(piece)
        level += len(piece)
        if level == self.window:
            yield pieces
            return
        self.at[level].append(pieces)
        self.counts[level] += 1
        if self.counts.sum() > self.most_open:
            yield from self.top_up(keep_last=True)

    def best_level(self, size: int) -> int:
        """The level whose use raises the sum of squares least; 0 opens a window.

        Half the change of the sum is counts[h + size] - counts[h] + 1; a window that becomes
        full leaves the sum, one that opens only enters it.
        """
        counts = self.counts
        change = 2 * (counts[size:] - counts[: self.window + 1 - size]) + 2
        change[0] = 2 * counts[size] + 1
        change[-1] = 1 - 2 * counts[self.window - size]
        open_levels = counts[: self.window + 1 - size] > 0
        open_levels[0] = True
        return int(np.where(open_levels, change, np.iinfo(np.int64).max).argmin())

    def top_up(self, keep_last: bool) -> Iterator[list[Piece]]:
        """Fill the fullest open windows with documents of the emptiest, cut where need be."""
        waiting = deque(pieces for level in reversed(self.at) for pieces in level)
        self.at = [[] for _ in range(self.window)]
        self.counts[:] = 0
        while waiting:
            pieces = waiting.popleft()
            room = self.window - sum(map(len, pieces))
            while room and waiting:
                piece = waiting[-1].pop()
                if len(piece) > room:
                    waiting[-1].append(piece.part(room))
                    piece = piece.part(0, room)
                if not waiting[-1]:
                    waiting.pop()
                pieces.append(piece)
                room -= len(piece)
            if room and keep_last:
                self.at[self.window - room].append(pieces)
                self.counts[self.window - room] += 1
            else:
                yield pieces


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    most_open: int = MOST_OPEN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A document is the ids of its text by the tokenizer file plus ``end_id``; a null text is
    empty.  ``ids`` are little-endian unsigned 32-bit numbers.  Documents longer than a window
    fill whole windows and their rest is placed; in the end a task cuts documents to fill its
    open windows, so it leaves at most one window that is not full.  The pieces of a sequence
    follow each other from offset 0.  Every row is a document of its own, also with a repeated
    or null id; an empty table gives no pieces, other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, start long, ids binary, doc_tokens long, sequence_id long, offset long"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = WordEncoder(tokenizer, end_id), LevelPacker(window, most_open)
        columns = [[] for _ in range(6)]
        sequence, pending = TaskContext.get().partitionId() << 40, 0
        arrow_id = pa.int64()

        def batch() -> pa.RecordBatch:
            types = [arrow_id, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            for column in columns:
                column.clear()
            names = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays(arrays, names)

        def put(pieces: list[Piece]) -> None:
            nonlocal sequence, pending
            offset = 0
            for piece in pieces:
                row = (piece.doc_id, piece.start, piece.ids, piece.doc_tokens, sequence, offset)
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
                offset += len(piece)
                pending += len(piece.ids)
            sequence += 1

        for given in batches:
            arrow_id = given.column(0).type
            for start in range(0, given.num_rows, 500):
                part = given.slice(start, 500)
                texts = [text or b"" for text in pc.cast(part.column(1), pa.binary()).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(texts), strict=True):
                    for pieces in packer.add(Piece(doc_id, 0, ids, len(ids) // 4)):
                        put(pieces)
                    if pending >= BATCH_BYTES:
                        yield batch()
                        pending = 0
        for pieces in packer.top_up(keep_last=False):
            put(pieces)
            if pending >= BATCH_BYTES:
                yield batch()
                pending = 0
        if columns[0]:
            yield batch()

    return docs.select(id_col, text_col).mapInArrow(packed, schema)
