"""Repeated passages: every run of a few consecutive sentences, hashed and joined globally.

A run that stands in several documents stays in the one with the smallest id; in the others,
and where it stands again in the same document, the sentences it covers go.  Long sentences are
also cut where their words say, so a passage is found wherever in a sentence it begins; of them
only the words that are covered go.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run has at least so many sentences and so many words.
SENTENCES, WORDS = 3, 12

#: A sentence is cut after so many words, so that text without stops has sentences too.
LONGEST = 16

#: For runs within such a sentence a second cut is after a word that its own hash picks, one in SEVERAL, and
#: after LONGEST words at the latest: equal passages are cut alike wherever they begin.  Runs of
#: this cut have at least as many words as three pieces of the first cut.
SEVERAL, CONTENT_WORDS = 5, 3 * LONGEST

SENTENCE = re.compile(rb"[^.!?\n]*+(?:[.!?]++(?!\s)[^.!?\n]*+)*+(?:[.!?]*+\s++)?")
SOME_WORDS = re.compile(rb"\s*(?:\S++(?:\s+|\Z)){1,%d}|\s+" % LONGEST)
WORD = re.compile(rb"\s*\S+\s*")

#: Odd factors of the two halves of a run's hash.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)
INVERSES = np.array([pow(int(f), -1, 1 << 64) for f in FACTORS], np.uint64)

#: Documents hashed together, at most, and bytes of text, on average of such a part.
TOGETHER, TOGETHER_BYTES = 500, 4 << 20

#: Words whose picks a task remembers.
MOST_WORDS = 600_000


def sentences(text: bytes) -> list[bytes]:
    """The sentences of a text in order, each with the white space behind it; joined they are
    the text."""
    return [piece for piece, _ in pieces(text, SOME_WORDS.findall)]


def pieces(text: bytes, cut: Callable[[bytes], Iterable[bytes]]) -> list[tuple[bytes, int]]:
    """The sentences of a text, long ones cut by ``cut``, and the number of the long one they
    are of (0: of none)."""
    out = []
    for number, part in enumerate(SENTENCE.findall(text), 1):
        if part.count(b" ") < LONGEST or len(part.split()) <= LONGEST:
            out.append((part, 0))
        else:
            out.extend((piece, number) for piece in cut(part))
    return out[:-1]  # the last match is empty


def cut_by_content(sentence: bytes) -> Iterator[bytes]:
    begin, words = 0, 0
    for word in WORD.finditer(sentence):
        words += 1
        if words == LONGEST or xxhash.xxh32_intdigest(word[0].strip().lower()) % SEVERAL == 0:
            yield sentence[begin : word.end()]
            begin, words = word.end(), 0
    if begin < len(sentence):
        yield sentence[begin:]


class Runs:
    """The shortest long enough runs from every sentence of some texts on.

    ``owner``: the text of each run; ``begin``, ``end``: its sentences, counted over all texts;
    ``hashes``: two 64-bit halves; ``again``: whether it stands earlier in the same text.  Case
    and white space do not count.  With ``content`` long sentences are cut by content, and only
    runs within one are kept.
    """

    def __init__(self, texts: list[bytes], least: int, words: int, content: bool = False):
        cut = [pieces(text, cut_by_content if content else SOME_WORDS.findall) for text in texts]
        self.parts = [[piece for piece, _ in of_text] for of_text in cut]
        said = [(part.lower().split(), number) for of_text in cut for part, number in of_text]
        self.find([len(parts) for parts in self.parts], said, least, words, content)

    @classmethod
    def hashed(cls, sizes: list[int], said: list[tuple[list[bytes], int]], least: int, words: int, content: bool) -> Runs:
        """Runs of texts of which only the words are at hand."""
        runs = cls.__new__(cls)
        runs.find(sizes, said, least, words, content)
        return runs

    def find(self, sizes: list[int], said: list[tuple[list[bytes], int]], least: int, words: int, content: bool) -> None:
        """``sizes``: sentences of each text; ``said``: the words of each and the number of the
        long sentence it is of."""
        counts = np.fromiter([len(w) for w, _ in said], np.int64, len(said))
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        owner = np.repeat(np.arange(len(sizes)), np.diff(self.first))
        digests = b"".join([xxhash.xxh3_128_digest(b" ".join(w)) for w, _ in said])
        hashes = np.frombuffer(digests, np.uint64).reshape(-1, 2) * (counts > 0)[:, None].astype(np.uint64)
        # A run ends once both its words and its sentences with words are enough.
        word_sum, filled = (np.concatenate([[0], np.cumsum(x)]) for x in (counts, counts > 0))
        end = np.maximum(np.searchsorted(word_sum, word_sum[:-1] + words), np.searchsorted(filled, filled[:-1] + least))
        runs = (end <= self.first[owner + 1]) & (counts > 0)
        if content:
            long = np.array([number for _, number in said], np.int64)
            runs[runs] = (long[runs] > 0) & (long[runs] == long[end[runs] - 1])
        starts = np.flatnonzero(runs)
        self.begin, self.end, self.owner = starts, end[starts], owner[starts]
        # Sentences without words add nothing and take no power, so they change no hash.
        power = np.concatenate([[0], np.cumsum(counts > 0)[:-1]]) if len(counts) else np.zeros(0, np.int64)
        self.hashes = np.empty((len(starts), 2), np.uint64)
        for half in range(2):
            up = powers(FACTORS[half], int(filled[-1]) + 1)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes[:, half] * up[power], dtype=np.uint64)])
            down = powers(INVERSES[half], int(filled[-1]) + 1)
            self.hashes[:, half] = (total[self.end] - total[self.begin]) * down[power[starts]]
        order = np.lexsort((self.begin, self.hashes[:, 1], self.hashes[:, 0], self.owner))
        same = (self.hashes[order][1:] == self.hashes[order][:-1]).all(1) & (np.diff(self.owner[order]) == 0)
        self.again = np.zeros(len(starts), bool)
        self.again[order[1:][same]] = True


class Picks(dict):
    """Whether a word ends a piece of the second cut, remembered."""

    def __missing__(self, word: bytes) -> bool:
        if len(self) > MOST_WORDS:
            self.clear()
        self[word] = picked = xxhash.xxh32_intdigest(word) % SEVERAL == 0
        return picked


def hashes_of_both_cuts(texts: list[bytes], least: int, words: int, picks: Picks) -> tuple[Runs, Runs]:
    """The runs of both cuts, of the second those within long sentences, from the words alone:
    every text is split once."""
    sizes, said = ([], []), ([], [])
    for text in texts:
        before = len(said[0]), len(said[1])
        for number, part in enumerate(SENTENCE.findall(text.lower()), 1):
            spoken = part.split()
            if len(spoken) <= LONGEST:
                said[0].append((spoken, 0))
                continue
            said[0].extend((spoken[k : k + LONGEST], number) for k in range(0, len(spoken), LONGEST))
            begin = 0
            for at, picked in enumerate(map(picks.__getitem__, spoken), 1):
                if picked or at - begin == LONGEST:
                    said[1].append((spoken[begin:at], number))
                    begin = at
            if begin < len(spoken):
                said[1].append((spoken[begin:], number))
        said[0].pop()  # the last match is empty
        for k in range(2):
            sizes[k].append(len(said[k]) - before[k])
    return (
        Runs.hashed(sizes[0], said[0], least, words, False),
        Runs.hashed(sizes[1], said[1], least, max(words, CONTENT_WORDS), True),
    )


def both_cuts(texts: list[bytes], least: int, words: int) -> tuple[Runs, Runs]:
    return Runs(texts, least, words), Runs(texts, least, max(words, CONTENT_WORDS), content=True)


def powers(factor: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, factor, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def together(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows, first and number, that are not too large; a larger text is one by itself."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        reach = ends[start] - sizes[start] + TOGETHER_BYTES
        end = max(start + 1, min(int(np.searchsorted(ends, reach, side="right")), start + TOGETHER))
        yield start, end - start
        start = end


def run_table(docs: DataFrame, least: int, words: int) -> DataFrame:
    """``h1``, ``h2``, ``doc_id``, ``again``: the distinct runs of every row, and whether it holds
    them more than once."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picks = Picks()
        for batch in batches:
            texts = pc.cast(batch.column(1), pa.binary())
            for start, count in together(pc.fill_null(pc.binary_length(texts), 0).to_numpy()):
                cuts = hashes_of_both_cuts([t or b"" for t in texts.slice(start, count).to_pylist()], least, words, picks)
                hashes = np.concatenate([runs.hashes for runs in cuts]).view(np.int64)
                owner, again = (np.concatenate([getattr(runs, name) for runs in cuts]) for name in ("owner", "again"))
                table = pa.table({"h1": hashes[:, 0], "h2": hashes[:, 1], "owner": owner, "again": again})
                distinct = table.group_by(["h1", "h2", "owner"]).aggregate([("again", "max")]).combine_chunks()
                ids = batch.column(0).slice(start, count).take(distinct.column("owner").combine_chunks())
                columns = [distinct.column("h1").combine_chunks(), distinct.column("h2").combine_chunks(), ids, distinct.column("again_max").combine_chunks()]
                yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "doc_id", "again"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(hashed, f"h1 long, h2 long, doc_id {id_type}, again boolean")


def repeated_runs(docs: DataFrame, least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``repeats_of``, ``runs`` for documents with runs that stand elsewhere first
    or stand in them twice."""
    found = run_table(docs, least, words)
    repeated = (
        found.where(F.col("doc_id").isNotNull())
        .groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("n"), F.max("again").alias("twice"))
        .where("n > 1 OR twice")
        .select("h1", "h2", "first")
    )
    other = F.when(F.col("doc_id") != F.col("first"), F.col("first"))
    # Runs are many and each row of a run is small: where one has very many rows, the adaptive
    # planner deals them over several tasks.
    later = found.join(repeated, ["h1", "h2"]).withColumn("other", other)
    return (
        later.where(F.col("doc_id").isNotNull() & (F.col("other").isNotNull() | F.col("again")))
        .groupBy("doc_id")
        .agg(
            F.array_sort(F.collect_set("other")).alias("repeats_of"),
            F.collect_set(F.when(F.col("other").isNotNull(), F.struct("h1", "h2"))).alias("runs"),
        )
    )


def remove_repeated_passages(
    docs: DataFrame, least: int = SENTENCES, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``removed``, ``repeats_of``, ``text``.

    ``removed`` counts the sentences that went, wholly or in part, ``repeats_of`` lists the documents in which
    their runs stand first, ``text`` is what stays.  Null texts stay null.  Rows without an id
    stay whole.  Rows with one id are one document: none is taken for a repetition of the other.
    An empty table gives an empty result; other columns are not read.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = named.join(repeated_runs(named, least, words), "doc_id", "left")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(pc.cast(batch.column(1), pa.binary())), 0).to_numpy()
            for start, count in together(sizes):
                part = batch.slice(start, count)
                kept, gone = part.column(1).to_pylist(), [0] * part.num_rows
                marked = [i for i, runs in enumerate(part.column(3)) if runs.is_valid and kept[i]]
                marked_texts = [kept[i].encode() for i in marked]
                cuts = both_cuts(marked_texts, least, words)
                later = [part.column(3)[i].as_py() for i in marked]
                stays = [standing(runs, later) for runs in cuts]
                for k, i in enumerate(marked):
                    stay = np.ones(len(marked_texts[k]), bool)
                    for runs, of_cut in zip(cuts, stays, strict=True):
                        stay &= np.repeat(of_cut[runs.first[k] : runs.first[k + 1]], [len(p) for p in runs.parts[k]])
                    begins = np.cumsum([0, *(len(p) for p in cuts[0].parts[k][:-1])])
                    kept[i] = np.frombuffer(marked_texts[k], np.uint8)[stay].tobytes().decode()
                    gone[i] = int((~np.logical_and.reduceat(stay, begins)).sum())
                columns = [part.column(0), pa.array(gone, pa.int64()), part.column(2), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "removed", "repeats_of", "text"])

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, removed long, repeats_of array<{id_type}>, text string"
    done = joined.select("doc_id", "text", "repeats_of", "runs").mapInArrow(removed, schema)
    none = F.array().cast(f"array<{id_type}>")
    return done.withColumn("repeats_of", F.coalesce("repeats_of", none))


def standing(runs: Runs, later: list[list[dict]]) -> np.ndarray:
    """Which sentences stay: those that no run of ``later`` and no second run covers."""
    away = {(k, x["h1"], x["h2"]) for k, found in enumerate(later) for x in found}
    halves = runs.hashes.view(np.int64).tolist()
    goes = runs.again | np.array([(k, *h) in away for k, h in zip(runs.owner.tolist(), halves, strict=True)], bool)
    change = np.zeros(int(runs.first[-1]) + 1, np.int64)
    np.add.at(change, runs.begin[goes], 1)
    np.add.at(change, runs.end[goes], -1)
    return np.cumsum(change)[:-1] == 0
