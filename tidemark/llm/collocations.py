"""Collocations: word sequences that stand together more often than their parts would by chance.

Counting by weighted acyclic automata.  A task counts the sequences of up to five words of a shard
of text: ranks of words are doubled into ranks of sequences, so equal ones meet, and the sorted
distinct sequences with their counts are the shard's automaton.  It holds a language's words as
first steps; the weight of a prefix is the sum of the weights behind it.

Union by prefix range.  Split points, quantiles of a sample of sequences, cut every automaton into
pieces, each one row.  Whoever gets the pieces of a range puts their words into one order, adds up
equal paths step by step and goes on only behind prefixes that are frequent enough, or that a
split point begins with: those continue in a neighbouring range, and are added up at the end.

Composition.  Both parts of a cut phrase are paths of the union too; their weights are looked up
by joins.

A shard sends a sequence once, however often it stands there, and a range is cut within a frequent
word or pair of words, so neither makes a large group.  The sample only says where ranges are cut.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

#: Phrases have so many words at most and stand so often at least.
LONGEST, LEAST = 5, 100

#: Results of each language.
TOP = 2000

#: Word counts of languages, one row each, that are sent to all tasks rather than shuffled.
MOST_SENT = 10_000

UNKNOWN_LANG = "und"

#: Bytes of text that are counted together, and of a prefix range, on average.
SHARD, RANGE = 4 << 20, 4 << 20

#: Sequences sampled for each split point.
SAMPLED = 40

#: The characters that part pieces, and the letters to lower-case.
STOPS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes.maketrans(STOPS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"." * len(STOPS) + b"abcdefghijklmnopqrstuvwxyz")


def words_and_stops(texts: list[bytes]) -> list[bytes]:
    """Words of the texts in order, with a full stop between pieces."""
    spaced = b" . ".join([text.translate(FOLD).replace(b".", b" . ") for text in texts])
    # White space other than space and tab stands in STOPS.
    return spaced.split()


class Automaton:
    """Distinct sequences of words, sorted, with their counts.

    ``words``: sorted; ``paths``: a column for each step with the rank of the word from 1, 0 where
    the piece ends; ``weights``: how often exactly this path stands.
    """

    def __init__(self, words: list[bytes], paths: np.ndarray, weights: np.ndarray):
        self.words, self.paths, self.weights = words, paths, weights

    @classmethod
    def of_texts(cls, texts: list[bytes], longest: int) -> Automaton:
        found = words_and_stops(texts)
        coded = pa.array(found, pa.binary()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        order = sorted(range(len(words)), key=words.__getitem__)
        rank = np.empty(len(words), np.int64)
        stop = words.index(b".") if b"." in words else -1
        real = [k for k in order if k != stop]
        rank[real] = np.arange(1, len(real) + 1)
        if stop >= 0:
            rank[stop] = 0
        steps = rank[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        return cls([words[k] for k in real], *counted_paths(steps, longest))

    def pieces(self, splits: list[tuple[bytes, ...]]) -> Iterator[tuple[int, bytes]]:
        """The parts between split points, as bytes."""
        ranks = {word: k for k, word in enumerate(self.words, 1)}
        bounds = [0, *(self.place(split, ranks) for split in splits), len(self.weights)]
        for part, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if a < b:
                yield part, self.to_bytes(a, b)

    def place(self, split: tuple[bytes, ...], ranks: dict[bytes, int]) -> int:
        """The first path that is not before ``split``."""
        low, high = 0, len(self.weights)
        for step, word in enumerate(split):
            column = self.paths[step]
            rank = ranks.get(word) if word else 0
            if rank is None:
                return low + int(np.searchsorted(column[low:high], bisect_left(self.words, word) + 1))
            low, high = (low + int(np.searchsorted(column[low:high], rank, side=s)) for s in ("left", "right"))
        return low

    def to_bytes(self, begin: int, end: int) -> bytes:
        paths = self.paths[:, begin:end]
        used = np.unique(paths)
        used = used[used > 0]
        small = np.searchsorted(used, paths) + 1
        small[paths == 0] = 0
        words = b" ".join([self.words[k - 1] for k in used.tolist()])
        kind = "<u2" if len(used) < 65535 else "<u4"
        parts = [words, small.astype(kind).tobytes(), self.weights[begin:end].astype("<u8").tobytes()]
        head = struct.pack("<4Q", paths.shape[0], end - begin, int(kind == "<u4"), len(words))
        return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))

    @classmethod
    def from_bytes(cls, value: bytes) -> Automaton:
        data = zstandard.ZstdDecompressor().decompress(value)
        steps, count, wide, size = struct.unpack_from("<4Q", data)
        kind = "<u4" if wide else "<u2"
        at = 32 + size
        paths = np.frombuffer(data, kind, steps * count, at).reshape(steps, count)
        weights = np.frombuffer(data, "<u8", count, at + steps * count * np.dtype(kind).itemsize)
        return cls(data[32:at].split(b" ") if size else [], paths, weights.astype(np.int64))


def counted_paths(steps: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct sequences that begin at each word, and how often they stand."""
    # Behind the end of a piece all further steps are none.
    padded = np.concatenate([steps, np.zeros(longest, np.int64)])
    rank, width = padded, 1
    by_width = [padded]  # the ranks of sequences of 1, 2, 4 words and so on
    while width < longest:
        doublings = min(width, longest - width).bit_length() - 1
        pair = np.zeros_like(rank)
        pair[: len(rank) - width] = by_width[doublings][width:]
        open_ = np.ones(len(rank), bool)
        for k in range(width):
            open_[: len(rank) - k] &= padded[k:] > 0
        key = rank * (int(pair.max(initial=0)) + 1) + np.where(open_, pair, 0)
        rank = np.unique(key, return_inverse=True)[1]
        by_width.append(rank)
        width += 1 << doublings
    begins = np.flatnonzero(steps > 0)
    ranks = rank[begins]
    distinct, first, weights = np.unique(ranks, return_index=True, return_counts=True)
    at = begins[first]
    paths = np.zeros((longest, len(at)), np.int64)
    alive = np.ones(len(at), bool)
    for k in range(longest):
        alive &= padded[at + k] > 0
        paths[k] = np.where(alive, padded[at + k], 0)
    return paths, weights.astype(np.int64)


def union(pieces: list[Automaton]) -> Automaton:
    """All paths over one sorted list of words; equal paths may still stand several times."""
    words = sorted(set().union(*(p.words for p in pieces)))
    rank = {word: k for k, word in enumerate(words, 1)}
    paths = []
    for piece in pieces:
        to = np.array([0, *map(rank.__getitem__, piece.words)], np.int64)
        paths.append(to[piece.paths])
    return Automaton(words, np.concatenate(paths, axis=1), np.concatenate([p.weights for p in pieces]))


def frequent_prefixes(whole: Automaton, least: int, ends: list[tuple[bytes, ...]]) -> Iterator[tuple[list[bytes], int]]:
    """Prefixes with a weight of at least ``least``, and all that a sequence of ``ends`` begins
    with, with their weights."""
    ranks = {word: k for k, word in enumerate(whole.words, 1)}
    coded = [[ranks.get(word, -1) if word else 0 for word in end] for end in ends]
    rows = np.arange(len(whole.weights))
    node = np.zeros(len(rows), np.int64)  # the prefix so far
    said: list[tuple] = [()]
    for step in range(whole.paths.shape[0]):
        column = whole.paths[step][rows]
        rows, node, column = rows[column > 0], node[column > 0], column[column > 0]
        if not len(rows):
            return
        key = node * (len(whole.words) + 1) + column
        distinct, inverse = np.unique(key, return_inverse=True)
        weights = np.bincount(inverse, whole.weights[rows], len(distinct)).astype(np.int64)
        keep = weights >= least
        for end in coded:
            prefix = tuple(end[: step + 1])
            if prefix[:-1] in said and min(prefix) > 0:
                keep |= distinct == said.index(prefix[:-1]) * (len(whole.words) + 1) + prefix[-1]
        number = np.cumsum(keep) - 1
        kept = distinct[keep].tolist()
        said = [(*said[k // (len(whole.words) + 1)], k % (len(whole.words) + 1)) for k in kept]
        for path, weight in zip(said, weights[keep].tolist(), strict=True):
            yield [whole.words[k - 1] for k in path], weight
        stays = keep[inverse]
        rows, node = rows[stays], number[inverse[stays]]


def by_lang(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, in shards of about ``size`` bytes; a longer text is one by itself."""
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    total = 0
    for batch in batches:
        texts = pc.cast(batch.column(1), pa.binary())
        for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            if text.is_valid:
                value = text.as_py()
                waiting.setdefault(lang, []).append(value)
                sizes[lang] = sizes.get(lang, 0) + len(value)
                total += len(value)
                if total >= size:
                    largest = max(sizes, key=sizes.__getitem__)
                    total -= sizes.pop(largest)
                    yield largest, waiting.pop(largest)
    yield from waiting.items()


def split_points(texts: DataFrame, rows: int, ranges: int, longest: int) -> list[tuple[str, tuple[bytes, ...]]]:
    """Quantiles of a sample of sequences, with their languages."""
    if ranges <= 1:
        return []
    share = min(1.0, 100 * ranges / rows)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, places = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_and_stops([(text or "").encode()])
                # The longer the text, the more of its places: one in a thousand words, evenly spread.
                step = 1000
                for at in range(len(text or "") % step, len(words), step):
                    path = words[at : at + longest]
                    path = path[: path.index(b".")] if b"." in path else path
                    if path:
                        langs.append(lang)
                        places.append(b" ".join(path))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(places, pa.binary())], ["lang", "path"])

    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    drawn = sample.mapInArrow(sampled, "lang string, path binary").orderBy(F.rand(1)).limit(SAMPLED * ranges)
    found = sorted((row.lang, tuple(bytes(row.path).split(b" "))) for row in drawn.collect())
    step = max(1, len(found) // ranges)
    return sorted({(lang, path + (b"",) * (longest - len(path))) for lang, path in found[step::step]})


def count_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``lang``, ``phrase``, ``words`` (how many), ``f`` for phrases of up to ``longest`` words that
    stand ``least`` times or more, and for each language its number of words as the empty phrase.

    ``docs`` has ``lang`` and ``text``, without nulls.
    """
    rows, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    splits = split_points(docs, rows, -(-size // RANGE), longest)
    langs = [lang for lang, _ in splits]

    def shard_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in by_lang(batches, SHARD):
            counted = Automaton.of_texts(texts, longest)
            if not len(counted.weights):
                continue
            a, b = bisect_left(langs, lang), bisect_right(langs, lang)
            cut = list(counted.pieces([path for _, path in splits[a:b]]))
            columns = [
                pa.array([a + part for part, _ in cut], pa.int32()),
                pa.array([lang] * len(cut), pa.string()),
                pa.array([blob for _, blob in cut], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["range", "lang", "blob"])

    def merged(part: pa.Table) -> pa.Table:
        lang, number = part.column("lang")[0].as_py(), part.column("range")[0].as_py()
        whole = union([Automaton.from_bytes(blob.as_py()) for blob in part.column("blob")])
        ends = [path for other, path in splits[max(number - 1, 0) : number + 1] if other == lang]
        found = list(frequent_prefixes(whole, least, ends))
        phrases = [b" ".join(path) for path, _ in found]
        columns = [
            pa.array([lang] * (len(found) + 1), pa.string()),
            pc.cast(pa.array([*phrases, b""], pa.binary()), pa.string()),
            pa.array([*(len(path) for path, _ in found), 0], pa.int32()),
            pa.array([*(weight for _, weight in found), int(whole.weights.sum())], pa.int64()),
        ]
        return pa.Table.from_arrays(columns, names=["lang", "phrase", "words", "f"])

    pieces = docs.select("lang", "text").mapInArrow(shard_pieces, "range int, lang string, blob binary")
    parts = pieces.groupBy("range", "lang").applyInArrow(merged, "lang string, phrase string, words int, f long")
    # Prefixes that a range ends within are in both neighbours.
    return parts.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("words") == 0))


def best_phrases(counted: DataFrame, top: int = TOP) -> DataFrame:
    """The phrases of ``count_phrases`` that lie in no longer one as frequent, scored and ranked."""
    phrases = counted.where("words > 0")
    totals = counted.where("words = 0").select("lang", F.col("f").alias("n"))
    several = phrases.where("words > 1")

    # What stands as often with one more word in front or behind is part of that.
    spoken = F.split("phrase", " ")
    shorter = several.select("lang", "f", spoken.alias("w")).where(F.size("w") > 2).select(
        "lang", "f", F.explode(F.array(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1))).alias("w")
    )
    inside = shorter.groupBy("lang", F.array_join("w", " ").alias("phrase")).agg(F.max("f").alias("f"))
    open_ = several.join(inside, ["lang", "phrase", "f"], "left_anti")

    split = open_.select("lang", "phrase", F.col("f").alias("a"), spoken.alias("w")).withColumn(
        "k", F.explode(F.sequence(F.lit(1), F.size("w") - 1))
    )
    cut = split.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("before"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("behind"),
    )
    weights = lambda phrase, f: phrases.select("lang", F.col("phrase").alias(phrase), F.col("f").alias(f))
    # One row a language: sent to all tasks where there are few languages.
    if totals.count() <= MOST_SENT:
        totals = F.broadcast(totals)
    parts = cut.join(weights("before", "l"), ["lang", "before"]).join(weights("behind", "r"), ["lang", "behind"])
    exact = [F.col(c).cast("decimal(19,0)") for c in "anlr"]
    product = reduce(lambda x, y: (x * y).cast("decimal(38,0)"), [exact[0], exact[1], F.lit(1000).cast("decimal(4,0)")])
    scored = parts.join(totals, "lang").select(
        "lang", "phrase", "a", "l", "r", "n", "k",
        F.call_function("div", product, (exact[2] * exact[3]).cast("decimal(38,0)")).cast("long").alias("score"),
    )
    lowest = scored.groupBy("lang", "phrase").agg(F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "k")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = lowest.select("lang", "phrase", "cut.*").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(
    docs: DataFrame,
    top: int = TOP,
    longest: int = LONGEST,
    least: int = LEAST,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the first ``top`` phrases
    of every language, by score, then ``a``, both descending, then phrase.

    Texts have A-Z lower-cased, are split into pieces at ``.,;:!?`` and line ends, and those into
    words at spaces and tabs.  ``n`` counts the words of a language, ``a`` how often a phrase of 2
    to ``longest`` words stands within pieces, overlaps included, ``l`` and ``r`` its first words and
    the rest where it is cut with the lowest score (ties: the fewest first words); the score is
    ``floor(1000 * a * n / (l * r))``.  Phrases that stand fewer than ``least`` times are none, and
    those that lie inside a longer one that stands as often go.  A null text counts as empty, a
    null language as ``und``.  Repeated rows count as often as they stand there; an empty table
    gives an empty result; other columns are not read.  Sums are exact up to 64 bits, products up
    to 38 digits.
    """
    named = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), F.col(text_col).alias("text")
    ).where(F.col("text").isNotNull())
    return best_phrases(stored(count_phrases(named, longest, least), "phrases"), top)
