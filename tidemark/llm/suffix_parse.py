"""Substring dedup by prefix-free parsing: every byte covered by a string of 50 bytes that also
starts in a document with a smaller id goes.

Parse.  The text is cut by triggers, positions where a rolling hash of ``TRIGGER`` bytes is the
smallest among those within a string of 50 bytes.  Every such string belongs to the first of its
smallest triggers, and the strings of one trigger lie next to each other: with the 49 bytes that
the last of them reaches further they are a phrase.  What is a trigger depends on nothing outside
a string, so equal strings lie in phrases with the same trigger, at the same distance from it.

Dictionary.  Equal phrases are one entry, with the smallest id among its documents: in all others
the whole phrase repeats.  What is left to find are strings that an entry shares with a different
entry of the same trigger.  For these entries a suffix array to the depth of 50 bytes is built.
Entries without a rival need none, so highly repetitive text costs little.

Corpus order.  Neighbours in the suffix array that agree in 50 bytes are one string; its first
document is the first of its entries, and the parse says where the entries stand.

Documents are dealt by hash into shards of about ``SHARD`` bytes.  A shard sends every trigger
and every phrase once, however often it holds them, so the text of a third of all documents makes
no large group; a trigger with many entries is sent string by string.  Shards and what they are
told meet in a cogroup; the shuffled shards are used by all four passes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Strings are so long, triggers are chosen by so many bytes.
LENGTH, TRIGGER = 50, 24

#: Bytes of text in a shard, on average, and bytes that are parsed at once.
SHARD, CHUNK = 2 << 20, 1 << 18

#: Bytes of text that are dealt together.
DEALT = 16 << 20

#: A trigger that more phrases than this have, counted by shard, is sent string by string.
MANY = 2_000

#: Reply kinds: repeated triggers, first documents of phrases, triggers with rivals, such with
#: many, and places of repeated strings within phrases.
LIVE, FIRST, RIVALS, MANY_RIVALS, WITHIN = range(5)

U64, FACTOR = np.uint64, 0x9E3779B97F4A7C15
PLACE = U64((1 << 24) - 1)


def pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays as one compressed value, numbers split by significance: equal high bytes meet."""
    parts = [a if isinstance(a, bytes) else a.view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays]
    head = struct.pack(f"<I{len(parts)}Q", len(parts), *map(len, parts))
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def unpack(value: bytes, *types: str | None) -> list[np.ndarray | bytes]:
    data = zstandard.ZstdDecompressor().decompress(value)
    (count,) = struct.unpack_from("<I", data)
    sizes, at, out = struct.unpack_from(f"<{count}Q", data, 4), 4 + 8 * count, []
    for size, kind in zip(sizes, types, strict=True):
        part, at = data[at : at + size], at + size
        if kind is None:
            out.append(part)
        else:
            width = np.dtype(kind).itemsize
            planes = np.frombuffer(part, np.uint8).reshape(width, size // width)
            out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
    return out


def rising(values: np.ndarray) -> np.ndarray:
    """Sorted numbers as differences, which are small."""
    return np.diff(values, prepend=U64(0))


def powers(factor: int, count: int) -> np.ndarray:
    out = np.full(count, factor & (2**64 - 1), U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Parser:
    """Phrases of texts: ``start`` and ``strings`` (how many 50-byte strings begin there, one
    after the other), ``trigger`` and ``phrase`` (64-bit hashes)."""

    def __init__(self, length: int = LENGTH, trigger: int = TRIGGER):
        self.length, self.trigger = length, trigger
        self.letters = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=U64)
        self.up = powers(FACTOR, CHUNK + length)
        self.down = powers(pow(FACTOR, -1, 1 << 64), CHUNK + length)

    def chunks(self, sizes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Runs of whole texts, or parts of one long text with overlap: begin, end, and the ends
        of the texts within."""
        ends = np.cumsum(sizes)
        i = 0
        while i < len(sizes):
            begin = int(ends[i] - sizes[i])
            j = max(int(np.searchsorted(ends, begin + CHUNK, side="right")), i + 1)
            if sizes[i] > CHUNK:
                for at in range(begin, int(ends[i]), CHUNK):
                    end = min(at + CHUNK + self.length - 1, int(ends[i]))
                    yield at, end, np.array([end])
            else:
                yield begin, int(ends[j - 1]), ends[i:j]
            i = j

    def __call__(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        found = [self.parse(data[a:b], a, ends - a) for a, b, ends in self.chunks(sizes) if b - a >= self.length]
        if not found:
            return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64))
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))

    def parse(self, data: np.ndarray, begin: int, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(self.letters[data] * self.up[: len(data)], dtype=U64)])
        rolling = (sums[self.trigger :] - sums[: -self.trigger]) * self.down[: len(data) - self.trigger + 1]
        rolling ^= rolling >> U64(29)
        rolling *= U64(0xBF58476D1CE4E5B9)
        rolling ^= rolling >> U64(32)
        # The smallest hash of each string, with its place in the low bits: ties to the first.
        least = (rolling & ~PLACE) | np.arange(len(rolling), dtype=U64)
        wide, reach = 1, self.length - self.trigger + 1
        while wide < reach:
            step = min(wide, reach - wide)
            least = np.minimum(least[:-step], least[step:])
            wide += step
        owner = (least & PLACE).astype(np.int64)
        # Strings that reach beyond their text are none.
        begins = np.concatenate([[0], ends[:-1]])
        change = np.zeros(len(owner) + 1, np.int64)
        whole = ends - begins >= self.length
        np.add.at(change, begins[whole], 1)
        np.add.at(change, ends[whole] - self.length + 1, -1)
        owner[np.cumsum(change[:-1]) == 0] = -1
        start = np.flatnonzero(np.diff(owner, prepend=-2))
        strings = np.diff(start, append=len(owner))
        real = owner[start] >= 0
        # Texts that follow each other without a gap between their strings cannot be: each string
        # ends within its text, so at least 49 places lie between them.
        start, strings = start[real], strings[real]
        phrase = (sums[start + strings - 1 + self.length] - sums[start]) * self.down[start]
        return start + begin, strings, rolling[owner[start]], phrase


class Shard:
    """The texts of a shard and their phrases, each phrase with the number of its document."""

    def __init__(self, blobs: pa.ChunkedArray, parser: Parser):
        ids, valid, sizes, data = zip(*(unpack(b.as_py(), "<i8", "?", "<i8", None) for b in blobs), strict=True)
        self.ids, self.valid, self.sizes = map(np.concatenate, (ids, valid, sizes))
        self.bytes = b"".join(data)
        self.ends = np.cumsum(self.sizes)
        start, strings, trigger, phrase = parser(np.frombuffer(self.bytes, np.uint8), self.sizes)
        doc = np.searchsorted(self.ends, start, side="right")
        named = self.valid[doc]
        self.start, self.strings, self.trigger, self.phrase, self.doc = (
            x[named] for x in (start, strings, trigger, phrase, doc)
        )
        # One entry for equal phrases, by phrase and trigger; the first of an entry has its smallest id.
        self.id = self.ids[self.doc]
        self.order = np.lexsort((self.id, self.trigger, self.phrase))
        new = changes(self.phrase[self.order], self.trigger[self.order])
        self.entry = np.empty(len(new), np.int64)
        self.entry[self.order] = np.cumsum(new) - 1
        self.head = self.order[np.flatnonzero(new)]
        self.first = self.id[self.head]


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where rows of sorted columns differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def cuts_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash, rising with it."""
    return ((hashes >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)


def outgoing(shard: int, kind: int, route: np.ndarray, parts: int, *columns: np.ndarray, sort: bool = False) -> Iterator[tuple]:
    """Rows for the parts that ``route`` leads to; the first column rises within a part."""
    part = cuts_of(route, parts)
    order = np.lexsort((columns[0], part))
    part, columns = part[order], [c[order] for c in columns]
    bounds = np.append(np.flatnonzero(changes(part)), len(part)) if len(part) else [0]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        first, *rest = (c[a:b] for c in columns)
        yield int(part[a]), kind, shard, pack(rising(first), *rest)


SENT = "part int, kind int, shard int, blob binary"
TOLD = "shard int, kind int, blob binary"
SENT_ARROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("shard", pa.int32()), ("blob", pa.binary())])
TOLD_ARROW = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])


def rows(found: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*found, strict=True)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def read(part: pa.Table, kind: int, *types: str) -> list[np.ndarray]:
    """Columns of the blobs of one kind, the first made whole again, and the shard of each row."""
    of_kind = part.filter(pc.equal(part.column("kind"), kind))
    found = []
    for shard, blob in zip(of_kind.column("shard").to_pylist(), of_kind.column("blob"), strict=True):
        first, *rest = unpack(blob.as_py(), *types)
        first = np.cumsum(first, dtype=U64)
        found.append([first, *rest, np.full(len(first), shard)])
    if not found:
        return [np.zeros(0, t) for t in (*types, "<i8")]
    return [np.concatenate(c) for c in zip(*found, strict=True)]


def told(kind: int, shard: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Rows for the shards; the first column rises."""
    order = np.lexsort((columns[0], shard))
    shard, columns = shard[order], [c[order] for c in columns]
    bounds = np.append(np.flatnonzero(changes(shard)), len(shard)) if len(shard) else [0]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        first, *rest = (c[a:b] for c in columns)
        yield int(shard[a]), kind, pack(rising(first), *rest)


def within_sorted(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which ``values`` are among the sorted ``of``."""
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def matches(phrase: np.ndarray, trigger: np.ndarray, of_phrase: np.ndarray, of_trigger: np.ndarray) -> np.ndarray:
    """For each of the sorted distinct entries (``phrase``, ``trigger``) the row of the others that
    equals it, or -1; the others are distinct."""
    all_phrases, all_triggers = np.concatenate([phrase, of_phrase]), np.concatenate([trigger, of_trigger])
    side = np.repeat([0, 1], [len(phrase), len(of_phrase)])
    order = np.lexsort((side, all_triggers, all_phrases))
    same = ~changes(all_phrases[order], all_triggers[order])
    out = np.full(len(phrase), -1)
    at = np.flatnonzero(same)
    out[order[at - 1]] = order[at] - len(phrase)
    return out


# --- what shards send and parts answer


def send_triggers(shard: int, texts: Shard, parts: int) -> list[tuple]:
    distinct = np.unique(texts.trigger)
    return list(outgoing(shard, LIVE, distinct, parts, distinct))


def answer_triggers(part: pa.Table) -> list[tuple]:
    """Triggers that several shards hold."""
    trigger, shard = read(part, LIVE, "<u8")
    order = np.argsort(trigger, kind="stable")
    trigger, shard = trigger[order], shard[order]
    new = changes(trigger) if len(trigger) else np.zeros(0, bool)
    shared = ~new | np.append(~new[1:], False) if len(new) else new
    return list(told(LIVE, shard[shared], trigger[shared]))


def live_triggers(texts: Shard, replies: pa.Table) -> np.ndarray:
    """Sorted triggers that several documents hold."""
    (trigger, _) = read(replies, LIVE, "<u8")
    order = np.lexsort((texts.id, texts.trigger))
    sorted_triggers, ids = texts.trigger[order], texts.id[order]
    again = (sorted_triggers[1:] == sorted_triggers[:-1]) & (ids[1:] != ids[:-1])
    return np.unique(np.concatenate([trigger, sorted_triggers[1:][again]]))


def send_phrases(shard: int, texts: Shard, parts: int, replies: pa.Table) -> list[tuple]:
    """Phrases with repeated triggers: each with its first document by phrase, and by trigger one
    phrase of it and how many there are."""
    phrase, trigger = texts.phrase[texts.head], texts.trigger[texts.head]
    live = within_sorted(trigger, live_triggers(texts, replies))
    phrase, trigger, first = phrase[live], trigger[live], texts.first[live]
    out = list(outgoing(shard, FIRST, phrase, parts, phrase, trigger.astype("<u4"), first))
    order = np.lexsort((phrase, trigger))
    trigger, phrase = trigger[order], phrase[order]
    heads = np.flatnonzero(changes(trigger)) if len(trigger) else np.zeros(0, np.int64)
    count = np.diff(heads, append=len(trigger)).astype("<u4")
    return out + list(outgoing(shard, RIVALS, trigger[heads], parts, trigger[heads], phrase[heads], count))


def answer_phrases(part: pa.Table) -> list[tuple]:
    """Earlier first documents in other shards; triggers with rival phrases."""
    phrase, trigger, first, shard = read(part, FIRST, "<u8", "<u4", "<i8")
    out = []
    if len(phrase):
        order = np.lexsort((first, trigger, phrase))
        phrase, trigger, first, shard = phrase[order], trigger[order], first[order], shard[order]
        new = changes(phrase, trigger)
        least = first[np.flatnonzero(new)][np.cumsum(new) - 1]
        later = least < first
        out += told(FIRST, shard[later], phrase[later], trigger[later], least[later])
    trigger, phrase, count, shard = read(part, RIVALS, "<u8", "<u8", "<u4")
    if len(trigger):
        order = np.lexsort((phrase, trigger))
        trigger, phrase, count, shard = trigger[order], phrase[order], count[order], shard[order]
        new = changes(trigger)
        heads, group = np.flatnonzero(new), np.cumsum(new) - 1
        several = (np.add.reduceat(changes(trigger, phrase).astype(int), heads) > 1) | (np.maximum.reduceat(count, heads) > 1)
        many = np.add.reduceat(count.astype(np.int64), heads) > MANY
        for kind, which in ((RIVALS, several & ~many), (MANY_RIVALS, several & many)):
            out += told(kind, shard[which[group]], trigger[which[group]])
    return out


def first_documents(texts: Shard, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Of every entry the smallest id in all shards, and whether it is this shard's."""
    phrase, trigger, first, _ = read(replies, FIRST, "<u8", "<u4", "<i8")
    own = np.lexsort((texts.trigger[texts.head].astype("<u4"), texts.phrase[texts.head]))
    at = matches(texts.phrase[texts.head][own], texts.trigger[texts.head].astype("<u4")[own], phrase, trigger)
    least = texts.first.copy()
    least[own[at >= 0]] = first[at[at >= 0]]
    return least, least == texts.first


def send_rivals(shard: int, texts: Shard, parts: int, replies: pa.Table, length: int) -> list[tuple]:
    """The bytes of the entries that are this shard's and have rivals."""
    _, own = first_documents(texts, replies)
    trigger = texts.trigger[texts.head]
    out = []
    data = np.frombuffer(texts.bytes, np.uint8)
    for kind in (RIVALS, MANY_RIVALS):
        of_kind = np.unique(read(replies, kind, "<u8")[0])
        entry = np.flatnonzero(own & within_sorted(trigger, of_kind))
        head = texts.head[entry]
        start, strings, at = texts.start[head], texts.strings[head], np.zeros(len(head), np.int64)
        route = trigger[entry]
        if kind == MANY_RIVALS:  # every string by itself, to a part that its bytes choose
            at = np.arange(strings.sum()) - np.repeat(np.cumsum(strings) - strings, strings)
            entry, start = np.repeat(entry, strings), np.repeat(start, strings) + at
            strings = np.ones(len(entry), np.int64)
            route = np.array([xxhash.xxh3_64_intdigest(texts.bytes[s : s + length]) for s in start.tolist()], U64)
        part = cuts_of(route, parts)
        order = np.argsort(part, kind="stable")
        bounds = np.append(np.flatnonzero(changes(part[order])), len(order)) if len(order) else [0]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            of_part = order[a:b][np.lexsort((at[order[a:b]], entry[order[a:b]]))]
            e = entry[of_part]
            size = strings[of_part] + length - 1
            places = np.repeat(start[of_part] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            blob = pack(
                texts.phrase[texts.head[e]], trigger[e].astype("<u4"), texts.first[e], strings[of_part].astype("<u4"),
                at[of_part].astype("<u4"), data[places].tobytes(),
            )
            out.append((int(part[order[a]]), WITHIN, shard, blob))
    return out


def suffix_ranks(data: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes at ``begins`` by their first ``length`` bytes, and where each
    differs from the one before."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    keys = []
    for at in range(0, length, 8):
        width = min(8, length - at)
        key = np.zeros(len(begins), U64)
        for k in range(width):
            key = (key << U64(8)) | padded[begins + (at + k)].astype(U64)
        keys.append(key)
    order = np.lexsort(keys[::-1])
    return order, changes(*[key[order] for key in keys])


def answer_rivals(part: pa.Table, length: int) -> list[tuple]:
    """Of the entries sent, the strings that stand in an entry with an earlier first document."""
    found = []
    for shard, blob in zip(part.column("shard").to_pylist(), part.column("blob"), strict=True):
        phrase, trigger, first, strings, at, data = unpack(blob.as_py(), "<u8", "<u4", "<i8", "<u4", "<u4", None)
        found.append((phrase, trigger, first, strings, at, np.frombuffer(data, np.uint8), np.full(len(phrase), shard)))
    phrase, trigger, first, strings, at, data, shard = (np.concatenate(c) for c in zip(*found, strict=True))
    strings, at = strings.astype(np.int64), at.astype(np.int64)
    size = strings + length - 1
    owner = np.repeat(np.arange(len(phrase)), strings)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
    begins = np.repeat(np.cumsum(size) - size, strings) + inside
    order, new = suffix_ranks(data, begins, length)
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(first[owner[order]], heads)[np.cumsum(new) - 1]
    repeats = np.zeros(len(order), bool)
    repeats[order] = least < first[owner[order]]
    # Runs of repeated strings of one entry.
    spot = np.flatnonzero(repeats)
    if not len(spot):
        return []
    run = changes(owner[spot], inside[spot] - np.arange(len(spot)))
    begin = spot[run]
    count = np.diff(np.append(np.flatnonzero(run), len(spot)))
    of = owner[begin]
    place = (inside[begin] + at[of]).astype("<u4")
    return list(told(WITHIN, shard[of], phrase[of], trigger[of], place, count.astype("<u4")))


def repeated_spans(texts: Shard, replies: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``doc``, ``begin``, ``end`` of the maximal runs of bytes that go, in order."""
    least, own = first_documents(texts, replies)
    whole = np.flatnonzero(texts.id > least[texts.entry])
    begin, count = [texts.start[whole]], [texts.strings[whole]]
    phrase, trigger, place, strings, _ = read(replies, WITHIN, "<u8", "<u4", "<u4", "<u4")
    if len(phrase):
        # Places of an entry hold for its occurrences in its first document.
        order = np.lexsort((trigger, phrase))
        phrase, trigger, place, strings = (x[order] for x in (phrase, trigger, place, strings))
        heads = np.flatnonzero(changes(phrase, trigger))
        sizes = np.diff(heads, append=len(phrase))
        entry_order = np.lexsort((texts.trigger[texts.head].astype("<u4"), texts.phrase[texts.head]))
        at = matches(
            texts.phrase[texts.head][entry_order], texts.trigger[texts.head].astype("<u4")[entry_order],
            phrase[heads], trigger[heads],
        )
        group = np.full(len(texts.head), -1)
        group[entry_order] = at
        spot = np.flatnonzero((texts.id == least[texts.entry]) & (group[texts.entry] >= 0))
        g = group[texts.entry[spot]]
        row = np.repeat(heads[g] - (np.cumsum(sizes[g]) - sizes[g]), sizes[g]) + np.arange(sizes[g].sum())
        begin.append(np.repeat(texts.start[spot], sizes[g]) + place[row])
        count.append(strings[row].astype(np.int64))
    begin, count = np.concatenate(begin), np.concatenate(count)
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], (begin + count + length - 1)[order]
    if not len(begin):
        return begin, begin, end
    reach = np.maximum.accumulate(end)
    # Bytes of neighbouring documents never join.
    doc = np.searchsorted(texts.ends, begin, side="right")
    new = np.ones(len(begin), bool)
    new[1:] = (begin[1:] > reach[:-1]) | (doc[1:] != doc[:-1])
    heads = np.flatnonzero(new)
    return doc[heads], begin[heads], np.maximum.reduceat(end, heads)


def kept_texts(texts: Shard, spans: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Table:
    doc, begin, end = spans
    starts = texts.ends - texts.sizes
    kept = [texts.bytes[a:b] for a, b in zip(starts.tolist(), texts.ends.tolist(), strict=True)]
    bounds = np.searchsorted(doc, np.arange(len(kept) + 1))
    for d in np.unique(doc).tolist():
        at, pieces = int(starts[d]), []
        for k in range(bounds[d], bounds[d + 1]):
            pieces.append(texts.bytes[at : begin[k]])
            at = int(end[k])
        kept[d] = b"".join([*pieces, texts.bytes[at : texts.ends[d]]])
    where = pa.StructArray.from_arrays(
        [pa.array(begin - starts[doc], pa.int64()), pa.array(end - begin, pa.int64())], ["start", "length"]
    )
    of_docs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), where)
    ids = pa.array(texts.ids, pa.int64(), mask=~texts.valid)
    return pa.Table.from_arrays([ids, pa.array(kept, pa.binary()), of_docs], names=["doc_id", "kept", "spans"])


# --- the passes


def shards_of(docs: DataFrame, count: int) -> DataFrame:
    """``shard``, ``blob``: documents dealt by a hash of text and id, several in a blob."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(pc.cast(batch.column(1), pa.binary())), 0).to_numpy()
            step = max(1, int(batch.num_rows * DEALT / (sizes.sum() + 1)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                valid = part.column(0).is_valid().to_numpy(zero_copy_only=False)
                ids = pc.fill_null(part.column(0), 0).to_numpy()
                texts = [t or b"" for t in pc.cast(part.column(1), pa.binary()).to_pylist()]
                lengths = np.fromiter(map(len, texts), "<i8", len(texts))
                seeds = ids.view(U64).tolist()
                hashes = [xxhash.xxh3_64_intdigest(t, seed) for t, seed in zip(texts, seeds, strict=True)]
                shard = (np.array(hashes, U64) % U64(count)).astype(np.int32)
                order = np.argsort(shard, kind="stable")
                bounds = np.append(np.flatnonzero(changes(shard[order])), len(order))
                found = []
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    rows_ = order[a:b]
                    blob = pack(ids[rows_], valid[rows_], lengths[rows_], b"".join([texts[r] for r in rows_.tolist()]))
                    found.append((int(shard[order[a]]), blob))
                columns = list(zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())], ["shard", "blob"])

    return docs.mapInArrow(dealt, "shard int, blob binary")


def remove_repeated_strings(
    docs: DataFrame, length: int = LENGTH, trigger: int = TRIGGER, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` (long), ``kept`` (bytes) and ``spans`` (``start``,
    ``length`` of the maximal runs of bytes that went, in order).

    A byte of the UTF-8 text goes if a string of ``length`` bytes that covers it also starts in a
    document with a smaller id.  Strings are judged on the given texts, never on what is left,
    and none reaches from one document into another.  Null texts count as empty.  Rows without
    an id stay whole and make no other row repeat; rows with one id are one document, so neither
    repeats the other.  Texts shorter than ``length`` stay.  An empty table gives an empty
    result; other columns are not read.  Ids are whole numbers.
    """
    if not 0 < trigger < length:
        raise ValueError("trigger must be shorter than length")
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // SHARD))
    shards = shards_of(named, parts)

    def shard_of(table: pa.Table) -> tuple[int, Shard]:
        return table.column("shard")[0].as_py(), Shard(table.column("blob"), Parser(length, trigger))

    def triggers(table: pa.Table) -> pa.Table:
        return rows(send_triggers(*shard_of(table), parts), SENT_ARROW)

    def phrases(table: pa.Table, replies: pa.Table) -> pa.Table:
        return rows(send_phrases(*shard_of(table), parts, replies), SENT_ARROW)

    def rivals(table: pa.Table, replies: pa.Table) -> pa.Table:
        return rows(send_rivals(*shard_of(table), parts, replies, length), SENT_ARROW)

    def result(table: pa.Table, replies: pa.Table) -> pa.Table:
        texts = shard_of(table)[1]
        return kept_texts(texts, repeated_spans(texts, replies, length))

    by_shard = shards.groupBy("shard")
    sent = by_shard.applyInArrow(triggers, SENT)
    live = sent.groupBy("part").applyInArrow(lambda t: rows(answer_triggers(t), TOLD_ARROW), TOLD)
    sent = by_shard.cogroup(live.groupBy("shard")).applyInArrow(phrases, SENT)
    known = sent.groupBy("part", "kind").applyInArrow(lambda t: rows(answer_phrases(t), TOLD_ARROW), TOLD)
    sent = by_shard.cogroup(known.groupBy("shard")).applyInArrow(rivals, SENT)
    places = sent.groupBy("part").applyInArrow(lambda t: rows(answer_rivals(t, length), TOLD_ARROW), TOLD)
    replies = known.where(F.col("kind") == FIRST).unionAll(places)
    schema = "doc_id long, kept binary, spans array<struct<start: long, length: long>>"
    return by_shard.cogroup(replies.groupBy("shard")).applyInArrow(result, schema)
