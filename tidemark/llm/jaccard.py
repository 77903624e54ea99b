"""Exact set similarity join of documents on word n-grams, by set relations.

Every set is ordered from its rarest shingle up, so linked sets share one of their first
shingles, and a set whose first shingles stand nowhere else is done.  Index lists of the others
are walked in two ways.  First, for a few rounds, each set asks only leading sets of its lists,
and what links to a set is taken over from it: documents of one component need no further
comparison.  Then lists that still hold several components are compared block by block; blocks
whose sizes or positions rule a link out are skipped, and pairs whose sketches do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import spread_lookup, stored

SHINGLE, PERCENT = 5, 75

#: Shingles a task hashes at a time, and bytes of text for a bucket of shingles.
BATCH_SHINGLES, BUCKET_BYTES = 1 << 20, 12 << 20

#: A shingle in so many sets of a batch is common: it comes last in the order of all sets and
#: is not sent to be counted set by set.
COMMON = 16
MOST_WORDS = 300_000  # words whose hashes a task remembers
COMMON_COUNT = np.uint32(2**32 - 1)

#: Leaders that a set asks in each round, and sets of a list block.
ASKED, BLOCK = (2, 12, 12), 1024

#: Bits of a set's sketch: each says whether an odd number of its shingles falls on it.
SKETCH = 1024

MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes, hashes: WordHashes, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles of a text, A-Z in lower case."""
    words = text.lower().split()
    if len(words) < n:
        joined = xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)
        return np.array([joined] if words else [], np.uint64)
    if len(hashes) > MOST_WORDS:
        hashes.clear()
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    mixed = values[: len(words) - n + 1].copy()
    for i in range(1, n):
        mixed = mixed * MIX + values[i : len(words) - n + 1 + i]
    mixed ^= mixed >> np.uint64(29)
    mixed *= MIX
    return np.unique(mixed ^ mixed >> np.uint64(32))


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    """So many of a set's first shingles hold one of any linked set's."""
    return size - -(-percent * size // 100) + 1


def hashed_batches(docs: DataFrame, n: int, buckets: int) -> DataFrame:
    """Documents in batches: a row per batch and bucket of shingles, and one (bucket -1) with
    the ids, sizes and digests of the batch's sets and their common shingles."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def rows_of(batch: int, ids: list, sets: list[np.ndarray], id_arrow: pa.DataType) -> Iterator[tuple]:
        digests = [xxhash.xxh3_128_digest(s.tobytes()) + len(s).to_bytes(4, "little") for s in sets]
        index: dict[bytes, int] = {}
        members: list[list] = []
        for doc_id, digest in zip(ids, digests, strict=True):
            if digest not in index:
                index[digest] = len(members)
                members.append([])
            members[index[digest]].append(doc_id)
        first = [sets[digests.index(d)] for d in index] if len(index) < len(sets) else sets
        sizes = np.array([len(s) for s in first], np.uint32)
        shingles = np.concatenate([*first, np.array([], np.uint64)])
        owner = np.repeat(np.arange(len(first)), sizes)
        order = np.argsort(shingles, kind="stable")
        shingles, owner = shingles[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]])) if len(shingles) else np.array([], int)
        counts = np.diff(np.append(starts, len(shingles)))
        common = np.repeat(counts >= COMMON, counts)
        held = np.argsort(owner[common], kind="stable")
        common_counts = np.bincount(owner[common], minlength=len(first)).astype(np.uint32)
        yield (-1, batch, members, sizes, b"".join(index), common_counts, shingles[common][held], b"")
        often = starts[counts >= COMMON]
        often_counts = counts[counts >= COMMON].astype(np.uint32)
        cut = np.searchsorted(shingles, bucket_starts(buckets))
        for bucket, (low, high) in enumerate(zip(cut, np.append(cut[1:], len(shingles)), strict=True)):
            rare = ~common[low:high]
            part, whose = shingles[low:high][rare], owner[low:high][rare]
            by_owner = np.argsort(whose, kind="stable")
            there = (often >= low) & (often < high)
            sent = np.bincount(whose, minlength=len(first)).astype(np.uint32)
            marks = np.concatenate([shingles[often[there]], often_counts[there].astype(np.uint64)])
            yield (bucket, batch, None, sent, b"", b"", part[by_owner], marks)

    names = ["bucket", "batch", "ids", "counts", "digests", "common", "shingles", "marks"]
    types = [pa.int32(), pa.int64(), None, pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ids, sets, held = WordHashes(), [], [], 0
        number, id_arrow = TaskContext.get().partitionId() << 32, pa.int64()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal ids, sets, held, number
            for row in rows_of(number, ids, sets, id_arrow):
                values = [x.tobytes() if isinstance(x, np.ndarray) else x for x in row]
                kinds = [pa.list_(pa.list_(id_arrow)) if t is None else t for t in types]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)
            ids, sets, held, number = [], [], 0, number + 1

        for given in batches:
            id_arrow = given.column(0).type
            texts = pc.cast(given.column(1), pa.binary())
            for doc_id, text in zip(given.column(0), texts, strict=True):
                ids.append(doc_id.as_py())
                sets.append(shingle_set(text.as_py() or b"", hashes, n))
                held += len(sets[-1])
                if held >= BATCH_SHINGLES or len(ids) >= 50_000:
                    yield from flush()
        if ids:
            yield from flush()

    schema = f"bucket int, batch long, ids array<array<{id_type}>>, counts binary, digests binary, common binary, shingles binary, marks binary"
    return docs.select("doc_id", "text").mapInArrow(hashed, schema)


def bucket_starts(buckets: int) -> np.ndarray:
    return np.array([(i << 64) // buckets for i in range(buckets)], np.uint64)


def numbers(value: bytes | None, kind) -> np.ndarray:
    return np.frombuffer(value or b"", kind)


def counted(part: pa.Table) -> pa.Table:
    """For each batch, the shingles of one bucket that stand in other sets too, and in how many."""
    rows = part.select(["batch", "counts", "shingles", "marks"]).to_pylist()
    shingles = np.concatenate([numbers(r["shingles"], np.uint64) for r in rows])
    distinct, place, found = np.unique(shingles, return_inverse=True, return_counts=True)
    found = np.minimum(found, COMMON_COUNT - 1).astype(np.uint32)
    for row in rows:
        marks = numbers(row["marks"], np.uint64)
        at = np.searchsorted(distinct, marks[: len(marks) // 2])
        at = at[(at < len(distinct)) & (distinct[np.minimum(at, len(distinct) - 1)] == marks[: len(marks) // 2])] if len(distinct) else at[:0]
        found[at] = COMMON_COUNT
    counts, out, begin = found[place], [], 0
    for row in rows:
        sent = numbers(row["counts"], np.uint32)
        end = begin + int(sent.sum())
        shared = counts[begin:end] > 1
        left = np.bincount(np.repeat(np.arange(len(sent)), sent)[shared], minlength=len(sent)).astype(np.uint32)
        out.append((row["batch"], left.tobytes(), shingles[begin:end][shared].tobytes(), counts[begin:end][shared].tobytes()))
        begin = end
    columns = zip(*out, strict=True)
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["batch", "counts", "shingles", "found"])


def sketch(shingles: np.ndarray) -> bytes:
    """Two sets differ in at least as many shingles as their sketches differ in bits."""
    spots = (shingles * MIX) >> np.uint64(64 - SKETCH.bit_length() + 1)
    return np.packbits(np.bincount(spots.astype(np.int64), minlength=SKETCH) % 2 == 1).tobytes()


def joined_sets(percent: int):
    def join_batch(part: pa.Table) -> pa.Table:
        """The sets of a batch with their shared shingles, from the rarest up."""
        rows = part.to_pylist()
        head = next(r for r in rows if r["ids"] is not None)
        sizes = numbers(head["sizes"], np.uint32).astype(np.int64)
        owners, shingles, found = [], [], []
        for row in rows:
            counts = numbers(row["counts"], np.uint32)
            owners.append(np.repeat(np.arange(len(counts)), counts))
            shingles.append(numbers(row["shingles"], np.uint64))
            known = numbers(row["found"], np.uint32)
            found.append(known if len(known) else np.full(len(shingles[-1]), COMMON_COUNT))
        owner, shingle, count = np.concatenate(owners), np.concatenate(shingles), np.concatenate(found)
        order = np.lexsort((shingle, count, owner))
        owner, shingle, count = owner[order], shingle[order], count[order]
        shared = np.bincount(owner, minlength=len(sizes))
        alone = sizes - shared
        ask = np.clip(prefix_length(sizes, percent) - alone, 0, None) * (sizes > 0)
        weight = np.bincount(owner, np.log2(np.minimum(count, 1 << 16)), minlength=len(sizes)) / np.maximum(sizes, 1)
        ends = np.cumsum(shared)
        kept = [shingle[e - s : e].view(np.int64) if a else shingle[:0].view(np.int64) for e, s, a in zip(ends, shared, ask, strict=True)]
        digests = [head["digests"][20 * i : 20 * i + 20] for i in range(len(sizes))]
        sketches = [sketch(k.view(np.uint64)) if len(k) else None for k in kept]
        arrays = [part.schema.field("ids").type.value_type, pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.binary()]
        values = [head["ids"], digests, sizes, ask, weight, kept, sketches]
        names = ["ids", "digest", "size", "ask", "centre", "shingles", "sketch"]
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(values, arrays, strict=True)], names=names)

    return join_batch


def set_table(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Stored distinct sets of each batch: ``ids`` of the documents, ``digest``, ``size``,
    ``ask`` (leading shared shingles that can link it), ``centre``, ``shingles`` (shared ones
    from the rarest up) and their ``sketch``, both only where ``ask`` > 0."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES + 1)
    batches = hashed_batches(docs, n, buckets)
    # Both halves come from one pass: the heads of batches ride along as bucket -1 - hash.
    spread = F.when(F.col("bucket") < 0, F.lit(-1) - F.pmod(F.col("batch"), F.lit(buckets))).otherwise(F.col("bucket"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = f"batch long, ids array<array<{id_type}>>, sizes binary, digests binary, counts binary, shingles binary, found binary"

    def passed(part: pa.Table) -> pa.Table:
        if part.column("bucket")[0].as_py() < 0:
            columns = ["batch", "ids", "counts", "digests", "common", "shingles"]
            head = part.select(columns).rename_columns(["batch", "ids", "sizes", "digests", "counts", "shingles"])
            return head.append_column("found", pa.nulls(len(part), pa.binary()))
        done, none = counted(part), part.schema.field("ids").type
        size = len(done)
        arrays = [done.column("batch"), pa.nulls(size, none), pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary()), *(done.column(c) for c in ("counts", "shingles", "found"))]
        return pa.Table.from_arrays(arrays, names=["batch", "ids", "sizes", "digests", "counts", "shingles", "found"])

    counts = batches.withColumn("deal", spread).groupBy("deal").applyInArrow(passed, out)
    schema = f"ids array<{id_type}>, digest binary, size long, ask long, centre double, shingles array<long>, sketch binary"
    return stored(counts.groupBy("batch").applyInArrow(joined_sets(percent), schema), "sets")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` whose sets ``a`` and ``b`` link, by counting their common shingles."""
    of = sets.select("sid", "size", "shingles")
    left = pairs.join(of.withColumnsRenamed({"sid": "a", "size": "size_a", "shingles": "shingles_a"}), "a")
    both = left.join(of.withColumnsRenamed({"sid": "b", "size": "size_b", "shingles": "shingles_b"}), "b")
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    counted = both.select(*pairs.columns, common.alias("common"), (F.col("size_a") + F.col("size_b")).alias("sizes"))
    return counted.where(100 * F.col("common") >= percent * (F.col("sizes") - F.col("common"))).select(*pairs.columns)


def mixed_lists(placed: DataFrame, *more) -> DataFrame:
    """Index lists that hold sets of several components."""
    ends = F.min("component").alias("low"), F.max("component").alias("high")
    return placed.groupBy("shingle").agg(*ends, *more).where("low <> high").drop("low", "high")


def ask_leaders(placed: DataFrame, sets: DataFrame, turn: int, percent: int) -> DataFrame:
    """Components that link when sets ask the leaders of their lists: ``a``, ``b``.

    First the most central set of a list leads, later one that a hash picks anew for each list.
    A set asks the leaders that it meets most often.
    """
    order = F.col("sid") if turn == 0 else F.xxhash64("sid", "shingle", F.lit(turn))
    leaders = mixed_lists(placed, F.max_by("sid", order).alias("b"), F.max_by("component", order).alias("of_b"))
    met = placed.join(leaders, "shingle").where("component <> of_b")
    asks = met.groupBy(F.col("sid").alias("a"), "b", F.col("component").alias("of_a"), "of_b").count()
    best = Window.partitionBy("a").orderBy(F.desc("count"), F.xxhash64("a", "b"))
    chosen = asks.withColumn("n", F.row_number().over(best)).where(F.col("n") <= ASKED[turn])
    links = linked(chosen.select("a", "b", "of_a", "of_b"), sets, percent)
    return links.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))


def merged_labels(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (``sid``, ``component``) after components that ``edges`` link have become one."""
    merged = components(edges).select(F.col("node").alias("component"), F.col("component").alias("becomes"))
    joined = labels.join(merged, "component", "left")
    return joined.select("sid", F.coalesce("becomes", "component").alias("component"))


def block_pairs(percent: int):
    def compare(part: pa.Table) -> pa.Table:
        """Pairs of two blocks of an index list that are of different components and whose sizes,
        positions and sketches allow a link."""
        column = {c: part.column(c).to_numpy() for c in ("sid", "size", "place", "component", "side", "alone")}
        order = np.argsort(column["place"], kind="stable")
        column = {c: v[order] for c, v in column.items()}
        sketches = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint64).reshape(len(order), -1)[order]
        one, two = np.flatnonzero(column["side"] != 1), np.flatnonzero(column["side"] != 0)
        rest = column["size"] - column["place"]  # shingles from the common one on
        found = []
        for i in range(0, len(one), 128):
            a = one[i : i + 128]
            need = -(-percent * (column["size"][a].min() + column["size"][two].min()) // (100 + percent)) if len(two) else 0
            if rest[a].max() < need:
                continue
            for j in range(0, len(two), 128):
                b = two[j : j + 128]
                if rest[b].max() < need:
                    continue
                sizes = column["size"][a][:, None] + column["size"][b]
                most = np.minimum(rest[a][:, None], rest[b])
                may = (100 + percent) * most >= percent * sizes
                may &= column["component"][a][:, None] != column["component"][b]
                x, y = np.nonzero(may)
                # Shingles of one set only: where the sketches differ, and those of no other set.
                apart = np.bitwise_count(sketches[a[x]] ^ sketches[b[y]]).sum(1, dtype=np.int64)
                apart += column["alone"][a[x]] + column["alone"][b[y]]
                near = (100 + percent) * apart <= (100 - percent) * sizes[x, y]
                x, y = x[near], y[near]
                found.append((column["sid"][a][x], column["sid"][b][y], column["place"][a][x], column["place"][b][y]))
        a, b, pa_, pb = (np.concatenate([f[k] for f in found]) if found else np.array([], np.int64) for k in range(4))
        low = a < b
        arrays = [np.where(low, a, b), np.where(low, b, a), np.where(low, pa_, pb), np.where(low, pb, pa_)]
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in arrays], names=["a", "b", "place_a", "place_b"])

    return compare


def similar_documents(
    docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``.

    Two documents link when their sets of distinct n-word shingles (A-Z in lower case, words
    parted by ASCII white space) have ``100 * intersection >= percent * union``; a component is
    named by its smallest id.  A text with fewer words is one shingle; null and empty texts have
    none and link with nothing.  Null ids name no component; rows that repeat an id link like
    any others.  An empty table gives an empty result; other columns are not read.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    table = set_table(named, n, percent)
    open_sets = table.where("ask > 0").groupBy("digest").agg(
        F.first("size").alias("size"), F.first("ask").alias("ask"),
        F.first("centre").alias("centre"), F.first("shingles").alias("shingles"), F.first("sketch").alias("sketch"),
    )
    # Sorted by centre, so that of two numbers the larger is the more central set.
    ordered = stored(open_sets.repartitionByRange("centre", "digest").sortWithinPartitions("centre", "digest"), "open-sets")
    sets = stored(ordered.withColumn("sid", F.monotonically_increasing_id()), "numbered-sets")
    first = F.expr("slice(shingles, 1, int(ask))")
    alone = F.col("size") - F.size("shingles")
    postings = sets.select("sid", "size", alone.alias("alone"), F.posexplode(first).alias("at", "shingle"))
    postings = stored(postings.select("shingle", "sid", "size", (F.col("alone") + F.col("at")).alias("place")), "postings")

    # Sets ask the leaders of their lists, and lists that come to hold one component are done.
    labels = sets.select("sid", F.col("sid").alias("component"))
    placed = postings.withColumn("component", F.col("sid"))
    for turn in range(len(ASKED)):
        labels = stored(merged_labels(labels, ask_leaders(placed, sets, turn, percent)), "labels")
        placed = placed.drop("component").join(labels, "sid")
        placed = stored(placed.join(mixed_lists(placed), "shingle", "left_semi"), "placed")

    # What is left is compared block by block.
    mixed = mixed_lists(placed, F.count("*").alias("n")).select("shingle", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    listed = placed.join(mixed, "shingle").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")))
    listed = listed.join(sets.select("sid", alone.alias("alone"), "sketch"), "sid")
    # Block i meets blocks i and above; side 0 and 1 are compared with each other, 2 with itself.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    carried = ["shingle", "sid", "size", "place", "component", "alone", "sketch"]
    dealt = listed.select(*carried, "block", other).select(
        *carried,
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    pairs = dealt.groupBy("shingle", "i", "j").applyInArrow(block_pairs(percent), "a long, b long, place_a long, place_b long")
    seen = pairs.groupBy("a", "b").agg(
        F.countDistinct("place_a").alias("met"), F.max("place_a").alias("place_a"), F.max("place_b").alias("place_b")
    )
    sizes = sets.select("sid", "size")
    sized = seen.join(sizes.withColumnsRenamed({"sid": "a", "size": "size_a"}), "a").join(sizes.withColumnsRenamed({"sid": "b", "size": "size_b"}), "b")
    most = F.col("met") + F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b")) - 1
    possible = sized.where((100 + percent) * most >= percent * (F.col("size_a") + F.col("size_b"))).select("a", "b")
    later = linked(stored(possible, "pairs"), sets, percent)
    of = labels.withColumnsRenamed({"sid": "a", "component": "of_a"}), labels.withColumnsRenamed({"sid": "b", "component": "of_b"})
    links = later.join(of[0], "a").join(of[1], "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    component = sets.select("digest", "sid").join(merged_labels(labels, links), "sid").drop("sid")
    documents = table.select("digest", "size", F.explode("ids").alias("doc_id"))
    smallest = documents.where("size > 0").groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    grouped = smallest.join(component, "digest", "left").withColumn("name", F.coalesce(F.col("component").cast("string"), F.hex("digest")))
    grouped = stored(grouped, "groups")
    names = grouped.groupBy("name").agg(F.min("least").alias("component_id"), F.sum("n").alias("n")).where(F.col("n") > 1)
    answers = grouped.join(names.drop("n"), "name").select("digest", "component_id")
    return spread_lookup(documents, answers, ["digest"], by="doc_id").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
