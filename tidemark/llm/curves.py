"""Approximate nearest neighbours on several shifted Hilbert curves.

Vectors are projected to a few random directions, laid on a shifted grid, and ordered along the
Hilbert curve through it, several times with other directions and shifts.  Spark range-sorts
each ordering; a query is compared with the vectors whose places lie near its own, and the
findings of all curves are merged and ranked by the exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.mixing import running_total
from tidemark.llm.tables import spread_lookup, stored

#: Curves, directions of each, bits of a grid coordinate (directions * bits < 63).
CURVES, DIRECTIONS, BITS = 24, 12, 5

#: A query meets the vectors of so many places on either side on each curve: a share of all
#: vectors, at least LEAST_REACH.  Vectors without any structure need a fixed share for a fixed
#: recall; where near vectors are much nearer than others a smaller one will do.
REACH, LEAST_REACH = 0.025, 256

#: Places of a curve that one task compares at a time.
BLOCK = 2048


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points given by unsigned grid coordinates, a row each.

    From the highest bit down, the part of the curve inside the cube a point lies in is mirrored
    or turned so that it becomes the standard one; what remains is a Gray code, read bit by bit.
    """
    axes = grid.T.astype(np.int64)
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for axis in axes:
            upper = (axis >> bit & 1).astype(bool)
            swap = np.where(upper, 0, (axes[0] ^ axis) & below)
            axes[0] ^= np.where(upper, below, swap)
            axis ^= swap  # nothing for the first axis itself
    axes = np.bitwise_xor.accumulate(axes, axis=0)
    parity = np.zeros_like(axes[0])
    for bit in range(bits - 1, 0, -1):
        parity ^= np.where(axes[-1] >> bit & 1, (1 << bit) - 1, 0)
    axes ^= parity
    key = np.zeros(len(grid), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = key << 1 | axis >> bit & 1
    return key


def vectors_of(column: pa.Array, kind: str) -> np.ndarray:
    """Rows of doubles from a column of byte strings that hold numbers of ``kind``."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(float)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable_vectors(rows: DataFrame, id_col: str, vector_col: str, kind: str) -> DataFrame:
    """``vec_id`` and ``bytes`` of the vectors that take part: of the most frequent length,
    not null or zero, without null or non-finite components."""
    lengths = rows.where(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("n")).count()
    most = lengths.orderBy(F.desc("count"), "n").first()
    dimension = most["n"] if most else 0

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = pc.fill_null(pc.list_flatten(lists), float("nan")).to_numpy(zero_copy_only=False)
            x = flat.astype(kind, copy=False).reshape(-1, dimension) if batch.num_rows else np.empty((0, dimension), kind)
            norm = np.linalg.norm(x.astype(float), axis=1)
            good = np.isfinite(norm) & (norm > 0)
            data = pa.array([row.tobytes() for row in x[good]], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), data], ["vec_id", "bytes"])

    fitting = rows.where(F.size(vector_col) == dimension).select(F.col(id_col).alias("vec_id"), vector_col)
    id_type = rows.schema[id_col].dataType.simpleString()
    return fitting.where(F.col("vec_id").isNotNull()).mapInArrow(packed, f"vec_id {id_type}, bytes binary")


def moments(vectors: DataFrame, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of all unit vectors."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                u = unit(vectors_of(batch.column(0), kind))
                part = np.concatenate([[len(u)], u.sum(0), (u.T @ u).ravel()])
                total = part if total is None else total + part
        if total is not None:
            columns = [pa.array(range(len(total)), pa.int32()), pa.array(total, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["k", "value"])

    found = vectors.select("bytes").mapInArrow(sums, "k int, value double").groupBy("k").agg(F.sum("value").alias("v"))
    total = np.array([row["v"] for row in found.orderBy("k").collect()])
    if not len(total):
        return np.zeros(0), np.zeros((0, 0))
    d = int((np.sqrt(4 * len(total) - 3) - 1) / 2)
    mean = total[1 : d + 1] / total[0]
    return mean, total[d + 1 :].reshape(d, d) / total[0] - np.outer(mean, mean)


def curve_keys(
    distinct: DataFrame, kind: str, curves: int, directions: int, bits: int, seed: int = 1
) -> DataFrame:
    """``vec_id``, ``curve``, ``key``: the place of every vector on every curve."""
    mean, covariance = moments(distinct, kind)
    d, dice = len(mean), np.random.default_rng(seed)
    directions = min(directions, d)
    plans = []
    for _ in range(curves if d else 0):
        turn = np.linalg.qr(dice.normal(size=(d, d)))[0][:, :directions]
        spread = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", turn, covariance, turn), 1e-18))
        # The grid spans about eight deviations and is shifted by up to a fifth of that.
        plans.append((turn, spread, 3.2 + 1.6 * dice.random(directions)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            u = unit(vectors_of(batch.column(1), kind)) - mean
            for curve, (turn, spread, shift) in enumerate(plans):
                cells = ((u @ turn) / spread + shift) / 8 * (1 << bits)
                keys = hilbert_keys(np.clip(cells, 0, (1 << bits) - 1).astype(np.int64), bits)
                columns = [batch.column(0), pa.array(np.full(len(u), curve, np.int32)), pa.array(keys)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "curve", "key"])

    id_type = distinct.schema["vec_id"].dataType.simpleString()
    return distinct.select("vec_id", "bytes").mapInArrow(keyed, f"vec_id {id_type}, curve int, key long")


def nearest(
    rows: DataFrame,
    is_query,
    k: int = 5,
    curves: int = CURVES,
    directions: int = DIRECTIONS,
    bits: int = BITS,
    reach: float = REACH,
    least_reach: int = LEAST_REACH,
    block: int = BLOCK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: of every vector whose id ``is_query`` picks
    the ``k`` nearest found among all others, by cosine, ties to the smaller id.

    ``is_query`` is a function of the id column.  Null, zero and non-finite vectors, vectors of
    another length than most and rows without an id take no part.  Equal vectors are found
    together: the curves hold one of them, with the smallest ``k + 1`` ids.  Rows that repeat an
    id and vector count once.  With fewer than ``k`` candidates all are returned, and an empty
    table gives an empty result; other columns are not read.
    """
    kind = "<f8" if "double" in rows.schema[vector_col].dataType.simpleString() else "<f4"
    vectors = stored(usable_vectors(rows, id_col, vector_col, kind).distinct(), "vectors")
    # Most k + 1 smallest ids of equal vectors matter; the limit applies before the shuffle.
    first = Window.partitionBy("bytes").orderBy("vec_id")
    few = vectors.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    distinct = stored(
        few.groupBy("bytes")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("vec_id"), "ids", "bytes"),
        "vectors-distinct",
    )
    queries = vectors.where(is_query(F.col("vec_id"))).withColumnRenamed("vec_id", "query_id")
    owners = stored(
        spread_lookup(queries, distinct.select("bytes", "vec_id"), ["bytes"], by="query_id").select("query_id", "vec_id"),
        "vectors-queries",
    )
    places = running_total(
        curve_keys(distinct, kind, curves, directions, bits).withColumn("one", F.lit(1)),
        ["key", "vec_id"], "one", ["curve"], "curves",
    )
    wide = max(least_reach, int(reach * distinct.count()))
    asked = owners.select("vec_id").distinct().withColumn("asked", F.lit(True))
    spots = (
        places.groupBy("vec_id")
        .agg(F.collect_list(F.struct("curve", (F.col("so_far") - 1).alias("place"))).alias("spots"))
        .join(distinct.select("vec_id", "bytes"), "vec_id")
        .join(asked, "vec_id", "left")
        .select("vec_id", "bytes", "asked", F.explode("spots").alias("spot"))
        .select("vec_id", "bytes", "asked", "spot.curve", "spot.place")
    )
    whole = lambda place: F.floor(place / block).cast("int")
    members = spots.select("curve", whole(F.col("place")).alias("block"), "vec_id", "bytes", F.lit(None).cast("long").alias("at"), "place")
    nearby = F.sequence(whole(F.greatest(F.col("place") - wide, F.lit(0))), whole(F.col("place") + wide))
    asking = spots.where("asked").select("curve", F.explode(nearby).alias("block"), "vec_id", "bytes", F.col("place").alias("at"), "place")

    def compared(part: pa.Table) -> pa.Table:
        is_asking = part.column("at").is_valid()
        given, asked = part.filter(pc.invert(is_asking)), part.filter(is_asking)
        if not given.num_rows or not asked.num_rows:
            return pa.Table.from_arrays([part.column("vec_id")[:0], part.column("vec_id")[:0], pa.array([], pa.float64())], names=names)
        ids, places = given.column("vec_id").to_numpy(), given.column("place").to_numpy()
        x = vectors_of(given.column("bytes").combine_chunks(), kind)
        norms, found = np.linalg.norm(x, axis=1), []
        for start in range(0, asked.num_rows, 256):
            ask = asked.slice(start, 256)
            q = vectors_of(ask.column("bytes").combine_chunks(), kind)
            scores = (q @ x.T) / (np.linalg.norm(q, axis=1)[:, None] * norms)
            far = np.abs(ask.column("at").to_numpy()[:, None] - places) > wide
            scores[far] = -np.inf
            best = np.argsort(-scores, axis=1, kind="stable")[:, : k + 1] if len(ids) <= k + 1 else np.argpartition(-scores, k, axis=1)[:, : k + 1]
            asker = np.repeat(ask.column("vec_id").to_numpy(), best.shape[1])
            score = np.take_along_axis(scores, best, 1).ravel()
            near = np.isfinite(score)
            found.append((asker[near], ids[best.ravel()][near], score[near]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=names)

    names = ["asker", "vec_id", "score"]
    id_type = rows.schema[id_col].dataType.simpleString()
    found = members.unionAll(asking).groupBy("curve", "block").applyInArrow(compared, f"asker {id_type}, vec_id {id_type}, score double")
    best = Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id")
    merged = (
        found.groupBy("asker", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("n", F.row_number().over(best))
        .where(F.col("n") <= k + 1)
        .join(distinct.select("vec_id", "ids"), "vec_id")
        .groupBy("asker")
        .agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    )
    # A query of a large group of equal vectors shares its findings with the whole group.
    answers = spread_lookup(owners.withColumnRenamed("vec_id", "asker"), merged, ["asker"], by="query_id", how="inner")
    flat = answers.select("query_id", F.explode("found").alias("f")).select("query_id", "f.score", F.explode("f.ids").alias("vec_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        flat.where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
