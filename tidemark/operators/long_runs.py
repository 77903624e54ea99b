"""Bursts of heavy keys, whose runs of fails may go on through any number of slices.

A burst is anchored at a fail and the next anchor is the first fail beyond its horizon, so
within a slice every fail points at a later one.  A slice does not know which of its first
fails is an anchor; it only depends on the time up to which the open burst reaches.  So a
slice becomes a step function from that time to the time up to which the burst open at its
end reaches, found by doubling the pointers.  The functions, one small row per slice, are
applied in the order of the slices, and then every slice finds its bursts by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType

from tidemark.operators.skew import SLICE, join_small

BURST = ["_from", "_to", "_ends", "cnt"]


def sliced_bursts(fails: DataFrame, keys: list[str], horizon_us: int) -> DataFrame:
    """``keys, _from, _to, _ends, cnt`` of all bursts in the ``fails`` of heavy keys.

    ``fails`` has ``_us``, ``_seq``, ``_slice``, ``_ends`` (the next row that is no fail) and
    ``_opens``: whether a fail opens a run, by what comes before it in any slice.
    """
    key_fields = [fails.schema[k] for k in keys]
    step_fields = [
        StructField("_open_before", BooleanType()),
        StructField("_through", BooleanType()),
        StructField("_up_to", ArrayType(LongType())),
        StructField("_reach", ArrayType(LongType())),
        StructField("_last_reach", LongType()),
    ]
    slice_field = StructField(SLICE, LongType())
    by_slice = fails.groupBy(*keys, SLICE)
    steps = by_slice.applyInArrow(
        _step_function(keys, horizon_us), StructType([*key_fields, slice_field, *step_fields])
    )
    # One row per slice: a bounded number, see ``skew``.
    reached = (
        steps.repartition(*keys)
        .sortWithinPartitions(*keys, SLICE)
        .mapInArrow(
            _in_order(keys), StructType([*key_fields, slice_field, StructField("_reached", LongType())])
        )
    )
    parts = (
        join_small(fails, reached, [*keys, SLICE])
        .groupBy(*keys, SLICE)
        .applyInArrow(
            _bursts(keys, horizon_us), StructType(key_fields + [StructField(c, LongType()) for c in BURST])
        )
    )
    # Parts of a burst in several slices.  Runs that begin at one instant end at different rows,
    # or else within the horizon, which discards both.
    return parts.groupBy(*keys, "_from", "_ends").agg(
        F.max("_to").alias("_to"), F.sum("cnt").alias("cnt")
    ).select(*keys, *BURST)


def _ordered(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    table = table.sort_by([("_us", "ascending"), ("_seq", "ascending")])
    opens = table.column("_opens").to_numpy()
    return table, table.column("_us").to_numpy(), opens.astype(bool)


def next_anchors(us: np.ndarray, opens: np.ndarray, horizon_us: int) -> np.ndarray:
    """The place of the first fail of the same run beyond the horizon of each, or the run's end."""
    n = len(us)
    heads = np.flatnonzero(opens)
    ends = np.append(heads, n)[np.searchsorted(heads, np.arange(n), side="right")]
    return np.minimum(np.searchsorted(us, us + horizon_us, side="right"), ends)


def last_anchors(following: np.ndarray) -> np.ndarray:
    """Where the pointers lead from each place before they leave the table."""
    here = np.arange(len(following))
    to = np.where(following < len(following), following, here)
    while True:
        further = to[to]
        if (further == to).all():
            return to
        to = further


def anchors_from(starts: np.ndarray, following: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """All places that the pointers visit from ``starts``, each within its run."""
    n = len(following)
    # A place that begins a run is a start already, so pointers stop before it.
    stop = np.append(opens, True)
    to = np.append(np.where(stop[following], n, following), n)
    seen = np.zeros(n + 1, bool)
    seen[starts] = True
    while True:
        reached = to[np.flatnonzero(seen)]
        if seen[reached[reached < n]].all():
            return np.flatnonzero(seen[:n])
        seen[reached] = True
        to = to[to]


def _step_function(keys: list[str], horizon_us: int):
    def step(table: pa.Table) -> pa.Table:
        table, us, opens = _ordered(table)
        heads = np.flatnonzero(opens)
        end = int(heads[0]) if len(heads) else len(us)  # of the run from before
        up_to, reach, last = [], [], None
        if end == len(us):
            # An anchor before this slice reaches less than a horizon beyond its first fail.
            tried = min(int(np.searchsorted(us, us[0] + horizon_us, side="right")) + 1, end)
            to = us[last_anchors(next_anchors(us, opens, horizon_us))[:tried]] + horizon_us
            keep = np.append(to[1:] != to[:-1], True)
            up_to, reach = us[:tried][keep].tolist(), to[keep].tolist()
        else:
            start = int(heads[-1])
            following = next_anchors(us[start:], opens[start:], horizon_us)
            last = int(us[start + last_anchors(following)[0]]) + horizon_us
        first = {k: [table.column(k)[0].as_py()] for k in [*keys, SLICE]}
        values = {"_open_before": [end > 0], "_through": [end == len(us)], "_up_to": [up_to], "_reach": [reach], "_last_reach": [last]}
        lists = {"_up_to": pa.list_(pa.int64()), "_reach": pa.list_(pa.int64()), "_last_reach": pa.int64()}
        columns = [pa.array(v, table.schema.field(k).type) for k, v in first.items()]
        columns += [pa.array(v, lists.get(k, pa.bool_())) for k, v in values.items()]
        return pa.Table.from_arrays(columns, names=[*first, *values])

    return step


def _in_order(keys: list[str]):
    """Apply the step functions of a key in the order of its slices; gives the reach of the burst
    that is open when a slice begins, where its first fails go on with a run."""

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, reach = None, None
        for batch in batches:
            rows, found = batch.to_pylist(), []
            for row in rows:
                if key != [row[k] for k in keys]:
                    key, reach = [row[k] for k in keys], None
                found.append(reach if row["_open_before"] else None)
                if not row["_through"]:
                    reach = row["_last_reach"]
                elif row["_up_to"] and row["_up_to"][-1] > reach:
                    reach = row["_reach"][int(np.searchsorted(row["_up_to"], reach, side="right"))]
            columns = [batch.column(c) for c in [*keys, SLICE]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.int64())], [*keys, SLICE, "_reached"])

    return carry


def _bursts(keys: list[str], horizon_us: int):
    def walk(table: pa.Table) -> pa.Table:
        table, us, opens = _ordered(table)
        reached = table.column("_reached")[0].as_py()
        following = next_anchors(us, opens, horizon_us)
        heads = np.flatnonzero(opens)
        end = int(heads[0]) if len(heads) else len(us)
        inside = int(np.searchsorted(us[:end], reached, side="right")) if end else 0
        starts = np.append(heads, inside) if inside < end else heads
        anchors = anchors_from(starts, following, opens)
        begins = np.unique(np.append(anchors, 0)) if inside else anchors
        first = us[begins].copy()
        if inside:
            first[0] = reached - horizon_us  # its anchor lies in an earlier slice
        sizes = np.diff(begins, append=len(us))
        values = [first, us[begins + sizes - 1], table.column("_ends").combine_chunks().take(pa.array(begins)), sizes]
        of_keys = [table.column(k).combine_chunks().take(pa.array(begins)) for k in keys]
        arrays = [v if isinstance(v, pa.Array) else pa.array(v, pa.int64()) for v in values]
        return pa.Table.from_arrays([*of_keys, *arrays], names=[*keys, *BURST])

    return walk
