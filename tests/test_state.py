"""What the stream operators keep per key, tried without a stream."""

import random

import numpy as np
import pytest
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.streaming import machines
from tidemark.streaming.panes import Ring
from tidemark.streaming.waiting import BUCKET, Waiting


class MapState(dict):
    """A map state that counts what is read."""

    def __init__(self):
        self.reads = 0

    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        self.reads += 1
        return self[key]

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]

    def iterator(self):
        return iter(list(self.items()))


class Handle:
    def __init__(self):
        self.maps = {}

    def getMapState(self, name, key, value):
        return self.maps.setdefault(name, MapState())


def waiting():
    handle = Handle()
    return Waiting(handle, StructType([StructField("us", LongType())])), handle


def test_rows_come_back_in_time_once():
    rng = random.Random(1)
    kept, _ = waiting()
    rows = [(rng.randrange(-5 * BUCKET, 50 * BUCKET), k) for k in range(2000)]
    for start in range(0, len(rows), 300):
        assert kept.add(rows[start : start + 300]) == min(rows[start : start + 300])[0]
    out, now = [], -6 * BUCKET
    while kept.first() is not None:
        now = max(now + rng.randrange(3 * BUCKET), kept.first())
        ready = [row for bucket in kept.due(now) for row in sorted(bucket)]
        assert all(row[0] <= now for row in ready)
        out += ready
        if rng.random() < 0.3:  # a row that comes meanwhile
            late = (now + 1 + rng.randrange(9 * BUCKET), len(rows))
            rows.append(late)
            kept.add([late])
    assert out == sorted(rows, key=lambda r: r[0]) or sorted(out) == sorted(rows)
    assert [row[0] for row in out] == sorted(row[0] for row in rows)


def test_a_timer_reads_the_buckets_that_are_due_only():
    kept, handle = waiting()
    for batch in range(20):
        kept.add((second * BUCKET + batch, batch) for second in range(50_000))
    parts = handle.maps["waiting_rows"]
    assert len(parts) == 1_000_000  # a million waiting rows
    parts.reads = 0
    assert sum(map(len, kept.due(2 * BUCKET - 1))) == 40
    assert parts.reads == 40 and len(parts) == 999_960


def run(machine, rows, until):
    """All rows of a key in order, the machine being told of every instant it asks for."""
    memory, out = {}, []
    for us, tag in [*rows, (until, None)]:
        while (due := machine.due(memory)) is not None and due <= us:
            out += [(due, v["_kind"]) for v in machine.advance(memory, due)]
        if tag is not None:
            out += [(us, v["_kind"]) for v in machine.step(memory, us, tag, None)]
    return out, memory


def test_marks_of_ended_keys_go():
    machine = machines.Lifecycle(deadline=5, wait=20, keep=100)
    assert run(machine, [(0, 1), (3, 2)], 119) == ([(3, "paid")], {"over": 120})
    assert run(machine, [(0, 1), (3, 2)], 120) == ([(3, "paid")], {})
    # While the mark stays nothing follows; afterwards the key begins anew.
    assert run(machine, [(0, 1), (3, 2), (60, 1)], 400)[0] == [(3, "paid")]
    assert run(machine, [(0, 1), (130, 1)], 400) == ([(5, "timeout"), (135, "timeout")], {})
    assert run(machine, [(0, 2)], 400) == ([(20, "no_create")], {})


@pytest.mark.parametrize("ratio", [1, 6, 720])
def test_ring_of_panes(ratio):
    """The last count of every window is the batch's, whatever comes late and early."""
    rng = random.Random(ratio)
    slide, size, out, rows = 5, 5 * ratio, {}, []
    ring, now = Ring(size, slide), -10**9
    for _ in range(60):
        times = [max(now + 1, rng.randrange(4000)) for _ in range(rng.randrange(1, 30))]
        rows += times
        panes, counts = np.unique([t - t % slide for t in times], return_counts=True)
        given = list(zip(*ring.add(panes, counts)))
        assert all(end <= max(rows) - max(rows) % slide + slide for end, _ in given)
        out.update(given)
        if rng.random() < 0.2:
            now = max(now, max(rows) - rng.randrange(400))
            out.update(zip(*ring.advance(now)))
        assert len(ring.panes) <= (max(rows) - max(now, min(rows)) + size) // slide + 2
    while (due := ring.due()) is not None:
        out.update(zip(*ring.advance(due)))
    want = {}
    for t in rows:
        for end in range(t - t % slide + slide, t - t % slide + size + 1, slide):
            want[end] = want.get(end, 0) + 1
    assert {int(k): int(v) for k, v in out.items()} == want
    assert not len(ring.panes)
