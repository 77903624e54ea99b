"""Sliding counts on a stream at a cost that does not grow with the number of overlapping windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

# Names that do not begin with an underscore reach the worker unchanged.
PANE, NO_KEY = "tidemark_pane", "tidemark_no_key"

RING = "panes array<bigint>, counts array<bigint>, upto bigint"


class Ring:
    """Rows per pane of one key, for the panes that an open window covers.

    A window's count is the difference of two running sums over the panes.  ``upto`` is the
    end of the latest window that was given out.
    """

    def __init__(self, size: int, slide: int, panes=(), counts=(), upto: int | None = None):
        self.size, self.slide, self.upto = size, slide, upto
        self.panes, self.counts = np.array(panes, np.int64), np.array(counts, np.int64)

    def add(self, panes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends and counts of the windows that change, up to the one of the latest pane."""
        self.panes, at = np.unique(np.append(self.panes, panes), return_inverse=True)
        self.counts = np.bincount(at, np.append(self.counts, counts)).astype(np.int64)
        upto = int(self.panes[0]) if self.upto is None else self.upto
        # Windows given out before that cover a pane of these, then those that are reached now.
        width = np.arange(self.slide, self.size + self.slide, self.slide)
        again = np.unique((np.unique(panes)[:, None] + width).ravel())
        again = again[again <= upto]
        head = int(self.panes[-1]) + self.slide
        return self.counted(np.append(again, self.ends(upto, head)))

    def advance(self, now: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows that end up to ``now`` and were not given out; panes behind them go."""
        found = self.counted(self.ends(self.upto, now // self.slide * self.slide))
        open_ = self.panes + self.size > now
        self.panes, self.counts = self.panes[open_], self.counts[open_]
        return found

    def ends(self, upto: int, end: int) -> np.ndarray:
        """Ends behind ``upto``, up to ``end``, of windows that cover a pane."""
        if not len(self.panes):
            return np.zeros(0, np.int64)
        self.upto = max(upto, end)
        last = min(end, int(self.panes[-1]) + self.size)
        return np.arange(upto + self.slide, last + 1, self.slide, dtype=np.int64)

    def counted(self, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = np.append(0, np.cumsum(self.counts))
        counts = sums[np.searchsorted(self.panes, ends)] - sums[np.searchsorted(self.panes, ends - self.size)]
        return ends[counts > 0], counts[counts > 0]

    def due(self) -> int | None:
        """When the next window ends that has rows, or else the first pane is of no more use."""
        if not len(self.panes):
            return None
        open_ = self.panes[self.panes + self.size > self.upto]
        return max(self.upto, int(open_[0])) + self.slide if len(open_) else int(self.panes[0]) + self.size


class PaneRing(StatefulProcessor):
    """One state entry per key, its ring; a timer for the next window that ends."""

    def __init__(self, keys: list[str], size: int, slide: int, out: str):
        self.keys, self.size, self.slide, self.out = keys, size, slide, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", RING)

    def _load(self) -> Ring:
        return Ring(self.size, self.slide, *(self.ring.get() or ()))

    def _save(self, ring: Ring) -> None:
        due = ring.due()
        if due is None:
            self.ring.clear()
        else:
            self.ring.update((ring.panes.tolist(), ring.counts.tolist(), ring.upto))
            self.handle.registerTimer(-(-due // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found: dict[int, int] = {}
        for part in rows:
            for pane, count in part[PANE].value_counts().items():
                found[pane] = found.get(pane, 0) + count
        ring = self._load()
        changed = ring.add(np.array(list(found)), np.array(list(found.values())))
        self._save(ring)
        yield self._rows(key, *changed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.ring.exists():
            ring = self._load()
            closed = ring.advance(timerValues.getCurrentWatermarkInMs() * 1000)
            self._save(ring)
            yield self._rows(key, *closed)

    def _rows(self, key, ends, counts) -> pd.DataFrame:
        of_key = {k: pd.Series([v] * len(ends), dtype=object) for k, v in zip(self.keys, key, strict=True)}
        return pd.DataFrame({**of_key, "_end": ends, self.out: counts})

    def close(self) -> None:
        pass


def window_count_updates(df: DataFrame, keys: list[str], size: int, slide: int, ts: str, out: str) -> DataFrame:
    """``keys, _end, out`` of the windows (in microseconds) that a micro-batch changes."""
    pane = F.unix_micros(F.col(ts).cast("timestamp"))
    by = keys or [NO_KEY]
    fed = df.select(*(F.col(k) for k in keys), F.lit(0).alias(NO_KEY), F.col(ts), (pane - F.pmod(pane, F.lit(slide))).alias(PANE))
    schema = StructType([fed.schema[k] for k in by] + [StructField("_end", LongType()), StructField(out, LongType())])
    ring = PaneRing(by, size, slide, out)
    found = fed.groupBy(*by).transformWithStateInPandas(ring, schema, "update", "EventTime")
    return found.select(*keys, "_end", out)
