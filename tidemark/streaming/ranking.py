"""Rankings of a stream of counts, refined as the counts come."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.streaming.waiting import plain


class Best:
    """The ``n`` largest of the counts seen so far; a count that comes again replaces the old one.

    Counts only grow, so a row that has fallen out need not be remembered: it comes again
    when it belongs in.  Equal counts are ranked by ``tie`` ascending, without it last.
    """

    def __init__(self, n: int, cnt: int, tie: int, same: list[int], rows=()):
        self.n, self.cnt, self.tie, self.same = n, cnt, tie, same
        self.rows = {self._name(row): row for row in rows}

    def _name(self, row: tuple) -> tuple:
        return tuple(row[k] for k in self.same)

    def _order(self, row: tuple) -> tuple:
        tie = row[self.tie]
        return -row[self.cnt], tie is not None, tie if tie is not None else 0

    def add(self, rows: Iterator[tuple]) -> None:
        for row in rows:
            name = self._name(row)
            known = self.rows.get(name)
            if known is None or known[self.cnt] < row[self.cnt]:
                self.rows[name] = row
            if len(self.rows) > 2 * self.n + 100:
                self._cut()
        self._cut()

    def _cut(self) -> None:
        self.rows = {self._name(row): row for row in heapq.nsmallest(self.n, self.rows.values(), key=self._order)}

    def ranked(self) -> list[tuple]:
        return sorted(self.rows.values(), key=self._order)


class TopOfWindow(StatefulProcessor):
    def __init__(self, names: list[str], row: StructType, n: int, cnt: str, tie: str, window_end: str):
        self.names, self.row, self.window_end = names, row, window_end
        self.same = [k for k, name in enumerate(names) if name not in (cnt, window_end)]
        self.n, self.cnt, self.tie = n, names.index(cnt), names.index(tie)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", self.row)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [plain(row) for row in self.best.get()] if self.best.exists() else []
        best = Best(self.n, self.cnt, self.tie, self.same, held)
        before = best.ranked()
        best.add(plain(tuple(row[name] for name in self.names)) for row in rows)
        now = best.ranked()
        self.best.put(now)
        self.handle.registerTimer(int(key[0].timestamp() * 1000) + 1)
        for rank, row in enumerate(now, 1):
            if rank > len(before) or before[rank - 1] != row:
                yield Row(*self.names, "rank")(*row, rank)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.best.clear()
        return iter(())

    def close(self) -> None:
        pass


def top_n(counts: DataFrame, n: int, tie: str, cnt: str, window_end: str) -> DataFrame:
    """The ranks that change in a micro-batch (update mode); ``n`` rows per window are kept, until
    the watermark passes its end."""
    names = counts.columns
    schema = StructType([*counts.schema.fields, StructField("rank", IntegerType())])
    ranking = TopOfWindow(names, counts.schema, n, cnt, tie, window_end)
    return counts.groupBy(window_end).transformWithState(ranking, schema, "update", "EventTime")
