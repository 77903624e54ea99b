"""What the stateful stream operators do with one row or one instant.

A machine keeps a small JSON-able memory per key.  ``step`` sees the rows of the key in
event-time order; ``advance`` is told that no row before ``now`` is missing any more and
emits what that decides; ``due`` names the next instant at which it wants to be told.
Times are microseconds.  Emitted dictionaries fill the columns of ``replay.OUTPUT``.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass


@dataclass(frozen=True)
class Pairs:
    """Neighbouring rows, tag bit 1 on the first and bit 2 on the second."""

    within: int

    def step(self, memory, us, tag, body):
        last = memory.get("last")
        memory["last"] = [us, tag]
        if last and last[1] & 1 and tag & 2 and us - last[0] < self.within:
            yield {"_a": last[0], "_b": us}

    def advance(self, memory, now):
        if memory and now >= memory["last"][0] + self.within:
            memory.clear()
        return ()

    def due(self, memory):
        return memory["last"][0] + self.within if memory else None


@dataclass(frozen=True)
class Bursts:
    """Fails (tag 1) within the horizon of the first one; any other row there discards them."""

    horizon: int
    min_count: int

    def step(self, memory, us, tag, body):
        if not tag:
            memory.clear()
        elif memory:
            memory["to"] = us
            memory["n"] += 1
        else:
            memory.update({"from": us, "to": us, "n": 1})
        return ()

    def advance(self, memory, now):
        if memory and now > memory["from"] + self.horizon:
            if memory["n"] >= self.min_count:
                yield {"_a": memory["from"], "_b": memory["to"], "_n": memory["n"]}
            memory.clear()

    def due(self, memory):
        return memory["from"] + self.horizon + 1 if memory else None


@dataclass(frozen=True)
class Follows:
    """Every first row (tag bit 1) waits for the next second row (tag bit 2)."""

    within: int

    def step(self, memory, us, tag, body):
        if tag & 2:
            for start in memory.pop("open", ()):
                yield {"_a": start, "_b": us, "_kind": "matched"}
        if tag & 1:
            memory.setdefault("open", []).append(us)

    def advance(self, memory, now):
        waiting = memory.pop("open", [])
        late = bisect_right(waiting, now - self.within)
        for start in waiting[:late]:
            yield {"_a": start, "_kind": "timeout"}
        if waiting[late:]:
            memory["open"] = waiting[late:]

    def due(self, memory):
        return memory["open"][0] + self.within if memory.get("open") else None


@dataclass(frozen=True)
class Lifecycle:
    """One status per key, of the rows less than ``wait`` after its first one.

    Tag bit 1 is the first kind of row, bit 2 the second.  Of a key that is over only a mark
    stays, so that a later row gives no second status; it goes ``keep`` after the ``wait`` has
    ended, so the state does not grow with the number of keys there ever were.
    """

    deadline: int
    wait: int
    keep: int

    def step(self, memory, us, tag, body):
        if "over" in memory:
            return
        memory.setdefault("since", us)
        if tag & 1:
            memory.setdefault("create", us)
        if tag & 2:
            memory.setdefault("pay", us)
        create, pay = memory.get("create"), memory.get("pay")
        if create is not None and pay is not None and pay < create + self.deadline:
            yield from self._status(memory, "paid")

    def advance(self, memory, now):
        if "over" in memory and now >= memory["over"]:
            memory.clear()
        if not memory or "over" in memory:
            return
        if now >= memory["since"] + self.wait:
            yield from self._status(memory, "timeout" if "create" in memory else "no_create")
        elif "create" in memory and now >= memory["create"] + self.deadline:
            yield from self._status(memory, "timeout")

    def _status(self, memory, status):
        pay = None if status == "timeout" else memory.get("pay")
        out = {"_a": memory.get("create"), "_b": pay, "_kind": status}
        over = memory["since"] + self.wait + self.keep
        memory.clear()
        memory["over"] = over
        yield out

    def due(self, memory):
        if not memory:
            return None
        if "over" in memory:
            return memory["over"]
        forget = memory["since"] + self.wait
        return min(forget, memory["create"] + self.deadline) if "create" in memory else forget


@dataclass(frozen=True)
class Reconcile:
    """One pending row per key; a near row of the other side (tag 0 or 1) takes it."""

    tolerance: int
    tag_first = True  # of equal times, the left side comes first

    def step(self, memory, us, tag, body):
        if memory and memory["tag"] != tag:
            sides = {memory["tag"]: memory["body"], tag: body}
            memory.clear()
            yield {"_kind": "matched", "_left": sides[0], "_right": sides[1]}
            return
        yield from self._alone(memory)
        memory.update({"us": us, "tag": tag, "body": body})

    def advance(self, memory, now):
        if memory and now > memory["us"] + self.tolerance:
            yield from self._alone(memory)

    def _alone(self, memory):
        if memory:
            side = "right" if memory["tag"] else "left"
            yield {"_kind": f"{side}_only", f"_{side}": memory["body"]}
        memory.clear()

    def due(self, memory):
        return memory["us"] + self.tolerance + 1 if memory else None


@dataclass(frozen=True)
class Cap:
    """The first ``passes`` rows of a period pass, the next one warns, later ones are dropped."""

    passes: int
    period: int

    def step(self, memory, us, tag, body):
        memory.setdefault("end", us - us % self.period + self.period)
        memory["n"] = memory.get("n", 0) + 1
        if memory["n"] <= self.passes + 1:
            yield {"_a": us, "_kind": "pass" if memory["n"] <= self.passes else "warn", "_left": body}

    def advance(self, memory, now):
        if memory and now >= memory["end"]:
            memory.clear()
        return ()

    def due(self, memory):
        return memory["end"] if memory else None
