"""Small event tables and plain-Python versions of the operators to compare with."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

EPOCH = datetime(1970, 1, 1)
BASE = 1_700_000_000


def at(seconds: float) -> datetime:
    """Naive UTC time ``seconds`` after a base that is no multiple of the windows."""
    return EPOCH + timedelta(seconds=BASE + seconds)


def frame(spark, rows, schema):
    """A table whose ``ts`` is given in seconds after the base."""
    names = [part.split()[0] for part in schema.split(",")]
    if "ts" in names:
        i = names.index("ts")
        rows = [
            (*row[:i], at(row[i]).replace(tzinfo=timezone.utc), *row[i + 1 :]) for row in rows
        ]
    return spark.createDataFrame(rows, schema)


def rows_of(df, *columns):
    """Sorted tuples; times become seconds after the base."""

    def plain(value):
        if isinstance(value, datetime):
            return round((value - EPOCH).total_seconds() - BASE, 6)
        return value

    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(plain(v) for v in row) for row in picked.collect()),
        key=lambda r: [(v is None, str(type(v)), v) for v in r],
    )


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(type(v)), v) for v in r])


def random_log(seed, n=120, span=60, states=("fail", "ok"), users=("hot", "b", "c", None)):
    """``(user, state, ts, seq)`` rows, one user holding most of them, with equal times."""
    rng = random.Random(seed)
    weights = [6] + [1] * (len(users) - 1)
    return [
        (rng.choices(users, weights)[0], rng.choice(states), rng.randrange(span), seq)
        for seq in range(n)
    ]


def by_user(rows):
    groups = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[2], r[3])):
        groups[row[0]].append(row)
    return groups


def sliding_counts(rows, size, slide):
    """``(key, end) -> count`` for ``(key, ts)`` rows; ends relative to the base."""
    counts = Counter()
    for key, ts in rows:
        start = (BASE + ts) // slide * slide
        while start > BASE + ts - size:
            counts[key, start + size - BASE] += 1
            start -= slide
    return counts


def pairs(rows, within):
    out = []
    for user, log in by_user(rows).items():
        for a, b in zip(log, log[1:]):
            if a[1] == b[1] == "fail" and b[2] - a[2] < within:
                out.append((user, a[2], b[2]))
    return ordered(out)


def bursts(rows, horizon, min_count):
    """A list per user: a success clears it, its timer gives it out if it is long enough."""
    out = []

    def fire(user, current):
        if len(current) >= min_count:
            out.append((user, current[0], current[-1], len(current)))

    for user, log in by_user(rows).items():
        current = []
        for _, state, ts, _ in log:
            if current and ts > current[0] + horizon:
                fire(user, current)
                current = []
            if state == "fail":
                current.append(ts)
            else:
                current = []
        fire(user, current)
    return ordered(out)


def follows(rows, within):
    out = []
    for user, log in by_user(rows).items():
        for i, (_, state, ts, _) in enumerate(log):
            if state == "create":
                later = [r[2] for r in log[i + 1 :] if r[1] == "pay"]
                hit = later and later[0] - ts < within
                out.append((user, ts, later[0] if hit else None, "matched" if hit else "timeout"))
    return ordered(out)


def unpaid(rows, deadline, lookback=None):
    out = []
    for user, log in by_user(rows).items():
        pays = [r[2] for r in log if r[1] == "pay"]
        for _, state, ts, _ in log:
            if state == "create":
                low = float("-inf") if lookback is None else ts - lookback
                if not any(low <= p < ts + deadline for p in pays):
                    out.append((user, ts))
    return ordered(out)


def lifecycle(rows, deadline, wait=10**9):
    out = []
    for user, log in by_user(rows).items():
        log = [r for r in log if r[1] in ("create", "pay")]
        log = [r for r in log if r[2] < log[0][2] + wait]
        creates = [r[2] for r in log if r[1] == "create"]
        pays = [r[2] for r in log if r[1] == "pay"]
        if not creates and not pays:
            continue
        if not creates:
            status = "no_create"
        elif pays and min(pays) < min(creates) + deadline:
            status = "paid"
        else:
            status = "timeout"
        out.append((user, status))
    return ordered(out)


def reconciled(left, right, tolerance):
    """One pending row per key, as ``(key, kind, left seq, right seq)``."""
    merged = defaultdict(list)
    for side, rows in ((0, left), (1, right)):
        for key, ts, seq in rows:
            merged[key].append((ts, side, seq))
    out = []
    for key, log in merged.items():
        pending = None
        for row in [*sorted(log), None]:
            if (
                pending
                and row
                and key is not None
                and row[1] != pending[1]
                and row[0] - pending[0] <= tolerance
            ):
                both = sorted((pending, row), key=lambda r: r[1])
                out.append((key, "matched", both[0][2], both[1][2]))
                pending = None
                continue
            if pending:
                alone = ("right_only", None, pending[2]) if pending[1] else ("left_only", pending[2], None)
                out.append((key, *alone))
            pending = row
    return ordered(out)


def capped(rows, passes, day):
    """``(user, seq, kind)`` of the rows that pass and the one that warns."""
    out = []
    for user, log in by_user(rows).items():
        seen = Counter()
        for _, _, ts, seq in log:
            period = (BASE + ts) // day
            seen[period] += 1
            if seen[period] <= passes + 1:
                out.append((user, seq, "pass" if seen[period] <= passes else "warn"))
    return ordered(out)


def running(rows, size):
    """``(seq, window end, distinct so far, new)`` of ``(user, state, ts, seq)`` rows."""
    seen, out = defaultdict(set), []
    for user, _, ts, seq in sorted(rows, key=lambda r: (r[2], r[3])):
        end = (BASE + ts) // size * size + size - BASE
        new = user is not None and user not in seen[end]
        if new:
            seen[end].add(user)
        out.append((seq, end, len(seen[end]), new))
    return ordered(out)
