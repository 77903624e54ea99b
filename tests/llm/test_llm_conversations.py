"""Repair of conversations against a plain-Python version, and the word graph by itself."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string"
NOTHING = hashlib.sha256().hexdigest()


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def repaired(rows):
    """Counts, cost, audit and lines of the rows of one conversation."""
    md5 = lambda r: hashlib.md5(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).digest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), md5(r)))
    faults, seen = [], set()
    for _, _, role, text in rows:
        black = re.findall(r"[^\x20\x09-\x0D]", text)
        if not black:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if black[-1] in ".!?" else "truncated")
        seen.add((role, text))
    steps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @lru_cache(None)
    def best(i, state, inserted=0):
        ways = []
        if i == len(rows) and state in (0, 3):
            ways.append((0, "", ()))
        if inserted < 4:
            for role in ("user", "assistant"):
                if (state, role[0]) in steps:
                    cost, audit, lines = best(i, steps[state, role[0]], inserted + 1)
                    ways.append((cost + 2, "I" + audit, (f"{role}:", *lines)))
        if i < len(rows):
            _, _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state)
            ways.append((cost + 3, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                for new, edit, price in ((role, "K", 0), ("user", "R", 2), ("assistant", "R", 2)):
                    if (state, new[:1]) in steps:
                        cost, audit, lines = best(i + 1, steps[state, new[:1]])
                        ways.append((cost + price + more, edit + audit, (f"{new}:{text}", *lines)))
        return min(ways, default=(10**9, "", ()))

    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    for i in range(len(rows), -1, -1):  # from the end, so that no call is nested deeply
        cost, audit, lines = best(i, 0)
        for state in (1, 2, 3):
            best(i, state)
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, lines)


def brute(rows):
    left = damage(rows)
    out = []
    for conv in {r[0] for r in rows}:
        *counts, lines = repaired([r for r in left if r[0] == conv])
        out.append((conv, *counts, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def found(rows, piece=cv.PIECE):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in cv.audit_damage(rows, piece).select(names).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    roles = ["user", "user", "user", "assistant", "assistant", "assistant", "system", "tool", "", None, "umpire", "a:b"]
    texts = ["Well.", "Yes!  ", "no stop", "Why?\n", "", " \t", None, "one. two", "é。", "\u00a0", "x\x1c"]

    def conversation(conv, size):
        return [(conv, rng.choice([k, k, k, k, k + 3, None]), rng.choice(roles), rng.choice([*texts, f"Line {k}."])) for k in range(size)]

    out = [r for conv in range(120) for r in conversation(conv, rng.randrange(1, 12))]
    out += conversation(500, 300) + conversation(None, 9) + conversation(-3, 5)
    out += [(600, 1, "user", "The same.")] * 70 + [(601, None, "assistant", "The same.")] * 3
    out += [(602, k, "user", "Again.") for k in range(90)]
    out += [(700, k, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(200)]
    # Conversations that lose every row.
    gone = [c for c in range(1000, 3000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    return out + [(c, 0, "user", "Lost.") for c in gone]


@pytest.mark.parametrize("piece", [cv.PIECE, 3])
def test_same_as_brute_force(spark, rows, piece):
    extra = {"n": F.lit(1), "part": F.lit("x"), "fault": F.lit(2), "text2": F.lit(None)}
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(extra).repartition(3)
    assert found(docs, piece) == brute(rows)


def test_repaired_rows_are_legal(spark, rows):
    edited, summary = cv.repair(spark.createDataFrame(rows, SCHEMA), piece=4)
    lines = {}
    for r in cv.repaired(edited).orderBy("part", "place", "line").collect():
        lines.setdefault(r.conv_id, []).append((r.role, r.text))
    by_conv = {r.conv_id: r for r in summary.collect()}
    assert set(lines) <= set(by_conv) == {r[0] for r in rows}
    for conv, r in by_conv.items():
        own = lines.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in own))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in own).encode()).hexdigest() == r.repaired_sha256
        assert len(r.audit) - r.audit.count("D") == len(own)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(empty) == []
    edited, summary = cv.repair(empty)
    assert cv.repaired(edited).collect() == summary.collect() == []


def test_word_graph_shares_suffixes(monkeypatch):
    made = []
    node = cv.node
    monkeypatch.setattr(cv, "node", lambda letter, after: made.append(letter) or node(letter, after))
    signatures = sorted(["sua", "ua", "ouua", "xua", "sUa", "a", "sua" * 5], key=lambda s: s[::-1])
    solved = dict(cv.tables_of(iter(signatures)))
    assert len(made) == len({s[k:] for s in signatures for k in range(len(s))})
    assert solved["sua"][0][3] == (0, "KKK") and solved["ua"][1][3] == (0, "KK")
    assert solved["a"][0] == [(3, "D"), None, (2, "R"), (2, "IK")]
    assert solved["sUa"][0][3] == (1, "KKK") and solved["xua"][0][3] == (3, "DKK")
