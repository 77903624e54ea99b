"""Removal of repeated byte strings against a plain-Python version."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import suffix_parse

SCHEMA = "doc_id long, text string"


def brute(rows, length=50):
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, text in texts:
        for p in range(len(text) - length + 1) if i is not None else ():
            string = text[p : p + length]
            first[string] = min(first.get(string, i), i)
    out = []
    for i, text in texts:
        gone = [False] * len(text)
        for p in range(len(text) - length + 1) if i is not None else ():
            if first[text[p : p + length]] < i:
                gone[p : p + length] = [True] * length
        spans, p = [], 0
        while p < len(text):
            q = p
            while q < len(text) and gone[q]:
                q += 1
            if q > p:
                spans.append((p, q - p))
            p = q + 1
        out.append((i, bytes(b for b, g in zip(text, gone, strict=True) if not g), spans))
    return sorted(out, key=str)


def found(docs, **limits):
    rows = suffix_parse.remove_repeated_strings(docs, **limits).collect()
    return sorted(((r.doc_id, bytes(r.kept), [(s.start, s.length) for s in r.spans]) for r in rows), key=str)


@pytest.fixture(scope="module")
def rows():
    """Shared passages of all lengths at all places, runs of one letter, copies, repeated ids."""
    rng = random.Random(3)
    words = ["alpha", "bé", "gamma", "delt", "e", "the", "of", "und", "größe", "\n", "文"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [prose(30) for _ in range(6)]

    def text():
        parts = []
        for _ in range(rng.randrange(8)):
            passage = rng.choice(passages)
            begin = rng.randrange(60)
            parts.append(rng.choice([prose(rng.randrange(1, 25)), passage, passage[begin : begin + rng.randrange(120)], "a" * rng.randrange(10, 90)]))
        return " ".join(parts)

    out = [(rng.randrange(1, 80), text()) for _ in range(90)]
    out += [(1000 + i, passages[0] * 3) for i in range(40)]  # a large group of copies
    out += [(None, passages[0]), (None, passages[0]), (5, None), (6, ""), (-7, passages[1]), (2000, prose(4000))]
    return out


@pytest.mark.parametrize("many", [suffix_parse.MANY, 3])
def test_same_as_brute_force(spark, rows, monkeypatch, many):
    monkeypatch.setattr(suffix_parse, "SHARD", 3000)  # several shards
    monkeypatch.setattr(suffix_parse, "CHUNK", 700)  # texts that are parsed in parts
    monkeypatch.setattr(suffix_parse, "MANY", many)
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"part": F.lit("x"), "shard": F.lit(1), "blob": F.lit(None)})
    assert found(docs.repartition(3)) == brute(rows)


def test_other_lengths(spark, rows, monkeypatch):
    monkeypatch.setattr(suffix_parse, "SHARD", 3000)
    short = rows[:60]
    assert found(spark.createDataFrame(short, SCHEMA), length=20, trigger=7) == brute(short, 20)


def test_no_rows_and_no_long_texts(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_parse.remove_repeated_strings(empty).columns == ["doc_id", "kept", "spans"]
    assert found(empty) == []
    short = [(1, "x" * 49), (2, "x" * 49), (3, None)]
    assert found(spark.createDataFrame(short, SCHEMA)) == brute(short)


def test_strings_of_exactly_the_length(spark):
    string = "0123456789" * 5
    rows = [(1, string), (2, string), (3, string[:49] + "!"), (4, "é" + string), (5, string + string)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_suffix_ranks():
    import numpy as np

    data = np.frombuffer(b"banana banana band", np.uint8)
    begins = np.arange(len(data) - 5)
    order, new = suffix_parse.suffix_ranks(data, begins, 6)
    strings = [data[b : b + 6].tobytes() for b in begins]
    assert [strings[k] for k in order] == sorted(strings)
    assert new.sum() == len(set(strings))
