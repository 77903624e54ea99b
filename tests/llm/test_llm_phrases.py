"""Collocations against a plain-Python version, and the counting automata by themselves."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, least, top, longest=5):
    counts, n = {}, Counter()
    for _, text, lang in rows:
        lang = lang if lang is not None else "und"
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for b in range(len(words)):
                for m in range(1, min(longest, len(words) - b) + 1):
                    counts.setdefault(lang, Counter())[tuple(words[b : b + m])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        frequent = {p: c for p, c in f.items() if c >= least}
        for phrase, a in frequent.items():
            if len(phrase) < 2:
                continue
            inside = any(
                100 * c >= 100 * a and any(q[i : i + len(phrase)] == phrase for i in range(len(q) - len(phrase) + 1))
                for q, c in frequent.items()
                if len(q) > len(phrase)
            )
            if not inside:
                cuts = [(1000 * a * n[lang] // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(docs, **limits):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in co.collocations(docs, **limits).select(columns).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = ["a", "B", "of", "the", "The", "größe", "É", "x-1", "\u00a0", "\x1c", "文", "new", "york", "zoo"]
    phrases = ["New York Zoo of the", "the of the of the", "a a a a a a a", "x-1 文"]

    def text():
        parts = [rng.choice([rng.choice(words), rng.choice(phrases)]) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"]) for _ in range(rng.randrange(40))]
        return "".join(parts)

    out = [(i, text(), rng.choice(["en", "en", "en", "de", None, "und", ""])) for i in range(150)]
    out += [(i, "the same copy of one text", "en") for i in range(60)]
    out += [(None, None, "en"), (1, "", "fr"), (1, " . ! ", "fr"), (2, "lone", "it"), (900, " ".join(text() for _ in range(200)), "en")]
    return out


@pytest.mark.parametrize("shard,size", [(co.SHARD, co.RANGE), (600, 700)])
def test_same_as_brute_force(spark, rows, monkeypatch, shard, size):
    monkeypatch.setattr(co, "SHARD", shard)  # several automata
    monkeypatch.setattr(co, "RANGE", size)  # several prefix ranges
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"phrase": F.lit("x"), "range": F.lit(1), "w": F.lit(2), "f": F.lit(3)})
    docs = docs.repartition(3)
    assert found(docs, least=7) == brute(rows, 7, co.TOP)
    assert found(docs, least=3, top=9, longest=3) == brute(rows, 3, 9, 3)


def test_languages_beyond_a_broadcast(spark, rows, monkeypatch):
    monkeypatch.setattr(co, "MOST_SENT", 0)
    assert found(spark.createDataFrame(rows, SCHEMA), least=7) == brute(rows, 7, co.TOP)


def test_no_rows_and_no_phrases(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, None, None), (2, "a b c", "en")], SCHEMA)) == []


def test_products_beyond_64_bits(spark):
    n, a, left, right = 10**18, 10**16 + 7, 10**16 + 9, 3 * 10**16 + 1
    rows = [("en", "", 0, n), ("en", "x", 1, left), ("en", "y", 1, right), ("en", "x y", 2, a)]
    (got,) = co.best_phrases(spark.createDataFrame(rows, "lang string, phrase string, words int, f long")).collect()
    assert tuple(got) == ("en", 1, "x y", a, left, right, n, 1000 * a * n // (left * right))


@pytest.mark.parametrize("longest", [2, 3, 5, 7])
def test_automaton(longest):
    rng = random.Random(longest)
    text = " ".join(rng.choice(["a", "b", "c", "d", "."]) for _ in range(400)).encode()
    whole = co.Automaton.of_texts([text], longest)
    words, want = text.split(), Counter()
    for b, word in enumerate(words):
        path = words[b : b + longest]
        if word != b".":
            want[tuple(path[: path.index(b".")] if b"." in path else path)] += 1
    paths = [tuple(whole.words[k - 1] for k in column if k) for column in whole.paths.T.tolist()]
    assert dict(zip(paths, whole.weights.tolist(), strict=True)) == dict(want)
    assert paths == sorted(paths)
    splits = sorted({p + (b"",) * (longest - len(p)) for p in [*paths[10:400:37], (b"bb",), (b"a", b"bb"), (b"zz",)]})
    cut = list(whole.pieces(splits))
    again = [(part, co.Automaton.from_bytes(blob)) for part, blob in cut]
    back = [(part, tuple(a.words[k - 1] for k in column if k)) for part, a in again for column in a.paths.T.tolist()]
    assert [p for _, p in back] == paths
    for part, path in back:
        padded = path + (b"",) * (longest - len(path))
        assert part == sum(split <= padded for split in splits)
    merged = co.union([a for _, a in again])
    found = {tuple(p): w for p, w in co.frequent_prefixes(merged, 4, [])}
    prefixes = Counter()
    for path, weight in want.items():
        for m in range(1, len(path) + 1):
            prefixes[path[:m]] += weight
    assert found == {p: w for p, w in prefixes.items() if w >= 4}
    assert np.all(merged.weights > 0)
