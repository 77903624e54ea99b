"""Document operators against plain-Python versions on small odd tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chunk_dedup, jaccard, line_templates, mixing, sentence_spans
from tidemark.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(400)]


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def table(spark, rows):
    """Documents with some columns that operators use names like."""
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    extra = {"key": F.lit(1), "size": F.lit("x"), "recipe": F.lit(None).cast("string"), "doc": F.lit(2)}
    return spark.createDataFrame(full, SCHEMA).withColumns(extra)


def prose(rng, words, stop=0.1):
    return " ".join(rng.choice(WORDS) + (". " if rng.random() < stop else "") for _ in range(words))


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls, empties, copies in groups, near copies, one very long text, shared lines."""
    rng = random.Random(5)
    base = [prose(rng, rng.randrange(1, 300)) for _ in range(40)]
    texts = [None, "", " \n\t", "one", "ONE", "Ünicode ÄÖ", "ünicode äö", *base, *base[:10], base[3].upper(), *[base[0]] * 15]
    for text in base[:12]:
        words = text.split(" ")
        for _ in range(3):
            changed = list(words)
            for _ in range(max(1, len(words) // 60)):
                changed[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(changed))
    shared = "This line stands in very many documents today"
    texts += [f"{prose(rng, 30)}\n{shared}\n{prose(rng, 30)}" for _ in range(14)]
    texts += [f"{prose(rng, 20)}\nPage {i} of 9{i} was printed for user{i} here again\n{prose(rng, 5)}" for i in range(12)]
    passage = prose(rng, 60, stop=0.2)
    texts += [f"{prose(rng, 40)}.\n{passage}.\n{prose(rng, 40)}." for _ in range(6)]
    texts.append(prose(rng, 30_000))
    return [(i * 3 + 1, t, ["a", "b", "c", None][rng.randrange(4)]) for i, t in enumerate(texts)]


def test_exact_duplicates(spark, odd_rows):
    repeated = [*odd_rows, odd_rows[9], (None, "one", "a")]
    got = chunk_dedup.exact_duplicates(table(spark, repeated)).collect()
    groups = defaultdict(list)
    for i, text, _ in repeated:
        groups[fold(text)].append(i)
    assert len(got) == len(repeated)
    texts = defaultdict(set)
    for i, text, _ in repeated:
        texts[i].add(fold(text))
    for row in got:
        text = next(t for t in texts[row.doc_id] if hashlib.sha256(t.encode()).hexdigest() == row.text_sha256)
        largest = max(i for i in groups[text] if i is not None)
        assert (row.keep_id, row.group_size, row.kept) == (largest, len(groups[text]), row.doc_id == largest)


def test_chunks_join_to_the_text_and_are_shared(spark, odd_rows):
    docs = table(spark, odd_rows)
    folded = chunk_dedup.folded_texts(docs, "doc_id", "text")
    chunks = folded.select("folded", chunk_dedup.chunks_of(F.col("folded")).alias("chunks"))
    assert chunks.where(F.concat_ws("", "chunks") != F.col("folded")).count() == 0
    sizes = chunks.select(F.explode("chunks").alias("c")).select(F.max(F.char_length("c"))).first()[0]
    assert sizes <= chunk_dedup.LONGEST
    dictionary = chunk_dedup.chunk_dictionary(docs)
    every = [row.c for row in chunks.select(F.explode("chunks").alias("c")).collect()]
    assert dictionary.count() == len(set(every)) < len(every)


def test_two_chunks_with_one_identifier_stop_the_run(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(chunk_dedup, "identifier", lambda chunk: F.unhex(F.substring(F.sha2(chunk, 256), 1, 2)))
    with pytest.raises(Exception, match="one chunk identifier"):
        chunk_dedup.exact_duplicates(table(spark, odd_rows)).collect()


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute_components(rows):
    sets, parent = {i: shingles(t) for i, t, _ in rows}, {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        find(a)
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("common", [2, 16])
def test_similar_documents(spark, odd_rows, common, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON", common)
    rows = [(i, t, s) for i, t, s in odd_rows if t is None or len(t) < 20_000]
    got = jaccard.similar_documents(table(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)
    assert len(got) == len(rows)


def test_similar_documents_without_central_sets(spark, monkeypatch):
    """Chains of near copies in which the first round is led astray: the blocks find the rest."""
    rng, rows = random.Random(2), []
    for group in range(4):
        words = [rng.choice(WORDS) for _ in range(120)]
        for k in range(40):
            words[rng.randrange(len(words))] = f"new{rng.randrange(9)}"
            rows.append((len(rows), " ".join(words), "a"))
            if k % 8 == 0:
                words = words[rng.randrange(3) :]
    monkeypatch.setattr(jaccard, "ASKED", (1,))
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    got = jaccard.similar_documents(table(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_similar_documents_repeated_and_null_ids(spark):
    text = " ".join(WORDS[:30])
    rows = [(4, text, "a"), (4, text, "a"), (2, text.upper(), "a"), (None, text, "a"), (None, None, "a"), (9, "", "a"), (9, "a b", "a")]
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard.similar_documents(table(spark, rows)).collect())
    assert got == [(0, 0, 0), (0, 26, 2), (2, 26, 2), (4, 26, 2), (4, 26, 2), (9, 0, 9), (9, 1, 9)]


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (200, 201), (201, 202), (202, 200), (300, 300)]
    got = components(spark.createDataFrame(chain, "a long, b long")).collect()
    want = {i: 0 for i in range(61)} | {100: 100, 101: 100, 200: 200, 201: 200, 202: 200}
    assert {r.node: r.component for r in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def masked_lines(text):
    lines = [line.strip(" \t\r") for line in (text or "").lower().split("\n")]
    return [" ".join("<*>" if re.search(r"\d", w) else w for w in re.split(r"(?<=\s)|(?=\s)", line) if not w.isspace()) for line in lines]


def line_units(line):
    tokens, group = line.split(" "), 1
    if len(tokens) > 16:
        group = 4
        while len(tokens) > 8 * group:
            group *= 2
    return [" ".join(tokens[k : k + group]) for k in range(0, len(tokens), group)]


def brute_line_drops(rows, min_docs=10, constant=0.5, branch=0.01, shares=(0.5, 1.0), of_rarest=0.5):
    """The first document of every line that is of a recurring template."""
    docs, places = defaultdict(set), Counter()
    for i, text, _ in rows:
        for line in set(masked_lines(text)) - {""} if i is not None else ():
            docs[line].add(i)
            places.update((len(line.split(" ")), at, unit) for at, unit in enumerate(line_units(line)) if unit != "<*>")

    def needed(line):
        n = len(line.split(" "))
        return n if n <= 3 else -(-len(line_units(line)) // 2)

    def enough(line):
        n = len(line.split(" "))
        return sum(places[n, at, unit] >= min_docs for at, unit in enumerate(line_units(line))) >= needed(line)

    candidates = {line: len(ids) for line, ids in docs.items() if enough(line)}
    leaf = {line: (len(line.split(" ")),) for line in candidates}
    for depth in range(2):
        whole, some = Counter(), Counter()
        step = {line: [*line_units(line), "", ""][depth] for line in candidates}
        for line, n in candidates.items():
            whole[leaf[line]] += n
            some[leaf[line], step[line]] += n
        for line in candidates:
            have = some[leaf[line], step[line]]
            own = step[line] != "<*>" and have >= min_docs and have >= branch * whole[leaf[line]]
            step[line] = step[line] if own else "<*>"
        leaf = {line: (*leaf[line], step[line]) for line in candidates}
    support = Counter()
    for line, n in candidates.items():
        for at, unit in enumerate(line_units(line)):
            support[leaf[line], at, unit] += n * (unit != "<*>")
    templates, of_line = defaultdict(set), defaultdict(set)
    for line in candidates:
        found = {(at, unit): support[leaf[line], at, unit] for at, unit in enumerate(line_units(line))}
        found = {u: s for u, s in found.items() if s >= min_docs}
        if len(found) >= needed(line):
            level = sorted(found.values(), reverse=True)[needed(line) - 1]
            for share in shares:
                fixed = {u: s for u, s in found.items() if s >= level * share}
                template = (leaf[line], frozenset(fixed), min(fixed.values()))
                templates[template] |= docs[line]
                of_line[line].add(template)
    out = {}
    for line, choices in of_line.items():
        recurring = [t for t in choices if len(templates[t]) >= max(min_docs, of_rarest * t[2])]
        if recurring:
            out[line] = min(templates[max(recurring, key=lambda t: len(templates[t]))])
    return out


def test_recurring_lines(spark, odd_rows):
    rows = [*odd_rows, (None, "This line stands in very many documents today", None), odd_rows[70]]
    rng = random.Random(4)
    name = lambda: "".join(rng.choices("abcdefghij", k=6))
    fields = lambda k: f"by {name()} in {name()}\nthe {name()} of {rng.choice(WORDS)}\n{prose(rng, 40)} always the same long end {k % 3} of it"
    rows += [(2000 + k, fields(k), "a") for k in range(70)]
    rows += [(3000 + k, " ".join(rng.choice(["the", "of", "and", "in", f"v{k}"]) for _ in range(8)), "a") for k in range(90)]
    first = brute_line_drops(rows)
    assert any("<*>" in line for line in first) and sum(line.startswith("by ") for line in first) > 50
    names = ("_low", "_masked", "_drops", "_kept", "line", "n", "row", "id", "units", "drops")
    docs = table(spark, rows).withColumns({name: F.lit(1) for name in names})
    got = line_templates.drop_recurring_lines(docs)
    assert got.columns == [*docs.columns, "dropped_lines"]
    kept = Counter((r.doc_id, r.text, r.dropped_lines) for r in got.collect())
    want = Counter()
    for i, text, _ in rows:
        if text is None:
            want[i, None, 0] += 1
            continue
        lines = text.split("\n")
        stay = [line for line, low in zip(lines, masked_lines(text), strict=True) if i is None or first.get(low, i) == i]
        want[i, "\n".join(stay), len(lines) - len(stay)] += 1
    assert kept == want
    assert sum(r[2] for r in want) > 20


def brute_passages(rows, least=3, words=12):
    """First document of every run, and the runs of each document."""
    runs, first = {}, {}
    for i, text, _ in rows:
        parts = [p.decode() for p in sentence_spans.sentences((text or "").encode())]
        found = []
        for b in range(len(parts)):
            for e in range(b + 1, len(parts) + 1):
                said = [p.lower().split() for p in parts[b:e] if p.split()]
                if len(said) >= least and sum(map(len, said)) >= words:
                    if parts[b].split():
                        found.append((b, e, str(said)))
                    break
        runs[i] = parts, found
        for _, _, said in found:
            first[said] = min(i, first.get(said, i))
    return runs, first


def test_repeated_passages(spark, odd_rows):
    rows = [(i, t, s) for i, t, s in odd_rows if t is None or len(t) < 20_000]
    runs, first = brute_passages(rows)
    got = {r.doc_id: r for r in sentence_spans.remove_repeated_passages(table(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        parts, found = runs[i]
        stays, seen, others = [True] * len(parts), set(), set()
        for b, e, said in found:
            if first[said] != i:
                others.add(first[said])
            if first[said] != i or said in seen:
                stays[b:e] = [False] * (e - b)
            seen.add(said)
        want = None if text is None else "".join(p for p, s in zip(parts, stays, strict=True) if s)
        assert (got[i].text, got[i].removed, got[i].repeats_of) == (want, len(parts) - sum(stays), sorted(others))


def test_runs_from_words_alone_are_those_of_the_cut_texts(odd_rows):
    texts = [(t or "").encode() for _, t, _ in odd_rows] + [b"no end", b"A b. C d! e", ("x " * 99).encode()]
    for fast, cut in zip(sentence_spans.hashes_of_both_cuts(texts, 3, 12, sentence_spans.Picks()), sentence_spans.both_cuts(texts, 3, 12), strict=True):
        rows = [sorted(zip(r.owner.tolist(), r.hashes.tolist(), r.again.tolist(), strict=True)) for r in (fast, cut)]
        assert rows[0] == rows[1] and rows[0]


def test_long_text_without_stops_has_sentences():
    text = " ".join(WORDS[:100]).encode()
    parts = sentence_spans.sentences(text)
    assert b"".join(parts) == text and {len(p.split()) for p in parts[:-1]} == {16}


def test_passages_of_rows_without_and_with_one_id_stay(spark):
    text = ". ".join(WORDS[:40]) + "."
    rows = [(None, text, "a"), (5, text, "a"), (5, text, "a"), (7, text, "a")]
    got = sentence_spans.remove_repeated_passages(table(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text == text, r.repeats_of) for r in got) == [(0, True, []), (5, True, []), (5, True, []), (7, False, [5])]


def water_level(sizes, weights=(1, 2, 3), passes=3):
    """Targets by resharing the excess until none is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_names, left = {}, set(names), sum(sizes.values())
    while open_names:
        share = {s: left * weight[s] / sum(weight[x] for x in open_names) for s in open_names}
        full = {s for s in open_names if share[s] > passes * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = passes * sizes[s]
            left -= target[s]
        open_names -= full
    return target


def test_fair_queue(spark, odd_rows):
    small = [(9000 + i, prose(random.Random(i), 8), ["tiny", "é", "Z", "none"][i % 4]) for i in range(40)]
    rows = [*odd_rows[:-1], *small, (9100, "", "void"), small[0]]
    count = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    sizes = Counter()
    for i, _, s in rows:
        sizes[s] += count[i]
    want = water_level(sizes)
    got = mixing.fair_queue(table(spark, rows)).collect()
    assert len(got) == len(rows)
    source = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got:
        assert (r.size, r.source_size) == (count[r.doc_id], sizes[source[r.doc_id]])
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    total, largest = sum(sizes.values()), max(count.values())
    assert total - largest <= sum(taken.values()) <= total
    for s, target in want.items():
        assert abs(taken[s] - target) <= 2 * largest
    again = mixing.fair_queue(table(spark, rows[::-1])).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_empty_tables(spark):
    empty = table(spark, [])
    for result in (
        chunk_dedup.exact_duplicates(empty),
        jaccard.similar_documents(empty),
        line_templates.drop_recurring_lines(empty),
        sentence_spans.remove_repeated_passages(empty),
        mixing.fair_queue(empty),
    ):
        assert result.count() == 0
    nothing = mixing.fair_queue(table(spark, [(1, None, None), (2, "", "a")])).collect()
    assert [(r.size, r.target, r.taken) for r in nothing] == [(0, 0.0, 0)] * 2


def lines_dropped(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.dropped_lines for r in line_templates.drop_recurring_lines(docs).collect()}


@pytest.mark.parametrize("docs", [40, 600, 3000])
def test_templates_with_word_fields_are_found_in_tables_of_any_size(spark, docs):
    """Two fields of 100 values each: the values recur in large tables, their pairs do not."""
    rng, letters = random.Random(docs), "abcdefghij"
    value = lambda name: name + rng.choice(letters) + rng.choice(letters)
    texts = [f"latest news of today posted in {value('city')} by {value('name')} for all readers of this site" for _ in range(docs)]
    assert lines_dropped(spark, texts) == {i: int(i > 0) for i in range(docs)}


def test_templates_with_a_word_field_at_the_begin_and_any_white_space(spark):
    names = ["".join(random.Random(i).choices("abcdefghij", k=8)) for i in range(20)]
    texts = [f"posted by {a} on our front page\nuser {a} logged in\n{a} has left this channel" for a in names]
    assert lines_dropped(spark, texts) == {i: 3 * (i > 0) for i in range(20)}
    spaced = ["all readers  see\tthis line", "all readers see this line", " all\treaders see  this line\r"] * 4
    assert lines_dropped(spark, spaced) == {i: int(i > 0) for i in range(12)}


def test_templates_of_few_constants(spark):
    """Half of the tokens and more are fields, of digits or of words."""
    rng = random.Random(12)
    name = lambda: "".join(rng.choices("abcdefghij", k=6))
    for line in (lambda k: f"page {k} of {k + 9}", lambda k: f"posted by {name()} on {k}/5 at {k}:30", lambda k: f"by {name()} in {name()}"):
        texts = [f"{' '.join(name() for _ in range(15))}\n{line(k)}" for k in range(60)]
        assert lines_dropped(spark, texts) == {i: int(i > 0) for i in range(60)}


def test_lines_that_differ_in_fields_only_are_one_pattern(spark):
    rng = random.Random(14)
    name = lambda: "".join(rng.choices("abcdefghij", k=8))
    texts = [(k, f"posted by {name()} on our front page of {k}\nall of {name()} {name()}") for k in range(80)]
    lines = line_templates.line_table(spark.createDataFrame(texts, "doc_id long, text string"))
    placed = line_templates.placed_lines(lines)
    got = line_templates.candidate_lines(placed, 10, 0.5).collect()
    assert Counter((r.n, sum(u is not None for u in r.units)) for r in got) == {(9, 7): 80, (4, 2): 80}
    assert len({r.key for r in got}) == 160 and len({r.pattern for r in got}) == 2


def test_texts_are_parted_once(spark, monkeypatch):
    plans, stored = [], line_templates.stored
    monkeypatch.setattr(line_templates, "stored", lambda rows, label: plans.append(rows._jdf.queryExecution().toString()) or stored(rows, label))
    line_templates.recurring_lines(spark.createDataFrame([(k, f"line {k} of all") for k in range(20)], "doc_id long, text string"))
    assert sum("split(lower" in plan for plan in plans) == 1


def test_rows_of_units_are_made_once(spark, monkeypatch):
    """Their supports and the patterns' constants are read from one table."""
    plans, stored = [], line_templates.stored
    monkeypatch.setattr(line_templates, "stored", lambda rows, label: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or stored(rows, label))
    line_templates.recurring_lines(spark.createDataFrame([(k, f"line {k} of all") for k in range(20)], "doc_id long, text string"))
    assert sum(plan.count("Generate inline(filter(transform(units") for plan in plans) == 1


def test_texts_go_to_the_join_once(spark):
    """Whole texts are dealt by id to meet the lines that go: as part of their row, and not a second time."""
    docs = spark.createDataFrame([(k, f"line {k} of all") for k in range(20)], "doc_id long, text string").repartition(2)
    plan = line_templates.drop_recurring_lines(docs)._jdf.queryExecution().optimizedPlan()
    while not plan.nodeName().startswith("Join"):
        plan = plan.children().head()
    dealt = plan.children().head().output()
    kinds = [dealt.apply(k).dataType().catalogString() for k in range(dealt.size())]
    assert sum(kind.count("string") for kind in kinds) == 1


def test_common_words_make_no_template(spark):
    """Lines that share frequent words only stay, however many there are."""
    rng = random.Random(13)
    common, word = ["the", "of", "and", "in", "to"], lambda: "".join(rng.choices("abcdefghij", k=6))
    texts = ["\n".join(" ".join(rng.choice(common) if rng.random() < 0.5 else word() for _ in range(6)) for _ in range(10)) for _ in range(150)]
    assert sum(lines_dropped(spark, texts).values()) <= 15


def test_short_lines_recur(spark):
    lines = ["All rights reserved.", "Read more", "Menu"]
    texts = ["\n".join([*lines, "", f"page {i}", "abcdefghijkl"[i]]) for i in range(12)]
    assert lines_dropped(spark, texts) == {i: 3 * (i > 0) for i in range(12)}


def test_passages_without_stops_are_found_wherever_they_begin(spark):
    rng = random.Random(1)
    passage = rng.sample(WORDS, 80)
    texts = [" ".join([*(f"a{i}x{k}" for k in range(i)), *passage, *(f"z{i}x{k}" for k in range(9))]) for i in range(19)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in sentence_spans.remove_repeated_passages(docs).collect()}
    assert got[0].text == texts[0]
    for i in range(1, 19):
        left = got[i].text.split()
        # At least 40 of the 80 words went, and none of the others.
        assert len(set(left) & set(passage)) <= 40 and set(texts[i].split()) - set(left) <= set(passage)
        assert got[i].repeats_of and got[i].removed > 0
