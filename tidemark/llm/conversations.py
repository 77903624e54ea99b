"""Repair of the structure of conversations: the cheapest edits that make the roles legal.

The rows of a conversation, in the order of their turns, become a signature: a letter for the role
and fault of each.  Signatures are cut into pieces of at most ``PIECE`` letters.  All distinct
pieces of all conversations, sorted from their ends, share their suffixes in an acyclic word
graph; for each of its nodes the cost to go and the least audit are computed once, from every
state of the role grammar to every other, whatever number of conversations hold the suffix.  The
pieces of a conversation are then put together from its last to its first.

Rows are range-sorted, so a long conversation is shared by many tasks; rows that are equal travel
as one with a count.  Only the letters of a conversation's audit, and in turn the lines for its
digest, pass through one task, since both are single values.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

#: Letters of a signature that are worked out together.
PIECE = 64

#: White space, and what ends a text.
SPACES, STOPS = " \t\n\x0b\x0c\r", ".!?"

#: Role pairs that may follow each other, by their initials.
LEGAL = {"su", "ua", "au"}

#: States of ``(s?(ua)+)?``: nothing yet, behind s, behind u, behind a.  ``STEP[state]`` says where
#: an initial leads, ``WANTS[state]`` the role that may be inserted or given.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTS = ("user", "user", "assistant", "user")
NEXT = tuple(STEP[state][role[0]] for state, role in enumerate(WANTS))

#: Costs of edits.
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: What is inserted behind the last row to end in each state.
ENDING = ((0, ""), (4, "II"), (2, "I"), (0, ""))

#: A required deletion in a signature; other rows have the initial of the role or ``OTHER``, upper
#: case where the text is truncated.
GONE, OTHER = "x", "o"


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` with the faults that the hash of conversation and
    turn picks: dropped, emptied, without stops, repeated, or given the role user."""
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    key = F.concat(conv, F.lit(":"), turn)
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    picked = rows.withColumn("fault", F.crc32(key.cast("binary")) % 20).where("fault <> 0")
    fault = F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.translate(text, STOPS, "")).otherwise(text)
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return picked.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"), text.alias("text"), F.explode(copies).alias("copy")
    ).drop("copy")


# --- the word graph


def candidates(letter: str, after: list[list], state: int) -> Iterator[tuple[list, int, str]]:
    """Ways to deal with a row: what follows, cost, edit."""
    if letter == GONE:
        yield after[state], DELETE, "D"
        return
    initial, more = letter.lower(), TRUNCATED if letter.isupper() else 0
    yield after[state], DELETE, "D"
    if initial in STEP[state]:
        yield after[STEP[state][initial]], more, "K"
    yield after[NEXT[state]], RENAME + more, "R"


def node(letter: str, after: list[list]) -> list[list]:
    """``node[state][end]``: the least cost and audit (None: no way) of ``letter`` and all behind
    it, from the states before it to those behind the suffix, given those of the shorter suffix."""
    plain = []
    for state in range(4):
        ways = list(candidates(letter, after, state))
        plain.append([least((cost + way[end][0], edit + way[end][1]) for way, cost, edit in ways if way[end]) for end in range(4)])
    out = []
    for state in range(4):
        path = [state]
        for _ in range(3):  # beyond three inserted rows a state comes again
            path.append(NEXT[path[-1]])
        out.append([
            least((INSERT * k + plain[s][end][0], "I" * k + plain[s][end][1]) for k, s in enumerate(path) if plain[s][end])
            for end in range(4)
        ])
    return out


def least(ways: Iterator[tuple[int, str]]) -> tuple[int, str] | None:
    return min(ways, default=None)


LEAF = [[(0, "") if state == end else None for end in range(4)] for state in range(4)]


def tables_of(signatures: Iterator[str]) -> Iterator[tuple[str, list[list]]]:
    """The node of every signature; they come sorted from their ends, so the nodes of a common
    suffix are there from the one before."""
    nodes, last = [LEAF], ""
    for signature in signatures:
        shared = 0
        while shared < min(len(last), len(signature)) and last[-1 - shared] == signature[-1 - shared]:
            shared += 1
        del nodes[shared + 1 :]
        for letter in reversed(signature[: len(signature) - shared]):
            nodes.append(node(letter, nodes[-1]))
        last = signature
        yield signature, nodes[-1]


def solved(pieces: DataFrame) -> DataFrame:
    """``signature``, ``costs``, ``audits`` (16 each, state by end) of the distinct signatures."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = (s for batch in batches for s in batch.column(0).to_pylist())
        found: list[tuple] = []
        for signature, table in tables_of(given):
            flat = [way for of_state in table for way in of_state]
            found.append((signature, [w and w[0] for w in flat], [w and w[1] for w in flat]))
            if len(found) == 1000:
                yield batch_of(found, schema)
                found = []
        yield batch_of(found, schema)

    schema = pa.schema([("signature", pa.string()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
    distinct = pieces.select("signature").distinct()
    ordered = distinct.repartitionByRange(F.reverse("signature")).sortWithinPartitions(F.reverse("signature"))
    return ordered.mapInArrow(work, "signature string, costs array<long>, audits array<string>")


def batch_of(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


# --- pieces of conversations


def faulty_rows(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number ``n``; ``blank``, ``again`` (role and text stand in an
    earlier turn) and ``truncated``."""
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    said = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")))
    said_rows = counted.withColumn("said", said)
    # Null turns come first.
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    several = said_rows.groupBy("conv_id", "said").agg(F.min(place).alias("first"), F.count("*").alias("m")).where("m > 1")
    several = several.select(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("said") == F.col("_said"))
    again = F.col("first").isNotNull() & (F.col("first") != place)
    trimmed = F.rtrim("text", F.lit(SPACES))
    ends = F.right(trimmed, F.lit(1)).isin(*STOPS)
    blank = trimmed == ""
    return said_rows.join(several, same, "left").select(
        "conv_id", "turn", "role", "said", "n", blank.alias("blank"), again.alias("again"),
        (~blank & ~again & ~ends).alias("truncated"), F.when(~blank & ~again, F.col("text")).alias("text"),
    )


class Piece:
    """Some rows of a conversation in a row, being gathered."""

    def __init__(self, conv_id):
        self.conv_id, self.letters, self.lines = conv_id, [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first = self.last = None

    def add(self, turn, initial: str, letter: str, line: tuple | None, blank: bool, truncated: bool) -> None:
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.letters.append(letter)
        self.lines.append(line)
        self.blank += blank
        self.duplicate += letter == GONE and not blank
        self.truncated += truncated


COUNTS = ("first_turn", "last_turn", "turns", "first", "last", "blank", "duplicate", "truncated", "illegal")


def pieces_of(rows: DataFrame, piece: int) -> DataFrame:
    """Range-sorted rows, cut into pieces: ``part`` and ``place`` order them, ``lines`` are role and
    text of the rows, null for rows that must go."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        now, found = None, []

        def done(p: Piece) -> tuple:
            lines = [line and {"role": line[0], "text": line[1]} for line in p.lines]
            return (p.conv_id, part, place, "".join(p.letters), lines, *(getattr(p, c) for c in COUNTS))

        for batch in batches:
            for row in batch.to_pylist():
                role, blank = row["role"], row["blank"]
                initial = role[:1]
                kind = initial if initial in ("s", "u", "a") else OTHER
                for copy in range(row["n"]):
                    if now is not None and (now.conv_id != row["conv_id"] or len(now.letters) == piece):
                        found.append(done(now))
                        now, place = None, place + 1
                    now = now or Piece(row["conv_id"])
                    stays = not blank and not row["again"] and copy == 0
                    truncated = stays and row["truncated"]
                    letter = (kind.upper() if truncated else kind) if stays else GONE
                    now.add(row["turn"], initial, letter, (role, row["text"]) if stays else None, blank, truncated)
                if len(found) >= 500:
                    yield batch_of(found, schema)
                    found = []
        if now is not None:
            found.append(done(now))
        yield batch_of(found, schema)

    id_type, turn_type = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    empty = rows.sparkSession.createDataFrame([], f"conv_id {id_type}, turn {turn_type}")
    arrow = dict(zip(("conv_id", "turn"), arrow_types(empty), strict=True))
    line = pa.struct([("role", pa.string()), ("text", pa.string())])
    counts = {"first_turn": arrow["turn"], "last_turn": arrow["turn"], "first": pa.string(), "last": pa.string()}
    schema = pa.schema([
        ("conv_id", arrow["conv_id"]), ("part", pa.int32()), ("place", pa.int64()), ("signature", pa.string()),
        ("lines", pa.list_(line)), *((c, counts.get(c, pa.int64())) for c in COUNTS),
    ])
    said = {"first_turn": turn_type, "last_turn": turn_type, "first": "string", "last": "string"}
    out = f"conv_id {id_type}, part int, place long, signature string, lines array<struct<role: string, text: string>>, "
    order = ["conv_id", "turn", "role", "said"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(cut, out + ", ".join(f"{c} {said.get(c, 'long')}" for c in COUNTS))


def arrow_types(rows: DataFrame) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return [field.type for field in to_arrow_schema(rows.schema)]


# --- from pieces to conversations


class Way:
    """A cost and an audit, which is a text and the audit of a later piece."""

    __slots__ = ("cost", "text", "end", "rest")

    def __init__(self, cost: int, text: str, end: int, rest: Way | None):
        self.cost, self.text, self.end, self.rest = cost, text, end, rest

    def before(self, other: Way) -> bool:
        if self.cost != other.cost:
            return self.cost < other.cost
        # The first letter that differs decides; both are rarely equal for long.
        mine, others, a, b = self, other, self.text, other.text
        while True:
            size = min(len(a), len(b))
            if a[:size] != b[:size]:
                return a < b
            a, b = a[size:], b[size:]
            while not a and mine.rest:
                mine = mine.rest
                a = mine.text
            while not b and others.rest:
                others = others.rest
                b = others.text
            if not a or not b:
                return not a and bool(b)


def ways_back(piece: dict, later: list[Way]) -> list[Way | None]:
    """The best way from every state before a piece to the end of the conversation."""
    out: list[Way | None] = []
    for state in range(4):
        best = None
        for end in range(4):
            cost = piece["costs"][4 * state + end]
            if cost is not None and later[end] is not None:
                way = Way(cost + later[end].cost, piece["audits"][4 * state + end], end, later[end])
                if best is None or way.before(best):
                    best = way
        out.append(best)
    return out


ENDS = [Way(cost, text, end, None) for end, (cost, text) in enumerate(ENDING)]


def chosen_edits(pieces: DataFrame) -> DataFrame:
    """``part``, ``place``, ``state`` before the piece, ``audit``; the first piece of a conversation
    has its counts too.  ``pieces`` has ``costs`` and ``audits``."""
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        now: Conversation | None = None
        for batch in batches:
            for piece in batch.to_pylist():
                if now is None or now.conv_id != piece["conv_id"]:
                    if now is not None:
                        found.extend(now.edits())
                    now = Conversation(piece["conv_id"])
                now.add(piece)
                if len(found) >= 1000:
                    yield batch_of(found, schema)
                    found = []
        if now is not None:
            found.extend(now.edits())
        yield batch_of(found, schema)

    schema = pa.schema([("part", pa.int32()), ("place", pa.int64()), ("state", pa.int32()), ("audit", pa.string()), *((n, pa.int64()) for n in names)])
    backwards = pieces.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("place"))
    return backwards.mapInArrow(fold, "part int, place long, state int, audit string, " + ", ".join(f"{n} long" for n in names))


class Conversation:
    """The pieces of a conversation, last first."""

    def __init__(self, conv_id):
        self.conv_id, self.best, self.places = conv_id, ENDS, []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first_turn = self.first = None

    def add(self, piece: dict) -> None:
        self.best = ways_back(piece, self.best)
        self.places.append((piece["part"], piece["place"]))
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + piece[name])
        if self.first is not None and piece["last"] + self.first not in LEGAL:
            self.illegal += 1
        self.first = piece["first"]
        if piece["first_turn"] is not None:
            # A turn that goes on in the next piece counts once.
            self.turns -= piece["last_turn"] == self.low
            self.low = piece["first_turn"]
            self.high = piece["last_turn"] if self.high is None else self.high

    def edits(self) -> Iterator[tuple]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        way, state = self.best[0], 0
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, way.cost)
        for part, place in reversed(self.places):
            end, text = way.end, way.text
            if way.rest.rest is None:  # the last piece, and what is inserted behind it
                text += way.rest.text
            yield (part, place, state, text, *counts)
            counts, way, state = (None,) * 6, way.rest, end


def repaired_lines(lines: list[dict | None], audit: str, state: int) -> Iterator[tuple[str, str]]:
    """Role and text of the rows that stay or are new."""
    given = iter(lines)
    for edit in audit:
        line = None if edit == "I" else next(given)
        if edit == "D":
            continue
        role = line["role"] if edit == "K" else WANTS[state]
        state = STEP[state][role[:1]]
        yield role, line["text"] if line else ""


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation: its counts, whole audit and the SHA-256 of its repaired lines.
    ``pieces`` has ``lines`` and what ``chosen_edits`` gives."""
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        now = None
        for batch in batches:
            for piece in batch.to_pylist():
                if piece["cost"] is not None:  # the first of a conversation
                    if now is not None:
                        found.append((*now, "".join(audits), digest.hexdigest()))
                    now, audits, digest, some = [piece[c] for c in ("conv_id", *names)], [], hashlib.sha256(), ""
                audits.append(piece["audit"])
                for role, text in repaired_lines(piece["lines"], piece["audit"], piece["state"]):
                    digest.update(f"{some}{role}:{text}".encode())
                    some = "\n"
                if len(found) >= 1000:
                    yield batch_of(found, schema)
                    found = []
        if now is not None:
            found.append((*now, "".join(audits), digest.hexdigest()))
        yield batch_of(found, schema)

    id_type = pieces.schema["conv_id"].dataType.simpleString()
    schema = pa.schema([("conv_id", arrow_types(pieces.select("conv_id"))[0]), *((n, pa.int64()) for n in names), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return ordered.mapInArrow(hashed, f"conv_id {id_type}, " + ", ".join(f"{n} long" for n in names) + ", audit string, repaired_sha256 string")


def repair(
    rows: DataFrame, piece: int = PIECE, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The pieces of all conversations with ``state`` and ``audit``, and one row per conversation.

    A conversation's rows are in the order of turn (nulls first); equal turns by role and then the
    MD5 of role and text.  A row's first fault counts: blank (nothing but white space), duplicate
    (role and text stand earlier), truncated (does not end in ``.!?``).  Blank rows and duplicates
    must go.  The cheapest edits that make the roles' initials ``(s?(ua)+)?`` are K (keep, 0), R
    (give the role user or assistant, 2), D (delete, 3) and I (insert an empty text of user or
    assistant, 2), and 1 for every truncated row that stays; of equally cheap audits the
    ASCII-least is taken.  ``gaps`` counts the missing whole numbers between the least and the
    largest turn.  Null roles and texts count as one space, a null conversation is one of its own.
    Rows that stand several times count as often.  An empty table gives empty results; other
    columns are not read.  Turns are whole numbers.
    """
    space = F.lit(" ")
    named = rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"),
    )
    pieces = stored(pieces_of(stored(faulty_rows(named), "conversation-rows"), piece), "conversation-pieces")
    short = pieces.drop("lines").join(solved(pieces), "signature")
    edits = chosen_edits(short)
    edited = pieces.select("conv_id", "part", "place", "lines").join(edits, ["part", "place"])
    return edited, digests(edited)


def repaired(edited: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``place``, ``line``, ``role``, ``text``: the repaired rows, from the
    pieces that ``repair`` gives; the three numbers order those of a conversation."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for p in batch.to_pylist():
                for k, line in enumerate(repaired_lines(p["lines"], p["audit"], p["state"])):
                    found.append((p["conv_id"], p["part"], p["place"], k, *line))
            yield batch_of(found, schema)

    kind = edited.schema["conv_id"].dataType.simpleString()
    names = [("part", pa.int32()), ("place", pa.int64()), ("line", pa.int64()), ("role", pa.string()), ("text", pa.string())]
    schema = pa.schema([("conv_id", arrow_types(edited.select("conv_id"))[0]), *names])
    return edited.select("conv_id", "part", "place", "lines", "audit", "state").mapInArrow(
        lines, f"conv_id {kind}, part int, place long, line long, role string, text string"
    )


def audit_damage(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per ``conv_id`` of ``rows``: its damaged rows (see ``damaged``) counted and repaired.

    Conversations of which no row is left have zeros, an empty audit and the digest of nothing.
    Otherwise as ``repair`` says.
    """
    done = repair(damaged(rows.select("conv_id", "turn", "role", "text")), piece)[1]
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    found = done.withColumnRenamed("conv_id", "_conv")
    joined = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    nothing = hashlib.sha256().hexdigest()
    return joined.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
