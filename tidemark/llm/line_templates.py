"""Line dedup by a fixed-depth tree of log templates, in built-in expressions only.

Tokens with digits are variable.  A line is parsed as units: its tokens, or where these are more
than ``UNITS`` at most ``GROUPS`` groups of 4, 8, 16 and so on tokens that follow each other.  Only lines of
which at least half of the units stand in several documents, at the same place of lines with as
many tokens, can be of a template; all others end there.  Texts are parted once: all that follows
knows a unit, with its place, by a hash of 64 bits, and lines that differ in other units only as
one pattern.

These go down a tree: the number of tokens, then the first and the second unit, with one child
for every unit that has its share of the lines of a node and a wildcard child for all others.  In
a leaf, what is constant is measured by the line itself: by the support of the least frequent of
the units that must be constant.  A template must stand in several documents, and in at least
half of those that have its rarest constant: words that are common by themselves make no
template.  Lines of recurring templates are dropped, but for the document that has them first.
All but the number of documents goes by shares, so a template is found in a large table as in a
small one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

#: Documents a template must stand in.
MIN_DOCS = 10

#: So much of a line's units must be constant; in lines of up to SHORT tokens that is every token.
CONSTANT, SHORT = 0.5, 3

#: Units of a line, at most: single tokens, or groups, up to the longest.
UNITS, GROUPS, LONGEST_GROUP = 16, 8, 1 << 16

#: A unit has a child of its own if it has so much of a node's lines.
BRANCH = 0.01

#: Constant are units with at least so much of the support that the line's constants have: one
#: template a share.
SHARES = (0.5, 1.0)

#: A template has so many of the documents that have its rarest constant at its place.
OF_RAREST = 0.5

VARIABLE = "<*>"

#: Frequent units, and lines that may be of templates, that are sent to all tasks, not shuffled.
MOST_BROADCAST = 1_000_000


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def masked(low: Column) -> Column:
    """A lower-case line with white space as single spaces and tokens that hold a digit as variable."""
    wide = low.contains("  ") | low.rlike(r"[\t\x0B\f\r]")
    spaced = F.when(wide, F.regexp_replace(low, r"[ \t\x0B\f\r]+", " ")).otherwise(low)
    fields = F.when(low.rlike(r"\d"), F.regexp_replace(spaced, r"(?<!\S)[^\s\d]*+\d\S*+", VARIABLE)).otherwise(spaced)
    # One search tells that a line has none of all this, as most have.
    return F.when(low.contains("  ") | low.rlike(r"[\d\t\x0B\f\r]"), fields).otherwise(low)


def clean(line: Column) -> Column:
    return F.trim(line)


def line_table(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``line`` (masked) and ``n``, its tokens, for the lines of every row."""
    lines = docs.select("doc_id", F.explode(F.array_distinct(F.split(F.lower("text"), "\n"))).alias("low"))
    # Out of an explode, so that no later use of a line masks it again.
    lines = lines.select("doc_id", F.explode(F.array(clean(masked(F.col("low"))))).alias("line")).where("line <> ''")
    spaces = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit("")))
    return lines.withColumn("n", spaces + 1)


def units(line: Column, n: Column) -> Column:
    """The tokens of a line, or groups of them if they are many."""
    cut = F.when(n <= UNITS, F.split(line, " "))
    group = 4
    while group < LONGEST_GROUP:
        cut = cut.when(n <= GROUPS * group, F.regexp_extract_all(line, F.lit(r"\S++(?: \S++){0,%d}+" % (group - 1)), F.lit(0)))
        group *= 2
    return cut.otherwise(F.regexp_extract_all(line, F.lit(r"\S++(?: \S++){0,%d}+" % (group - 1)), F.lit(0)))


def must_be_constant(n: Column, count: Column, constant: float) -> Column:
    return F.when(n <= SHORT, n).otherwise(F.ceil(count * constant - F.lit(1e-9))).cast("int")


def sent(rows: DataFrame) -> DataFrame:
    """``rows``, broadcast if they are few."""
    return F.broadcast(rows) if rows.count() <= MOST_BROADCAST else rows


def placed_lines(lines: DataFrame) -> DataFrame:
    """``doc_id``, ``key``, ``n`` and ``units`` of the lines: a unit as hash of itself and its place, or null if variable."""
    number = lambda unit, at: F.when(unit != VARIABLE, F.xxhash64("n", at, unit))
    return lines.select("doc_id", line_key(F.col("line")).alias("key"), "n", F.transform(units(F.col("line"), F.col("n")), number).alias("units"))


def place_bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(62)).cast("int"))


def candidate_lines(placed: DataFrame, min_docs: int, constant: float) -> DataFrame:
    """The rows of ``placed`` of which enough units are frequent at their place among lines of as many
    tokens, with their ``pattern``: these units, all others being variable."""
    each = placed.select("key", "n", F.size("units").alias("m"), F.posexplode("units").alias("at", "unit")).where("unit IS NOT NULL")
    frequent = each.groupBy("unit").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    frequent = stored(frequent.select("unit"), "frequent-units")
    # A bit for each place: copies of a line count once.  Beyond 62 units, of lines with millions
    # of tokens, bits are shared and fewer of them are asked for.
    bits = F.bit_or(place_bit(F.col("at"))).alias("bits")
    hits = each.join(sent(frequent), "unit").groupBy("key", "n", "m").agg(bits)
    needed = must_be_constant(F.col("n"), F.least("m", F.lit(62)), constant)
    keys = stored(hits.where(F.bit_count("bits") >= needed).select("key", "bits"), "candidate-lines")
    # A unit that is not frequent at its place has no support in any leaf.
    known = lambda unit, at: F.when(F.col("bits").bitwiseAND(place_bit(at)) != 0, unit)
    cut = placed.join(sent(keys), "key").select("doc_id", "key", "n", F.transform("units", known).alias("units"))
    names = F.transform("units", lambda unit: F.coalesce(unit.cast("string"), F.lit(VARIABLE)))
    return cut.withColumn("pattern", line_key(F.concat_ws(" ", "n", names)))


def with_leaf(patterns: DataFrame, min_docs: int) -> DataFrame:
    """``patterns`` with ``leaf``: the path of their lines down the tree."""
    parsed = patterns.withColumn("leaf", F.col("n").cast("string"))
    for depth in range(2):
        parsed = parsed.withColumn("step", F.get("units", F.lit(depth)))
        nodes = parsed.groupBy(F.col("leaf").alias("_leaf")).agg(F.sum("docs").alias("all"))
        steps = parsed.where("step IS NOT NULL").groupBy("leaf", "step").agg(F.sum("docs").alias("some"))
        children = steps.join(nodes, F.col("leaf") == F.col("_leaf"))
        children = children.where((F.col("some") >= min_docs) & (F.col("some") >= BRANCH * F.col("all")))
        children = children.select("leaf", "step", F.lit(True).alias("own"))
        step = F.when(F.col("own"), F.col("step").cast("string")).otherwise(VARIABLE)
        parsed = parsed.join(children, ["leaf", "step"], "left").withColumn("leaf", F.concat_ws("\n", "leaf", step))
        parsed = parsed.drop("own", "step")
    return parsed.select("pattern", "n", "units", "docs", F.unhex(F.md5("leaf")).alias("leaf"))


def templates(parsed: DataFrame, min_docs: int, constant: float) -> DataFrame:
    """``pattern``, each ``template`` its lines belong to, and the support of the rarest constant."""
    placed = F.transform("units", lambda unit, at: F.struct(at.alias("at"), unit.alias("unit")))
    # Two passes read these rows: they are made once.
    fields = stored(parsed.select("leaf", "pattern", "docs", F.inline(F.filter(placed, lambda x: x["unit"].isNotNull()))), "pattern-units")
    supports = fields.groupBy("leaf", "at", "unit").agg(F.sum("docs").alias("support")).where(F.col("support") >= min_docs)
    known = fields.drop("docs").join(supports, ["leaf", "at", "unit"])
    parts = known.groupBy("pattern").agg(F.collect_list(F.struct("at", "unit", "support")).alias("fields"))
    needed = must_be_constant(F.col("n"), F.size("units"), constant)
    ranked = F.sort_array(F.col("fields.support"), asc=False)
    found = parsed.join(parts, "pattern").where(F.size("fields") >= needed).withColumn("level", F.element_at(ranked, needed))

    def template(share: float) -> Column:
        fixed = F.filter("fields", lambda x: x["support"] >= F.col("level") * share)
        # Equal numbers of tokens and equal constants are equal templates.
        places = F.array_sort(F.transform(fixed, lambda x: F.struct(x["at"].alias("at"), x["unit"].alias("unit"))))
        name = F.concat_ws(" ", "n", F.hex("leaf"), F.to_json(places))
        return F.struct(F.unhex(F.md5(name)).alias("template"), F.array_min(F.transform(fixed, lambda x: x["support"])).alias("rarest"))

    each = F.array_distinct(F.array(*[template(share) for share in SHARES]))
    return found.select("pattern", F.inline(each))


def recurring_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    constant: float = CONSTANT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``key`` of the lines to drop."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    lines = line_table(named.where(F.col("doc_id").isNotNull()))
    # Texts are parted once: all that follows reads the numbers of their units.
    placed = stored(placed_lines(lines), "placed-lines")
    candidates = stored(candidate_lines(placed, min_docs, constant).distinct(), "template-lines")
    # Lines that differ in variable units only go down the tree once.
    patterns = candidates.groupBy("pattern", "n", "units").agg(F.count("*").alias("docs"))
    found = stored(templates(stored(with_leaf(patterns, min_docs), "parsed-lines"), min_docs, constant), "templates")
    keys = candidates.select("doc_id", "key", "pattern")
    # Lines of a template are many, and so are those of a pattern: the adaptive planner deals them.
    recurring = (
        keys.join(found, "pattern")
        .select("template", "rarest", "doc_id")
        .distinct()
        .groupBy("template")
        .agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("rarest").alias("rarest"))
        .where((F.col("n") >= min_docs) & (F.col("n") >= OF_RAREST * F.col("rarest")))
    )
    # A line goes with the most frequent of its templates.
    most = F.max_by("first", F.struct("n", "template")).alias("first")
    of_lines = found.select("pattern", "template").join(recurring, "template").groupBy("pattern").agg(most)
    return keys.join(of_lines, "pattern").where("doc_id <> first").select("doc_id", "key")


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` without the lines whose template recurs across documents.

    All columns stay; ``dropped_lines`` is new (or replaced) and counts the lines that went.
    Of the documents with a template the one with the smallest id keeps its lines.  Null and
    empty texts stay as they are.  Rows without an id are neither counted nor changed.  Rows
    with one id count as one document.  An empty table gives an empty result.  ``limits`` are
    those of ``recurring_lines``.
    """
    columns = [c for c in docs.columns if c != "dropped_lines"]
    drops = (
        recurring_lines(docs, id_col=id_col, text_col=text_col, **limits)
        .groupBy(F.col("doc_id").alias("drop_id"))
        .agg(F.collect_set("key").alias("drops"))
    )
    # The row is kept as one value, so no column can clash; texts go to the join in it, not twice.
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).alias("id"))
    joined = rows.join(drops, F.col("id") == F.col("drop_id"), "left").withColumn("text", F.col("row").getField(text_col))
    # Only texts with lines to drop are parted again.
    dropping = F.col("drops").isNotNull()
    both = F.arrays_zip(F.split("text", "\n").alias("line"), F.split(F.lower("text"), "\n").alias("low"))
    kept = F.filter(both, lambda x: ~F.array_contains("drops", line_key(clean(masked(x["low"])))))
    split = joined.withColumn("kept", F.when(dropping, kept))
    changed = F.when(F.col("kept").isNull(), F.col("text")).otherwise(F.array_join(F.col("kept.line"), "\n"))
    lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    gone = F.when(F.col("kept").isNull(), F.lit(0)).otherwise(lines - F.size("kept"))
    out = [(changed if c == text_col else F.col("row").getField(c)).alias(c) for c in columns]
    return split.select(*out, gone.cast("long").alias("dropped_lines"))
