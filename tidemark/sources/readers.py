"""Text-log readers; every function takes and gives batch or streaming frames alike.

Parsing uses Spark's own expressions only.  A malformed line is kept with ``_rejected``
set instead of failing the job: ``accepted`` and ``rejected`` split one parsed frame
into the two outputs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.formats import RecordFormat

ACCESS_TIME_PATTERN = "dd/MM/yyyy:HH:mm:ss"

# Positions of the used fields in a space-separated web access-log line (fixed values).
ACCESS_IP, ACCESS_TIME, ACCESS_URL = 0, 3, 6


# Times from year 1 to year 9999, in seconds; others are no times of a log.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def read_lines(
    spark: SparkSession, path: str, streaming: bool = False, numbered: bool = False
) -> DataFrame:
    """Lines of a file or directory as column ``value``.

    ``numbered`` adds ``_place``, a text that orders lines by the path of their file and their
    place in it, the same way for a batch and a stream.
    """
    lines = (spark.readStream if streaming else spark.read).text(path)
    if not numbered:
        return lines
    placed = lines.select("value", "_metadata.file_path", "_metadata.file_block_start")
    # Within a block of a file the lines are read in order by one task.
    if streaming:
        counted = placed.mapInArrow(_count_lines, "value string, file_path string, file_block_start long, n long")
    else:
        counted = placed.withColumn("n", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    digits = [F.lpad(F.col(c).cast("string"), 20, "0") for c in ("file_block_start", "n")]
    return counted.select("value", F.concat_ws(":", "file_path", *digits).alias("_place"))


def _count_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = 0
    for batch in batches:
        numbers = pa.array(range(seen, seen + batch.num_rows), pa.int64())
        seen += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, numbers], [*batch.schema.names, "n"])


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _records(lines: DataFrame, sep: str, fields: list[Column], required: list[str]) -> DataFrame:
    """``fields``, computed from the array ``_parts`` of each line, plus ``_line`` and ``_rejected``.

    The fields come out of ``inline``: a filter on them then stays above it, where on a
    plain projection it would be pushed below and split and parse every line again.
    """
    place = [c for c in lines.columns if c == "_place"]
    split = lines.select(F.col("value").alias("_line"), *place, F.split("value", sep).alias("_parts"))
    records = split.select("_line", *place, F.inline(F.array(F.struct(*fields))))
    return records.withColumn("_rejected", _any([F.col(name).isNull() for name in required]))


def _fields(fmt: RecordFormat) -> list[Column]:
    """The typed fields of a format, of the array ``_parts``."""
    fields = []
    for position, (name, kind) in enumerate(fmt.fields):
        text = F.trim(F.get("_parts", F.lit(position)))
        value = F.when(text != "", text)
        if kind != "string":
            value = value.try_cast(kind)
        if name == "ts":
            unit = 1 if fmt.unit == "seconds" else 1000
            value = F.when(value.between(FIRST_SECOND * unit, LAST_SECOND * unit + unit - 1), value)
            value = F.timestamp_seconds(value) if unit == 1 else F.timestamp_millis(value)
        fields.append(value.alias(name))
    return fields


def _required(fmt: RecordFormat) -> list[str]:
    return [name for name, _ in fmt.fields if name not in fmt.optional]


def parse_lines(lines: DataFrame, fmt: RecordFormat) -> DataFrame:
    """Typed columns of ``fmt`` plus ``_line`` and ``_rejected``."""
    return _records(lines, fmt.sep, _fields(fmt), _required(fmt))


def parse_mixed(lines: DataFrame, formats: Sequence[RecordFormat], name_col: str = "format") -> DataFrame:
    """Lines of several formats in one pass; ``name_col`` has the name of each line's format.

    Gives ``name_col``, a struct for every format that is set on its own lines, ``_line`` and
    ``_rejected``; a line of another format, or of none, is rejected.
    """
    mine = {fmt: F.col(name_col) == fmt.name for fmt in formats}

    def of_format(values: dict[RecordFormat, Column], otherwise: Column | None = None) -> Column:
        chosen = reduce(lambda found, fmt: found.when(mine[fmt], values[fmt]), formats, F)
        return chosen if otherwise is None else chosen.otherwise(otherwise)

    parts = of_format({fmt: F.split("value", fmt.sep) for fmt in formats}).alias("_parts")
    split = lines.select(name_col, F.col("value").alias("_line"), parts)
    structs = [F.when(mine[fmt], F.struct(*_fields(fmt))).alias(fmt.name) for fmt in formats]
    records = split.select(name_col, "_line", F.inline(F.array(F.struct(*structs))))
    missing = {fmt: _any([F.col(f"{fmt.name}.{name}").isNull() for name in _required(fmt)]) for fmt in formats}
    return records.withColumn("_rejected", of_format(missing, F.lit(True)))


def parse_access_log(lines: DataFrame) -> DataFrame:
    """``ip, ts, url`` of web access-log lines plus ``_line`` and ``_rejected``."""
    time = F.get("_parts", F.lit(ACCESS_TIME))
    fields = [
        F.get("_parts", F.lit(ACCESS_IP)).alias("ip"),
        F.try_to_timestamp(time, F.lit(ACCESS_TIME_PATTERN)).alias("ts"),
        F.get("_parts", F.lit(ACCESS_URL)).alias("url"),
    ]
    return _records(lines, " ", fields, ["ts", "url"])


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("_rejected")).drop("_line", "_rejected")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where("_rejected").select(F.col("_line").alias("line"))


def read_parsed(
    spark: SparkSession, path: str, fmt: RecordFormat, streaming: bool = False, numbered: bool = False
) -> DataFrame:
    return parse_lines(read_lines(spark, path, streaming, numbered), fmt)


def read_events(
    spark: SparkSession,
    path: str,
    fmt: RecordFormat,
    streaming: bool = False,
    seq: str | None = None,
) -> DataFrame:
    """Well-formed records of ``fmt``.

    ``seq`` names an extra column with the place of the record: by the path of its file, then
    by its place in the file.  The sequence operators use it to order records of equal time, of
    a batch and of a stream alike.
    """
    events = accepted(read_parsed(spark, path, fmt, streaming, seq is not None))
    return events.withColumnRenamed("_place", seq) if seq else events


def read_access_log(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return accepted(parse_access_log(read_lines(spark, path, streaming)))
