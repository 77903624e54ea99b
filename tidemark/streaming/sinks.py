"""Stream and batch outputs: print, several typed outputs of one pass, rankings per window."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tidemark.operators.topn import top_n


def print_rows(df: DataFrame, mode: str = "append") -> DataStreamWriter | None:
    """Show the rows of a batch, or a writer that shows every micro-batch (start it yourself)."""
    if df.isStreaming:
        return df.writeStream.format("console").outputMode(mode).option("truncate", False)
    df.show(truncate=False)
    return None


def write_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], mode: str = "append"
) -> DataStreamWriter:
    return df.writeStream.outputMode(mode).foreachBatch(write)


def _filesystem(spark, path: str):
    """The file system of a path, and a function from text to its paths."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def write_split(
    df: DataFrame, kind_col: str, path: str, kinds: list[str], fmt: str = "parquet"
) -> DataStreamWriter | None:
    """Write the rows of every kind apart, in one write; ``read_split`` reads those of a kind.

    Rows are written once, into a directory per kind, and a manifest then lists the parts of
    each kind; what has no manifest is not there.  A kind that is not among ``kinds`` is an
    error, so no row is lost silently.  A stream writes a directory per micro-batch and
    replaces it when the batch is repeated after a failure, so every row is there once.
    """
    known = F.coalesce(F.col(kind_col).isin(list(kinds)), F.lit(False))
    unknown = F.concat(F.lit("no path for the kind "), F.coalesce(F.col(kind_col), F.lit("NULL")))
    checked = F.when(known, F.col(kind_col)).otherwise(F.raise_error(unknown))

    def write(batch: DataFrame, name: str) -> None:
        rows = batch.withColumn("_kind", checked).drop(kind_col)
        rows.write.mode("overwrite").partitionBy("_kind").format(fmt).save(f"{path}/rows/{name}")
        _write_manifest(rows, path, name, fmt)

    if df.isStreaming:
        return write_batches(df, lambda batch, n: write(batch, f"batch-{n}"))
    write(df, "all")
    return None


def _write_manifest(rows: DataFrame, path: str, name: str, fmt: str) -> None:
    spark = rows.sparkSession
    files, place = _filesystem(spark, path)
    parts: dict[str, list[str]] = {}
    for kind in files.listStatus(place(f"{path}/rows/{name}")):
        if kind.isDirectory():
            parts[kind.getPath().getName()] = [part.getPath().getName() for part in files.listStatus(kind.getPath())]
    text = json.dumps({"format": fmt, "schema": rows.schema.jsonValue(), "parts": parts})
    # Complete under another name first, so no reader sees half of it.
    half, whole = place(f"{path}/manifests/.{name}"), place(f"{path}/manifests/{name}.json")
    out = files.create(half, True)
    out.write(text.encode())
    out.close()
    files.delete(whole, False)
    files.rename(half, whole)


def read_split(spark, path: str, kind: str) -> DataFrame:
    """The rows of one kind, as far as manifests tell; no part of another kind is read."""
    files, place = _filesystem(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(place(f"{path}/manifests"))]
    found, schema, fmt = [], None, "parquet"
    for name in sorted(n for n in names if n.endswith(".json")):
        text = spark.read.text(f"{path}/manifests/{name}", wholetext=True).first()[0]
        manifest = json.loads(text)
        fmt, schema = manifest["format"], StructType.fromJson(manifest["schema"])
        rows = f"{path}/rows/{name.removesuffix('.json')}"
        found += [f"{rows}/{d}/{part}" for d, parts in manifest["parts"].items() if unquote(d) == f"_kind={kind}" for part in parts]
    if schema is None:
        raise ValueError(f"no manifest under {path}")
    schema = StructType([field for field in schema if field.name != "_kind"])
    return spark.read.schema(schema).format(fmt).load(found) if found else spark.createDataFrame([], schema)


def replace_windows(
    updates: DataFrame, keys: list[str], path: str, window_end: str = "window_end", fmt: str = "parquet"
) -> DataStreamWriter:
    """Keep the latest row of every key and window under ``path`` (update mode).

    A micro-batch writes the windows it changes anew, each a directory: its own rows and, of
    the other keys, those that are there.  So late rows change a stored window, nothing
    else is touched, and a batch that is repeated after a failure gives the same windows.
    Rows carry the number of the batch that wrote them; ``read_windows`` reads them.
    """
    spark = updates.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        files, place = _filesystem(spark, path)
        staged = f"{path.rstrip('/')}-updates"
        marked = batch.withColumns({"_batch": F.lit(number).cast("bigint"), "_window": F.unix_micros(F.col(window_end).cast("timestamp"))})
        marked.write.mode("overwrite").format(fmt).save(staged)
        new = batch.sparkSession.read.schema(marked.schema).format(fmt).load(staged)
        if files.exists(place(path)):
            of_batch = new.select("_window", *keys).withColumn("_there", F.lit(True))
            stored = batch.sparkSession.read.schema(new.schema).format(fmt).load(path)
            stored = stored.join(new.select("_window").distinct(), "_window", "left_semi")
            same = reduce(lambda a, b: a & b, [stored[c].eqNullSafe(of_batch[c]) for c in ("_window", *keys)])
            new = stored.join(of_batch, same, "left_anti").select(*new.columns).unionByName(new)
        writer = new.repartition("_window").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("_window").format(fmt).save(path)
        files.delete(place(staged), True)

    return write_batches(updates, write, "update")


def read_windows(spark, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The rows that ``replace_windows`` keeps, with the columns of ``schema``."""
    return spark.read.schema(schema).format(fmt).load(path).select(*schema.names)


def write_top_n(
    counts: DataFrame, n: int, tie: str, path: str, cnt: str = "cnt", fmt: str = "parquet"
) -> DataStreamWriter:
    """Rank the windows that closed in each micro-batch.

    In append mode all counts of a window are final in the same micro-batch, so ranking
    the batch ranks whole windows, with the same cut before the shuffle as in batch use.
    """

    def write(batch: DataFrame, number: int) -> None:
        ranked = top_n(batch, n, tie, cnt)
        ranked.write.mode("overwrite").format(fmt).save(f"{path}/batch={number}")

    return write_batches(counts, write)
