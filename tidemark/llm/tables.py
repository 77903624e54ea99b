"""Reading tables, keeping intermediate tables in the shared folder, and joins on hot keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where it is unset, as in tests, a temporary folder is set for a local session; a cluster
    without the setting is refused.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written to the shared folder and read back: cuts the lineage, and unlike a
    checkpoint lets the planner know the size."""
    spark = rows.sparkSession
    path = new_folder(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def fold_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed."""
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def spread_lookup(
    rows: DataFrame, lookup: DataFrame, keys: list[str], by: str, ways: int = 32, how: str = "left"
) -> DataFrame:
    """Join ``rows`` with ``lookup`` (one row per key) where a key may hold most of ``rows``.

    A key of ``rows`` is dealt over ``ways`` tasks by the hash of the column ``by``; ``lookup``
    is repeated as often.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(ways)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
