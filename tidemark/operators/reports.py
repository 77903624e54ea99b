"""Text reports of ranked windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"


def ranking_report(
    top: DataFrame,
    key: str,
    cnt: str = "cnt",
    title: str = "time: ",
    header: str = "key -> count",
) -> DataFrame:
    """One text per window: a title line, a header line and a line per ranked key.

    ``top`` comes from ``top_n``, so a window holds at most N lines.
    """
    line = F.concat(F.col(key).cast("string"), F.lit(" -> "), F.col(cnt).cast("string"))
    lines = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    body = F.array_join(F.col("lines.line"), "\n")
    head = F.concat(F.lit(title), F.date_format("window_end", TIME_PATTERN))
    return (
        top.groupBy("window_end")
        .agg(lines.alias("lines"))
        .select("window_end", F.concat_ws("\n", head, F.lit(header), body).alias("report"))
    )
