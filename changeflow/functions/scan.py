"""Running lookups along a log that stay balanced when one key holds most of the rows.

A plain ``Window.partitionBy(key).orderBy(seq)`` sorts all rows of a key in one task. Here each key's
log is cut into chunks of the order column, every chunk is summarised by a map-side combined
aggregation, the summaries (one row per key and chunk) are scanned, and the result is carried into
the chunks. No task sees more than one chunk of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def carry_previous(
    df: DataFrame,
    keys: list[str],
    value: Column,
    when: Column,
    out: str,
    seq: str = "seq",
    chunk: str = "chunk",
    forward: bool = False,
) -> DataFrame:
    """Add ``out``: ``value`` of the nearest strictly earlier row of the same keys for which ``when`` holds.

    ``value`` must not be null where ``when`` holds. ``chunk`` must be a monotone function of ``seq``.
    ``forward=True`` looks at strictly later rows instead.
    """
    marked = df.withColumn("_v", F.when(when, value))
    pick = F.min_by if forward else F.max_by
    sort = (lambda c: F.col(c).desc()) if forward else (lambda c: F.col(c).asc())
    summary = marked.groupBy(*keys, chunk).agg(
        pick("_v", F.when(F.col("_v").isNotNull(), F.col(seq))).alias("_tail")
    )
    over_chunks = Window.partitionBy(*keys).orderBy(sort(chunk)).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(*keys, chunk, F.last("_tail", ignorenulls=True).over(over_chunks).alias("_carry"))
    inside = Window.partitionBy(*keys, chunk).orderBy(sort(seq)).rowsBetween(Window.unboundedPreceding, -1)
    return (
        marked.join(carried, [*keys, chunk], "left")
        .withColumn(out, F.coalesce(F.last("_v", ignorenulls=True).over(inside), F.col("_carry")))
        .drop("_v", "_carry")
    )
