"""Statistics as queries over change events, net changes, rejects and the commit log.

All are map-side combined aggregations; nothing is sorted or collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPS = ("I", "U", "K", "D")
REPORT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _bad() -> Column:
    return F.col("error").isNotNull()


def op_counts(events: DataFrame) -> DataFrame:
    """Messages and errors by operation."""
    return events.groupBy("op").agg(
        F.count_if(~_bad()).alias("messages"), F.count_if(_bad()).alias("errors")
    )


def op_totals(events: DataFrame) -> DataFrame:
    """One row: totals and messages and errors per operation."""
    per_op = []
    for op in OPS:
        per_op.append(F.count_if((F.col("op") == op) & ~_bad()).alias(f"messages_{op.lower()}"))
        per_op.append(F.count_if((F.col("op") == op) & _bad()).alias(f"errors_{op.lower()}"))
    return events.agg(F.count(F.lit(1)).alias("total"), F.count_if(_bad()).alias("errors"), *per_op)


def observe_ops(events: DataFrame, name: str = "changeflow") -> DataFrame:
    """The same totals as observed metrics of a running query (streaming progress)."""
    return events.observe(
        name,
        F.count(F.lit(1)).alias("total"),
        F.count_if(_bad()).alias("errors"),
        *[F.count_if(F.col("op") == op).alias(f"messages_{op.lower()}") for op in OPS],
    )


def table_stats(events: DataFrame, net: DataFrame, rejects: DataFrame) -> DataFrame:
    """Per table: messages by operation, net changes by operation, failures by operation.

    The inputs need ``table_name`` and ``op``.
    """
    parts = []
    for df, prefix, ops in ((events, "msgs", OPS), (net, "dmls", OPS), (rejects, "fails", OPS)):
        counts = df.select(
            "table_name",
            *[
                F.when(F.col("op") == op, 1).otherwise(0).cast("bigint").alias(f"{p}_{op.lower()}")
                if p == prefix else F.lit(0).cast("bigint").alias(f"{p}_{op.lower()}")
                for p in ("msgs", "dmls", "fails") for op in ops
            ],
        )
        parts.append(counts)
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return stacked.groupBy("table_name").agg(
        *[F.sum(c).alias(c) for c in stacked.columns if c != "table_name"]
    )


def load_stats(commits: DataFrame) -> DataFrame:
    """Loader totals from the commit log (one row per batch and table)."""
    per_batch = commits.groupBy("batch_id").agg(
        F.max("status").alias("status"),
        *[F.sum(c).alias(c) for c in ("messages", "inserts", "updates", "deletes", "rejects")],
    )
    done = F.count_if(F.col("status") == "done")
    return per_batch.agg(
        F.count(F.lit(1)).alias("tasks_total"),
        done.alias("tasks_done"),
        (F.count(F.lit(1)) - done).alias("tasks_todo"),
        done.alias("transactions_total"),
        F.count_if(F.col("status") == "failed").alias("transactions_fails"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("messages", "inserts", "updates", "deletes", "rejects")],
    )


def partition_progress(envelope: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Per topic and partition: number of records, last offset and the time of that record."""
    return envelope.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"),
        F.max("offset").alias("last_offset"),
        F.max_by(ts, "offset").alias("last_time"),
    )


def freshness(progress: DataFrame) -> DataFrame:
    """Oldest and newest last time over all partitions."""
    return progress.agg(F.min("last_time").alias("oldest"), F.max("last_time").alias("newest"))


def interval_counts(events: DataFrame, interval_s: int, by: list[str], ts: str) -> DataFrame:
    bucket = F.floor(F.unix_timestamp(ts) / interval_s).cast("bigint")
    return events.groupBy(*by, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def throughput(events: DataFrame, interval_s: int, by: list[str] | None = None, ts: str = "event_ts") -> DataFrame:
    """Messages per second: best interval, average over the run, last interval.

    ``by=["table_name", "op"]`` gives the speeds per table and operation.
    """
    by = by or []
    counts = interval_counts(events, interval_s, by, ts)
    span = (F.max("bucket") - F.min("bucket") + 1) * interval_s
    return counts.groupBy(*by).agg(
        F.floor(F.max("n") / interval_s).alias("max_speed"),
        F.floor(F.sum("n") / span).alias("avg_speed"),
        F.floor(F.max_by("n", "bucket") / interval_s).alias("cur_speed"),
        F.sum("n").alias("messages"),
    )


def throughput_stream(events: DataFrame, interval_s: int, lateness_s: int = 60, ts: str = "event_ts") -> DataFrame:
    """Streaming form: messages per tumbling window, closed by a watermark."""
    return (
        events.withWatermark(ts, f"{lateness_s} seconds")
        .groupBy(F.window(ts, f"{interval_s} seconds"), "op")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("start"), "op", "n", F.floor(F.col("n") / interval_s).alias("speed"))
    )


def error_counts(rejects: DataFrame) -> DataFrame:
    """Failed rows by operation and reason."""
    return rejects.groupBy("op", F.col("error.code").alias("code")).agg(F.count(F.lit(1)).alias("rows"))


def report(df: DataFrame, name: str, fmt: str = "json") -> DataFrame:
    """Render statistics rows as text or JSON lines.

    ``tables``: rows of ``table_stats``; ``tasks``: rows of ``partition_progress``; ``log``: the row of
    ``op_totals``; ``database``: the row of ``load_stats``; ``consumers`` and ``loaders``: any progress rows.
    """
    if fmt == "json":
        return df.select(F.to_json(_report_struct(df, name)).alias("line"))
    return df.select(_report_text(df, name).alias("line"))


def _by_op(prefix: str) -> Column:
    return F.struct(*[F.col(f"{prefix}_{op.lower()}").alias(op.lower()) for op in OPS])


# groups of counters by operation in the rows of a report: name in the report -> prefix of the columns
_GROUPS = {
    "tables": {"messages": "msgs", "applied": "dmls", "failed": "fails"},
    "log": {"messages": "messages", "errors_by_op": "errors"},
}


def _report_fields(df: DataFrame, name: str) -> list[Column]:
    """The row's own columns, its counters by operation grouped, times as text."""
    groups = _GROUPS.get(name, {})
    grouped = {f"{prefix}_{op.lower()}" for prefix in groups.values() for op in OPS}
    times = {f.name for f in df.schema.fields if f.dataType.typeName().startswith("timestamp")}
    own = [
        F.date_format(c, REPORT_TIME_FORMAT).alias(c) if c in times else F.col(c) for c in df.columns if c not in grouped
    ]
    return own + [_by_op(prefix).alias(label) for label, prefix in groups.items()]


def _report_struct(df: DataFrame, name: str) -> Column:
    return F.struct(*_report_fields(df, name))


def _report_text(df: DataFrame, name: str) -> Column:
    """``name: value`` pairs; a group of counters reads ``name: i=1 u=2 k=0 d=0``."""
    groups = _GROUPS.get(name, {})
    fields, parts = _report_fields(df, name), []
    for c, value in zip(df.select(*fields).columns, fields):
        if c in groups:
            counts = [F.concat(F.lit(f"{op.lower()}="), F.col(f"{groups[c]}_{op.lower()}").cast("string")) for op in OPS]
            text = F.concat_ws(" ", *counts)
        else:
            text = F.coalesce(value.cast("string"), F.lit("null"))
        parts.append(F.concat(F.lit(f"{c}: "), text))
    return F.concat_ws(", ", *parts)
