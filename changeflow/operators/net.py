"""Netting: all changes of a key inside a batch -> at most one net change.

Net rows carry ``op`` (I, U, K, D), source key ``s_*``, destination key ``d_*`` and ``c_*`` columns as in
``bind``. They all refer to the snapshot *before* the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeflow.functions.scan import carry_previous
from changeflow.model import TableSpec
from changeflow.operators.bind import dst_cols, val_cols


def overlay_aggs(spec: TableSpec, with_old: bool = False) -> list[Column]:
    """Per column the last set value with its order, and the first old value if wanted.

    ``max(struct(seq, cur))`` keeps an explicit NULL (the struct is not null) and combines map-side, so
    a key with most of the rows costs one row per input partition in the shuffle.
    """
    aggs = []
    for c in val_cols(spec):
        is_set = F.col(c).isNotNull()
        last = F.struct(F.col("seq"), F.col(c)["cur"].alias("cur"))
        aggs.append(F.max(F.when(is_set, last)).alias(f"last_{c}"))
        if with_old:
            first = F.struct(F.col("seq"), F.col(c)["old"].alias("old"))
            aggs.append(F.min(F.when(is_set, first)).alias(f"first_{c}"))
    return aggs


def overlay_columns(spec: TableSpec, with_old: bool, keep: Column) -> list[Column]:
    """``c_*`` columns from the overlay aggregates; ``keep(last.seq)`` decides if the value still counts."""
    out = []
    for c in val_cols(spec):
        last = F.col(f"last_{c}")
        fields = [last["cur"].alias("cur")]
        if with_old:
            fields.append(F.col(f"first_{c}")["old"].alias("old"))
        alive = last.isNotNull() & keep(last["seq"])
        out.append(F.when(alive, F.struct(*fields)).alias(c))
    return out


def net_changes(changes: DataFrame, spec: TableSpec, with_old: bool = False) -> DataFrame:
    """Net changes of a batch without key changes: one aggregation, one shuffle by key.

    The last I or D of a key resets the row; a column's last value counts if it is not older than the
    reset. No pre-pass and no window is needed because order and value travel together.
    """
    keys = dst_cols(spec)
    resets = F.col("op").isin("I", "D")
    grouped = changes.groupBy(*keys).agg(
        F.max(F.when(resets, F.struct("seq", "op"))).alias("reset"),
        *overlay_aggs(spec, with_old),
        F.count(F.lit(1)).alias("n_events"),
        F.max("seq").alias("last_seq"),
    )
    reset = F.col("reset")

    def keep(seq: Column) -> Column:
        return reset.isNull() | ((reset["op"] == "I") & (seq >= reset["seq"]))

    return grouped.select(
        F.coalesce(reset["op"], F.lit("U")).alias("op"),
        *[F.col(k).alias("s" + k[1:]) for k in keys],
        *keys,
        *overlay_columns(spec, with_old, keep),
        "n_events",
        "last_seq",
    )


def net_changes_long(events: DataFrame) -> DataFrame:
    """Net changes of many tables in one shuffle, in long form.

    Input: change events without key changes with ``schema_name``, ``table_name``, ``row_key`` (array of key
    strings), ``op``, ``seq`` and ``cols``. Output: one row per table and key with ``op`` and the map
    ``cols`` of net current values. Rows are exploded to (key, column), combined map-side, and put
    back together per key, so both shuffles carry one row per key and column at most.
    """
    key = ["schema_name", "table_name", "row_key"]
    # the column '' carries the reset information of the row
    entries = F.concat(
        F.array(F.struct(F.lit("").alias("key"), F.lit(None).cast("string").alias("cur"))),
        F.transform(
            F.map_entries(F.map_filter("cols", lambda _, v: v["has_cur"])),
            lambda e: F.struct(e["key"].alias("key"), e["value"]["cur"].alias("cur")),
        ),
    )
    resets = F.col("op").isin("I", "D") & (F.col("e.key") == "")
    per_column = (
        events.select(*key, "op", "seq", F.explode(entries).alias("e"))
        .groupBy(*key, F.col("e.key").alias("column"))
        .agg(
            F.max(F.struct("seq", F.col("e.cur").alias("cur"))).alias("last"),
            F.max(F.when(resets, F.struct("seq", "op"))).alias("reset"),
        )
    )
    # columns per key are bounded by the table width
    per_key = per_column.groupBy(*key).agg(
        F.max("reset").alias("reset"),
        F.collect_list(F.when(F.col("column") != "", F.struct("column", "last"))).alias("items"),
    )
    reset = F.col("reset")
    live = F.filter(
        "items", lambda i: reset.isNull() | ((reset["op"] == "I") & (i["last"]["seq"] >= reset["seq"]))
    )
    return per_key.select(
        *key,
        F.coalesce(reset["op"], F.lit("U")).alias("op"),
        F.map_from_entries(F.transform(live, lambda i: F.struct(i["column"], i["last"]["cur"]))).alias("cols"),
    )


def with_epoch(df: DataFrame, spec: TableSpec | None = None) -> DataFrame:
    """Epoch number per topic and partition: how many K events came up to and including this one.

    Counted per offset block first, then inside the block, so one partition is not one task.
    """
    blocks = df.groupBy("chunk").agg(F.count_if(F.col("op") == "K").alias("_k"))
    part = Window.partitionBy("chunk.topic", "chunk.partition").orderBy("chunk.block")
    before = blocks.select(
        "chunk", (F.sum("_k").over(part) - F.col("_k")).alias("_before")
    )
    inside = Window.partitionBy("chunk").orderBy("seq")
    is_k = F.when(F.col("op") == "K", 1).otherwise(0)
    return (
        df.join(before, "chunk")
        .withColumn("epoch", F.col("_before") + F.sum(is_k).over(inside))
        .drop("_before")
    )


def net_lineage(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Which offsets made each net change, one row per contributing change (without key changes).

    Long form on purpose: an array per key would put all rows of a hot key into one cell. Updates that hit
    a row deleted earlier in the batch do not contribute.
    """
    keys = dst_cols(spec)
    flagged = _flag_after_delete(changes.select("seq", "chunk", "op", *keys), keys)
    return flagged.filter(~F.col("after_delete")).select(
        *keys, F.col("seq.topic").alias("topic"), F.col("seq.partition").alias("partition"),
        F.col("seq.offset").alias("offset"), "op",
    )


def net_offsets(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Offset range and count of the changes behind every net change, map-side combined."""
    lineage = net_lineage(changes, spec)
    return lineage.groupBy(*dst_cols(spec)).agg(
        F.count(F.lit(1)).alias("n_offsets"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.sum("offset").alias("offset_sum"),
    )


def _flag_after_delete(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Mark updates whose last earlier I or D of the key in this batch is a D."""
    resets = F.col("op").isin("I", "D")
    marked = carry_previous(changes, keys, F.col("op"), resets, "_reset")
    hit = (F.col("op") == "U") & F.coalesce(F.col("_reset") == "D", F.lit(False))
    return marked.withColumn("after_delete", hit).drop("_reset")


def net_rejects(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Updates of rows that an earlier change of the same batch deleted (no key changes)."""
    flagged = _flag_after_delete(changes, dst_cols(spec))
    return (
        flagged.filter("after_delete")
        .drop("after_delete")
        .withColumn("error", F.struct(F.lit("after_delete").alias("code"), F.lit(None).cast("string").alias("detail")))
    )


def unchanged(cur: Column, old: Column) -> Column:
    """A set column counts as unchanged only if both values are present and equal."""
    return F.coalesce(cur == old, F.lit(False))


def drop_noop_updates(net: DataFrame, spec: TableSpec) -> DataFrame:
    """Remove unchanged columns from updates, and updates that change nothing.

    Needs net rows with old values (``net_changes(..., with_old=True)``).
    """
    is_update = F.col("op").isin("U", "K")
    slim = net.select(
        *[
            F.when(is_update & F.col(n).isNotNull() & unchanged(F.col(n)["cur"], F.col(n)["old"]), None)
            .otherwise(F.col(n))
            .alias(n)
            if n in val_cols(spec)
            else F.col(n)
            for n in net.columns
        ]
    )
    sets_something = F.lit(False)
    for c in val_cols(spec):
        sets_something = sets_something | F.col(c).isNotNull()
    return slim.filter((F.col("op") != "U") | sets_something)


def net_without_noops(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Net changes without columns that end as they began, by the old values in the messages, and without updates that change nothing."""
    slim = drop_noop_updates(net_changes(changes, spec, with_old=True), spec)
    return slim.select(*[
        F.when(F.col(n).isNotNull(), F.struct(F.col(n)["cur"].alias("cur"))).alias(n) if n in val_cols(spec) else F.col(n) for n in slim.columns
    ])


def net_report(changes: DataFrame, net: DataFrame, table: str) -> DataFrame:
    """Messages in against net changes out, by operation, for one table."""
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("op").agg(F.count(F.lit(1)).alias(name))

    return (
        counts(changes, "messages")
        .join(counts(net, "net"), "op", "full_outer")
        .select(
            F.lit(table).alias("table_name"),
            "op",
            F.coalesce("messages", F.lit(0)).cast("bigint").alias("messages"),
            F.coalesce("net", F.lit(0)).cast("bigint").alias("net"),
        )
    )
