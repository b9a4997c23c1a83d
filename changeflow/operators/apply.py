"""Apply net changes to a snapshot DataFrame. All joins are equi-joins on the key columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow import fixed_values as fv
from changeflow.model import TableSpec


def _on(spec: TableSpec, prefix: str = "s_") -> Column:
    cond = None
    for k in spec.key_names:
        eq = F.col(f"snap.{k}") == F.col(f"net.{prefix}{k}")
        cond = eq if cond is None else cond & eq
    return cond


def _net_row(spec: TableSpec) -> list[Column]:
    """A complete row from a net change: absent columns are NULL."""
    return [
        F.col(f"d_{n}").alias(n) if n in spec.key_names else F.col(f"c_{n}")["cur"].alias(n)
        for n in spec.column_names
    ]


def _overlaid(spec: TableSpec, hit: Column, full: bool = False) -> list[Column]:
    """Snapshot row with the columns of a matching net change on top."""
    out = []
    for n in spec.column_names:
        if n in spec.key_names:
            col = F.when(hit, F.col(f"net.d_{n}")).otherwise(F.col(f"snap.{n}"))
        else:
            c = F.col(f"net.c_{n}")
            takes = hit if full else hit & c.isNotNull()
            col = F.when(takes, c["cur"]).otherwise(F.col(f"snap.{n}"))
        out.append(col.alias(n))
    return out


def apply_upsert(snapshot: DataFrame, net: DataFrame, spec: TableSpec) -> DataFrame:
    """Insert net inserts, replacing rows that have the same key."""
    inserts = net.filter(F.col("op") == "I")
    kept = snapshot.alias("snap").join(inserts.alias("net"), _on(spec, "d_"), "left_anti")
    return kept.unionByName(inserts.select(*_net_row(spec)))


def apply_update(snapshot: DataFrame, net: DataFrame, spec: TableSpec, full: bool = False) -> DataFrame:
    """Overlay net updates on the rows they name; updates of missing rows have no effect.

    ``full=True`` replaces the whole row: columns the update does not set become NULL.
    """
    updates = net.filter(F.col("op") == "U")
    joined = snapshot.alias("snap").join(updates.alias("net"), _on(spec), "left")
    return joined.select(*_overlaid(spec, F.col("net.op").isNotNull(), full))


def apply_delete(snapshot: DataFrame, net: DataFrame, spec: TableSpec) -> DataFrame:
    """Remove the rows named by net deletes."""
    deletes = net.filter(F.col("op") == "D")
    return snapshot.alias("snap").join(deletes.alias("net"), _on(spec), "left_anti")


def apply_key_change(snapshot: DataFrame, net: DataFrame, spec: TableSpec) -> DataFrame:
    """Move rows from their old to their new key and overlay the columns of the change."""
    moves = net.filter(F.col("op") == "K")
    joined = snapshot.alias("snap").join(moves.alias("net"), _on(spec), "left")
    return joined.select(*_overlaid(spec, F.col("net.op").isNotNull()))


def merge_batch(snapshot: DataFrame, net: DataFrame, spec: TableSpec) -> DataFrame:
    """The whole batch: stored rows take their net change in one left join on the source key, net inserts are added.

    Every net row refers to the snapshot before the batch, so order among I, U, K and D does not matter. A stored row that is
    named by a net delete or insert goes. Fresh rows placed by a key change have a null source key: they are inserts that match nothing.
    Unlike a full outer join, a left join can send out a net that proves small; a checkpointed net has no measured size and is joined by key.
    """
    named = net.filter(F.col(f"s_{spec.key_names[0]}").isNotNull()).alias("net")
    joined = snapshot.select(*spec.column_names).alias("snap").join(named, _on(spec), "left")
    op = F.col("net.op")
    kept = joined.filter(op.isNull() | op.isin("U", "K")).select(*_overlaid(spec, op.isNotNull()))
    return kept.unionByName(net.filter(F.col("op") == "I").select(*_net_row(spec)))


def batch_rows(spec: TableSpec | Column, batch_size: int = fv.DEFAULT_BATCH_SIZE) -> int | Column:
    """Rows per write batch: the configured size, capped so that a batch stays within the commit size.

    Of a table, or as a column of a column with the table's width in bytes.
    """
    if isinstance(spec, Column):
        fits = F.floor(F.lit(fv.COMMIT_BYTES) / F.greatest(F.lit(1).cast("bigint"), spec))
        return F.greatest(F.lit(1).cast("bigint"), F.least(F.lit(batch_size).cast("bigint"), fits))
    width = sum(c.width for c in spec.columns)
    return max(1, min(batch_size, fv.COMMIT_BYTES // max(1, width)))


def read_in_key_order(snapshot: DataFrame, spec: TableSpec) -> DataFrame:
    """The table in key order (a range-partitioned sort)."""
    return snapshot.select(*spec.column_names).orderBy(*spec.key_names)
