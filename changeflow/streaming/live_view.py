"""Current state per key as a streaming aggregation: the netting aggregate kept across micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.model import TableSpec
from changeflow.operators.net import net_changes


def live_view(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Net state of every key over the whole stream so far (inserts, updates, deletes).

    ``changes`` are wide change rows of a stream. Because order travels with each value, late or
    reordered micro-batches give the same state. Combined map-side before the state store, so a hot
    key costs one row per task and batch. Write it in ``update`` or ``complete`` mode; ``op`` D means the key is
    gone, U that only updates were seen.
    """
    return net_changes(changes, spec)


def live_rows(view: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of the view whose key was inserted and not deleted."""
    return view.filter(F.col("op") == "I").select(
        *[
            F.col(f"d_{n}").alias(n) if n in spec.key_names else F.col(f"c_{n}")["cur"].alias(n)
            for n in spec.column_names
        ]
    )
