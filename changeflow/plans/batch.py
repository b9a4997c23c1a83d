"""One batch end to end: envelope -> decode -> route -> bind -> net -> merge."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.config import JobConfig
from changeflow.model import Catalog, TableSpec
from changeflow.operators.apply import merge_batch
from changeflow.operators.bind import bind_changes
from changeflow.operators.keychange import batch_lineage, net_batch
from changeflow.operators.nopk import replay_nopk
from changeflow.operators.route import bind_columns, known_tables, map_columns, map_tables, split_by_table, split_errors
from changeflow.session import configure, cut_lineage
from changeflow.sources.envelope import assigned_partitions, envelope_error, topic_config
from changeflow.sources.registry import decode


def decode_and_route(envelope: DataFrame, job: JobConfig, catalog: Catalog) -> DataFrame:
    """Change events bound to target tables and columns; bad rows carry ``error``."""
    spark = configure(envelope.sparkSession)
    events = decode(topic_config(envelope, job.topic_schemas()), job, catalog)
    if job.topics:
        events = events.withColumn("error", F.coalesce(envelope_error(assigned_partitions(job)), "error"))
    if job.mappings:
        events = map_tables(events, job.mappings_df(spark), catalog)
        if any(m.columns for m in job.mappings):
            events = map_columns(events, job.column_mappings_df(spark))
    return bind_columns(events, catalog, by="position" if job.format == "ctrl" else "name")


@dataclass
class TableBatch:
    spec: TableSpec
    changes: DataFrame
    net: DataFrame | None
    rejects: DataFrame
    # None where only what changed is written
    table: DataFrame | None
    # offsets behind every net change, worked out when asked for; None for tables without a key
    lineage: Callable[[], DataFrame] | None = None


def bind_or_reject(events: DataFrame, spec: TableSpec, update_mode: str = "sparse") -> tuple[DataFrame, DataFrame]:
    """Typed changes of one table and the events that cannot be bound."""
    changes, unbound = bind_changes(events, spec, update_mode)
    return changes, unbound.select("topic", "partition", "offset", "item", "op", "error")


def apply_table(
    events: DataFrame, spec: TableSpec, snapshot: DataFrame, update_mode: str = "sparse", skip_unchanged: bool = False,
    materialise: bool = False,
) -> TableBatch:
    """Bind, net and merge the events of one table.

    ``materialise`` writes the typed changes of a table with a key once: netting, rejects and lineage read them several times, and they
    are far narrower than the events.
    """
    changes, unbound = bind_or_reject(events, spec, update_mode)
    if materialise and spec.has_pk:
        changes = cut_lineage(changes)
    if not spec.has_pk:
        good = events.filter(F.col("error").isNull())
        return TableBatch(spec, changes, None, unbound, replay_nopk(snapshot, good, spec))
    result = net_batch(changes, spec, snapshot, skip_unchanged)
    collided = result.rejects.select("seq.topic", "seq.partition", "seq.offset", "seq.item", "op", "error")
    return TableBatch(
        spec, changes, result.net, unbound.unionByName(collided), merge_batch(snapshot, result.net, spec),
        lambda: batch_lineage(changes, spec, result),
    )


def run_batch(
    envelope: DataFrame,
    job: JobConfig,
    catalog: Catalog,
    snapshots: dict[str, DataFrame],
    materialise: bool = True,
) -> dict[str, TableBatch]:
    """Apply one batch of messages to all target tables of the catalog.

    The decoded batch is written once, because every table and several passes of the key-change path read it;
    ``materialise=False`` suits a single table with inserts, updates and deletes only.
    """
    routed = decode_and_route(envelope, job, catalog)
    if materialise:
        routed = cut_lineage(routed)
    good, _bad = split_errors(routed, job.on_error)
    per_table = split_by_table(known_tables(good, catalog), catalog)
    return {
        name: apply_table(events, catalog[name], snapshots[name], job.update_mode, job.skip_unchanged)
        for name, events in per_table.items()
    }
