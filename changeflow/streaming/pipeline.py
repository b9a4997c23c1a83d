"""Continuous apply: source -> decode -> route -> net -> merge, one published version per micro-batch."""

from __future__ import annotations

import json
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.config import JobConfig
from changeflow.model import ENVELOPE_SCHEMA, Catalog, TableSpec
from changeflow.operators.apply import merge_batch
from changeflow.operators.archive import applied_script, to_sql_text, write_raw_archive, write_sql_archive, write_unload
from changeflow.operators.nopk import nopk_changes, nopk_delta
from changeflow.operators.route import known_tables, split_errors, with_target
from changeflow.plans.batch import TableBatch, apply_table, bind_or_reject, decode_and_route
from changeflow.session import cut_lineage
from changeflow.functions.text import start_position
from changeflow.sources.envelope import from_positions, read_envelope, start_positions, wanted_partitions
from changeflow.streaming.store import BY_HAND, MAX_DELTAS, SnapshotStore

# ``turn``: how often the partition had been released when it was held; a released row ends the holds of its turn
HOLD_SCHEMA = "topic string, partition int, first_bad bigint, turn int, released boolean"
PLACE = ["topic", "partition"]


def first_bad_offsets(events: DataFrame) -> DataFrame:
    """First bad offset per topic and partition: one row per held partition."""
    return (
        events.groupBy("topic", "partition")
        .agg(F.min(F.when(F.col("error").isNotNull(), F.col("offset"))).alias("first_bad"))
        .filter(F.col("first_bad").isNotNull())
    )


def hold_after_error(events: DataFrame, holds: DataFrame | None = None) -> DataFrame:
    """Rows before the first bad row of their partition; the partition stops there, others go on."""
    bad = cut_lineage(first_bad_offsets(events)) if holds is None else holds
    # one row per held partition: joined by key, all events would meet in as many tasks as the log has partitions
    return (
        events.join(F.broadcast(bad), ["topic", "partition"], "left")
        .filter(F.col("first_bad").isNull() | (F.col("offset") < F.col("first_bad")))
        .drop("first_bad")
    )


def dealt_out(batch: DataFrame) -> DataFrame:
    """Messages over all cores. Few files or log partitions would be as few tasks, and decoding is the dear step."""
    return batch.repartition(max(batch.sparkSession.sparkContext.defaultParallelism, batch.rdd.getNumPartitions()))


class Pipeline:
    """Applies micro-batches to a snapshot store. ``apply_batch`` is the ``foreachBatch`` function."""

    def __init__(self, spark: SparkSession, job: JobConfig, store: SnapshotStore, on_error: str | None = None, compact_every: int = MAX_DELTAS):
        self.compact_every = compact_every
        self.spark, self.job, self.store = spark, job, store
        self.catalog: Catalog = store.catalog
        self.on_error = on_error or job.on_error
        if not job.unload_dir:
            raise ValueError("unload_dir: name a folder that all executors can reach")

    # -- held partitions -----------------------------------------------------------------------------
    def _hold_log(self) -> DataFrame:
        try:
            return self.spark.read.schema(HOLD_SCHEMA).parquet(f"{self.store.root}/holds")
        except AnalysisException:
            return self.spark.createDataFrame([], HOLD_SCHEMA)

    def _turns(self) -> DataFrame:
        """Releases per partition that was released at all."""
        return self._hold_log().filter("released").groupBy(*PLACE).agg((F.max("turn") + 1).alias("_turn"))

    def holds(self) -> DataFrame:
        """Held partitions and the offset each of them stopped at."""
        held = self._hold_log().filter(~F.coalesce("released", F.lit(False))).join(cut_lineage(self._turns()), PLACE, "left")
        held = held.filter(F.coalesce("turn", F.lit(0)) >= F.coalesce("_turn", F.lit(0)))
        return held.groupBy(*PLACE).agg(F.min("first_bad").alias("first_bad"))

    def _good_rows(self, routed: DataFrame, release: bool = False) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        """Rows to apply, rows that are not applied, and the holds they are under."""
        if self.on_error != "hold":
            return *split_errors(routed, self.on_error), None
        new = cut_lineage(first_bad_offsets(routed))
        if not new.isEmpty():
            # an error of a release holds the partition in the turn that the release begins
            turn = F.coalesce("_turn", F.lit(0)) + int(release)
            self._log_holds(new.join(cut_lineage(self._turns()), PLACE, "left").select(*PLACE, "first_bad", turn.alias("turn"), F.lit(False).alias("released")))
        holds = new if release else cut_lineage(self.holds())
        good = hold_after_error(routed, holds)
        held = routed.join(F.broadcast(holds), PLACE).filter(F.col("offset") >= F.col("first_bad"))
        return good, held.drop("first_bad"), holds

    def _log_holds(self, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").parquet(f"{self.store.root}/holds")

    def parked(self, topic: str, partition: int) -> DataFrame:
        """Messages of a held partition from the offset it stopped at, as they are to be applied: the newest version of each offset."""
        hold = self.holds().filter((F.col("topic") == topic) & (F.col("partition") == partition))
        try:
            kept = self.spark.read.schema(f"{ENVELOPE_SCHEMA}, version int").parquet(f"{self.store.root}/parked")
        except AnalysisException:
            kept = self.spark.createDataFrame([], f"{ENVELOPE_SCHEMA}, version int")
        kept = kept.join(F.broadcast(hold), PLACE).filter(F.col("offset") >= F.col("first_bad"))
        message = F.struct(*[c for c in kept.columns if c not in (*PLACE, "offset", "first_bad")])
        newest = kept.groupBy(*PLACE, "offset").agg(F.max_by(message, "version").alias("m"))
        return newest.select("m.key", "m.value", *PLACE, "offset", "m.timestamp")

    def release(self, topic: str, partition: int, repaired: DataFrame | None = None, skip: DataFrame | None = None) -> bool:
        """Apply the parked messages of a held partition in log order and let the partition go on.

        ``repaired``: messages that replace parked ones of their offset; ``skip``: rows with an ``offset`` that are left out. If a message
        is still bad, those before it are applied and the partition is held there. Returns whether the partition is free. Call it
        between micro-batches or while the stream is stopped; a release that broke off is repeated by calling it again with the
        same arguments, and applied once.
        """
        here = (F.col("topic") == topic) & (F.col("partition") == partition)
        if self.on_error != "hold" or self.holds().filter(here).isEmpty():
            return True
        done = self._turns().filter(here).first()
        turn = done["_turn"] if done else 0
        messages = self.parked(topic, partition)
        if repaired is not None:
            fixed = cut_lineage(repaired.filter(here).select(*[c for c in messages.columns if c in repaired.columns]))
            unchanged = messages.join(fixed.select("offset"), "offset", "left_anti").select(*messages.columns)
            messages = unchanged.unionByName(fixed, allowMissingColumns=True)
        if skip is not None:
            messages = messages.join(skip.select("offset"), "offset", "left_anti").select(*messages.columns)
        self.apply_batch(cut_lineage(messages), turn, stream=f"release-{topic}-{partition}")
        row = [(topic, partition, None, turn, True)]
        self._log_holds(self.spark.createDataFrame(row, HOLD_SCHEMA))
        return self.holds().filter(here).isEmpty()

    # -- one batch -----------------------------------------------------------------------------------
    def stream_id(self) -> str:
        """Id of the streaming query whose batch this is: Spark keeps it with the checkpoint, so a new checkpoint is a new stream."""
        return self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or BY_HAND

    def apply_batch(self, batch: DataFrame, batch_id: int, stream: str | None = None) -> None:
        """Apply and publish one micro-batch; a batch that is already published is skipped, a failed one is listed as failed."""
        stream = stream or self.stream_id()
        if self.store.is_committed(batch_id, stream):
            return
        try:
            published = self._apply(batch, batch_id, stream)
        except Exception:
            self.store.publish(batch_id, [{"table_name": ""}], stream, status="failed")
            raise
        # a batch without rows is published too, so that it is not taken up again
        self.store.publish(batch_id, published or [{"table_name": ""}], stream)
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            for spec in self.catalog:
                self.store.compact(spec)

    def _apply(self, batch: DataFrame, batch_id: int, stream: str) -> list[dict]:
        job, place = self.job, f"stream={stream}/batch={batch_id}"
        routed = cut_lineage(decode_and_route(dealt_out(batch), job, self.catalog))
        release = stream.startswith("release-")
        good, bad, holds = self._good_rows(routed, release)
        if holds is not None and not holds.isEmpty():
            # in the log's own form, so that a release can decode repaired messages; a release writes a newer version
            version = F.lit(batch_id + 1 if release else 0)
            kept = batch.join(F.broadcast(holds), PLACE).filter(F.col("offset") >= F.col("first_bad"))
            kept.select(*batch.columns, version.alias("version")).write.mode("overwrite").parquet(f"{self.store.root}/parked/{place}")
        # archives have a folder per batch and are overwritten, so a repeated batch leaves them once
        if job.raw_dir and job.dump_binary:
            write_raw_archive(batch, f"{job.raw_dir}/{place}", job.max_file_records, "overwrite")
        # bad rows are counted with the table they name: at most one row per target table, one for all other names
        errors = {r["target"]: r["n"] for r in with_target(bad, self.catalog).groupBy("target").agg(F.count(F.lit(1)).alias("n")).collect()}
        if errors:
            write_unload(bad, f"{job.unload_dir}/{place}", max_records=job.max_file_records, mode="overwrite")
        good = known_tables(good, self.catalog)
        # at most one row per target table
        present = good.groupBy("schema_name", "table_name").agg(F.count(F.lit(1)).alias("messages")).collect()
        published = []
        for row in sorted(present):
            spec = self.catalog[f"{row['schema_name']}.{row['table_name']}"]
            events = good.filter((F.col("schema_name") == spec.schema) & (F.col("table_name") == spec.table))
            done = {"messages": row["messages"], **self._apply_table(events, spec, batch_id, stream, place)}
            done["rejects"] += errors.pop(spec.full_name, 0)
            published.append(done)
        return published + [{"table_name": name, "messages": n, "rejects": n} for name, n in sorted(errors.items())]

    def _apply_table(self, events: DataFrame, spec: TableSpec, batch_id: int, stream: str, place: str) -> dict:
        job, store = self.job, self.store
        if spec.has_pk:
            out, written = self._merge_delta(events, spec, batch_id, stream)
        else:
            out, written = self._count_delta(events, spec, batch_id, stream)
        if job.raw_dir:
            sql = to_sql_text(events, spec).withColumn("table_name", F.lit(spec.full_name))
            path = f"{job.raw_dir}/sql/{spec.full_name}/{place}"
            write_sql_archive(sql, path, ["table_name", "topic", "partition"], job.max_file_records, "overwrite")
        counts = {"rejects": out.rejects.count()}
        if counts["rejects"]:
            path = f"{job.unload_dir}/{spec.full_name}/{place}"
            write_unload(out.rejects, path, max_records=job.max_file_records, mode="overwrite")
        if out.net is not None:
            if job.load_dir:
                applied = applied_script(out.net, out.lineage(), spec).withColumn("table_name", F.lit(spec.full_name))
                path = f"{job.load_dir}/{spec.full_name}/{place}"
                write_sql_archive(applied, path, ["table_name", "topic", "partition"], job.max_file_records, "overwrite")
            ops = {"I": "inserts", "U": "updates", "K": "updates", "D": "deletes"}
            # at most four rows
            for r in out.net.groupBy("op").count().collect():
                counts[ops[r["op"]]] = counts.get(ops[r["op"]], 0) + r["count"]
        return {"table_name": spec.full_name, **written, **counts}

    def _merge_delta(self, events: DataFrame, spec: TableSpec, batch_id: int, stream: str) -> tuple[TableBatch, dict]:
        """Net against the stored keys, then write the new state of the rows that the net changes name.

        Of the table, only these rows in the touched buckets are read and joined.
        """
        store = self.store
        out = apply_table(events, spec, store.read(spec), self.job.update_mode, self.job.skip_unchanged, materialise=True)
        # both are counted and written
        out.net, out.rejects = cut_lineage(out.net), cut_lineage(out.rejects)
        buckets = store.touched_buckets(out.net, spec)
        named = [out.net.select(*[F.col(f"{side}_{k}").alias(k) for k in spec.key_names]) for side in "sd"]
        # a fresh row has no source key
        keys = cut_lineage(named[0].union(named[1]).dropna(subset=spec.key_names).distinct())
        before = store.read(spec, buckets).join(keys, spec.key_names, "left_semi")
        after = cut_lineage(merge_batch(before, out.net, spec))
        store.write_delta(after, keys.join(after, spec.key_names, "left_anti"), spec, batch_id, stream)
        return out, {"deltas": buckets}


    def _count_delta(self, events: DataFrame, spec: TableSpec, batch_id: int, stream: str) -> tuple[TableBatch, dict]:
        """Write the copies of rows that a batch adds to a table without a key or takes from it.

        Inserts read nothing of the table. Changes that compare all columns read the buckets of the rows they name; one that compares
        some of the columns can hit any row, so then all buckets are read. Only rows whose number changes are written.
        """
        store = self.store
        bound, rejects = bind_or_reject(events, spec, self.job.update_mode)
        good = events.filter(F.col("error").isNull())
        changes = cut_lineage(nopk_changes(good, spec))
        anywhere = not changes.filter(~F.col("full")).isEmpty()
        # at most one integer per bucket
        places = changes.select(F.pmod("place", F.lit(store.buckets)).cast("int").alias("b")).distinct()
        counted = store.read_counts(spec, None if anywhere else sorted(r["b"] for r in places.collect()))
        delta = cut_lineage(nopk_delta(counted, good, spec, changes))
        written = store.write_counts(delta, spec, batch_id, stream)
        return TableBatch(spec, bound, None, rejects, None), {"deltas": written}


def start_pipeline(
    spark: SparkSession,
    job: JobConfig,
    store: SnapshotStore,
    checkpoint: str,
    available_now: bool = False,
    on_error: str | None = None,
) -> StreamingQuery:
    """Start the continuous job. Offsets are checkpointed by Spark after a batch is published."""
    pipeline = Pipeline(spark, job, store, on_error)
    log = read_envelope(spark, job, streaming=True)
    if job.source != "kafka" and start_position(job.mode)[0] not in ("start", "committed"):
        log = from_positions(log, _stored_positions(spark, job, f"{checkpoint}-start"))
    writer = (
        log.writeStream.queryName("changeflow")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(pipeline.apply_batch)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{job.interval_s} seconds")
    query = writer.start()
    _STARTED[query.id] = (job, store, checkpoint)
    return query


# jobs started here by the id of their query: what an immediate stop needs to know of them
_STARTED: dict[str, tuple[JobConfig, SnapshotStore, str]] = {}


def _numbered(spark: SparkSession, path: str, field: str) -> DataFrame:
    """``(n, value)`` of the files of a checkpoint log that are named by batch number and hold JSON lines with ``field``."""
    try:
        lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    except AnalysisException:
        return spark.createDataFrame([], "n bigint, value string")
    lines = lines.filter(F.get_json_object("value", f"$.{field}").isNotNull())
    return lines.select(F.regexp_extract("file", r"^\d+", 0).try_cast("bigint").alias("n"), "value")


def unapplied_rows(spark: SparkSession, job: JobConfig, store: SnapshotStore, checkpoint: str, stream: str) -> DataFrame:
    """Messages of a file log that the stopped query ``stream`` has not applied, whether they were planned already or not.

    Spark's checkpoint lists the files of every planned batch and the batches that ended; a batch that the store has published is applied
    even if Spark could not note its end any more.
    """
    ended = _numbered(spark, f"{checkpoint}/commits", "nextBatchWatermarkMs").agg(F.max("n")).first()[0]
    published = store.published().filter(F.col("stream_id") == stream).agg(F.max("batch_id")).first()[0]
    last = max((n for n in (ended, published) if n is not None), default=-1)
    planned = _numbered(spark, f"{checkpoint}/offsets", "logOffset").filter(F.col("n") <= last)
    upto = planned.agg(F.max(F.get_json_object("value", "$.logOffset").cast("bigint"))).first()[0]
    taken = _numbered(spark, f"{checkpoint}/sources/0", "path")
    taken = taken.filter(F.get_json_object("value", "$.batchId").cast("bigint") <= (-1 if upto is None else upto))
    plain = lambda c: F.regexp_replace(F.url_decode(F.regexp_replace(c, r"\+", "%2B")), "^file:/+", "/")
    taken = taken.select(plain(F.get_json_object("value", "$.path")).alias("_file")).distinct()
    log = spark.read.schema(ENVELOPE_SCHEMA).format(job.source).load(job.path).withColumn("_file", plain(F.col("_metadata.file_path")))
    left = wanted_partitions(log.join(taken, "_file", "left_anti").drop("_file"), job)
    if start_position(job.mode)[0] not in ("start", "committed"):
        left = from_positions(left, _stored_positions(spark, job, f"{checkpoint}-start"))
    return left


def _stored_positions(spark: SparkSession, job: JobConfig, path: str) -> DataFrame:
    """Start offsets of a file log, fixed when the job starts first and kept beside its checkpoint."""
    schema = "topic string, partition int, start_offset bigint"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        log = wanted_partitions(spark.read.schema(ENVELOPE_SCHEMA).format(job.source).load(job.path), job)
        start_positions(log, job.mode).write.parquet(path)
        return spark.read.schema(schema).parquet(path)


def run_pipeline(spark: SparkSession, job: JobConfig, store: SnapshotStore, checkpoint: str, on_error: str | None = None) -> StreamingQuery:
    """Start the job and stop it once no rows came for its ``stream_timeout_s``; a negative one waits for ever."""
    query = start_pipeline(spark, job, store, checkpoint, on_error=on_error)
    run_until_idle(query, job.stream_timeout_s)
    return query


def progress_rows(query: StreamingQuery) -> DataFrame:
    """Recent progress of a running job, one row per micro-batch and source (Spark keeps a bounded number).

    Render it with ``stats.report(df, "consumers")`` or ``"loaders"``.
    """
    rows = [
        (
            p["batchId"], p["timestamp"], s["description"], str(s["startOffset"]), str(s["endOffset"]),
            int(s["numInputRows"]), float(s["inputRowsPerSecond"] or 0), float(s["processedRowsPerSecond"] or 0),
        )
        for p in (json.loads(q.json) for q in query.recentProgress)
        for s in p["sources"]
    ]
    return SparkSession.active().createDataFrame(
        rows,
        "batch_id bigint, timestamp string, source string, start_offset string, end_offset string, "
        "messages bigint, input_per_s double, processed_per_s double",
    )


def run_until_idle(query: StreamingQuery, idle_s: float, poll_s: float = 0.5) -> None:
    """Stop after no batch brought rows for ``idle_s`` seconds; -1 waits for ever."""
    if idle_s < 0:
        query.awaitTermination()
        return
    last_batch, since = None, time.monotonic()
    while query.isActive and time.monotonic() - since < idle_s:
        progress = query.lastProgress
        if progress and progress["numInputRows"] > 0 and progress["batchId"] != last_batch:
            last_batch, since = progress["batchId"], time.monotonic()
        elif query.status["isTriggerActive"] and query.status["isDataAvailable"]:
            since = time.monotonic()
        query.awaitTermination(poll_s)
    query.stop()


def stop(query: StreamingQuery, mode: str, pending: DataFrame | None = None, unload_dir: str | None = None) -> None:
    """``normal`` applies everything available, ``immediate`` archives what is left, ``abort`` drops it.

    ``immediate`` finds the messages of a file log that are not applied by itself (``unapplied_rows``) and archives them under the job's
    ``unload_dir``, in the folder ``unapplied``; ``pending`` overrides what is found, ``unload_dir`` the folder. A Kafka log keeps them itself:
    there the rows must be given.
    """
    if mode == "normal":
        query.processAllAvailable()
        query.stop()
    elif mode == "immediate":
        query.stop()
        job, store, checkpoint = _STARTED.get(query.id, (None, None, None))
        if pending is None and job is not None and job.source != "kafka":
            pending = unapplied_rows(store.spark, job, store, checkpoint, query.id)
            unload_dir = unload_dir or f"{job.unload_dir}/unapplied"
        if pending is not None and unload_dir:
            write_unload(pending, unload_dir, reason="unapplied")
    elif mode == "abort":
        query.stop()
    else:
        raise ValueError(f"stop mode must be normal, immediate or abort, not {mode!r}")
    _STARTED.pop(query.id, None)


def pending_rows(log: DataFrame, applied: DataFrame) -> DataFrame:
    """Rows of the log after the last applied offset of their partition (``applied``: partition progress)."""
    done = applied.select("topic", "partition", "last_offset")
    return (
        log.join(done, ["topic", "partition"], "left")
        .filter(F.col("last_offset").isNull() | (F.col("offset") > F.col("last_offset")))
        .drop("last_offset")
    )
