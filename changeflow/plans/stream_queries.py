"""Streaming queries: the events log as a stream of files, applied in several micro-batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow import fixed_values as fv
from changeflow.config import JobConfig, Topic
from changeflow.model import ENVELOPE_SCHEMA, Catalog
from changeflow.operators.bind import bind_changes
from changeflow.operators.route import bind_columns
from changeflow.operators.stats import throughput_stream
from changeflow.plans import logs
from changeflow.plans.log_queries import REJECTS_SQL
from changeflow.plans.net_queries import MERGED_SQL, NET_SQL, SEGMENTS
from changeflow.plans.registry import query
from changeflow.sources.decode_text import decode_ctrl
from changeflow.streaming.live_view import live_view
from changeflow.streaming.pipeline import Pipeline, start_pipeline
from changeflow.streaming.store import BY_HAND, SnapshotStore

USERS = logs.USERS
SLICES = 4


def side(value, none):
    """One image of a column in a control-character message."""
    tagged = F.coalesce(F.concat(F.lit(fv.TAG_DATA), value), F.lit(fv.TAG_NULL))
    return F.when(none, F.lit(fv.TAG_NONE)).otherwise(tagged)


def _messages(spark, d):
    """The events log as control-character messages in the envelope."""
    log = logs.events_log(spark, d)
    key = F.col("c1").cast("string")
    deleted, inserted = F.col("op") == "D", F.col("op") == "I"
    fields = [F.concat(F.lit("0"), side(key, deleted), side(key, inserted))]
    for i, n in enumerate(("c2", "c3", "c4"), 1):
        # the events do not know the old value of an update: NULL never counts as unchanged
        field = F.concat(F.lit(str(i)), side(F.col(n), deleted), side(F.when(deleted, F.col(n)), inserted))
        fields.append(F.when(F.col(f"has_{n}"), field))
    return _ctrl_envelope(log, USERS, fields)


def _ctrl_envelope(log, spec, fields):
    """Control-character messages of a table from a log with ``op``, its place and time."""
    head = F.concat_ws(fv.TAG_DATA, *[F.lit(x) for x in ("P", "1", "x", "l", "1", "8", "0")])
    text = F.concat_ws(fv.FIELD_SEP, head, F.lit(spec.full_name), "op", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), *fields)
    return log.select(
        F.lit(None).cast("binary").alias("key"), F.encode(text, "UTF-8").alias("value"),
        "topic", "partition", "offset", "timestamp")


def _feed(log, order, path, run):
    """Append the log in slices of the order column and let the stream take each slice as a micro-batch.

    A file stream takes files by modification time, so log order is kept by adding slices one after another;
    a slice may have any number of files.
    """
    cuts = log.approxQuantile(order, [(i + 1) / SLICES for i in range(SLICES - 1)], 0.05)
    bounds = [None, *cuts, None]
    for low, high in zip(bounds, bounds[1:]):
        part = log
        if low is not None:
            part = part.filter(F.col(order) > low)
        if high is not None:
            part = part.filter(F.col(order) <= high)
        if high is None:
            part = part.unionByName(log.filter(F.col(order).isNull()))
        part.write.mode("append").parquet(path)
        run().awaitTermination()


@query("stream_apply", MERGED_SQL + "SELECT * FROM merged")
def stream_apply(spark, d):
    """Decode, net and merge micro-batch by micro-batch; the published table equals one batch merge."""
    root = logs.work_dir(spark)
    catalog = Catalog([USERS])
    store = SnapshotStore(spark, f"{root}/store", catalog, buckets=8)
    store.load(logs.user_seed(spark, d), USERS)
    job = JobConfig(
        source="parquet", path=f"{root}/log", format="ctrl", skip=True,
        unload_dir=f"{root}/unload", load_dir=f"{root}/applied", raw_dir=f"{root}/raw", dump_binary=True)
    _feed(
        _messages(spark, d), "offset", f"{root}/log",
        lambda: start_pipeline(spark, job, store, f"{root}/offsets", available_now=True),
    )
    return store.read(USERS)


@query("stream_restart", MERGED_SQL + "SELECT * FROM merged")
def stream_restart(spark, d):
    """The log in two streams with checkpoints of their own, one after the other into one store that is opened again in between."""
    root = logs.work_dir(spark)
    catalog = Catalog([USERS])
    SnapshotStore(spark, f"{root}/store", catalog, buckets=8).load(logs.user_seed(spark, d), USERS)
    messages = _messages(spark, d)
    middle = messages.approxQuantile("offset", [0.5], 0.05)[0] if not messages.isEmpty() else 0
    for name, part in (("first", F.col("offset") <= middle), ("second", ~F.coalesce(F.col("offset") <= middle, F.lit(False)))):
        messages.filter(part).write.parquet(f"{root}/log-{name}")
        store = SnapshotStore(spark, f"{root}/store", catalog)
        job = JobConfig(source="parquet", path=f"{root}/log-{name}", format="ctrl", skip=True, unload_dir=f"{root}/unload")
        start_pipeline(spark, job, store, f"{root}/offsets-{name}", available_now=True).awaitTermination()
    return SnapshotStore(spark, f"{root}/store", catalog).read(USERS)


@query(
    "pipeline_rejects",
    REJECTS_SQL + """SELECT seq AS "offset", 'after_delete' AS reason FROM rej""",
)
def pipeline_rejects(spark, d):
    """The unload archive of one applied batch, read back: updates of rows that the batch deleted before."""
    root = logs.work_dir(spark)
    store = SnapshotStore(spark, f"{root}/store", Catalog([USERS]), buckets=8)
    store.load(logs.user_seed(spark, d), USERS)
    job = JobConfig(format="ctrl", skip=True, unload_dir=f"{root}/unload")
    Pipeline(spark, job, store).apply_batch(_messages(spark, d), 0)
    saved = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/unload/{USERS.full_name}")
    return saved.select("offset", F.col("error.code").alias("reason"))


@query(
    "job_envelope_check",
    """SELECT event_id AS "offset", CAST(user_id % 4 AS INT) AS "partition", 'unexpected_partition' AS reason FROM events
WHERE user_id % 4 NOT IN (0, 1, 3)""",
)
def job_envelope_check(spark, d):
    """What a job that asks for partitions 0, 1 and 3 of a topic puts aside of a batch with all of them."""
    root = logs.work_dir(spark)
    store = SnapshotStore(spark, f"{root}/store", Catalog([USERS]), buckets=8)
    store.load(logs.user_seed(spark, d), USERS)
    job = JobConfig(format="ctrl", skip=True, unload_dir=f"{root}/unload", topics=[Topic("events", partition="0-1,3")])
    Pipeline(spark, job, store).apply_batch(_messages(spark, d), 0)
    return spark.read.parquet(f"{root}/unload/stream={BY_HAND}/batch=0").select("offset", "partition", "reason")


@query("hold_release", MERGED_SQL + "SELECT * FROM merged")
def hold_release(spark, d):
    """Damaged messages hold two partitions over two batches; repaired and released, the table equals that of the whole log."""
    root = logs.work_dir(spark)
    store = SnapshotStore(spark, f"{root}/store", Catalog([USERS]), buckets=8)
    store.load(logs.user_seed(spark, d), USERS)
    job = JobConfig(format="ctrl", skip=True, unload_dir=f"{root}/unload")
    pipeline = Pipeline(spark, job, store, on_error="hold")
    sound = _messages(spark, d)
    damaged = (F.col("partition") < 2) & (F.col("offset") % 50 == 7)
    log = sound.withColumn("value", F.when(damaged, F.encode(F.lit("?"), "UTF-8")).otherwise(F.col("value")))
    middle = log.approxQuantile("offset", [0.5], 0.05)[0] if not log.isEmpty() else 0
    first = F.col("offset") <= middle
    for i, part in enumerate((first, ~first)):
        pipeline.apply_batch(log.filter(part), i)
    for partition in (0, 1):
        pipeline.release("events", partition, repaired=sound.filter(damaged))
    return store.read(USERS)


def _segment_messages(spark, d):
    """Steps for a table without a key: a row per supplier; per nation an update of all columns; in region 0 one that compares the
    segment alone; a delete, then an insert."""
    def step(table, i, op, key, old, new, rows=None):
        """``old``, ``new``: (nation, segment), None where the message does not carry it; a column without both is left out."""
        images = list(zip(old or (None, None), new or (None, None)))
        lit = lambda v: F.lit(None).cast("string") if v is None else v.cast("string")
        fields = [F.concat(F.lit(str(n)), side(lit(b), F.lit(b is None)), side(lit(a), F.lit(a is None))) for n, (a, b) in enumerate(images)]
        source = logs.table(spark, d, table)
        log = (source if rows is None else source.filter(rows)).select(
            F.lit("segments").alias("topic"), F.lit(0).alias("partition"), (F.lit(i * 10**12) + F.col(key)).alias("offset"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"), F.lit(op).alias("op"), *[f.alias(f"f{n}") for n, f in enumerate(fields)])
        return _ctrl_envelope(log, SEGMENTS, [F.col(f"f{n}") for n, (a, b) in enumerate(images) if a is not None or b is not None])

    nation, name, text = F.col("n_nationkey"), F.col("n_name"), F.lit
    parts = [
        step("supplier", 0, "I", "s_suppkey", None, (F.col("s_nationkey"), text("NEW"))),
        step("nation", 1, "U", "n_nationkey", (nation, text("BUILDING")), (nation, name)),
        step("nation", 2, "U", "n_nationkey", (None, name), (None, text("CLOSED")), F.col("n_regionkey") == 0),
        step("nation", 3, "D", "n_nationkey", (nation, text("FURNITURE")), None),
        step("nation", 4, "I", "n_nationkey", None, (nation, name)),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "stream_apply_nopk",
    """WITH rows_ AS (SELECT c_nationkey AS nation, c_mktsegment AS segment FROM customer UNION ALL SELECT s_nationkey, 'NEW' FROM supplier),
done AS (SELECT nation, CASE WHEN segment <> 'BUILDING' THEN segment WHEN n_regionkey = 0 THEN 'CLOSED' ELSE n_name END AS segment
  FROM rows_ JOIN nation ON n_nationkey = nation)
SELECT * FROM done WHERE segment <> 'FURNITURE' UNION ALL SELECT n_nationkey, n_name FROM nation""",
)
def stream_apply_nopk(spark, d):
    """A table without a key over four micro-batches, each of which writes the numbers of copies that it changes."""
    root = logs.work_dir(spark)
    store = SnapshotStore(spark, f"{root}/store", Catalog([SEGMENTS]), buckets=8)
    customers = logs.table(spark, d, "customer")
    store.load(customers.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")), SEGMENTS)
    job = JobConfig(source="parquet", path=f"{root}/log", format="ctrl", skip=True, unload_dir=f"{root}/unload")
    _feed(
        _segment_messages(spark, d), "offset", f"{root}/log",
        lambda: start_pipeline(spark, job, store, f"{root}/offsets", available_now=True),
    )
    return store.read(SEGMENTS)


LIVE_SQL = NET_SQL + """
SELECT op, c1, n2.v AS c2, n3.v AS c3, n4.v AS c4, n_events FROM net"""


@query("stream_live_view", LIVE_SQL)
def stream_live_view(spark, d):
    """Net state per key kept in the state store; each batch writes the keys it changed."""
    root = logs.work_dir(spark)
    # the state does not depend on the order of micro-batches
    # a micro-batch takes as many files as there are cores: one file is one task or two
    files = max(1, spark.sparkContext.defaultParallelism)
    _messages(spark, d).repartitionByRange(SLICES * files, "offset").write.parquet(f"{root}/log")
    stream = spark.readStream.schema(ENVELOPE_SCHEMA).option("maxFilesPerTrigger", files).parquet(f"{root}/log")
    events = bind_columns(decode_ctrl(stream), Catalog([USERS]), by="position")
    changes, _ = bind_changes(events, USERS)
    view = live_view(changes, USERS)

    def keep(batch, batch_id):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{root}/view/b={batch_id}")

    query_ = (
        view.writeStream.outputMode("update").option("checkpointLocation", f"{root}/offsets")
        .trigger(availableNow=True).foreachBatch(keep).start()
    )
    query_.awaitTermination()
    states = spark.read.parquet(f"{root}/view")
    fields = ["op", *[f"c_{n}" for n in USERS.value_names], "n_events"]
    latest = states.groupBy("d_c1").agg(F.max_by(F.struct(*fields), "batch_id").alias("s"))
    return latest.select(
        "s.op", F.col("d_c1").alias("c1"), *[F.col(f"s.c_{n}.cur").alias(n) for n in USERS.value_names], "s.n_events")


@query(
    "stream_throughput",
    """SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type AS op, CAST(count(*) AS BIGINT) AS n,
  CAST(floor(count(*) / 21600) AS BIGINT) AS speed FROM events
WHERE time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 60 SECOND GROUP BY 1, 2""",
)
def stream_throughput(spark, d):
    """Messages per window in streaming form; windows closed by the watermark are emitted once."""
    root = logs.work_dir(spark)
    events = logs.table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("event_ts"), F.col("event_type").alias("op"))

    def run():
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/log")
        return (
            throughput_stream(stream, 21600).writeStream.outputMode("append").format("parquet")
            .option("checkpointLocation", f"{root}/offsets").option("path", f"{root}/out").trigger(availableNow=True)
            .start()
        )

    _feed(events.withColumn("sec", F.unix_timestamp("event_ts")), "sec", f"{root}/log", run)
    out = spark.read.schema("start timestamp, op string, n bigint, speed bigint").parquet(f"{root}/out")
    return out.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
