"""Streaming apply: exactly-once publishing, batch-split invariance, held partitions, drain modes."""

import pytest
from pyspark.sql import functions as F
from test_golden import MIX, MIX_SEED, NOPK, NOPK_TAIL, NOPK_WANT, ONEKEY, ctrl, envelope, ins

from changeflow.config import JobConfig, Topic
from changeflow.model import Catalog
from changeflow.operators.stats import load_stats, partition_progress, report
from changeflow.plans import stream_queries
from changeflow.plans.batch import apply_table, decode_and_route
from changeflow.streaming.pipeline import Pipeline, dealt_out, hold_after_error, pending_rows, progress_rows, run_until_idle, start_pipeline, stop
from changeflow.streaming.store import SnapshotStore

WANT = [
    (1, "aaa", "((("), (3, "ddd", "+++"), (4, "uuu1", "uuu2"),
    (6, "uuu2", "uuu1"), (7, "insert1", "insert2"), (9, "kkk2", "kkk1"),
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def setup(spark, tmp_path, spec, seed, **job):
    store = SnapshotStore(spark, str(tmp_path / "store"), Catalog([spec]), buckets=4)
    store.load(spark.createDataFrame(seed, spec.row_schema()), spec)
    cfg = JobConfig(
        format="ctrl", def_schema="S", source="parquet", path=str(tmp_path / "log"), skip=True,
        unload_dir=str(tmp_path / "unload"), max_files_per_trigger=1, interval_s=1, **job
    )
    return store, cfg


def write_log(spark, messages, path):
    """One file per message, in order."""
    df = envelope(spark, messages).withColumn("key", F.lit(None).cast("binary"))
    df.repartitionByRange(len(messages), "offset").write.mode("append").parquet(path)


def test_batches_publish_once_and_replay_is_a_no_op(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, MIX_SEED, load_dir=str(tmp_path / "applied"), raw_dir=str(tmp_path / "raw"), dump_binary=True)
    pipeline = Pipeline(spark, job, store)
    log = envelope(spark, MIX + ["rubbish"])
    pipeline.apply_batch(log.filter("offset < 9"), 0)
    pipeline.apply_batch(log.filter("offset >= 9"), 1)
    assert rows(store.read(ONEKEY)) == WANT
    pipeline.apply_batch(log, 1)
    assert rows(store.read(ONEKEY)) == WANT
    assert spark.read.parquet(str(tmp_path / "unload" / "stream=batch" / "batch=1")).count() == 1
    assert spark.read.text(str(tmp_path / "applied")).filter("value like 'DELETE%'").count() > 0
    assert spark.read.parquet(str(tmp_path / "raw" / "stream=batch" / "batch=0")).count() == 9
    # a crash before publishing: the batch is done again and its archives are there once
    again = SnapshotStore(spark, str(tmp_path / "again"), Catalog([ONEKEY]), buckets=4)
    again.load(spark.createDataFrame(MIX_SEED, ONEKEY.row_schema()), ONEKEY)
    Pipeline(spark, job, again).apply_batch(log.filter("offset < 9"), 0)
    assert spark.read.parquet(str(tmp_path / "raw" / "stream=batch" / "batch=0")).count() == 9
    totals = load_stats(store.commits().filter("batch_id >= 0")).first()
    assert (totals["tasks_done"], totals["messages"], totals["rejects"]) == (2, 15, 1)


def test_unpublished_version_is_invisible_and_redone(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, MIX_SEED)
    # a crash after writing and before publishing
    store.write(spark.createDataFrame([(99, "half", "done")], ONEKEY.row_schema()), ONEKEY, 0)
    assert rows(store.read(ONEKEY)) == sorted(MIX_SEED)
    Pipeline(spark, job, store).apply_batch(envelope(spark, MIX), 0)
    assert rows(store.read(ONEKEY)) == WANT


def test_only_touched_buckets_are_written(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, MIX_SEED)
    Pipeline(spark, job, store).apply_batch(envelope(spark, [ctrl("U", (0, 6, 6), (1, "x", "update"))]), 0)
    commit = store.commits().filter("batch_id = 0").first()
    assert len(commit["deltas"]) == 1 and commit["buckets"] == []
    assert (6, "x", "update") in rows(store.read(ONEKEY)) and len(rows(store.read(ONEKEY))) == 4


def test_emptied_bucket_stays_empty(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, [(5, "a", "b")])
    Pipeline(spark, job, store).apply_batch(envelope(spark, [ctrl("D", (0, ..., 5))]), 0)
    assert rows(store.read(ONEKEY)) == []
    Pipeline(spark, job, store).apply_batch(envelope(spark, [ins(5, "c", "d")]), 1)
    assert rows(store.read(ONEKEY)) == [(5, "c", "d")]


def test_stream_without_primary_key(spark, tmp_path):
    store, job = setup(spark, tmp_path, NOPK, MIX_SEED)
    pipeline = Pipeline(spark, job, store)
    log = envelope(spark, MIX[:11] + NOPK_TAIL + MIX[13:])
    pipeline.apply_batch(log.filter("offset < 7"), 0)
    pipeline.apply_batch(log.filter("offset >= 7"), 1)
    assert rows(store.read(NOPK)) == NOPK_WANT


def test_batch_without_primary_key_writes_only_what_it_changes(spark, tmp_path):
    seed = [(i, "same", "b") for i in range(20)] + [(1, "same", "b")] * 3
    store, job = setup(spark, tmp_path, NOPK, seed)
    pipeline = Pipeline(spark, job, store, compact_every=4)
    steps = [
        ins(50, "x", "y"),
        ctrl("U", (0, 2, 1), (1, "same", "same"), (2, "b", "b")),
        ctrl("U", (2, "c", "b"), (1, "same", "same")),
        ctrl("D", (0, ..., 50), (1, ..., "x"), (2, ..., "y")),
    ]
    # the insert, four rows that become others, all old rows, the delete
    states = [24, 24, 24, 23]
    deltas = [1, 2, 2 * 19, 1]
    log = envelope(spark, steps)
    read = []
    counts = store.read_counts
    store.read_counts = lambda spec, buckets=None: read.append(buckets) or counts(spec, buckets)
    for i, n in enumerate(states):
        pipeline.apply_batch(log.filter(F.col("offset") == i), i)
        assert spark.read.parquet(str(tmp_path / "store" / "S.T" / "stream=batch" / f"batch={i}" / "delta")).count() == deltas[i]
        assert store.read(NOPK).count() == n
    want = sorted([(i, "same", "c") for i in range(20) if i != 1] + [(2, "same", "c")] * 4, key=repr)
    assert rows(store.read(NOPK)) == want
    # inserts read no bucket, changes of whole rows one, a change that compares some columns all of them
    asked = [read[0], read[2], read[4], read[6]]
    assert [b if b is None else len(b) for b in asked] == [0, 1, None, 1]
    assert store.compact(NOPK, max_deltas=0)
    assert store._versions(NOPK).filter("delta").count() == 0 and rows(store.read(NOPK)) == want
    # a repeated batch changes nothing
    pipeline.apply_batch(log.filter("offset = 2"), 2)
    assert rows(store.read(NOPK)) == want


def test_partition_is_held_after_an_error(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, [])
    pipeline = Pipeline(spark, job, store, on_error="hold")
    one = envelope(spark, [ins(1, "a", "b"), "rubbish", ins(2, "a", "b")])
    other = envelope(spark, [ins(11, "a", "b"), ins(12, "a", "b")]).withColumn("partition", F.lit(1))
    pipeline.apply_batch(one.unionByName(other), 0)
    later = envelope(spark, [ins(3, "a", "b")]).withColumn("offset", F.lit(10).cast("bigint"))
    pipeline.apply_batch(later.unionByName(later.withColumn("partition", F.lit(1))), 1)
    assert [r[0] for r in rows(store.read(ONEKEY))] == [1, 11, 12, 3]


def test_continuous_run_until_idle_then_normal_stop(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, MIX_SEED)
    write_log(spark, MIX[:3], job.path)
    query = start_pipeline(spark, job, store, str(tmp_path / "offsets"))
    run_until_idle(query, 20)
    assert not query.isActive
    progress = progress_rows(query)
    assert progress.agg(F.sum("messages")).first()[0] == 3
    assert '"messages"' in report(progress, "consumers").first()["line"]
    assert [r[0] for r in rows(store.read(ONEKEY))] == [1, 2, 3, 5, 6, 7, 8]
    write_log(spark, [MIX[5]], job.path)
    query = start_pipeline(spark, job, store, str(tmp_path / "offsets"))
    stop(query, "normal")
    assert [r[0] for r in rows(store.read(ONEKEY))] == [1, 3, 5, 6, 7, 8]


def test_immediate_stop_archives_what_is_left(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, [])
    log = envelope(spark, [ins(i, "a", "b") for i in range(4)])
    Pipeline(spark, job, store).apply_batch(log.filter("offset < 3"), 0)
    write_log(spark, [ins(0, "a", "b")], job.path)
    query = start_pipeline(spark, job, store, str(tmp_path / "offsets"))
    left = pending_rows(log, partition_progress(log.filter("offset < 3")))
    stop(query, "immediate", left, job.unload_dir)
    saved = spark.read.parquet(job.unload_dir)
    assert [(r["offset"], r["reason"]) for r in saved.collect()] == [(3, "unapplied")]
    with pytest.raises(ValueError):
        stop(query, "sometime")


def test_a_new_checkpoint_goes_on_in_the_same_store(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, [])
    for i in range(2):
        write_log(spark, [ins(10 * i + n, "a", "b") for n in range(3)], f"{job.path}{i}")
        own = JobConfig(**{**vars(job), "path": f"{job.path}{i}"})
        start_pipeline(spark, own, store, str(tmp_path / f"offsets{i}"), available_now=True).awaitTermination()
    assert sorted(r[0] for r in rows(store.read(ONEKEY))) == [0, 1, 2, 10, 11, 12]


def test_another_number_of_buckets_is_refused(spark, tmp_path):
    store, _ = setup(spark, tmp_path, ONEKEY, MIX_SEED)
    with pytest.raises(ValueError, match="4 buckets"):
        SnapshotStore(spark, store.root, store.catalog, buckets=7)
    assert rows(SnapshotStore(spark, store.root, store.catalog).read(ONEKEY)) == sorted(MIX_SEED)


def test_failed_batch_is_listed(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, MIX_SEED)
    strict = JobConfig(**{**vars(job), "skip": False})
    with pytest.raises(Exception):
        Pipeline(spark, strict, store).apply_batch(envelope(spark, ["rubbish"]), 0)
    Pipeline(spark, job, store).apply_batch(envelope(spark, MIX), 1)
    totals = load_stats(store.commits().filter("batch_id >= 0")).first()
    assert (totals["tasks_total"], totals["tasks_done"], totals["transactions_fails"]) == (2, 1, 1)
    assert rows(store.read(ONEKEY)) == WANT


def test_updates_after_a_delete_are_archived_and_counted(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, MIX_SEED)
    log = envelope(spark, [ins(1, "a", "b"), ctrl("D", (0, ..., 1)), ctrl("U", (0, 1, 1), (1, "x", "a"))])
    Pipeline(spark, job, store).apply_batch(log, 0)
    saved = spark.read.option("recursiveFileLookup", "true").parquet(f"{job.unload_dir}/{ONEKEY.full_name}").collect()
    assert [r["offset"] for r in saved] == [2]
    assert store.commits().filter("batch_id = 0").first()["rejects"] == 1


def test_compaction_keeps_the_table(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, MIX_SEED)
    pipeline = Pipeline(spark, job, store)
    for i in range(4):
        pipeline.apply_batch(envelope(spark, [ins(20 + i, "a", "b"), ctrl("U", (0, 6, 6), (1, f"x{i}", "update")), ctrl("D", (0, ..., 19 + i))]), i)
    before = rows(store.read(ONEKEY))
    assert (6, "x3", "update") in before and [r[0] for r in before if r[0] >= 20] == [23]
    rewritten = store.compact(ONEKEY, max_deltas=2)
    assert rewritten and store.compact(ONEKEY, max_deltas=2) == []
    assert rows(store.read(ONEKEY)) == before
    pipeline.apply_batch(envelope(spark, [ctrl("D", (0, ..., 23))]), 4)
    assert [r for r in rows(store.read(ONEKEY)) if r[0] >= 20] == []


def test_released_partition_goes_on(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, [])
    pipeline = Pipeline(spark, job, store, on_error="hold")
    keys = lambda: [r[0] for r in rows(store.read(ONEKEY))]
    log = envelope(spark, [ins(1, "a", "b"), "rubbish", ins(2, "a", "b"), "rubbish", ins(3, "a", "b"), ins(4, "a", "b")])
    pipeline.apply_batch(log.filter("offset < 5"), 0)
    pipeline.apply_batch(log.filter("offset >= 5"), 1)
    assert keys() == [1]
    topic, partition = log.select("topic", "partition").first()
    # a free partition has nothing to release
    assert pipeline.release(topic, partition + 1)
    # not repaired: held at the same place, nothing applied
    assert not pipeline.release(topic, partition) and keys() == [1]
    # the first error repaired: applied up to the second one
    mended = envelope(spark, [ins(8, "a", "b"), ins(9, "a", "b")]).withColumn("offset", F.col("offset") * 2 + 1)
    assert not pipeline.release(topic, partition, mended.filter("offset = 1"))
    assert keys() == [1, 2, 8]
    assert sorted(r["offset"] for r in pipeline.parked(topic, partition).collect()) == [3, 4, 5]
    # the second one left out; what comes later is applied again
    assert pipeline.release(topic, partition, skip=spark.createDataFrame([(3,)], "offset bigint"))
    assert keys() == [1, 2, 3, 4, 8] and pipeline.holds().isEmpty()
    pipeline.apply_batch(envelope(spark, [ins(7, "a", "b")]).withColumn("offset", F.lit(20).cast("bigint")), 2)
    assert keys() == [1, 2, 3, 4, 7, 8]
    # and held anew after the next error
    pipeline.apply_batch(envelope(spark, ["rubbish", ins(30, "a", "b")]).withColumn("offset", F.col("offset") + 30), 3)
    assert [r["first_bad"] for r in pipeline.holds().collect()] == [30] and 30 not in keys()


def test_release_that_broke_off_is_applied_once(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, [])
    pipeline = Pipeline(spark, job, store, on_error="hold")
    log = envelope(spark, ["rubbish", ins(2, "a", "b")])
    pipeline.apply_batch(log, 0)
    topic, partition = log.select("topic", "partition").first()
    note, pipeline._log_holds = pipeline._log_holds, lambda rows: 1 / 0
    with pytest.raises(ZeroDivisionError):
        pipeline.release(topic, partition, envelope(spark, [ins(1, "a", "b")]))
    pipeline._log_holds = note
    assert pipeline.release(topic, partition, envelope(spark, [ins(1, "a", "b")]))
    assert [r[0] for r in rows(store.read(ONEKEY))] == [1, 2]
    assert store.published().filter("stream_id like 'release%'").select("commit_seq").distinct().count() == 1


def test_immediate_stop_finds_what_is_left(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, [])
    write_log(spark, [ins(i, "a", "b") for i in range(3)], job.path)
    query = start_pipeline(spark, job, store, str(tmp_path / "offsets"), available_now=True)
    query.awaitTermination()
    late = envelope(spark, [ins(i, "a", "b") for i in range(3, 6)]).withColumn("offset", F.col("offset") + 3)
    late.withColumn("key", F.lit(None).cast("binary")).write.mode("append").parquet(job.path)
    stop(query, "immediate")
    saved = spark.read.parquet(f"{job.unload_dir}/unapplied")
    assert sorted((r["offset"], r["reason"]) for r in saved.collect()) == [(i, "unapplied") for i in (3, 4, 5)]
    assert [r[0] for r in rows(store.read(ONEKEY))] == [0, 1, 2]


def test_partitions_that_were_not_asked_for_are_put_aside(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, MIX_SEED)
    log = envelope(spark, MIX)
    topic = log.first()["topic"]
    strange = log.unionByName(envelope(spark, [ins(50, "a", "b")]).withColumn("partition", F.lit(7))).unionByName(
        envelope(spark, [ins(51, "a", "b")]).withColumn("topic", F.lit("other")))
    job.topics = [Topic(topic, partition="0-3")]
    Pipeline(spark, job, store).apply_batch(strange, 0)
    assert rows(store.read(ONEKEY)) == WANT
    saved = spark.read.parquet(str(tmp_path / "unload" / "stream=batch" / "batch=0"))
    assert {(r["reason"], r["error"]["detail"]) for r in saved.collect()} == {("unexpected_partition", f"{topic}/7"), ("unexpected_topic", "other/0")}
    # all partitions of the topic
    again, job2 = setup(spark, tmp_path / "all", ONEKEY, MIX_SEED)
    job2.topics = [Topic(topic)]
    Pipeline(spark, job2, again).apply_batch(strange, 0)
    assert again.read(ONEKEY).filter("C1 = 50 OR C1 = 51").count() == 1


def test_names_of_no_table_are_one_entry_of_the_commit_log(spark, tmp_path):
    store, job = setup(spark, tmp_path, ONEKEY, MIX_SEED)
    bad = [m for i in range(5) for m in (f"rubbish {i}",)]
    Pipeline(spark, job, store).apply_batch(envelope(spark, MIX + bad), 0)
    entries = store.commits().filter("batch_id = 0").groupBy("table_name").agg(F.sum("rejects").alias("n")).collect()
    assert {r["table_name"]: r["n"] for r in entries if r["n"]} == {"": 5}


def test_update_alone_in_a_batch_of_the_event_messages_counts(spark, tmp_path):
    """The messages must not claim that an update's old value is its new one: the merge would leave the column out."""
    log = [(0, 1, "signup", 1.0), (1, 1, "view", 2.0), (2, 2, "signup", 3.0), (3, 1, "view", 4.0), (4, 2, "click", 5.0)]
    events = spark.createDataFrame(log, "event_id bigint, user_id bigint, event_type string, value double")
    events.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp")).write.parquet(str(tmp_path / "events.parquet"))
    store = SnapshotStore(spark, str(tmp_path / "store"), Catalog([stream_queries.USERS]), buckets=2)
    job = JobConfig(format="ctrl", skip=True, unload_dir=str(tmp_path / "unload"))
    pipeline, messages = Pipeline(spark, job, store), stream_queries._messages(spark, str(tmp_path))
    pipeline.apply_batch(messages.filter("offset < 3"), 0)
    pipeline.apply_batch(messages.filter("offset >= 3"), 1)
    assert rows(store.read(stream_queries.USERS)) == [(1, "view3", "100", None), (2, "signup2", "500", "2")]


def test_live_view_deals_a_micro_batch_out_to_several_files(spark, tmp_path, monkeypatch):
    """One file per micro-batch made its decoding one task, however long the log."""
    log = [(i, i % 3, ("signup", "view", "click")[i % 3], 1.0) for i in range(24)]
    events = spark.createDataFrame(log, "event_id bigint, user_id bigint, event_type string, value double")
    events.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp")).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(stream_queries.logs, "work_dir", lambda spark: str(tmp_path / "work"))
    view = stream_queries.stream_live_view(spark, str(tmp_path))
    assert sorted((r["c1"], r["op"], r["n_events"]) for r in view.collect()) == [(0, "I", 8), (1, "U", 8), (2, "U", 8)]
    assert len(list((tmp_path / "work" / "log").glob("*.parquet"))) > stream_queries.SLICES
    assert len(list((tmp_path / "work" / "view").glob("b=*"))) <= stream_queries.SLICES


def test_holds_are_sent_to_the_events(spark, capsys):
    """Joined by key, all events would meet in one task per partition of the log."""
    events = spark.createDataFrame([("t", 0, 1, None), ("t", 0, 2, "bad"), ("t", 0, 3, None), ("t", 1, 1, None)], "topic string, partition int, offset bigint, error string")
    good = hold_after_error(events)
    assert sorted((r["partition"], r["offset"]) for r in good.collect()) == [(0, 1), (1, 1)]
    good.explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out


def test_typed_changes_of_a_batch_are_bound_once(spark, tmp_path, capsys):
    store, job = setup(spark, tmp_path, ONEKEY, MIX_SEED)
    pipeline = Pipeline(spark, job, store)
    events = decode_and_route(envelope(spark, MIX), job, store.catalog)
    out = apply_table(events, ONEKEY, store.read(ONEKEY), materialise=True)
    capsys.readouterr()
    out.changes.explain()
    plan = capsys.readouterr().out
    assert "Scan ExistingRDD" in plan and "element_at" not in plan
    pipeline.apply_batch(envelope(spark, MIX), 0)
    assert rows(store.read(ONEKEY)) == WANT


def test_messages_of_one_file_are_dealt_out_before_decoding(spark):
    log = envelope(spark, MIX).coalesce(1)
    spread = dealt_out(log)
    assert spread.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
    assert rows(spread.select("offset")) == rows(log.select("offset"))
