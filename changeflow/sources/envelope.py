"""The change log as a DataFrame with the envelope schema, from Kafka or from files."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow import fixed_values as fv
from changeflow.functions.text import start_position
from changeflow.model import ENVELOPE_SCHEMA
from changeflow.session import cut_lineage


def read_envelope(spark: SparkSession, cfg, streaming: bool = False) -> DataFrame:
    """Open the configured log. ``cfg.source`` is ``kafka`` or a file format (``parquet``, ``json``).

    The partition lists of the topics hold for every source. The start position holds for batches; a file stream gets it from
    ``start_positions``, which a job stores when it starts first. A file stream takes files by modification time: add them in log
    order.
    """
    reader = spark.readStream if streaming else spark.read
    if cfg.source == "kafka":
        log = reader.format("kafka").options(**kafka_options(cfg, streaming)).load()
        # a batch from the end has no Kafka option
        return log if streaming or start_position(cfg.mode)[0] != "end" else start_from(log, cfg.mode)
    reader = reader.schema(ENVELOPE_SCHEMA)
    if streaming and cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    log = wanted_partitions(reader.format(cfg.source).load(cfg.path), cfg)
    return log if streaming else start_from(log, cfg.mode)


def wanted_partitions(df: DataFrame, cfg) -> DataFrame:
    """Records of the configured topics and of their partition lists; without topics everything."""
    if not cfg.topics:
        return df
    wanted = F.lit(False)
    for t in cfg.topics:
        own, partitions = F.col("topic") == t.topic, parse_partitions(str(t.partition))
        wanted = wanted | (own if partitions is None else own & F.col("partition").isin(partitions))
    return df.filter(wanted)


def start_positions(df: DataFrame, mode: str) -> DataFrame:
    """``(topic, partition, start_offset)`` of the log as it is now, for the start of a stream.

    Partitions that appear later have no entry: a stream takes them from their beginning.
    """
    kind, at = start_position(mode)
    after = F.max("offset") + 1
    first = {
        "end": after,
        "offset": F.lit(at if kind == "offset" else 0),
        "time": F.coalesce(F.min(F.when(F.col("timestamp") >= F.lit(at if kind == "time" else None), F.col("offset"))), after),
    }.get(kind, F.lit(0))
    return df.groupBy("topic", "partition").agg(first.cast("bigint").alias("start_offset"))


def from_positions(df: DataFrame, positions: DataFrame) -> DataFrame:
    """Records at or after their partition's start."""
    joined = df.join(positions, ["topic", "partition"], "left")
    return joined.filter(F.col("start_offset").isNull() | (F.col("offset") >= F.col("start_offset"))).select(*df.columns)


def kafka_options(cfg, streaming: bool = False) -> dict[str, str]:
    """Options of the Kafka source: topics or discovery, start position, fetch bounds, SASL/PLAIN."""
    options = {
        "kafka.bootstrap.servers": cfg.broker,
        "kafka.max.partition.fetch.bytes": str(cfg.fetch_bytes),
        "kafka.session.timeout.ms": str(cfg.session_timeout_s * 1000),
        "kafka.heartbeat.interval.ms": str(cfg.heartbeat_timeout_s * 1000),
        "kafka.request.timeout.ms": str(cfg.request_timeout_s * 1000),
        "failOnDataLoss": "true",
    }
    if not cfg.topics:
        options["subscribePattern"] = cfg.topic_pattern
    elif all(str(t.partition) == "-1" for t in cfg.topics):
        options["subscribe"] = ",".join(t.topic for t in cfg.topics)
    else:
        if any(str(t.partition) == "-1" for t in cfg.topics):
            raise ValueError("name the partitions of all topics, or of none")
        options["assign"] = json.dumps({t.topic: parse_partitions(str(t.partition)) for t in cfg.topics})
    kind, at = start_position(cfg.mode)
    if kind == "start":
        options["startingOffsets"] = "earliest"
    elif kind == "end":
        options["startingOffsets"] = "latest" if streaming else "earliest"
    elif kind == "time":
        options["startingTimestamp"] = str(int(at.timestamp() * 1000))
        options["startingOffsetsByTimestampStrategy"] = "latest"
    elif kind == "offset":
        if "assign" not in options:
            raise ValueError("a numeric start position needs a partition list per topic")
        assigned = json.loads(options["assign"])
        options["startingOffsets"] = json.dumps({t: {str(p): at for p in ps} for t, ps in assigned.items()})
    if streaming:
        options["maxOffsetsPerTrigger"] = str(cfg.fetch_size * cfg.max_wait_tasks)
    if cfg.kafka_user and cfg.kafka_password:
        options["kafka.security.protocol"] = "SASL_PLAINTEXT"
        options["kafka.sasl.mechanism"] = "PLAIN"
        options["kafka.sasl.jaas.config"] = fv.SASL_LOGIN % (cfg.kafka_user, cfg.kafka_password)
    return options


def topic_config(df: DataFrame, topics: dict[str, str]) -> DataFrame:
    """Add ``topic_schema``: the default schema of the record's topic."""
    if not topics:
        return df.withColumn("topic_schema", F.lit(None).cast("string"))
    schemas = F.create_map(*[F.lit(x) for pair in topics.items() for x in pair])
    return df.withColumn("topic_schema", F.try_element_at(schemas, F.col("topic")))


def discover(df: DataFrame) -> DataFrame:
    """Topics and partitions present in an envelope."""
    return df.select("topic", "partition").distinct()


def parse_partitions(spec: str) -> list[int] | None:
    """``-1`` all (None); ``4`` the first four; ``1,4-5,8`` and ``2-2`` lists and ranges."""
    spec = str(spec).strip()
    if spec == "-1":
        return None
    items = [i.strip() for i in spec.split(",") if i.strip()]
    if not items:
        raise ValueError(f"partition list is empty: {spec!r}")
    if len(items) == 1 and "-" not in items[0]:
        wanted = list(range(int(items[0])))
    else:
        wanted = []
        for item in items:
            ends = item.split("-")
            if len(ends) > 2:
                raise ValueError(f"not a partition or a range: {item!r}")
            wanted += range(int(ends[0]), int(ends[-1]) + 1)
    if len(wanted) > fv.MAX_PARTITIONS:
        raise ValueError(f"more than {fv.MAX_PARTITIONS} partitions: {spec!r}")
    if len(set(wanted)) != len(wanted):
        raise ValueError(f"a partition is named twice: {spec!r}")
    return sorted(wanted)


def select_partitions(df: DataFrame, spec: str) -> DataFrame:
    wanted = parse_partitions(spec)
    return df if wanted is None else df.filter(F.col("partition").isin(wanted))


def missing_partitions(df: DataFrame, spec: str) -> DataFrame:
    """Wanted partitions that the log does not have."""
    wanted = parse_partitions(spec) or []
    spark = df.sparkSession
    want = spark.createDataFrame([(p,) for p in wanted], "partition int")
    return want.join(df.select("partition").distinct(), "partition", "left_anti")


def start_from(df: DataFrame, mode: str) -> DataFrame:
    """Batch form of the start position."""
    kind, at = start_position(mode)
    if kind in ("start", "committed"):
        return df
    if kind == "end":
        return df.filter(F.lit(False))
    if kind == "offset":
        return df.filter(F.col("offset") >= at)
    return seek_time(df, F.lit(at))


def start_offsets(df: DataFrame, at: Column) -> DataFrame:
    """Per topic and partition the first offset whose timestamp is not before ``at`` (null: past the end)."""
    return df.groupBy("topic", "partition").agg(
        F.min(F.when(F.col("timestamp") >= at, F.col("offset"))).alias("start_offset")
    )


def seek_time(df: DataFrame, at: Column) -> DataFrame:
    """Records from each partition's first offset with a timestamp not before ``at``."""
    starts = cut_lineage(start_offsets(df, at).filter(F.col("start_offset").isNotNull()))
    return (
        df.join(starts, ["topic", "partition"])
        .filter(F.col("offset") >= F.col("start_offset"))
        .drop("start_offset")
    )


def assigned_partitions(cfg) -> dict[str, list[int] | None]:
    """Partitions a job asks for by topic; None: all of them."""
    assigned: dict[str, list[int] | None] = {}
    for t in cfg.topics:
        wanted, before = parse_partitions(t.partition), assigned.get(t.topic, [])
        assigned[t.topic] = None if wanted is None or before is None else sorted({*before, *wanted})
    return assigned


def envelope_error(assigned: dict[str, list[int] | None]) -> Column:
    """What is wrong with a record whose topic or partition was not asked for, or null."""
    known_topic = F.col("topic").isin(list(assigned))
    matches = [
        (F.col("topic") == t) & (F.lit(True) if ps is None else F.col("partition").isin(list(ps))) for t, ps in assigned.items()
    ]
    known_partition = reduce(lambda a, b: a | b, matches, F.lit(False))
    code = F.when(~known_topic, "unexpected_topic").when(~known_partition, "unexpected_partition")
    detail = F.concat_ws("/", "topic", F.col("partition").cast("string"))
    return F.when(code.isNotNull(), F.struct(code.alias("code"), detail.alias("detail")))


def check_envelope(df: DataFrame, assigned: dict[str, list[int] | None]) -> DataFrame:
    """Add ``error`` to records whose topic or partition was not asked for."""
    return df.withColumn("error", envelope_error(assigned))
