"""Job configuration from JSON and its validation."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from changeflow import fixed_values as fv
from changeflow.functions.text import start_position


@dataclass
class Topic:
    topic: str
    def_schema: str | None = None
    partition: str = "-1"
    group: str | None = None


@dataclass
class Mapping:
    schema_name: str
    table_name: str
    src_schema: str = ""
    src_table: str = ""
    columns: dict[str, str] = field(default_factory=dict)


@dataclass
class JobConfig:
    # target
    def_schema: str | None = None
    def_table: str | None = None
    batch_size: int = fv.DEFAULT_BATCH_SIZE
    batch_update: bool = False
    # columns whose last value equals the first old value in the messages are not written
    skip_unchanged: bool = True
    ignore: bool = False
    network_timeout_s: int = 60
    jdbc_url: str | None = None
    jdbc_driver: str | None = None
    # log
    source: str = "kafka"
    path: str | None = None
    broker: str = "localhost:9092"
    topics: list[Topic] = field(default_factory=list)
    topic_pattern: str = ".*"
    mode: str = ""
    fetch_size: int = fv.DEFAULT_FETCH_SIZE
    fetch_bytes: int = fv.DEFAULT_FETCH_BYTES
    max_files_per_trigger: int | None = None
    kafka_user: str | None = None
    kafka_password: str | None = None
    stream_timeout_s: int = -1
    heartbeat_timeout_s: int = 10
    session_timeout_s: int = 30
    request_timeout_s: int = 305
    # messages
    format: str = ""
    delimiter: str = fv.DEFAULT_DELIMITER
    encoding: str = fv.DEFAULT_ENCODING
    big_endian: bool = False
    json_null: str = "null"
    skip: bool = False
    # outputs
    dump_binary: bool = False
    raw_dir: str | None = None
    load_dir: str | None = None
    unload_dir: str | None = None
    max_file_records: int = 0
    max_wait_tasks: int = 10
    interval_s: int = 10
    show_tables: bool = True
    show_speed: bool = False
    mappings: list[Mapping] = field(default_factory=list)

    @property
    def update_mode(self) -> str:
        return "upsert" if self.batch_update else "sparse"

    @property
    def on_error(self) -> str:
        return "skip" if self.skip else "fail"

    @staticmethod
    def from_json(text: str) -> JobConfig:
        """Read the sections ``database``, ``kafka``, ``options`` and ``mappings``."""
        doc = json.loads(text)
        database, kafka = doc.get("database", {}), doc.get("kafka", {})
        options = doc.get("options", {})
        cfg = JobConfig()
        names = {
            "database": {
                "batchSize": "batch_size", "batchUpdate": "batch_update", "ignore": "ignore",
                "skipUnchanged": "skip_unchanged",
                "networkTO": "network_timeout_s", "DBUrl": "jdbc_url", "DBDriver": "jdbc_driver",
                "defSchema": "def_schema", "defTable": "def_table",
            },
            "kafka": {
                "broker": "broker", "fetchBytes": "fetch_bytes", "fetchSize": "fetch_size", "mode": "mode",
                "kafkaUser": "kafka_user", "kafkaPW": "kafka_password", "streamTO": "stream_timeout_s",
                "hbTO": "heartbeat_timeout_s", "seTO": "session_timeout_s", "reqTO": "request_timeout_s",
                "source": "source", "path": "path",
            },
            "options": {
                "bigEndian": "big_endian", "delimiter": "delimiter", "dumpBinary": "dump_binary",
                "encoding": "encoding", "format": "format", "interval": "interval_s", "skip": "skip",
                "loadDir": "load_dir", "rawDir": "raw_dir", "unloadDir": "unload_dir",
                "maxFileRecords": "max_file_records", "maxWaitTasks": "max_wait_tasks",
                "showTables": "show_tables", "showSpeed": "show_speed", "jsonNull": "json_null",
            },
        }
        for section, content in (("database", database), ("kafka", kafka), ("options", options)):
            for key, attribute in names[section].items():
                if content.get(key) is not None:
                    setattr(cfg, attribute, content[key])
        cfg.mode = str(cfg.mode).upper() if str(cfg.mode).lower() in ("start", "end") else str(cfg.mode)
        cfg.def_schema = _true_name(cfg.def_schema)
        cfg.def_table = _true_name(cfg.def_table)
        cfg.topics = [
            Topic(t["topic"], t.get("desSchema"), str(t.get("partition", "-1")), t.get("group"))
            for t in kafka.get("topics") or []
        ]
        cfg.mappings = [
            Mapping(
                m["schemaName"],
                m["tableName"],
                m.get("srcSchemaName") or "",
                m.get("srcTableName") or "",
                {
                    c["srcColumnName"]: c["columnName"]
                    for c in m.get("columns") or []
                    if c.get("srcColumnName") and c.get("columnName")
                },
            )
            for m in doc.get("mappings") or []
        ]
        return cfg

    def validate(self) -> JobConfig:
        """Raise ``ValueError`` for settings that cannot work; lift the network timeout to its minimum."""
        self.network_timeout_s = max(self.network_timeout_s, fv.MIN_NETWORK_TIMEOUT_S)
        problems = []
        if self.format in ("", "fixed") and not (self.def_schema and self.def_table):
            problems.append("schema and table must be given for formats without a table name")
        if self.format == "" and len(self.delimiter) != 1:
            problems.append("the delimiter must be a single character")
        try:
            start_position(self.mode)
        except ValueError as e:
            problems.append(str(e))
        if self.def_table and not self.def_schema:
            problems.append("a table needs a schema")
        if self.max_file_records < 0:
            problems.append("maxFileRecords cannot be negative")
        if self.max_wait_tasks < 1:
            problems.append("maxWaitTasks must be positive")
        for name in ("interval_s", "heartbeat_timeout_s", "session_timeout_s", "request_timeout_s"):
            if getattr(self, name) <= 0:
                problems.append(f"{name} must be positive")
        if (self.kafka_user is None) != (self.kafka_password is None):
            problems.append("user and password must be given together")
        if problems:
            raise ValueError("; ".join(problems))
        return self

    def topic_schemas(self) -> dict[str, str]:
        return {t.topic: t.def_schema for t in self.topics if t.def_schema}

    def mappings_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(m.src_schema, m.src_table, m.schema_name, m.table_name, i) for i, m in enumerate(self.mappings)],
            "src_schema string, src_table string, schema_name string, table_name string, rule int",
        )

    def column_mappings_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [
                (m.schema_name, m.table_name, src, dst)
                for m in self.mappings
                for src, dst in m.columns.items()
            ],
            "schema_name string, table_name string, src_column string, column_name string",
        )


def _true_name(name: str | None) -> str | None:
    """``[x]`` keeps its case, everything else is upper-cased."""
    if name is None:
        return None
    if name.startswith("[") and name.endswith("]"):
        return name[1:-1]
    return name.upper()
