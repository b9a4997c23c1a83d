"""Partition lists, start positions, envelope checks, catalog and job configuration."""

import json

import pytest
from pyspark.sql import functions as F

from changeflow.config import JobConfig, Topic
from changeflow.functions.text import decode_with_fallback, start_position
from changeflow.model import ColumnSpec, TableSpec
from changeflow.operators.apply import batch_rows
from changeflow.operators.archive import jdbc_options
from changeflow.sources.catalog import catalog_specs, load_catalog
from changeflow.sources.envelope import (
    check_envelope, kafka_options, missing_partitions, parse_partitions, read_envelope, seek_time, start_from,
)


@pytest.mark.parametrize(
    "text, want", [("4", [0, 1, 2, 3]), ("1,4-5,8", [1, 4, 5, 8]), ("2-2", [2]), ("-1", None), ("8,1", [1, 8]), ("0", [])]
)
def test_partition_lists(text, want):
    assert parse_partitions(text) == want


@pytest.mark.parametrize("text", ["1,1", "1-3,2", "1-2-3", "2000", ",", "a"])
def test_bad_partition_lists(text):
    with pytest.raises(ValueError):
        parse_partitions(text)


def log(spark):
    return spark.range(40).select(
        F.lit("t").alias("topic"), (F.col("id") % 10).cast("int").alias("partition"), F.col("id").alias("offset"),
        F.timestamp_seconds(F.col("id") * 60).alias("timestamp"),
    )


def test_missing_partitions(spark):
    assert missing_partitions(log(spark), "5").count() == 0
    assert sorted(r[0] for r in missing_partitions(log(spark), "12").collect()) == [10, 11]


def test_start_positions(spark):
    assert start_position("") == ("committed", None)
    assert start_position("17") == ("offset", 17)
    assert start_position("end") == ("end", None)
    for text in ("2024-01-31 10:00:00", "2024-01-31", "2024/01/31 10:00:00", "2024/01/31"):
        assert start_position(text)[0] == "time"
    for text in ("2024-1-31", "2024-13-01", "yesterday"):
        with pytest.raises(ValueError):
            start_position(text)
    df = log(spark)
    assert start_from(df, "START").count() == 40
    assert start_from(df, "END").count() == 0
    assert start_from(df, "35").count() == 5


def test_seek_by_time(spark):
    at = lambda s: F.timestamp_seconds(F.lit(s))
    assert seek_time(log(spark), at(0)).count() == 40
    assert seek_time(log(spark), at(30 * 60)).count() == 10
    assert seek_time(log(spark), at(10**6)).count() == 0


def test_envelope_check(spark):
    checked = check_envelope(log(spark), {"t": [0, 1]})
    assert checked.filter("error is null").count() == 8
    assert check_envelope(log(spark), {"u": [0]}).select("error.code").distinct().first()[0] == "unexpected_topic"


def test_kafka_options():
    cfg = JobConfig(topics=[Topic("a", None, "1,4-5")], mode="17", kafka_user="u", kafka_password="p")
    options = kafka_options(cfg, streaming=True)
    assert json.loads(options["assign"]) == {"a": [1, 4, 5]}
    assert json.loads(options["startingOffsets"]) == {"a": {"1": 17, "4": 17, "5": 17}}
    assert options["kafka.sasl.mechanism"] == "PLAIN" and "maxOffsetsPerTrigger" in options
    assert kafka_options(JobConfig(topics=[Topic("a"), Topic("b")]))["subscribe"] == "a,b"
    assert kafka_options(JobConfig())["subscribePattern"] == ".*"
    assert "startingTimestamp" in kafka_options(JobConfig(mode="2024-01-01"))


def test_file_source(spark, tmp_path):
    df = log(spark).withColumn("key", F.lit(None).cast("binary")).withColumn("value", F.lit("x").cast("binary"))
    df.write.parquet(str(tmp_path / "log"))
    cfg = JobConfig(source="parquet", path=str(tmp_path / "log"))
    assert read_envelope(spark, cfg).count() == 40
    assert read_envelope(spark, cfg, streaming=True).isStreaming


def test_catalog(spark):
    columns = spark.createDataFrame(
        [
            ("S", "T", 1, "b", 64, "VARCHAR", 40, "UTF8", True), ("S", "T", 0, "a", 132, "SIGNED INTEGER", 4, "", False),
            ("S", "N", 1, "x", 64, "VARCHAR", 8, "UCS2", True), ("_MD_", "O", 0, "o", 64, "VARCHAR", 8, "", True),
            ("S", "SB_HISTOGRAMS", 0, "h", 64, "VARCHAR", 8, "", True), ("R", "T", 0, "a", 132, "SIGNED INTEGER", 4, "", True),
        ],
        "schema_name string, table_name string, ordinal int, column_name string, type_code int, type_name string, "
        "size int, charset string, nullable boolean",
    )
    keys = spark.createDataFrame(
        [("S", "T", 2, "a"), ("S", "T", 1, "b")], "schema_name string, table_name string, key_seq int, column_name string")
    catalog = catalog_specs(load_catalog(columns, keys, schemas=["S"]))
    assert sorted(catalog.specs) == ["S.N", "S.T"]
    t, n = catalog["S.T"], catalog["S.N"]
    # key order is not column order
    assert (t.column_names, t.key_names, t.has_pk) == (["a", "b"], ["b", "a"], True)
    assert (n.key_names, n.has_pk) == (["x"], False)
    assert (t.column("b").width, n.column("x").width) == (10, 4)
    assert sorted(catalog_specs(load_catalog(columns, keys, tables=["T"])).specs) == ["R.T", "S.T"]


def test_write_batch_honours_row_width():
    wide = TableSpec("S", "W", (ColumnSpec("c", "VARCHAR", 16777216, "", 64),) * 9)
    assert batch_rows(wide, 500) == 3
    assert batch_rows(TableSpec("S", "X", (ColumnSpec("c", "VARCHAR", 2**30, "", 64),)), 500) == 1
    assert batch_rows(TableSpec.of("S", "Y", {"c": "VARCHAR"}), 500) == 500
    assert jdbc_options(wide, "jdbc:x", "d", 500)["batchsize"] == "3"


CONFIG = """{
 "database": {"batchSize": 100, "batchUpdate": true, "defSchema": "seabase", "defTable": "[t1]", "networkTO": 30},
 "kafka": {"broker": "h:9092", "mode": "start", "topics": [{"topic": "a", "desSchema": "S1", "partition": 4}], "streamTO": 5},
 "options": {"format": "ctrl", "delimiter": ",", "skip": true, "loadDir": "load", "interval": 2},
 "mappings": [{"srcSchemaName": "", "srcTableName": "", "schemaName": "S3", "tableName": "T",
               "columns": [{"srcColumnName": "x", "columnName": "y"}, {"srcColumnName": "", "columnName": "z"}]}]
}"""


def test_job_from_json(spark):
    job = JobConfig.from_json(CONFIG).validate()
    assert (job.def_schema, job.def_table, job.mode, job.update_mode, job.on_error) == ("SEABASE", "t1", "START", "upsert", "skip")
    assert job.network_timeout_s == 60 and job.topics == [Topic("a", "S1", "4", None)]
    assert job.topic_schemas() == {"a": "S1"}
    assert job.mappings_df(spark).collect()[0]["schema_name"] == "S3"
    assert [tuple(r) for r in job.column_mappings_df(spark).collect()] == [("S3", "T", "x", "y")]


@pytest.mark.parametrize(
    "change",
    [
        {"format": ""}, {"format": "", "def_schema": "S", "def_table": "T", "delimiter": ",,"}, {"mode": "soon"},
        {"def_table": "T"}, {"interval_s": 0}, {"heartbeat_timeout_s": 0}, {"kafka_user": "u"}, {"max_wait_tasks": -1},
    ],
)
def test_bad_jobs(change):
    with pytest.raises(ValueError):
        JobConfig(**{"format": "ctrl", **change}).validate()


def test_byte_decoding():
    assert decode_with_fallback("中国 Test".encode("gbk"), "GBK") == "中国 Test"
    assert decode_with_fallback("x€".encode(), "GBK") == "x€"
    assert decode_with_fallback(b"\xff\xff\xff", "utf-8") is None
    assert decode_with_fallback(None, "GBK") is None


def test_write_batch_of_a_width_column(spark):
    widths = [0, 1, 2**20, 2**29 - 1, 2**29, 2**29 + 1, 9 * 2**24, 2**40]
    got = spark.createDataFrame([(w,) for w in widths], "w bigint").select("w", batch_rows(F.col("w"), 500).alias("n")).collect()
    assert {r.w: r.n for r in got} == {w: batch_rows(TableSpec("S", "W", (ColumnSpec("c", "VARCHAR", w, "", 64),)), 500) for w in widths}
