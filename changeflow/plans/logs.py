"""Change logs derived from the driver tables, with the SQL that derives the same log elsewhere."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.model import TXN_TYPE, TableSpec
from changeflow.operators.bind import typed_changes
from changeflow.session import configure, ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """A fresh folder next to the checkpoints, which all executors can reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/work-{uuid.uuid4().hex}"


# -- events as a log of inserts, updates and deletes per user ------------------------------------
USERS = TableSpec.of(
    "S", "USERS", {"c1": "SIGNED BIGINT", "c2": "VARCHAR", "c3": "VARCHAR", "c4": "VARCHAR"}, ["c1"]
)

EVENTS_LOG_SQL = """
log AS (
  SELECT 'events' AS topic, CAST(user_id % 4 AS INT) AS part, event_id AS seq, user_id AS c1, ts,
    CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
    event_type IN ('signup','view') AS has_c2, event_type || CAST(event_id % 10 AS VARCHAR(2)) AS c2,
    event_type IN ('signup','click') AS has_c3, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR(20)) AS c3,
    event_type IN ('signup','purchase') AS has_c4,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 1000 AS VARCHAR(4)) END AS c4
  FROM events)
"""

SEED_SQL = """
seed AS (SELECT s_suppkey AS c1, s_name AS c2, CAST(s_nationkey AS VARCHAR(4)) AS c3, 'seed' AS c4 FROM supplier)
"""


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").alias("c1"),
        F.when(e == "signup", "I").when(e == "error", "D").otherwise("U").alias("op"),
        e.isin("signup", "view").alias("has_c2"),
        F.concat(e, (F.col("event_id") % 10).cast("string")).alias("c2"),
        e.isin("signup", "click").alias("has_c3"),
        F.round(F.col("value") * 100).cast("bigint").cast("string").alias("c3"),
        e.isin("signup", "purchase").alias("has_c4"),
        F.when(F.col("event_id") % 7 != 0, (F.col("event_id") % 1000).cast("string")).alias("c4"),
    )


def user_changes(spark: SparkSession, sf_dir: str, chunk_offsets: int = 1 << 20) -> DataFrame:
    key = {"c1": F.col("c1")}
    values = {n: (F.col(f"has_{n}"), F.col(n)) for n in ("c2", "c3", "c4")}
    return typed_changes(events_log(spark, sf_dir), USERS, F.col("op"), key, key, values, chunk_offsets=chunk_offsets)


def user_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("c1"), F.col("s_name").alias("c2"),
        F.col("s_nationkey").cast("string").alias("c3"), F.lit("seed").alias("c4"),
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log as change events (map of text values)."""
    log = events_log(spark, sf_dir)

    def value(n: str, has):
        deleted = F.col("op") == "D"
        return F.struct(
            F.lit(n).alias("key"),
            F.struct(
                F.when(~deleted, F.col(n).cast("string")).alias("cur"),
                F.when(deleted, F.col(n).cast("string")).alias("old"),
                (~deleted & has).alias("has_cur"),
                (deleted & has).alias("has_old"),
            ).alias("value"),
        )

    entries = F.array(
        value("c1", F.lit(True)), *[value(n, F.col(f"has_{n}")) for n in ("c2", "c3", "c4")]
    )
    present = F.filter(entries, lambda e: e["value"]["has_cur"] | e["value"]["has_old"])
    error_type = "struct<code:string,detail:string>"
    return log.select(
        "topic", "partition", "offset", F.lit(0).alias("item"), F.col("timestamp").alias("event_ts"),
        F.lit("S").alias("src_schema"), F.lit("USERS").alias("src_table"),
        F.lit("S").alias("schema_name"), F.lit("USERS").alias("table_name"), "op",
        F.map_from_entries(present).alias("cols"),
        F.lit(None).cast(TXN_TYPE).alias("txn"),
        F.concat_ws("|", "op", F.col("c1").cast("string")).alias("raw"),
        F.lit(None).cast(error_type).alias("error"),
    )


# -- orders as updates of customers ------------------------------------------------------------------
CUSTOMERS = TableSpec.of(
    "S", "CUSTOMERS", {"c_custkey": "SIGNED BIGINT", "c_name": "VARCHAR", "c_mktsegment": "VARCHAR"}, ["c_custkey"]
)


def customer_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")


def customer_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order updates its customer: name when the status is F or P, segment when it is O or P."""
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("topic"), F.lit(0).alias("partition"), F.col("o_orderkey").alias("offset"),
        "o_custkey", "o_orderstatus", "o_orderpriority",
    )
    key = {"c_custkey": F.col("o_custkey")}
    low = F.col("o_orderpriority") == "5-LOW"
    values = {
        "c_name": (F.col("o_orderstatus").isin("F", "P"), F.col("o_orderstatus")),
        "c_mktsegment": (F.col("o_orderstatus").isin("O", "P"), F.col("o_orderpriority")),
    }
    olds = {
        "c_name": F.when(low, F.col("o_orderstatus")).otherwise("F"),
        "c_mktsegment": F.when(low, F.col("o_orderpriority")).otherwise("1-URGENT"),
    }
    return typed_changes(orders, CUSTOMERS, F.lit("U"), key, key, values, olds)


UPDATES_SQL = """
upd AS (
  SELECT o_custkey AS k,
    arg_max({'v': o_orderstatus}, o_orderkey) FILTER (o_orderstatus IN ('F','P')) AS n,
    arg_max({'v': o_orderpriority}, o_orderkey) FILTER (o_orderstatus IN ('O','P')) AS m,
    arg_min({'v': CASE WHEN o_orderpriority = '5-LOW' THEN o_orderstatus ELSE 'F' END}, o_orderkey)
      FILTER (o_orderstatus IN ('F','P')) AS n_old,
    arg_min({'v': CASE WHEN o_orderpriority = '5-LOW' THEN o_orderpriority ELSE '1-URGENT' END}, o_orderkey)
      FILTER (o_orderstatus IN ('O','P')) AS m_old
  FROM orders GROUP BY o_custkey)
"""

# -- orders as a log with key changes ----------------------------------------------------------------
ORDERS = TableSpec.of("S", "ORDERS", {"c1": "SIGNED BIGINT", "c2": "VARCHAR", "c3": "VARCHAR"}, ["c1"])


def order_chain_changes(spark: SparkSession, sf_dir: str, chunk_offsets: int = 1 << 20) -> DataFrame:
    """Insert, up to two key changes, update and delete per order; every key change is well-formed."""
    k = F.col("o_orderkey")
    at = F.when(k % 4 == 0, k + 20000000).when(k % 2 == 0, k + 10000000).otherwise(k)
    steps = [
        (F.lit(True), "I", k, k),
        (k % 2 == 0, "K", k, k + 10000000),
        (k % 4 == 0, "K", k + 10000000, k + 20000000),
        (k % 3 == 0, "U", at, at),
        (k % 5 == 0, "D", at, at),
    ]
    exploded = F.explode(
        F.filter(
            F.array(
                *[
                    F.struct(F.lit(i).alias("i"), use.alias("use"), F.lit(op).alias("op"), old.alias("old"), new.alias("new"))
                    for i, (use, op, old, new) in enumerate(steps)
                ]
            ),
            lambda s: s["use"],
        )
    )
    log = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderstatus", "o_orderpriority", exploded.alias("s"))
        .select(
            F.lit("orders").alias("topic"), F.lit(0).alias("partition"),
            (F.col("o_orderkey") * 10 + F.col("s.i")).alias("offset"),
            "o_orderstatus", "o_orderpriority", "s.*",
        )
    )
    i = F.col("i")
    return typed_changes(
        log, ORDERS, F.col("op"), {"c1": F.col("old")}, {"c1": F.col("new")},
        {
            "c2": (i.isin(0, 2), F.when(i == 0, F.col("o_orderstatus")).when(i == 2, "moved")),
            "c3": (i.isin(0, 3), F.when(i == 0, F.col("o_orderpriority"))),
        },
        chunk_offsets=chunk_offsets,
    )


def order_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("c1"), F.col("o_orderstatus").alias("c2"), F.col("o_orderpriority").alias("c3")
    )


def doubling_changes(spark: SparkSession, sf_dir: str, descending: bool) -> DataFrame:
    """Every order moves from key k to 2k. In ascending order the new key is mostly still occupied; in
    descending order it has always been vacated before."""
    k = F.col("o_orderkey")
    # offsets count up or down with the key
    offset = F.lit(1 << 40) - k if descending else k
    orders = table(spark, sf_dir, "orders").withColumn("offset", offset)
    log = orders.select(F.lit("orders").alias("topic"), F.lit(0).alias("partition"), "offset", "o_orderkey")
    moved = F.lit("moved")
    changes = typed_changes(
        log, ORDERS, F.lit("K"), {"c1": k}, {"c1": k * 2},
        {"c2": (F.lit(True), moved), "c3": (F.lit(False), F.lit(None))},
    )
    # key 0 stays where it is: an update
    return changes.withColumn("op", F.when(F.col("s_c1") == F.col("d_c1"), "U").otherwise("K"))


def mixed_key_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events log with some events turned into key changes, many of them of absent rows."""
    eid = F.col("offset")
    log = events_log(spark, sf_dir).withColumn("partition", F.lit(0))
    first, second = eid % 97 == 0, eid % 97 == 1
    old = F.when(second, 1000000 + eid - 1).otherwise(F.col("c1"))
    new = F.when(first, 1000000 + eid).when(second, 2000000 + eid).otherwise(F.col("c1"))
    values = {n: (F.col(f"has_{n}"), F.col(n)) for n in ("c2", "c3", "c4")}
    return typed_changes(
        log, USERS, F.when(first | second, "K").otherwise(F.col("op")), {"c1": old}, {"c1": new}, values
    )
