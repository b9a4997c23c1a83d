"""Netting, merging and key-change queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow.model import TableSpec
from changeflow.operators import apply, archive, net, nopk
from changeflow.operators.bind import bind_changes, classify, typed_changes
from changeflow.operators.keychange import batch_lineage, key_change_lineage, key_change_outcomes, net_batch, net_with_key_changes
from changeflow.plans import logs
from changeflow.plans.registry import query

USERS, ORDERS, CUSTOMERS = logs.USERS, logs.ORDERS, logs.CUSTOMERS

NET_SQL = (
    "WITH "
    + logs.EVENTS_LOG_SQL
    + """,
r AS (SELECT c1, max(seq) AS rseq, arg_max(op, seq) AS rop FROM log WHERE op IN ('I','D') GROUP BY c1),
net AS (
  SELECT l.c1, coalesce(any_value(r.rop), 'U') AS op,
    arg_max({'v': c2}, seq) FILTER (has_c2 AND (r.rseq IS NULL OR (r.rop = 'I' AND seq >= r.rseq))) AS n2,
    arg_max({'v': c3}, seq) FILTER (has_c3 AND (r.rseq IS NULL OR (r.rop = 'I' AND seq >= r.rseq))) AS n3,
    arg_max({'v': c4}, seq) FILTER (has_c4 AND (r.rseq IS NULL OR (r.rop = 'I' AND seq >= r.rseq))) AS n4,
    CAST(count(*) AS BIGINT) AS n_events
  FROM log l LEFT JOIN r ON r.c1 = l.c1 GROUP BY l.c1)
"""
)
SEEDED_NET_SQL = NET_SQL + "," + logs.SEED_SQL


def _flat_net(df, spec):
    return df.select(
        "op",
        *[F.col(f"d_{k}").alias(k) for k in spec.key_names],
        *[c for n in spec.value_names for c in (
            F.col(f"c_{n}").isNotNull().alias(f"has_{n}"), F.col(f"c_{n}")["cur"].alias(n))],
    )


@query(
    "net_changes",
    NET_SQL + """
SELECT op, c1, n2 IS NOT NULL AS has_c2, n2.v AS c2, n3 IS NOT NULL AS has_c3, n3.v AS c3,
  n4 IS NOT NULL AS has_c4, n4.v AS c4, n_events FROM net""",
)
def net_changes(spark, d):
    df = net.net_changes(logs.user_changes(spark, d), USERS)
    return df.select("n_events", "op", F.col("d_c1").alias("c1"), *[
        c for n in USERS.value_names for c in (
            F.col(f"c_{n}").isNotNull().alias(f"has_{n}"), F.col(f"c_{n}")["cur"].alias(n))])


@query(
    "net_upsert_mode",
    "WITH " + logs.EVENTS_LOG_SQL + """
SELECT CASE arg_max(op, seq) WHEN 'D' THEN 'D' ELSE 'I' END AS op, c1,
  CASE WHEN arg_max(op, seq) <> 'D' AND arg_max(has_c2, seq) THEN arg_max({'v': c2}, seq).v END AS c2,
  CASE WHEN arg_max(op, seq) <> 'D' AND arg_max(has_c3, seq) THEN arg_max({'v': c3}, seq).v END AS c3,
  CASE WHEN arg_max(op, seq) <> 'D' AND arg_max(has_c4, seq) THEN arg_max({'v': c4}, seq).v END AS c4
FROM log GROUP BY c1""",
)
def net_upsert_mode(spark, d):
    """Updates taken as upserts: the last change of a key alone makes its row."""
    df = net.net_changes(classify(logs.user_changes(spark, d), USERS, "upsert"), USERS)
    return df.select("op", F.col("d_c1").alias("c1"), *[F.col(f"c_{n}")["cur"].alias(n) for n in USERS.value_names])


SPREAD_SQL = (
    "WITH " + logs.EVENTS_LOG_SQL.replace("log AS (", "raw AS (", 1)
    + ", log AS (SELECT * REPLACE (CAST((seq % 3) * 1000000000000 + seq AS BIGINT) AS seq) FROM raw)"
    + NET_SQL[len("WITH " + logs.EVENTS_LOG_SQL):]
)


@query("net_across_partitions", SPREAD_SQL + "SELECT op, c1, n2.v AS c2, n3.v AS c3, n4.v AS c4, n_events FROM net")
def net_across_partitions(spark, d):
    """Every key lies on three partitions: inside a batch, order is partition, then offset."""
    log = logs.events_log(spark, d).withColumn("partition", (F.col("offset") % 3).cast("int"))
    values = {n: (F.col(f"has_{n}"), F.col(n)) for n in ("c2", "c3", "c4")}
    key = {"c1": F.col("c1")}
    df = net.net_changes(typed_changes(log, USERS, F.col("op"), key, key, values), USERS)
    return df.select("op", F.col("d_c1").alias("c1"), *[F.col(f"c_{n}")["cur"].alias(n) for n in USERS.value_names], "n_events")


RESET_SQL = "WITH " + logs.EVENTS_LOG_SQL + """,
m AS (SELECT *, last_value(CASE WHEN op IN ('I','D') THEN op END IGNORE NULLS) OVER (
  PARTITION BY c1 ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM log)
"""


@query(
    "net_offsets",
    RESET_SQL + """
SELECT c1, CAST(count(*) AS BIGINT) AS n_offsets, min(seq) AS first_offset, max(seq) AS last_offset,
  CAST(sum(seq) AS BIGINT) AS offset_sum
FROM m WHERE NOT (op = 'U' AND coalesce(before = 'D', false)) GROUP BY c1""",
)
def net_offsets(spark, d):
    return net.net_offsets(logs.user_changes(spark, d), USERS).withColumnRenamed("d_c1", "c1")


@query(
    "net_lineage",
    RESET_SQL + """
SELECT c1, topic, part AS "partition", seq AS "offset", op
FROM m WHERE NOT (op = 'U' AND coalesce(before = 'D', false))""",
)
def net_lineage(spark, d):
    return net.net_lineage(logs.user_changes(spark, d), USERS).withColumnRenamed("d_c1", "c1")


@query(
    "net_rejects",
    RESET_SQL + "SELECT c1, seq AS \"offset\", 'after_delete' AS code FROM m WHERE op = 'U' AND before = 'D'",
)
def net_rejects(spark, d):
    df = net.net_rejects(logs.user_changes(spark, d), USERS)
    return df.select(F.col("d_c1").alias("c1"), F.col("seq.offset").alias("offset"), F.col("error.code").alias("code"))


@query(
    "net_report",
    NET_SQL + """
SELECT 'S.USERS' AS table_name, coalesce(a.op, b.op) AS op, coalesce(messages, 0) AS messages, coalesce(n, 0) AS net
FROM (SELECT op, CAST(count(*) AS BIGINT) AS messages FROM log GROUP BY op) a
FULL JOIN (SELECT op, CAST(count(*) AS BIGINT) AS n FROM net GROUP BY op) b ON a.op = b.op""",
)
def net_report(spark, d):
    changes = logs.user_changes(spark, d)
    return net.net_report(changes, net.net_changes(changes, USERS), "S.USERS")


@query(
    "net_changes_long",
    "WITH " + logs.EVENTS_LOG_SQL + """,
tl AS (SELECT 'T' || CAST(c1 % 3 AS VARCHAR(1)) AS t, * FROM log),
r AS (SELECT t, c1, max(seq) AS rseq, arg_max(op, seq) AS rop FROM tl WHERE op IN ('I','D') GROUP BY t, c1),
cells AS (
  SELECT t, c1, seq, op, 'c2' AS col, c2 AS v FROM tl WHERE has_c2 AND op <> 'D'
  UNION ALL SELECT t, c1, seq, op, 'c3', c3 FROM tl WHERE has_c3 AND op <> 'D'
  UNION ALL SELECT t, c1, seq, op, 'c4', c4 FROM tl WHERE has_c4 AND op <> 'D'),
kept AS (
  SELECT c.t, c.c1, c.col, arg_max({'v': c.v}, c.seq).v AS v FROM cells c LEFT JOIN r ON r.t = c.t AND r.c1 = c.c1
  WHERE r.rseq IS NULL OR (r.rop = 'I' AND c.seq >= r.rseq) GROUP BY c.t, c.c1, c.col),
keys AS (SELECT k.t, k.c1, coalesce(r.rop, 'U') AS op FROM (SELECT DISTINCT t, c1 FROM tl) k
  LEFT JOIN r ON r.t = k.t AND r.c1 = k.c1)
SELECT k.t AS table_name, CAST(k.c1 AS VARCHAR(20)) AS c1, k.op, kept.col AS column_name, kept.v AS value
FROM keys k LEFT JOIN kept ON kept.t = k.t AND kept.c1 = k.c1""",
)
def net_changes_long(spark, d):
    """Several tables in one pass over change events."""
    events = logs.user_events(spark, d)
    key = F.try_element_at("cols", F.lit("c1"))
    key = F.coalesce(key["cur"], key["old"])
    log = events.select(
        "schema_name",
        F.concat(F.lit("T"), (key.cast("bigint") % 3).cast("string")).alias("table_name"),
        F.array(key).alias("row_key"),
        "op",
        F.struct("topic", "partition", "offset", "item").alias("seq"),
        F.map_filter("cols", lambda k, v: k != "c1").alias("cols"),
    )
    out = net.net_changes_long(log)
    return out.select("table_name", F.col("row_key")[0].alias("c1"), "op", F.explode_outer("cols").alias("column_name", "value"))


@query(
    "drop_noop_updates",
    "WITH " + logs.UPDATES_SQL + """,
slim AS (SELECT k, CASE WHEN n.v = n_old.v THEN NULL ELSE n END AS n, CASE WHEN m.v = m_old.v THEN NULL ELSE m END AS m FROM upd)
SELECT k AS c_custkey, n IS NOT NULL AS has_c_name, n.v AS c_name, m IS NOT NULL AS has_c_mktsegment, m.v AS c_mktsegment
FROM slim WHERE n IS NOT NULL OR m IS NOT NULL""",
)
def drop_noop_updates(spark, d):
    netted = net.net_changes(logs.customer_updates(spark, d), CUSTOMERS, with_old=True)
    return _flat_net(net.drop_noop_updates(netted, CUSTOMERS), CUSTOMERS).drop("op")


@query(
    "merge_without_noops",
    "WITH " + logs.UPDATES_SQL + """
SELECT c_custkey, CASE WHEN n IS NOT NULL AND NOT coalesce(n.v = n_old.v, false) THEN n.v ELSE c_name END AS c_name,
  CASE WHEN m IS NOT NULL AND NOT coalesce(m.v = m_old.v, false) THEN m.v ELSE c_mktsegment END AS c_mktsegment
FROM customer LEFT JOIN upd ON k = c_custkey""",
)
def merge_without_noops(spark, d):
    """A merged batch whose updates leave columns alone that the messages show as unchanged."""
    seed = logs.customer_seed(spark, d)
    return apply.merge_batch(seed, net_batch(logs.customer_updates(spark, d), CUSTOMERS, seed, skip_unchanged=True).net, CUSTOMERS)


SCRIPT_SQL = SPREAD_SQL + """,
m AS (SELECT *, last_value(CASE WHEN op IN ('I','D') THEN op END IGNORE NULLS) OVER (
  PARTITION BY c1 ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM log),
lines AS (SELECT c1, seq // 1000000000000 AS part, (seq % 1000000000000) // 1000 AS line,
    '-- ' || string_agg(CAST(seq % 1000000000000 AS VARCHAR), ',' ORDER BY seq) AS made_by
  FROM m WHERE NOT (op = 'U' AND coalesce(before = 'D', false)) GROUP BY 1, 2, 3),
placed AS (SELECT *, row_number() OVER (PARTITION BY c1 ORDER BY part DESC, line DESC) AS back FROM lines),
lit AS (SELECT *, coalesce('''' || n2.v || '''', 'null') AS q2, coalesce('''' || n3.v || '''', 'null') AS q3,
  coalesce('''' || n4.v || '''', 'null') AS q4 FROM net),
texts AS (SELECT c1, CASE op WHEN 'D' THEN 'DELETE FROM "S"."USERS" WHERE "c1" = ' || c1
  WHEN 'I' THEN 'UPSERT INTO "S"."USERS"("c1"' || CASE WHEN n2 IS NOT NULL THEN ', "c2"' ELSE '' END ||
    CASE WHEN n3 IS NOT NULL THEN ', "c3"' ELSE '' END || CASE WHEN n4 IS NOT NULL THEN ', "c4"' ELSE '' END || ') VALUES(' || c1 ||
    CASE WHEN n2 IS NOT NULL THEN ', ' || q2 ELSE '' END || CASE WHEN n3 IS NOT NULL THEN ', ' || q3 ELSE '' END ||
    CASE WHEN n4 IS NOT NULL THEN ', ' || q4 ELSE '' END || ')'
  ELSE 'UPDATE "S"."USERS" SET "c1" = ' || c1 || CASE WHEN n2 IS NOT NULL THEN ', "c2" = ' || q2 ELSE '' END ||
    CASE WHEN n3 IS NOT NULL THEN ', "c3" = ' || q3 ELSE '' END || CASE WHEN n4 IS NOT NULL THEN ', "c4" = ' || q4 ELSE '' END ||
    ' WHERE "c1" = ' || c1 END || ';' AS statement FROM lit)
SELECT 'events' AS topic, CAST(part AS INT) AS "partition", CASE WHEN back = 1 THEN statement ELSE '' END || made_by AS sql_text
FROM placed JOIN texts ON texts.c1 = placed.c1"""


@query("applied_script", SCRIPT_SQL)
def applied_script(spark, d):
    """The applied statements with the offsets behind them, written by topic and partition and read back; a key lies on three partitions."""
    path = logs.work_dir(spark) + "/applied"
    log = logs.events_log(spark, d).withColumn("partition", (F.col("offset") % 3).cast("int"))
    values = {n: (F.col(f"has_{n}"), F.col(n)) for n in ("c2", "c3", "c4")}
    changes = typed_changes(log, USERS, F.col("op"), {"c1": F.col("c1")}, {"c1": F.col("c1")}, values)
    result = net_batch(changes, USERS, logs.user_seed(spark, d))
    script = archive.applied_script(result.net, batch_lineage(changes, USERS, result), USERS)
    archive.write_sql_archive(script, path, ["topic", "partition"], 100000)
    return spark.read.option("lineSep", archive.LINE_END).text(path).select("topic", "partition", F.col("value").alias("sql_text"))


@query(
    "epochs",
    """WITH log AS (SELECT CAST(user_id % 4 AS INT) AS part, event_id AS seq,
  CASE event_type WHEN 'error' THEN 'K' ELSE 'U' END AS op FROM events)
SELECT part AS "partition", seq AS "offset", op, CAST(sum(CASE WHEN op = 'K' THEN 1 ELSE 0 END) OVER (
  PARTITION BY part ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS epoch FROM log""",
)
def epochs(spark, d):
    log = logs.user_changes(spark, d).select("seq", "chunk", F.when(F.col("op") == "D", "K").otherwise("U").alias("op"))
    return net.with_epoch(log).select(
        F.col("seq.partition").alias("partition"), F.col("seq.offset").alias("offset"), "op", "epoch")


MERGED_SQL = SEEDED_NET_SQL + """,
j AS (SELECT s.c1 AS sk, net.c1 AS nk, s.c2 AS s2, s.c3 AS s3, s.c4 AS s4, net.* FROM seed s FULL JOIN net ON net.c1 = s.c1),
merged AS (SELECT coalesce(sk, nk) AS c1,
  CASE WHEN op = 'I' OR n2 IS NOT NULL THEN n2.v ELSE s2 END AS c2,
  CASE WHEN op = 'I' OR n3 IS NOT NULL THEN n3.v ELSE s3 END AS c3,
  CASE WHEN op = 'I' OR n4 IS NOT NULL THEN n4.v ELSE s4 END AS c4
  FROM j WHERE op IS NULL OR op = 'I' OR (op = 'U' AND sk IS NOT NULL))
"""


def merged_users(spark, d):
    return apply.merge_batch(
        logs.user_seed(spark, d), net.net_changes(logs.user_changes(spark, d), USERS), USERS
    )


@query("merge_batch", MERGED_SQL + "SELECT * FROM merged")
def merge_batch(spark, d):
    return merged_users(spark, d)


@query("snapshot_in_key_order", MERGED_SQL + "SELECT * FROM merged")
def snapshot_in_key_order(spark, d):
    return apply.read_in_key_order(merged_users(spark, d), USERS)


@query(
    "apply_upsert",
    SEEDED_NET_SQL + """
SELECT c1, c2, c3, c4 FROM seed WHERE c1 NOT IN (SELECT c1 FROM net WHERE op = 'I')
UNION ALL SELECT c1, n2.v, n3.v, n4.v FROM net WHERE op = 'I'""",
)
def apply_upsert(spark, d):
    return apply.apply_upsert(logs.user_seed(spark, d), net.net_changes(logs.user_changes(spark, d), USERS), USERS)


@query(
    "apply_delete",
    SEEDED_NET_SQL + "SELECT c1, c2, c3, c4 FROM seed WHERE c1 NOT IN (SELECT c1 FROM net WHERE op = 'D')",
)
def apply_delete(spark, d):
    return apply.apply_delete(logs.user_seed(spark, d), net.net_changes(logs.user_changes(spark, d), USERS), USERS)


@query(
    "apply_update_sparse",
    "WITH " + logs.UPDATES_SQL + """
SELECT c_custkey, CASE WHEN n IS NOT NULL THEN n.v ELSE c_name END AS c_name,
  CASE WHEN m IS NOT NULL THEN m.v ELSE c_mktsegment END AS c_mktsegment
FROM customer LEFT JOIN upd ON k = c_custkey""",
)
def apply_update_sparse(spark, d):
    return apply.apply_update(
        logs.customer_seed(spark, d), net.net_changes(logs.customer_updates(spark, d), CUSTOMERS), CUSTOMERS)


@query(
    "apply_update_full",
    "WITH " + logs.UPDATES_SQL + """
SELECT c_custkey, CASE WHEN k IS NOT NULL THEN n.v ELSE c_name END AS c_name,
  CASE WHEN k IS NOT NULL THEN m.v ELSE c_mktsegment END AS c_mktsegment
FROM customer LEFT JOIN upd ON k = c_custkey""",
)
def apply_update_full(spark, d):
    return apply.apply_update(
        logs.customer_seed(spark, d), net.net_changes(logs.customer_updates(spark, d), CUSTOMERS), CUSTOMERS, full=True)


def _order_key_events(spark, d):
    """Each order as an update of a two-column key (customer, status); one part may change or be null."""
    o = logs.table(spark, d, "orders")
    key, status, low = F.col("o_custkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority") == "5-LOW"
    none, yes = F.lit(None).cast("string"), F.lit(True)

    def value(cur, old, has_old):
        return F.struct(cur.alias("cur"), old.alias("old"), yes.alias("has_cur"), has_old.alias("has_old"))

    cols = F.create_map(
        F.lit("c_custkey"), value(key, key, ~low),
        F.lit("status"), value(F.when(status == "P", none).otherwise(status), F.lit("F"), yes),
        F.lit("note"), value(F.col("o_orderpriority"), none, F.lit(False)),
    )
    return o.select(
        F.lit("o").alias("topic"), F.lit(0).alias("partition"), F.col("o_orderkey").alias("offset"), F.lit(0).alias("item"),
        F.when(low, "K").otherwise("U").alias("op"), cols.alias("cols"),
        F.lit(None).cast("struct<code:string,detail:string>").alias("error"),
    )


TWO_KEYS = TableSpec.of(
    "S", "K2", {"c_custkey": "SIGNED BIGINT", "status": "VARCHAR", "note": "VARCHAR"}, ["status", "c_custkey"])


@query(
    "classify_updates",
    """SELECT o_orderkey AS "offset", CASE WHEN o_orderstatus = 'F' THEN 'U' ELSE 'K' END AS op, o_custkey AS c_custkey,
  'F' AS old_status, o_orderstatus AS new_status FROM orders WHERE o_orderstatus <> 'P'""",
)
def classify_updates(spark, d):
    """An update is a key change only if a key part really changed, whatever the message calls it."""
    good, _ = bind_changes(_order_key_events(spark, d), TWO_KEYS)
    return good.select(
        F.col("seq.offset").alias("offset"), "op", F.col("s_c_custkey").alias("c_custkey"),
        F.col("s_status").alias("old_status"), F.col("d_status").alias("new_status"))


@query(
    "null_key_rejects",
    """SELECT o_orderkey AS "offset", 'null_key' AS code, 'status' AS detail FROM orders WHERE o_orderstatus = 'P'""",
)
def null_key_rejects(spark, d):
    _, bad = bind_changes(_order_key_events(spark, d), TWO_KEYS)
    return bad.select("offset", "error.code", "error.detail")


# -- key changes -------------------------------------------------------------------------------------
CHAIN_SQL = """
SELECT CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey + 20000000 WHEN o_orderkey % 2 = 0 THEN o_orderkey + 10000000
  ELSE o_orderkey END AS c1,
  CASE WHEN o_orderkey % 4 = 0 THEN 'moved' ELSE o_orderstatus END AS c2,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS c3
FROM orders WHERE o_orderkey % 5 <> 0"""


@query("key_change_chain", CHAIN_SQL)
def key_change_chain(spark, d):
    """Rows inserted, moved twice, updated and deleted in one batch, onto an empty table."""
    empty = spark.createDataFrame([], ORDERS.row_schema())
    result = net_with_key_changes(logs.order_chain_changes(spark, d), ORDERS, empty)
    return apply.merge_batch(empty, result.net, ORDERS)


@query(
    "key_change_collide",
    """WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p,
  o_orderkey = 0 OR o_orderkey * 2 IN (SELECT o_orderkey FROM orders) AS stays FROM orders)
SELECT CASE WHEN stays THEN k ELSE k * 2 END AS c1, CASE WHEN stays AND k <> 0 THEN s ELSE 'moved' END AS c2, p AS c3
FROM o""",
)
def key_change_collide(spark, d):
    """Moves onto keys that are still occupied are rejected, the others happen."""
    seed = logs.order_seed(spark, d)
    return apply.merge_batch(seed, net_with_key_changes(logs.doubling_changes(spark, d, False), ORDERS, seed).net, ORDERS)


@query(
    "key_change_rejects",
    """SELECT o_orderkey AS old_key, o_orderkey * 2 AS new_key, 'key_collision' AS code FROM orders
WHERE o_orderkey <> 0 AND o_orderkey * 2 IN (SELECT o_orderkey FROM orders)""",
)
def key_change_rejects(spark, d):
    seed = logs.order_seed(spark, d)
    rejects = net_with_key_changes(logs.doubling_changes(spark, d, False), ORDERS, seed).rejects.filter("error.code = 'key_collision'")
    return rejects.select(F.col("s_c1").alias("old_key"), F.col("d_c1").alias("new_key"), F.col("error.code").alias("code"))


@query(
    "key_change_vacate",
    """SELECT o_orderkey * 2 AS c1, 'moved' AS c2, o_orderpriority AS c3 FROM orders""",
)
def key_change_vacate(spark, d):
    """Every key is vacated just before another row moves onto it."""
    seed = logs.order_seed(spark, d)
    return apply.merge_batch(seed, net_with_key_changes(logs.doubling_changes(spark, d, True), ORDERS, seed).net, ORDERS)


@query(
    "key_change_outcomes",
    """SELECT o_orderkey AS "offset", CASE WHEN o_orderkey * 2 IN (SELECT o_orderkey FROM orders) THEN 'collision'
  ELSE 'moved' END AS status FROM orders WHERE o_orderkey <> 0""",
)
def key_change_outcomes_query(spark, d):
    out = key_change_outcomes(logs.doubling_changes(spark, d, False), ORDERS, logs.order_seed(spark, d))
    return out.select(F.col("seq.offset").alias("offset"), "status")


@query(
    "apply_key_change",
    """SELECT c_custkey + 1000000000 AS c_custkey, 'moved' AS c_name, c_mktsegment FROM customer""",
)
def apply_key_change(spark, d):
    seed = logs.customer_seed(spark, d)
    key = F.col("c_custkey")
    log = seed.select(F.lit("c").alias("topic"), F.lit(0).alias("partition"), key.alias("offset"), "c_custkey")
    moves = typed_changes(
        log, CUSTOMERS, F.lit("K"), {"c_custkey": key}, {"c_custkey": key + 1000000000},
        {"c_name": (F.lit(True), F.lit("moved")), "c_mktsegment": (F.lit(False), F.lit(None))})
    return apply.apply_key_change(seed, moves, CUSTOMERS)


MIXED_SQL = "WITH RECURSIVE " + logs.EVENTS_LOG_SQL + "," + logs.SEED_SQL + """,
ev AS (SELECT row_number() OVER (ORDER BY seq) AS i, CASE WHEN seq % 97 IN (0, 1) THEN 'K' ELSE op END AS op,
  CASE WHEN seq % 97 = 1 THEN 1000000 + seq - 1 ELSE c1 END AS old_key,
  CASE seq % 97 WHEN 0 THEN 1000000 + seq WHEN 1 THEN 2000000 + seq ELSE c1 END AS new_key,
  has_c2, c2, has_c3, c3, has_c4, c4 FROM log),
st AS (
  SELECT CAST(0 AS BIGINT) AS i, (SELECT map_from_entries(list({'k': CAST(c1 AS BIGINT), 'v': {'c2': c2, 'c3': c3, 'c4': c4}})) FROM seed) AS m
  UNION ALL
  SELECT ev.i, CASE
    WHEN op = 'I' THEN map_concat(m, MAP {CAST(new_key AS BIGINT): {'c2': CASE WHEN has_c2 THEN ev.c2 END, 'c3': CASE WHEN has_c3 THEN ev.c3 END, 'c4': CASE WHEN has_c4 THEN ev.c4 END}})
    WHEN op = 'D' THEN map_from_entries([e FOR e IN map_entries(m) IF e.key != old_key])
    WHEN NOT map_contains(m, CAST(old_key AS BIGINT)) OR (op = 'K' AND map_contains(m, CAST(new_key AS BIGINT))) THEN m
    ELSE map_concat(map_from_entries([e FOR e IN map_entries(m) IF e.key != old_key]), MAP {CAST(new_key AS BIGINT): {
      'c2': CASE WHEN has_c2 THEN ev.c2 ELSE m[CAST(old_key AS BIGINT)].c2 END,
      'c3': CASE WHEN has_c3 THEN ev.c3 ELSE m[CAST(old_key AS BIGINT)].c3 END,
      'c4': CASE WHEN has_c4 THEN ev.c4 ELSE m[CAST(old_key AS BIGINT)].c4 END}}) END
  FROM st JOIN ev ON ev.i = st.i + 1),
done AS (SELECT unnest(map_entries(m)) AS e FROM st WHERE i = (SELECT count(*) FROM ev))
SELECT e.key AS c1, e.value.c2 AS c2, e.value.c3 AS c3, e.value.c4 AS c4 FROM done
"""


@query("key_change_mixed", MIXED_SQL)
def key_change_mixed(spark, d):
    """Events with key changes of present and absent rows; the SQL replays the log event by event."""
    seed = logs.user_seed(spark, d)
    return apply.merge_batch(seed, net_with_key_changes(logs.mixed_key_changes(spark, d), USERS, seed).net, USERS)


# what a key holds while the log is replayed: whether a row is there (null: unknown) and the offsets behind it
LINEAGE_SQL = MIXED_SQL[: MIXED_SQL.index("st AS (")].replace("SELECT row_number()", "SELECT seq, row_number()") + """
st AS (
  SELECT CAST(0 AS BIGINT) AS i, (SELECT map_from_entries(list({'k': CAST(c1 AS BIGINT), 'v': {'a': true, 'l': CAST([] AS BIGINT[])}})) FROM seed) AS m
  UNION ALL
  SELECT i, CASE
    WHEN op IN ('I', 'D') THEN map_concat(m, MAP {new_key: {'a': op = 'I', 'l': new_l || [seq]}})
    WHEN op = 'U' AND coalesce(old_a, true) THEN map_concat(m, MAP {new_key: {'a': old_a, 'l': new_l || [seq]}})
    WHEN op = 'U' OR NOT coalesce(old_a, false) OR coalesce(new_a, false) THEN m
    ELSE map_concat(m, MAP {old_key: {'a': false, 'l': [seq]}, new_key: {'a': true, 'l': new_l || old_l || [seq]}}) END
  FROM (SELECT ev.i, seq, op, CAST(old_key AS BIGINT) AS old_key, CAST(new_key AS BIGINT) AS new_key, m,
          m[CAST(old_key AS BIGINT)].a AS old_a, m[CAST(new_key AS BIGINT)].a AS new_a,
          coalesce(m[CAST(old_key AS BIGINT)].l, []) AS old_l, coalesce(m[CAST(new_key AS BIGINT)].l, []) AS new_l
        FROM st JOIN ev ON ev.i = st.i + 1)),
done AS (SELECT unnest(map_entries(m)) AS e FROM st WHERE i = (SELECT count(*) FROM ev)),
flat AS (SELECT DISTINCT e.key AS c1, unnest(e.value.l) AS "offset" FROM done)
SELECT CAST(c1 AS BIGINT) AS c1, 'events' AS topic, CAST(0 AS INT) AS "partition", "offset", ev.op FROM flat JOIN ev ON ev.seq = "offset"
"""


@query("key_change_lineage", LINEAGE_SQL)
def key_change_lineage_query(spark, d):
    """Offsets behind every key after key changes; the SQL carries them along event by event."""
    found = key_change_lineage(logs.mixed_key_changes(spark, d), USERS, logs.user_seed(spark, d))
    return found.withColumnRenamed("d_c1", "c1").withColumn("c1", F.col("c1").cast("bigint"))


# -- tables without a primary key ----------------------------------------------------------------------
SEGMENTS = TableSpec.of("S", "SEGMENTS", {"nation": "SIGNED INTEGER", "segment": "VARCHAR"})


def _segment_rows(spark, d):
    return logs.table(spark, d, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))


def _segment_events(spark, d, steps):
    """``steps``: per nation (op, current nation, current segment, old nation, old segment); a column is a
    pair (present, value)."""
    absent = F.lit(False), F.lit(None).cast("string")

    def value(name, cur, old):
        cur, old = cur or absent, old or absent
        return F.struct(
            F.lit(name).alias("key"),
            F.struct(
                cur[1].cast("string").alias("cur"), old[1].cast("string").alias("old"),
                cur[0].alias("has_cur"), old[0].alias("has_old"),
            ).alias("value"),
        )

    built = [
        F.struct(
            F.lit(i).alias("i"), F.lit(op).alias("op"),
            F.map_from_entries(F.array(value("nation", cn, on), value("segment", cs, os))).alias("cols"),
        )
        for i, (op, cn, cs, on, os) in enumerate(steps)
    ]
    return (
        logs.table(spark, d, "nation")
        .withColumn("s", F.explode(F.array(*built)))
        .select(
            F.lit("n").alias("topic"), F.lit(0).alias("partition"),
            (F.col("n_nationkey") * 10 + F.col("s.i")).cast("bigint").alias("offset"), F.lit(0).alias("item"),
            F.col("s.op").alias("op"), F.col("s.cols").alias("cols"),
            F.lit(None).cast("struct<code:string,detail:string>").alias("error"),
        )
    )


def _is(value):
    return F.lit(True), value


@query(
    "nopk_update",
    """SELECT c_nationkey AS nation, CASE WHEN c_mktsegment = 'BUILDING' THEN n_name ELSE c_mktsegment END AS segment
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def nopk_update(spark, d):
    nation = F.col("n_nationkey")
    events = _segment_events(spark, d, [("U", None, _is(F.col("n_name")), _is(nation), _is(F.lit("BUILDING")))])
    changes = nopk.nopk_changes(events, SEGMENTS)
    return nopk.apply_update_nopk(_segment_rows(spark, d), changes, SEGMENTS)


@query(
    "nopk_delete_null",
    """SELECT c_nationkey AS nation, c_mktsegment AS segment FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM nation WHERE n_nationkey = c_nationkey
  AND CASE WHEN n_regionkey = 0 THEN NULL ELSE 'MACHINERY' END = c_mktsegment)""",
)
def nopk_delete_null(spark, d):
    segment = F.when(F.col("n_regionkey") != 0, "MACHINERY")
    events = _segment_events(spark, d, [("D", None, None, _is(F.col("n_nationkey")), _is(segment))])
    changes = nopk.nopk_changes(events, SEGMENTS)
    return nopk.apply_delete_nopk(_segment_rows(spark, d), changes, SEGMENTS)


@query(
    "nopk_replay",
    """SELECT c_nationkey AS nation, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN n_name ELSE c_mktsegment END AS segment
FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_mktsegment <> 'FURNITURE'
UNION ALL SELECT n_nationkey, n_name FROM nation""",
)
def nopk_replay(spark, d):
    """Update, insert, update of both, delete: each step sees the rows the earlier ones left."""
    nation, name = F.col("n_nationkey"), F.col("n_name")
    machinery = _is(F.lit("MACHINERY"))
    events = _segment_events(
        spark, d,
        [
            ("U", None, machinery, _is(nation), _is(F.lit("BUILDING"))),
            ("I", _is(nation), machinery, None, None),
            ("U", None, _is(name), _is(nation), machinery),
            ("D", None, None, _is(nation), _is(F.lit("FURNITURE"))),
        ],
    )
    return nopk.replay_nopk(_segment_rows(spark, d), events, SEGMENTS)


@query(
    "nopk_insert_only",
    """SELECT c_nationkey AS nation, c_mktsegment AS segment FROM customer
UNION ALL SELECT n_nationkey, n_name FROM nation""",
)
def nopk_insert_only(spark, d):
    """Equal rows are never collapsed."""
    events = _segment_events(spark, d, [("I", _is(F.col("n_nationkey")), _is(F.col("n_name")), None, None)])
    return nopk.replay_nopk(_segment_rows(spark, d), events, SEGMENTS)


TRADE = TableSpec.of("S", "TRADE", {"nation": "SIGNED INTEGER", "segment": "VARCHAR", "state": "VARCHAR"})


@query(
    "nopk_partial_hot",
    """SELECT c_nationkey AS nation, CASE c_mktsegment WHEN 'BUILDING' THEN 'B2' ELSE c_mktsegment END AS segment, 'DONE' AS state
FROM customer""",
)
def nopk_partial_hot(spark, d):
    """Updates that compare one column and hit every row, before and after one that compares two: all rows have one match key."""
    rows = _segment_rows(spark, d).withColumn("state", F.lit("OPEN"))

    def cell(cur, old):
        text = lambda v: F.lit(v).cast("string")
        return F.struct(text(cur).alias("cur"), text(old).alias("old"), F.lit(cur is not None).alias("has_cur"), F.lit(old is not None).alias("has_old"))

    steps = [
        {"state": ("CLOSED", "OPEN")},
        {"segment": ("B2", "BUILDING"), "state": (None, "CLOSED")},
        {"state": ("DONE", "CLOSED")},
    ]
    of_step = [F.map_from_arrays(F.array(*map(F.lit, s)), F.array(*[cell(*v) for v in s.values()])) for s in steps]
    region = F.col("r_regionkey").cast("int")
    events = logs.table(spark, d, "region").filter(region < len(steps)).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), region.cast("bigint").alias("offset"), F.lit(0).alias("item"),
        F.lit("U").alias("op"), F.get(F.array(*of_step), region).alias("cols"), F.lit(None).cast("struct<code:string,detail:string>").alias("error"),
    )
    return nopk.replay_nopk(rows, events, TRADE)
