"""Source, archive, catalog and statistics queries over logs derived from whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow.config import JobConfig, Topic
from changeflow.model import TableSpec
from changeflow.operators import apply, archive, stats
from changeflow.operators.net import net_changes, net_rejects
from changeflow.plans import logs
from changeflow.plans.registry import query
from changeflow.sources import envelope as env
from changeflow.sources.catalog import load_catalog
from changeflow.streaming.pipeline import hold_after_error, pending_rows

LOG = "WITH " + logs.EVENTS_LOG_SQL


def _log(spark, d):
    return logs.events_log(spark, d)


# -- partitions and start positions --------------------------------------------------------------------
@query("select_partitions", LOG + 'SELECT part AS "partition", seq AS "offset" FROM log WHERE part IN (0, 2, 3)')
def select_partitions(spark, d):
    return env.select_partitions(_log(spark, d), "0,2-3").select("partition", "offset")


@query("select_all_partitions", LOG + 'SELECT part AS "partition", seq AS "offset" FROM log')
def select_all_partitions(spark, d):
    return env.select_partitions(_log(spark, d), "-1").select("partition", "offset")


@query(
    "missing_partitions",
    LOG + 'SELECT CAST(p AS INT) AS "partition" FROM range(0, 7) t(p) WHERE p NOT IN (SELECT part FROM log)',
)
def missing_partitions(spark, d):
    return env.missing_partitions(_log(spark, d), "7")


@query("discover_topics", LOG + 'SELECT DISTINCT topic, part AS "partition" FROM log')
def discover_topics(spark, d):
    return env.discover(_log(spark, d))


@query("start_offset", LOG + 'SELECT part AS "partition", seq AS "offset" FROM log WHERE seq >= 500')
def start_offset(spark, d):
    return env.start_from(_log(spark, d), "500").select("partition", "offset")


@query("job_start_position", LOG + 'SELECT part AS "partition", seq AS "offset" FROM log WHERE part IN (1, 3) AND seq >= 500')
def job_start_position(spark, d):
    """A job's partition list and start position as its batch source applies them."""
    path = logs.work_dir(spark) + "/log"
    records = _log(spark, d).select(F.lit(None).cast("binary").alias("key"), F.lit(None).cast("binary").alias("value"), "topic", "partition", "offset", "timestamp")
    records.write.parquet(path)
    job = JobConfig(source="parquet", path=path, mode="500", topics=[Topic("events", partition="1,3-3")])
    return env.read_envelope(spark, job).select("partition", "offset")


@query("job_start_at_end", LOG + 'SELECT part AS "partition", seq AS "offset" FROM log WHERE seq > (SELECT CAST(floor(max(seq) / 2 + 0.5) AS BIGINT) FROM log)')
def job_start_at_end(spark, d):
    """A stream that starts at the end of the first half of the log takes what is added later."""
    root = logs.work_dir(spark)
    log = _log(spark, d).select("topic", "partition", "offset", "timestamp")
    middle = log.agg(F.floor(F.max("offset") / 2 + 0.5).alias("half")).first()["half"]
    positions = env.start_positions(log.filter(F.col("offset") <= F.lit(middle)), "END")
    positions.write.parquet(f"{root}/start")
    return env.from_positions(log, spark.read.parquet(f"{root}/start")).select("partition", "offset")


@query("start_at_end", LOG + 'SELECT part AS "partition", seq AS "offset" FROM log WHERE false')
def start_at_end(spark, d):
    return env.start_from(_log(spark, d), "END").select("partition", "offset")


SEEK_SQL = LOG + """, s AS (SELECT part, min(seq) FILTER (ts >= TIMESTAMP '2024-01-10 00:00:00') AS start_offset FROM log GROUP BY part)
"""


@query("seek_time", SEEK_SQL + 'SELECT l.part AS "partition", seq AS "offset" FROM log l JOIN s ON s.part = l.part AND seq >= start_offset')
def seek_time(spark, d):
    return env.start_from(_log(spark, d), "2024-01-10").select("partition", "offset")


@query("seek_time_offsets", SEEK_SQL + 'SELECT part AS "partition", start_offset FROM s')
def seek_time_offsets(spark, d):
    at = F.lit("2024-01-10 00:00:00").cast("timestamp")
    return env.start_offsets(_log(spark, d), at).select("partition", "start_offset")


@query("seek_time_past_end", LOG + 'SELECT part AS "partition", seq AS "offset" FROM log WHERE false')
def seek_time_past_end(spark, d):
    return env.start_from(_log(spark, d), "2030/01/01 00:00:00").select("partition", "offset")


@query(
    "check_envelope",
    LOG + """SELECT part AS "partition", CASE WHEN part IN (0, 1) THEN NULL ELSE 'unexpected_partition' END AS code,
  CAST(count(*) AS BIGINT) AS n FROM log GROUP BY part""",
)
def check_envelope(spark, d):
    checked = env.check_envelope(_log(spark, d), {"events": [0, 1]})
    return checked.groupBy("partition", F.col("error.code").alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "topic_schemas",
    """SELECT event_type AS topic, CASE event_type WHEN 'click' THEN 'S1' WHEN 'view' THEN 'S2' END AS topic_schema,
  CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type""",
)
def topic_schemas(spark, d):
    """Several topics with their own default schema."""
    log = logs.table(spark, d, "events").select(F.col("event_type").alias("topic"))
    out = env.topic_config(log, {"click": "S1", "view": "S2"})
    return out.groupBy("topic", "topic_schema").agg(F.count(F.lit(1)).alias("n"))


HOLD_SQL = """WITH log AS (SELECT CAST(user_id % 64 AS INT) AS part, event_id AS seq, value > 90 AS bad FROM events),
h AS (SELECT part, min(seq) FILTER (bad) AS first_bad FROM log GROUP BY part)
"""


@query(
    "hold_after_error",
    HOLD_SQL + 'SELECT l.part AS "partition", seq AS "offset" FROM log l JOIN h ON h.part = l.part WHERE first_bad IS NULL OR seq < first_bad',
)
def hold_after_error_query(spark, d):
    """A partition stops at its first bad row, the others go on."""
    code = F.when(F.col("value") > 90, F.struct(F.lit("bad_value").alias("code"), F.lit(None).cast("string").alias("detail")))
    log = logs.table(spark, d, "events").select(
        F.lit("events").alias("topic"), (F.col("user_id") % 64).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), code.alias("error"))
    return hold_after_error(log).select("partition", "offset")


@query(
    "pending_rows",
    LOG + """, a AS (SELECT part, max(seq) AS last FROM log WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY part)
SELECT l.part AS "partition", seq AS "offset" FROM log l LEFT JOIN a ON a.part = l.part WHERE last IS NULL OR seq > last""",
)
def pending_rows_query(spark, d):
    """What an immediate stop leaves unapplied."""
    log = _log(spark, d)
    applied = log.filter(F.col("timestamp") < F.lit("2024-01-20 00:00:00").cast("timestamp"))
    return pending_rows(log, stats.partition_progress(applied)).select("partition", "offset")


# -- SQL scripts and archives ------------------------------------------------------------------------------
SQL_LIT = """
lit AS (SELECT *, coalesce('''' || c2 || '''', 'null') AS q2, coalesce('''' || c3 || '''', 'null') AS q3,
  coalesce('''' || c4 || '''', 'null') AS q4 FROM log)
"""


def _sql_text(spark, d):
    return archive.to_sql_text(logs.user_events(spark, d), logs.USERS)


@query(
    "sql_text_insert",
    LOG + "," + SQL_LIT + """
SELECT seq AS "offset", 'UPSERT INTO "S"."USERS"("c1", "c2", "c3", "c4") VALUES(' || c1 || ', ' || q2 || ', ' || q3 || ', ' || q4 || ');-- ' || seq AS sql_text
FROM lit WHERE op = 'I'""",
)
def sql_text_insert(spark, d):
    return _sql_text(spark, d).filter("op = 'I'").select("offset", "sql_text")


@query(
    "sql_text_update",
    LOG + "," + SQL_LIT + """
SELECT seq AS "offset", 'UPDATE "S"."USERS" SET "c1" = ' || c1 || CASE WHEN has_c2 THEN ', "c2" = ' || q2 ELSE '' END ||
  CASE WHEN has_c3 THEN ', "c3" = ' || q3 ELSE '' END || CASE WHEN has_c4 THEN ', "c4" = ' || q4 ELSE '' END ||
  ' WHERE "c1" = ' || c1 || ';-- ' || seq AS sql_text FROM lit WHERE op = 'U'""",
)
def sql_text_update(spark, d):
    return _sql_text(spark, d).filter("op = 'U'").select("offset", "sql_text")


@query(
    "sql_text_delete",
    LOG + """SELECT seq AS "offset", 'DELETE FROM "S"."USERS" WHERE "c1" = ' || c1 || ';-- ' || seq AS sql_text FROM log WHERE op = 'D'""",
)
def sql_text_delete(spark, d):
    return _sql_text(spark, d).filter("op = 'D'").select("offset", "sql_text")


@query(
    "sql_text_nopk",
    """SELECT c_custkey AS "offset", 'DELETE FROM "S"."N" WHERE "name" = ''' || c_name || ''' AND "segment"' ||
  CASE WHEN c_mktsegment = 'BUILDING' THEN ' is null' ELSE ' = ''' || c_mktsegment || '''' END || ';-- ' || c_custkey AS sql_text FROM customer""",
)
def sql_text_nopk(spark, d):
    """Without a primary key every column is compared; NULL becomes ``is null``."""
    spec = TableSpec.of("S", "N", {"name": "VARCHAR", "segment": "VARCHAR"})
    c = logs.table(spark, d, "customer")
    none, yes, no = F.lit(None).cast("string"), F.lit(True), F.lit(False)

    def old(value):
        return F.struct(none.alias("cur"), value.alias("old"), no.alias("has_cur"), yes.alias("has_old"))

    events = c.select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("c_custkey").alias("offset"), F.lit("D").alias("op"),
        F.create_map(
            F.lit("name"), old(F.col("c_name")),
            F.lit("segment"), old(F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")))).alias("cols"),
        F.lit(None).cast("struct<code:string,detail:string>").alias("error"))
    return archive.to_sql_text(events, spec).select("offset", "sql_text")


@query(
    "sql_text_applied",
    "WITH " + logs.UPDATES_SQL + """
SELECT k AS c_custkey, 'UPDATE "S"."CUSTOMERS" SET "c_custkey" = ' || k || CASE WHEN n IS NOT NULL THEN ', "c_name" = ''' || n.v || '''' ELSE '' END ||
  CASE WHEN m IS NOT NULL THEN ', "c_mktsegment" = ''' || m.v || '''' ELSE '' END || ' WHERE "c_custkey" = ' || k || ';' AS sql_text FROM upd""",
)
def sql_text_applied(spark, d):
    """The net changes as a script."""
    net = net_changes(logs.customer_updates(spark, d), logs.CUSTOMERS)
    return archive.net_sql_text(net, logs.CUSTOMERS).select(F.col("d_c_custkey").alias("c_custkey"), "sql_text")


@query("raw_archive", LOG + 'SELECT topic, part AS "partition", seq AS "offset", CAST(c1 AS VARCHAR(20)) AS value FROM log')
def raw_archive(spark, d):
    """Write the raw archive by topic and partition and read it back."""
    path = logs.work_dir(spark) + "/raw"
    records = _log(spark, d).select("topic", "partition", "offset", F.col("c1").cast("string").alias("value"))
    archive.write_raw_archive(records, path, max_records=100000)
    return spark.read.parquet(path).select("topic", "partition", "offset", "value")


@query(
    "sql_archive",
    LOG + "," + SQL_LIT + """
SELECT part AS "partition", CASE op WHEN 'D' THEN 'DELETE FROM "S"."USERS" WHERE "c1" = ' || c1
  WHEN 'I' THEN 'UPSERT INTO "S"."USERS"("c1", "c2", "c3", "c4") VALUES(' || c1 || ', ' || q2 || ', ' || q3 || ', ' || q4 || ')'
  ELSE 'UPDATE "S"."USERS" SET "c1" = ' || c1 || CASE WHEN has_c2 THEN ', "c2" = ' || q2 ELSE '' END ||
  CASE WHEN has_c3 THEN ', "c3" = ' || q3 ELSE '' END || CASE WHEN has_c4 THEN ', "c4" = ' || q4 ELSE '' END || ' WHERE "c1" = ' || c1 END
  || ';-- ' || seq AS sql_text FROM lit""",
)
def sql_archive(spark, d):
    """The whole log as SQL text files by topic and partition, rolled over every 500 records, read back."""
    path = logs.work_dir(spark) + "/sql"
    archive.write_sql_archive(_sql_text(spark, d), path, ["topic", "partition"], 500)
    return spark.read.option("lineSep", archive.LINE_END).text(path).select(F.col("value").alias("sql_text"), "partition")


REJECTS_SQL = LOG + """,
m AS (SELECT *, last_value(CASE WHEN op IN ('I','D') THEN op END IGNORE NULLS) OVER (
  PARTITION BY c1 ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM log),
rej AS (SELECT * FROM m WHERE op = 'U' AND before = 'D')
"""


@query("unload_archive", REJECTS_SQL + "SELECT seq AS \"offset\", c1, 'after_delete' AS reason FROM rej")
def unload_archive(spark, d):
    """Rejected rows kept by reason."""
    path = logs.work_dir(spark) + "/unload"
    rejects = net_rejects(logs.user_changes(spark, d), logs.USERS)
    archive.write_unload(rejects.select(F.col("seq.offset").alias("offset"), F.col("d_c1").alias("c1"), "error"), path)
    return spark.read.parquet(path).select("offset", "c1", "reason")


# -- statistics --------------------------------------------------------------------------------------------
def _checked_events(spark, d):
    """Events of which those with a value above 90 are bad."""
    bad = F.struct(F.lit("bad_value").alias("code"), F.lit(None).cast("string").alias("detail"))
    e = F.col("event_type")
    return logs.table(spark, d, "events").select(
        F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("event_ts"),
        F.concat(F.lit("S.T"), (F.col("user_id") % 5).cast("string")).alias("table_name"),
        F.when(e == "signup", "I").when(e == "error", "D").when(e == "view", "K").otherwise("U").alias("op"),
        F.when(F.col("value") > 90, bad).alias("error"))


CHECKED_SQL = """WITH ev AS (SELECT 'events' AS topic, CAST(user_id % 4 AS INT) AS part, event_id AS seq, ts, user_id,
  'S.T' || (user_id % 5) AS table_name,
  CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' WHEN 'view' THEN 'K' ELSE 'U' END AS op, value > 90 AS bad FROM events)
"""


@query(
    "op_counts",
    CHECKED_SQL + """SELECT op, CAST(count(*) FILTER (NOT bad) AS BIGINT) AS messages, CAST(count(*) FILTER (bad) AS BIGINT) AS errors FROM ev GROUP BY op""",
)
def op_counts(spark, d):
    return stats.op_counts(_checked_events(spark, d))


TOTALS_SQL = CHECKED_SQL + """, t AS (SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (bad) AS BIGINT) AS errors, """ + ", ".join(
    f"CAST(count(*) FILTER (op = '{o}' AND {'' if kind == 'errors' else 'NOT '}bad) AS BIGINT) AS {kind}_{o.lower()}"
    for o in "IUKD" for kind in ("messages", "errors")) + " FROM ev)"


@query("op_totals", TOTALS_SQL + "SELECT * FROM t")
def op_totals(spark, d):
    return stats.op_totals(_checked_events(spark, d))


def _table_stats(spark, d):
    events = _checked_events(spark, d)
    latest = logs.table(spark, d, "events").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("e"))
    net = latest.select(
        F.concat(F.lit("S.T"), (F.col("user_id") % 5).cast("string")).alias("table_name"),
        F.when(F.col("e") == "error", "D").otherwise("U").alias("op"))
    return stats.table_stats(events, net, events.filter(F.col("error").isNotNull()))


TABLE_STATS_SQL = CHECKED_SQL + """,
net AS (SELECT 'S.T' || (user_id % 5) AS table_name, CASE WHEN arg_max(op, seq) = 'D' THEN 'D' ELSE 'U' END AS op FROM ev GROUP BY user_id),
stacked AS (SELECT table_name, op, 'msgs' AS what FROM ev UNION ALL SELECT table_name, op, 'dmls' FROM net
  UNION ALL SELECT table_name, op, 'fails' FROM ev WHERE bad),
ts AS (SELECT table_name, """ + ", ".join(
    f"CAST(count(*) FILTER (what = '{w}' AND op = '{o}') AS BIGINT) AS {w}_{o.lower()}" for w in ("msgs", "dmls", "fails") for o in "IUKD"
) + " FROM stacked GROUP BY table_name)"


@query("table_stats", TABLE_STATS_SQL + "SELECT * FROM ts")
def table_stats(spark, d):
    return _table_stats(spark, d)


@query(
    "report_tables",
    TABLE_STATS_SQL + """SELECT '{"table_name":"' || table_name || '","messages":{"i":' || msgs_i || ',"u":' || msgs_u || ',"k":' || msgs_k || ',"d":' || msgs_d || '},' ||
 '"applied":{"i":' || dmls_i || ',"u":' || dmls_u || ',"k":' || dmls_k || ',"d":' || dmls_d || '},' || '"failed":{"i":' || fails_i || ',"u":' || fails_u || ',"k":' || fails_k || ',"d":' || fails_d || '}}' AS line FROM ts""",
)
def report_tables(spark, d):
    return stats.report(_table_stats(spark, d), "tables")


@query(
    "report_tables_text",
    TABLE_STATS_SQL + """SELECT 'table_name: ' || table_name || ', messages: i=' || msgs_i || ' u=' || msgs_u || ' k=' || msgs_k || ' d=' || msgs_d || ', applied: i=' || dmls_i || ' u=' || dmls_u || ' k=' || dmls_k || ' d=' || dmls_d ||
 ', failed: i=' || fails_i || ' u=' || fails_u || ' k=' || fails_k || ' d=' || fails_d AS line FROM ts""",
)
def report_tables_text(spark, d):
    return stats.report(_table_stats(spark, d), "tables", "text")


PROGRESS_SQL = LOG + """, pr AS (SELECT topic, part, CAST(count(*) AS BIGINT) AS records, max(seq) AS last_offset,
  arg_max(ts, seq) AS last_time FROM log GROUP BY topic, part)
"""


@query(
    "partition_progress",
    PROGRESS_SQL + """SELECT topic, part AS "partition", records, last_offset, strftime(last_time, '%Y-%m-%d %H:%M:%S') AS last_time FROM pr""",
)
def partition_progress(spark, d):
    df = stats.partition_progress(_log(spark, d))
    return df.withColumn("last_time", F.date_format("last_time", "yyyy-MM-dd HH:mm:ss"))


@query(
    "report_tasks",
    PROGRESS_SQL + """SELECT '{"topic":"' || topic || '","partition":' || part || ',"records":' || records || ',"last_offset":' || last_offset ||
 ',"last_time":"' || strftime(last_time, '%Y-%m-%d %H:%M:%S') || '"}' AS line FROM pr""",
)
def report_tasks(spark, d):
    return stats.report(stats.partition_progress(_log(spark, d)), "tasks")


@query(
    "report_log",
    TOTALS_SQL + """SELECT '{"total":' || total || ',"errors":' || errors || ',"messages":{"i":' || messages_i || ',"u":' || messages_u || ',"k":' || messages_k || ',"d":' || messages_d || '},' ||
 '"errors_by_op":{"i":' || errors_i || ',"u":' || errors_u || ',"k":' || errors_k || ',"d":' || errors_d || '}}' AS line FROM t""",
)
def report_log(spark, d):
    return stats.report(stats.op_totals(_checked_events(spark, d)), "log")


@query(
    "freshness",
    PROGRESS_SQL + """SELECT strftime(min(last_time), '%Y-%m-%d %H:%M:%S') AS oldest, strftime(max(last_time), '%Y-%m-%d %H:%M:%S') AS newest FROM pr""",
)
def freshness(spark, d):
    df = stats.freshness(stats.partition_progress(_log(spark, d)))
    return df.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in df.columns])


SPEED_SQL = """, b AS (SELECT {by} CAST(floor(epoch(ts) / 600) AS BIGINT) AS bucket, count(*) AS n FROM ev GROUP BY ALL)
SELECT {by} CAST(floor(max(n) / 600) AS BIGINT) AS max_speed, CAST(floor(sum(n) / ((max(bucket) - min(bucket) + 1) * 600)) AS BIGINT) AS avg_speed,
 CAST(floor(arg_max(n, bucket) / 600) AS BIGINT) AS cur_speed, CAST(sum(n) AS BIGINT) AS messages FROM b"""


@query("throughput", CHECKED_SQL + SPEED_SQL.format(by=""))
def throughput(spark, d):
    return stats.throughput(_checked_events(spark, d), 600)


@query("throughput_by_table", CHECKED_SQL + SPEED_SQL.format(by="table_name, op,") + " GROUP BY table_name, op")
def throughput_by_table(spark, d):
    return stats.throughput(_checked_events(spark, d), 600, ["table_name", "op"])


@query(
    "interval_counts",
    CHECKED_SQL + "SELECT op, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS bucket, CAST(count(*) AS BIGINT) AS n FROM ev GROUP BY 1, 2",
)
def interval_counts(spark, d):
    return stats.interval_counts(_checked_events(spark, d), 3600, ["op"], "event_ts")


@query(
    "error_counts",
    REJECTS_SQL + "SELECT op, 'after_delete' AS code, CAST(count(*) AS BIGINT) AS rows FROM rej GROUP BY op",
)
def error_counts(spark, d):
    return stats.error_counts(net_rejects(logs.user_changes(spark, d), logs.USERS))


COMMITS_SQL = """WITH c AS (SELECT event_id // 1000 AS batch_id, CASE WHEN event_id // 1000 = (SELECT max(event_id) // 1000 FROM events) THEN 'open' ELSE 'done' END AS status,
  event_type, value FROM events), l AS (SELECT
 CAST(count(DISTINCT batch_id) AS BIGINT) AS tasks_total, CAST(count(DISTINCT batch_id) FILTER (status = 'done') AS BIGINT) AS tasks_done,
 CAST(count(DISTINCT batch_id) FILTER (status <> 'done') AS BIGINT) AS tasks_todo,
 CAST(count(DISTINCT batch_id) FILTER (status = 'done') AS BIGINT) AS transactions_total, CAST(0 AS BIGINT) AS transactions_fails,
 CAST(count(*) AS BIGINT) AS messages, CAST(count(*) FILTER (event_type = 'signup') AS BIGINT) AS inserts,
 CAST(count(*) FILTER (event_type NOT IN ('signup', 'error')) AS BIGINT) AS updates,
 CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS deletes, CAST(count(*) FILTER (value > 90) AS BIGINT) AS rejects FROM c)
"""


def _load_stats(spark, d):
    """A commit log with one row per thousand events and table; the last batch is still open."""
    e = F.col("event_type")
    ev = logs.table(spark, d, "events").withColumn("batch_id", F.floor(F.col("event_id") / 1000))
    commits = ev.groupBy("batch_id", (F.col("user_id") % 3).alias("table_name")).agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(e == "signup").alias("inserts"),
        F.count_if(~e.isin("signup", "error")).alias("updates"), F.count_if(e == "error").alias("deletes"),
        F.count_if(F.col("value") > 90).alias("rejects"))
    last = F.floor(ev.agg(F.max("event_id")).scalar() / 1000)
    return stats.load_stats(commits.withColumn("status", F.when(F.col("batch_id") == last, "open").otherwise("done")))


@query("load_stats", COMMITS_SQL + "SELECT * FROM l")
def load_stats(spark, d):
    return _load_stats(spark, d)


@query(
    "report_database",
    COMMITS_SQL + """SELECT '{"tasks_total":' || tasks_total || ',"tasks_done":' || tasks_done || ',"tasks_todo":' || tasks_todo || ',"transactions_total":' || transactions_total || ',"transactions_fails":' || transactions_fails || ',"messages":' || messages || ',"inserts":' || inserts || ',"updates":' || updates || ',"deletes":' || deletes || ',"rejects":' || rejects || '}' AS line FROM l""",
)
def report_database(spark, d):
    return stats.report(_load_stats(spark, d), "database")


# -- catalog -------------------------------------------------------------------------------------------------
@query(
    "load_catalog",
    """WITH c AS (SELECT CASE WHEN p_type = 'SMALL' THEN '_MD_' ELSE p_type END AS s, p_brand || '_' || (p_partkey // 40) AS t, p_partkey AS o, p_name || p_partkey AS n, p_size FROM part)
SELECT s AS schema_name, t AS table_name, CAST(count(*) AS INT) AS n_columns, string_agg(n, ',' ORDER BY o) AS columns,
  coalesce(string_agg(n, ',' ORDER BY o DESC) FILTER (p_size > 40), string_agg(n, ',' ORDER BY o)) AS key_columns,
  count(*) FILTER (p_size > 40) > 0 AS has_pk
FROM c WHERE s <> '_MD_' GROUP BY s, t""",
)
def load_catalog_query(spark, d):
    """Parts read as column metadata of many small tables; the keys come in reverse column order."""
    p = logs.table(spark, d, "part").select(
        F.when(F.col("p_type") == "SMALL", "_MD_").otherwise(F.col("p_type")).alias("schema_name"),
        F.concat("p_brand", F.lit("_"), F.floor(F.col("p_partkey") / 40).cast("string")).alias("table_name"),
        F.col("p_partkey").cast("int").alias("ordinal"),
        F.concat("p_name", F.col("p_partkey").cast("string")).alias("column_name"),
        F.lit(64).alias("type_code"), F.lit("VARCHAR").alias("type_name"), F.col("p_size").alias("size"),
        F.lit("").alias("charset"), F.lit(True).alias("nullable"))
    keys = p.filter(F.col("size") > 40).select("schema_name", "table_name", (-F.col("ordinal")).alias("key_seq"), "column_name")
    out = load_catalog(p, keys)
    return out.select(
        "schema_name", "table_name", F.size("columns").alias("n_columns"),
        F.array_join(F.transform("columns", lambda c: c["column_name"]), ",").alias("columns"),
        F.array_join("key_columns", ",").alias("key_columns"), "has_pk")


@query(
    "batch_rows",
    """SELECT p_type AS table_name, CAST(greatest(1, least(500, 536870912 // sum(p_size * 100000))) AS BIGINT) AS batch_rows FROM part GROUP BY p_type""",
)
def batch_rows(spark, d):
    """Rows per write batch by table width, over parts read as column metadata."""
    columns = logs.table(spark, d, "part").select(F.col("p_type").alias("table_name"), (F.col("p_size") * 100000).cast("bigint").alias("size"))
    return columns.groupBy("table_name").agg(apply.batch_rows(F.sum("size")).alias("batch_rows"))
