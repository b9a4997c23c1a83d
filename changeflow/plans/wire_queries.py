"""Decoder, value-rule, routing and binding queries. Wire messages are built from whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow import fixed_values as fv
from changeflow.config import JobConfig
from changeflow.functions import text as tx
from changeflow.model import TXN_FIELDS, Catalog, ColumnSpec, TableSpec
from changeflow.operators import route
from changeflow.operators.bind import bind_changes, cast_typed, to_row
from changeflow.plans import logs
from changeflow.plans.registry import query
from changeflow.sources.decode_common import cell
from changeflow.sources.decode_fixed import decode_fixed
from changeflow.sources.decode_json import decode_json_array, decode_json_image
from changeflow.sources.decode_proto import decode_proto, soft_delete_rule
from changeflow.sources.decode_text import decode_ctrl, decode_delimited
from changeflow.sources.registry import decode, register_decoder

S1, S2, S3, S4 = fv.FIELD_SEP, fv.TAG_DATA, fv.TAG_NULL, fv.TAG_NONE


def _envelope(df, key, value, topic="wire"):
    return df.select(
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.col(key).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"), value.alias("value"),
    )


def _cur(name):
    return F.try_element_at("cols", F.lit(name))["cur"]


def _old(name):
    return F.try_element_at("cols", F.lit(name))["old"]


# -- delimited -----------------------------------------------------------------------------------------
PART = TableSpec.of(
    "S", "PART",
    {"p_partkey": "SIGNED BIGINT", "p_name": "VARCHAR", "p_brand": "VARCHAR", "p_type": "VARCHAR", "p_size": "SIGNED INTEGER"},
    ["p_partkey"],
)


def _part_lines(spark, d, delim):
    p = logs.table(spark, d, "part")
    quoted = F.concat(F.lit('"'), "p_name", F.lit('"'))
    line = F.concat_ws(delim, F.col("p_partkey").cast("string"), quoted, "p_brand", "p_type", F.col("p_size").cast("string"))
    return _envelope(p, "p_partkey", F.encode(line, "UTF-8"))


PART_SQL = "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part"


@query("decode_delimited", PART_SQL)
def decode_delimited_comma(spark, d):
    return to_row(decode_delimited(_part_lines(spark, d, ","), PART, ","), PART)


@query("decode_delimited_tab", PART_SQL)
def decode_delimited_tab(spark, d):
    return to_row(decode_delimited(_part_lines(spark, d, "\t"), PART, "\t"), PART)


@query(
    "decode_delimited_trailing",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  o_orderstatus <> 'F' AS has_status FROM orders""",
)
def decode_delimited_trailing(spark, d):
    """Trailing empty fields are absent, not empty."""
    spec = TableSpec.of("S", "O", {"o_orderkey": "SIGNED BIGINT", "o_orderstatus": "VARCHAR"}, ["o_orderkey"])
    o = logs.table(spark, d, "orders")
    status = F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).otherwise("")
    line = F.concat(F.col("o_orderkey").cast("string"), F.lit(","), status, F.lit(",,"))
    trimmed = F.when(F.col("o_orderstatus") != "F", F.regexp_replace(line, ",,$", "")).otherwise(line)
    events = decode_delimited(_envelope(o, "o_orderkey", F.encode(trimmed, "UTF-8")), spec)
    has = F.coalesce(F.try_element_at("cols", F.lit("o_orderstatus"))["has_cur"], F.lit(False))
    return events.select(
        _cur("o_orderkey").cast("bigint").alias("o_orderkey"), _cur("o_orderstatus").alias("o_orderstatus"),
        has.alias("has_status"))


# -- control-character log -------------------------------------------------------------------------------
CUSTOMER3 = TableSpec.of(
    "S", "CUST", {"c_custkey": "SIGNED BIGINT", "c_name": "VARCHAR", "c_mktsegment": "VARCHAR"}, ["c_custkey"])


def _ctrl_messages(spark, d):
    """Inserts, updates and deletes by segment; updates set the segment to NULL for nation 0."""
    c = logs.table(spark, d, "customer")
    key = F.col("c_custkey").cast("string")
    op = (
        F.when(F.col("c_mktsegment") == "BUILDING", "I").when(F.col("c_mktsegment") == "MACHINERY", "D").otherwise("U")
    )
    head = F.concat_ws(S2, F.lit("P"), F.lit("77"), F.concat(F.lit("x"), key), F.lit("1,2"), F.lit("1"), F.lit("8"), key)
    none, null = F.lit(S4), F.lit(S3)
    data = lambda v: F.concat(F.lit(S2), v)
    is_i, is_d = op == "I", op == "D"
    cur = lambda v: F.when(is_d, none).otherwise(v)
    old = lambda v: F.when(is_i, none).otherwise(v)
    segment = F.when((op == "U") & (F.col("c_nationkey") == 0), null).otherwise(data(F.col("c_mktsegment")))
    name = F.when(F.col("c_nationkey") % 2 == 0, F.lit("CAT.S.CUST")).otherwise(F.lit("S.CUST"))
    line = F.concat_ws(
        S1, head, name, op, F.lit("2018-04-02 07:59:54"),
        F.concat(F.lit("0"), cur(data(key)), old(data(key))),
        F.concat(F.lit("1"), cur(data(F.col("c_name"))), old(data(F.lit("before")))),
        F.concat(F.lit("2"), cur(segment), old(data(F.lit("'old'")))),
    )
    return _envelope(c, "c_custkey", F.encode(line, "UTF-8"))


CTRL_SQL = """
WITH c AS (SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 'I' WHEN 'MACHINERY' THEN 'D' ELSE 'U' END AS op FROM customer)
"""


@query(
    "decode_ctrl",
    CTRL_SQL + """
SELECT c_custkey AS "offset", 'S' AS schema_name, 'CUST' AS table_name, op, 'x' || c_custkey AS xid,
  CASE WHEN op = 'D' THEN NULL ELSE CAST(c_custkey AS VARCHAR(20)) END AS key_cur,
  CASE WHEN op = 'I' THEN NULL ELSE CAST(c_custkey AS VARCHAR(20)) END AS key_old,
  CASE WHEN op = 'D' THEN NULL ELSE c_name END AS name_cur, CASE WHEN op = 'I' THEN NULL ELSE 'before' END AS name_old,
  CASE WHEN op = 'D' OR (op = 'U' AND c_nationkey = 0) THEN NULL ELSE c_mktsegment END AS segment_cur,
  op <> 'D' AS has_segment FROM c""",
)
def decode_ctrl_query(spark, d):
    events = route.bind_columns(decode_ctrl(_ctrl_messages(spark, d)), Catalog([CUSTOMER3]), by="position")
    here = lambda n, side: F.when(F.try_element_at("cols", F.lit(n))[f"has_{side}"], F.try_element_at("cols", F.lit(n))[side])
    return events.select(
        "offset", "schema_name", "table_name", "op", F.col("txn.xid").alias("xid"),
        here("c_custkey", "cur").alias("key_cur"), here("c_custkey", "old").alias("key_old"),
        here("c_name", "cur").alias("name_cur"), here("c_name", "old").alias("name_old"),
        here("c_mktsegment", "cur").alias("segment_cur"),
        F.try_element_at("cols", F.lit("c_mktsegment"))["has_cur"].alias("has_segment"))


# -- JSON ------------------------------------------------------------------------------------------------
@query(
    "decode_json_image",
    """SELECT o_orderkey AS "offset", 'DB' AS schema_name, 'ORD' AS table_name,
  CASE o_orderstatus WHEN 'F' THEN 'I' WHEN 'O' THEN 'U' ELSE 'D' END AS op,
  CAST(o_orderkey AS VARCHAR(20)) AS key_cur, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS priority_cur,
  CASE WHEN o_orderstatus = 'O' THEN 'x' END AS priority_old, o_orderstatus = 'O' AS has_old,
  CAST(o_custkey AS VARCHAR(20)) AS xid FROM orders""",
)
def decode_json_image_query(spark, d):
    o = logs.table(spark, d, "orders")
    status = F.col("o_orderstatus")
    word = F.when(status == "F", "INSERT").when(status == "O", "update").otherwise("Delete")
    # NULL fields must stay in the text
    priority = F.when(status == "F", F.lit("null")).otherwise(F.concat(F.lit('"'), "o_orderpriority", F.lit('"')))
    old = F.when(status == "O", F.lit(',"old":{"PRIO":"x"}')).otherwise("")
    message = F.format_string(
        '{"database":"DB","table":"ORD","type":"%s","ts":1,"xid":%d,"commit":true,"position":"p","data":{"ID":%d,"PRIO":%s}%s}',
        word, "o_custkey", "o_orderkey", priority, old)
    events = decode_json_image(_envelope(o, "o_orderkey", F.encode(message, "UTF-8")))
    return events.select(
        "offset", "schema_name", "table_name", "op", _cur("ID").alias("key_cur"), _cur("PRIO").alias("priority_cur"),
        _old("PRIO").alias("priority_old"), F.try_element_at("cols", F.lit("PRIO"))["has_old"].alias("has_old"),
        F.col("txn.xid").alias("xid"))


@query(
    "decode_json_array",
    """SELECT c_custkey AS "offset", 0 AS item, 'CUST' AS table_name, 'I' AS op, CAST(c_custkey AS VARCHAR(20)) AS key_cur,
  NULL AS key_old, c_name AS name_cur, NULL AS name_old FROM customer
UNION ALL SELECT c_custkey, 1, 'CUST', 'U', CAST(c_custkey + 1 AS VARCHAR(20)), CAST(c_custkey AS VARCHAR(20)), c_mktsegment, c_name FROM customer
UNION ALL SELECT c_custkey, 2, 'CUST', 'D', NULL, CAST(c_custkey + 1 AS VARCHAR(20)), NULL, c_mktsegment FROM customer""",
)
def decode_json_array_query(spark, d):
    c = logs.table(spark, d, "customer")
    message = F.format_string(
        '[{"table_name":"cust","operate":"insert","column":[{"NAME":"%s"}],"key_column":[{"ID":"%d"}]},'
        '{"table_name":"cust","operate":"update","column":[{"NAME":"%s"},{"NAME":"%s"}],"key_column":[{"ID":"%d"},{"ID":"%d"}]},'
        '{"table_name":"cust","operate":"delete","column":[{"NAME":"%s"}],"key_column":[{"ID":"%d"}]}]',
        "c_name", "c_custkey", "c_name", "c_mktsegment", "c_custkey", F.col("c_custkey") + 1, "c_mktsegment",
        F.col("c_custkey") + 1)
    events = decode_json_array(_envelope(c, "c_custkey", F.encode(message, "UTF-8")), "S")
    return events.select(
        "offset", "item", "table_name", "op", _cur("ID").alias("key_cur"), _old("ID").alias("key_old"),
        _cur("NAME").alias("name_cur"), _old("NAME").alias("name_old"))


@query(
    "json_array_bad_pairs",
    """SELECT c_custkey AS "offset", 0 AS item, 'bad_pair' AS code FROM customer
UNION ALL SELECT c_custkey, 1, 'bad_pair' FROM customer UNION ALL SELECT c_custkey, 2, NULL FROM customer""",
)
def json_array_bad_pairs(spark, d):
    """An update list of odd length, one that pairs two columns, and a good one."""
    c = logs.table(spark, d, "customer")
    message = F.format_string(
        '[{"table_name":"cust","operate":"update","column":[{"NAME":"%s"},{"NAME":"%s"},{"NAME":"x"}],"key_column":[]},'
        '{"table_name":"cust","operate":"update","column":[{"NAME":"%s"},{"SEGMENT":"%s"}],"key_column":[]},'
        '{"table_name":"cust","operate":"update","column":[{"NAME":"%s"},{"NAME":"%s"}],"key_column":[]}]',
        *["c_name", "c_mktsegment"] * 3)
    events = decode_json_array(_envelope(c, "c_custkey", F.encode(message, "UTF-8")), "S")
    return events.select("offset", "item", F.col("error.code").alias("code"))


# -- fixed width -------------------------------------------------------------------------------------------
FIXED = TableSpec(
    "S", "FIXED",
    (
        ColumnSpec("orderkey", "UNSIGNED INTEGER", 4, "", 133),
        ColumnSpec("quantity", "UNSIGNED TINYINT", 1, "", 137),
        ColumnSpec("suppkey", "UNSIGNED SMALLINT", 2, "", 131),
        ColumnSpec("partkey", "UNSIGNED LARGEINT", 8, "", 138),
        ColumnSpec("flag", "VARCHAR", 4, "", 64),
    ),
)
FIXED_SQL = """
SELECT CAST(l_orderkey AS VARCHAR(20)) AS orderkey, CAST(CAST(l_quantity AS INT) AS VARCHAR(20)) AS quantity,
  CAST(l_suppkey AS VARCHAR(20)) AS suppkey, CAST(l_partkey AS VARCHAR(20)) AS partkey,
  l_returnflag || l_linestatus AS flag FROM lineitem"""


def _fixed_messages(spark, d, big_endian):
    li = logs.table(spark, d, "lineitem")

    def number(col, width):
        big = F.lpad(F.hex(F.col(col).cast("bigint")), 2 * width, "0")
        if big_endian:
            return F.unhex(big)
        return F.unhex(F.concat(*[F.substring(big, 2 * i + 1, 2) for i in reversed(range(width))]))

    value = F.concat(
        number("l_orderkey", 4), number("l_quantity", 1), number("l_suppkey", 2), number("l_partkey", 8),
        F.encode(F.concat("l_returnflag", "l_linestatus"), "UTF-8"))
    return _envelope(li, "l_orderkey", value)


def _fixed_rows(events):
    return events.select(*[_cur(c).alias(c) for c in FIXED.column_names])


@query("decode_fixed_be", FIXED_SQL)
def decode_fixed_be(spark, d):
    return _fixed_rows(decode_fixed(_fixed_messages(spark, d, True), FIXED, big_endian=True))


@query("decode_fixed_le", FIXED_SQL)
def decode_fixed_le(spark, d):
    return _fixed_rows(decode_fixed(_fixed_messages(spark, d, False), FIXED, big_endian=False))


@query(
    "decode_fixed_length_check",
    """SELECT CASE WHEN l_linestatus = 'O' THEN 'bad_length' END AS code, CAST(count(*) AS BIGINT) AS n,
  CAST(sum(CASE WHEN l_linestatus = 'O' THEN 0 ELSE l_orderkey END) AS BIGINT) AS key_sum
FROM lineitem GROUP BY l_linestatus = 'O', CASE WHEN l_linestatus = 'O' THEN 'bad_length' END""",
)
def decode_fixed_length_check(spark, d):
    """With integer columns only, a record of another length is a bad row."""
    spec = TableSpec("S", "F", (ColumnSpec("orderkey", "UNSIGNED INTEGER", 4, "", 133), ColumnSpec("n", "UNSIGNED TINYINT", 1, "", 137)))
    li = logs.table(spark, d, "lineitem")
    key = F.unhex(F.lpad(F.hex("l_orderkey"), 8, "0"))
    tail = F.when(F.col("l_linestatus") == "O", F.unhex(F.lit("0101"))).otherwise(F.unhex(F.lit("01")))
    events = decode_fixed(_envelope(li, "l_orderkey", F.concat(key, tail)), spec, big_endian=True)
    return events.groupBy(F.col("error.code").alias("code")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_cur("orderkey").cast("bigint")), F.lit(0)).alias("key_sum"))


# -- protobuf ----------------------------------------------------------------------------------------------
SUPPLIER = TableSpec.of(
    "S", "SUPP", {"S_KEY": "SIGNED BIGINT", "S_NAME": "VARCHAR", "S_NATION": "SIGNED INTEGER", "S_DATE": "TIMESTAMP"}, ["S_KEY"])


def _tagged(number, wire):
    tag = (number << 3) | wire
    return F.unhex(F.lit(f"{tag:02X}" if tag < 128 else f"{(tag & 0x7F) | 0x80:02X}{tag >> 7:02X}"))


def _bytes_field(number, value):
    """Length-delimited field; lengths up to 16383."""
    n = F.length(value)
    one = F.unhex(F.lpad(F.hex(n), 2, "0"))
    two = F.unhex(F.concat(F.lpad(F.hex((n % 128) + 128), 2, "0"), F.lpad(F.hex((n / 128).cast("int")), 2, "0")))
    return F.concat(_tagged(number, 2), F.when(n < 128, one).otherwise(two), value)


def _int_field(number, value):
    """Varint below 128."""
    return F.concat(_tagged(number, 0), F.unhex(F.lpad(F.hex(value), 2, "0")))


def _text(value):
    return F.encode(value, "UTF-8")


def _proto_column(number, index, name, old, new, nulls=None):
    """``old``/``new``: text column; NULL becomes the null flag, unless ``nulls`` gives the flags of both."""
    old_null, new_null = nulls or (old.isNull(), new.isNull())
    empty = F.unhex(F.lit(""))
    parts = [_int_field(1, F.lit(index)), _bytes_field(2, _text(F.lit(name)))]
    for value, is_null, flag, field in ((old, old_null, 5, 7), (new, new_null, 6, 8)):
        parts.append(F.when(is_null, _int_field(flag, F.lit(1))).otherwise(empty))
        parts.append(F.when(value.isNotNull(), _bytes_field(field, _text(F.coalesce(value, F.lit(""))))).otherwise(empty))
    return _bytes_field(number, F.concat(*parts))


def _proto_messages(spark, d):
    s = logs.table(spark, d, "customer")
    key = F.col("c_custkey").cast("string")
    seg = F.col("c_mktsegment")
    code = F.when(seg == "BUILDING", 0).when(seg == "MACHINERY", 2).otherwise(1)
    new_key = F.when(seg == "FURNITURE", F.concat(F.lit("9"), key)).otherwise(key)
    record = F.concat(
        _int_field(4, F.lit(2)),
        _bytes_field(5, _text(F.concat(F.lit("csn"), key))),
        _bytes_field(6, _text(F.concat(F.lit("x"), key))),
        *[_int_field(n, F.col("c_custkey") % m) for n, m in ((2, 90), (7, 100), (8, 50), (9, 20), (10, 7), (11, 3), (12, 2))],
        _int_field(13, code),
        _bytes_field(15, _text(F.lit("S.SUPP"))),
        _proto_column(16, 0, "S_KEY", key, new_key),
        _proto_column(17, 0, "S_KEY", key, new_key),
        _proto_column(17, 1, "S_NAME", F.lit("before"), F.col("c_name")),
        _proto_column(17, 2, "S_NATION", F.lit("1"), F.when(F.col("c_nationkey") == 0, F.lit("")).otherwise(F.col("c_nationkey").cast("string"))),
        _proto_column(17, 3, "S_DATE", F.lit("0000-00-00 00:00:00"), F.when(F.col("c_nationkey") != 1, F.lit("0000-00-00"))),
    )
    return _envelope(s, "c_custkey", record)


@query(
    "decode_proto",
    """SELECT c_custkey AS "offset",
  CASE c_mktsegment WHEN 'BUILDING' THEN 'I' WHEN 'MACHINERY' THEN 'D' WHEN 'FURNITURE' THEN 'K' ELSE 'U' END AS op,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN '9' || c_custkey ELSE CAST(c_custkey AS VARCHAR(20)) END AS key_cur,
  CAST(c_custkey AS VARCHAR(20)) AS key_old, c_name AS name_cur,
  CAST(c_nationkey AS VARCHAR(20)) AS nation_cur, CASE WHEN c_nationkey <> 1 THEN '0001-01-01' END AS date_cur,
  '0001-01-01 00:00:00' AS date_old, 'x' || c_custkey AS xid, 'csn' || c_custkey AS csn FROM customer""",
)
def decode_proto_query(spark, d):
    events = decode_proto(_proto_messages(spark, d), Catalog([SUPPLIER]))
    return events.select(
        "offset", "op", _cur("S_KEY").alias("key_cur"), _old("S_KEY").alias("key_old"), _cur("S_NAME").alias("name_cur"),
        _cur("S_NATION").alias("nation_cur"), _cur("S_DATE").alias("date_cur"), _old("S_DATE").alias("date_old"),
        F.col("txn.xid").alias("xid"), F.col("txn.csn").alias("csn"))


@query(
    "decode_proto_source1",
    """SELECT c_custkey AS "offset", CASE WHEN CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey = 7 ELSE c_nationkey % 2 = 1 END THEN 'U' ELSE 'K' END AS op,
  CAST(c_custkey AS VARCHAR(20)) AS key_cur, CASE c_mktsegment WHEN 'BUILDING' THEN '7' ELSE CAST(c_custkey AS VARCHAR(20)) END AS key_old,
  CASE WHEN c_nationkey % 3 <> 0 THEN c_name WHEN c_nationkey = 0 THEN '' END AS name_cur,
  CASE WHEN c_nationkey = 0 THEN '0' ELSE CAST(c_nationkey AS VARCHAR(20)) END AS nation_cur,
  CASE WHEN c_nationkey <> 0 THEN '0001-01-01' END AS date_cur FROM customer""",
)
def decode_proto_source1(spark, d):
    """Source 1: columns by index, only some of them sent, a null old key keeps its value, null flags read together with the bytes.

    The message calls an update a key change if the bytes of the keys differ, null or not; binding sees that a key that keeps its value
    has not moved.
    """
    c = logs.table(spark, d, "customer")
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey")
    never, text = F.lit(False), F.lit
    moved = F.col("c_mktsegment") == "BUILDING"
    empty, no_bytes = text(""), nation == 0
    kept = F.when(nation % 2 == 1, key).otherwise(empty)
    # bytes under a null flag read as NULL, a null flag without bytes as the empty value of the type
    record = F.concat(
        _int_field(4, F.lit(1)), _int_field(13, F.lit(1)), _bytes_field(15, _text(text("S.SUPP"))),
        _proto_column(16, 0, "", F.when(moved, "7").otherwise(kept), key, (~moved, never)),
        _proto_column(17, 1, "", text("before"), F.when(no_bytes, empty).otherwise(F.col("c_name")), (never, nation % 3 == 0)),
        _proto_column(17, 2, "", text("1"), F.when(no_bytes, empty).otherwise(nation.cast("string")), (never, no_bytes)),
        _proto_column(17, 3, "", text("1"), F.when(no_bytes, empty).otherwise("0000-00-00"), (never, no_bytes)),
    )
    events = decode_proto(_envelope(c, "c_custkey", record), Catalog([SUPPLIER]))
    return events.select(
        "offset", "op", _cur("S_KEY").alias("key_cur"), _old("S_KEY").alias("key_old"), _cur("S_NAME").alias("name_cur"),
        _cur("S_NATION").alias("nation_cur"), _cur("S_DATE").alias("date_cur"))


@query(
    "txn_attributes",
    """SELECT 'ctrl' AS format, c_custkey AS "offset", 'x' || c_custkey AS xid, '77' AS csn, CAST(c_custkey AS VARCHAR(20)) AS seq, '1' AS flag, 'P' AS process,
  '1,2' AS local_xid, '8' AS rebuild_xid, NULL AS begin_seq, NULL AS begin_rba, NULL AS rba, NULL AS trans_seq FROM customer
UNION ALL SELECT 'protobuf', c_custkey, 'x' || c_custkey, 'csn' || c_custkey, CAST(c_custkey % 20 AS VARCHAR(20)), CAST(c_custkey % 2 AS VARCHAR(20)),
  CAST(c_custkey % 90 AS VARCHAR(20)), NULL, NULL, CAST(c_custkey % 100 AS VARCHAR(20)), CAST(c_custkey % 50 AS VARCHAR(20)),
  CAST(c_custkey % 7 AS VARCHAR(20)), CAST(c_custkey % 3 AS VARCHAR(20)) FROM customer""",
)
def txn_attributes(spark, d):
    """All transaction attributes that the control-character and the protobuf format carry."""
    ctrl = decode_ctrl(_ctrl_messages(spark, d)).withColumn("format", F.lit("ctrl"))
    proto = decode_proto(_proto_messages(spark, d), Catalog([SUPPLIER])).withColumn("format", F.lit("protobuf"))
    names = [F.col(f"txn.{n}").alias(n) for n in TXN_FIELDS if n != "op_time"]
    return ctrl.select("format", "offset", *names).unionByName(proto.select("format", "offset", *names))


# -- value rules -------------------------------------------------------------------------------------------
@query(
    "null_rules",
    """WITH e AS (SELECT event_id, 1 + CAST(event_id % 2 AS INT) AS src, event_id % 3 = 0 AS is_null,
  CASE WHEN event_id % 5 < 2 THEN '' ELSE event_type END AS txt,
  CASE event_type WHEN 'click' THEN 'VARCHAR' WHEN 'view' THEN 'NCHAR VARYING' WHEN 'error' THEN 'SIGNED INTEGER'
    WHEN 'signup' THEN 'unsigned decimal ' ELSE 'TIMESTAMP' END AS tn FROM events),
v AS (SELECT *, CASE WHEN tn IN ('VARCHAR', 'NCHAR VARYING') THEN '' WHEN tn IN ('SIGNED INTEGER', 'unsigned decimal ') THEN '0' END AS empty FROM e)
SELECT event_id, CASE WHEN src = 1 THEN CASE WHEN is_null AND txt <> '' THEN NULL WHEN is_null THEN empty ELSE txt END
  ELSE CASE WHEN is_null THEN NULL WHEN txt = '' THEN empty ELSE txt END END AS value FROM v""",
)
def null_rules(spark, d):
    e = F.col("event_type")
    eid = F.col("event_id")
    text = F.when(eid % 5 < 2, "").otherwise(e)
    type_name = (
        F.when(e == "click", "VARCHAR").when(e == "view", "NCHAR VARYING").when(e == "error", "SIGNED INTEGER")
        .when(e == "signup", "unsigned decimal ").otherwise("TIMESTAMP"))
    value = tx.null_rule(1 + eid % 2, eid % 3 == 0, F.length(text), text, tx.empty_value(type_name))
    return logs.table(spark, d, "events").select("event_id", value.alias("value"))


@query(
    "zero_dates",
    """WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '0000-00-00' WHEN 'O' THEN '0000-00-00 00:00:00'
  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS v FROM orders)
SELECT o_orderkey, CASE v WHEN '0000-00-00' THEN '0001-01-01' WHEN '0000-00-00 00:00:00' THEN '0001-01-01 00:00:00' ELSE v END AS fixed FROM o""",
)
def zero_dates(spark, d):
    s = F.col("o_orderstatus")
    v = F.when(s == "F", "0000-00-00").when(s == "O", "0000-00-00 00:00:00").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return logs.table(spark, d, "orders").select("o_orderkey", tx.fix_zero_dates(v).alias("fixed"))


@query(
    "op_codes",
    """SELECT event_id, CASE WHEN event_id % 163 IN (0, 5) THEN 'I' WHEN event_id % 163 IN (1, 15) THEN 'U'
  WHEN event_id % 163 IN (2, 3) THEN 'D' WHEN event_id % 163 = 115 THEN 'K' END AS proto_op,
  CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' WHEN 'view' THEN 'U' WHEN 'click' THEN 'K' END AS word_op FROM events""",
)
def op_codes(spark, d):
    e = F.col("event_type")
    word = F.when(e == "signup", "insert").when(e == "error", "DELETE").when(e == "view", "Update").when(e == "click", "updatePK").otherwise("merge")
    return logs.table(spark, d, "events").select(
        "event_id", tx.normalise_op(F.col("event_id") % 163).alias("proto_op"), tx.normalise_op(word, "words").alias("word_op"))


def _tag_events(spark, d):
    """Orders as traffic with a delete tag: code from the customer key, tag values from the order key."""
    o = logs.table(spark, d, "orders")
    k = F.col("o_orderkey")
    cur = F.when(k % 3 == 0, "2").when(k % 3 == 1, "3").otherwise("1")
    old = F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise((k % 4).cast("string"))
    name_cur = F.when(k % 7 == 0, "b").otherwise("a")
    yes = F.lit(True)
    cols = F.create_map(
        F.lit(fv.SOFT_DELETE_COLUMN), cell(cur, old, yes, yes), F.lit("NAME"), cell(name_cur, F.lit("a"), yes, yes))
    return o.select("o_orderkey", (F.col("o_custkey") % 4).alias("code"), cols.alias("cols"))


@query(
    "soft_delete_filter",
    """WITH o AS (SELECT o_orderkey, o_custkey % 4 AS code,
  CASE o_orderkey % 3 WHEN 0 THEN '2' WHEN 1 THEN '3' ELSE '1' END AS cur,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS VARCHAR(2)) END AS old, o_orderkey % 7 = 0 AS name_changed FROM orders)
SELECT o_orderkey, code FROM o WHERE NOT (
  (code = 2 AND old IS NOT NULL AND old IN ('2', '3'))
  OR (code = 1 AND NOT name_changed AND ((cur = '2' AND old IS NULL) OR (cur = '3' AND old IS NOT NULL AND old = '1'))))""",
)
def soft_delete_filter(spark, d):
    return _tag_events(spark, d).filter(~soft_delete_rule(F.col("code"), F.lit(2), F.col("cols"))).select("o_orderkey", "code")


@query("clean_values", """SELECT event_id, replace(replace(props, '"', ''), '''', '') AS cleaned FROM events""")
def clean_values(spark, d):
    return logs.table(spark, d, "events").select("event_id", tx.strip_quotes(F.col("props")).alias("cleaned"))


@query("decode_bytes", "SELECT doc_id, md5(text) AS digest FROM documents")
def decode_bytes(spark, d):
    """Strict decoding of whole texts."""
    docs = logs.table(spark, d, "documents").select("doc_id", F.encode("text", "UTF-8").alias("raw"))
    return docs.select("doc_id", F.md5(tx.decode_bytes(F.col("raw"), "UTF-8").cast("binary")).alias("digest"))


@query(
    "decode_bytes_fallback",
    "SELECT c_custkey, c_name || CASE WHEN c_nationkey % 2 = 0 THEN 'ж' ELSE '€' END AS decoded FROM customer",
)
def decode_bytes_fallback(spark, d):
    """GBK bytes decode as GBK; UTF-8 bytes that are not valid GBK fall back to UTF-8."""
    c = logs.table(spark, d, "customer")
    gbk = F.encode(F.concat("c_name", F.lit("ж")), "GBK")
    utf8 = F.encode(F.concat("c_name", F.lit("€")), "UTF-8")
    raw = F.when(F.col("c_nationkey") % 2 == 0, gbk).otherwise(utf8)
    return c.select("c_custkey", tx.decode_bytes(raw, "GBK").alias("decoded"))


@query("normalise_text", "SELECT p_partkey, p_name FROM part")
def normalise_text(spark, d):
    """Text in another character set, here GBK."""
    p = logs.table(spark, d, "part").select("p_partkey", F.encode("p_name", "GBK").alias("raw"))
    return p.select("p_partkey", tx.normalise_text(F.col("raw"), "GBK").alias("p_name"))


# -- names, mappings, binding --------------------------------------------------------------------------------
def _named_events(spark, d):
    """Customers as events on tables named in one, two or three parts."""
    c = logs.table(spark, d, "customer")
    seg, nation = F.col("c_mktsegment"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    full = F.when(seg == "BUILDING", seg).when(seg == "MACHINERY", F.concat(nation, F.lit("."), seg)).otherwise(
        F.concat(F.lit("CAT."), nation, F.lit("."), seg))
    yes, no, none = F.lit(True), F.lit(False), F.lit(None).cast("string")
    return c.select(
        F.col("c_custkey").alias("offset"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        full.alias("src_table"), F.lit(None).cast("string").alias("src_schema"), F.lit("TS").alias("topic_schema"),
        F.create_map(F.lit("src_name"), cell(F.col("c_name"), none, yes, no)).alias("cols"),
        F.lit(None).cast("struct<code:string,detail:string>").alias("error"),
    )


NAMED_SQL = """
WITH ev AS (SELECT c_custkey AS "offset", CASE c_mktsegment WHEN 'BUILDING' THEN 'TS' ELSE 'N' || c_nationkey END AS schema_name,
  c_mktsegment AS table_name, c_name FROM customer)
"""


@query("resolve_names", NAMED_SQL + 'SELECT "offset", schema_name, table_name FROM ev')
def resolve_names(spark, d):
    return route.resolve_names(_named_events(spark, d)).select("offset", "schema_name", "table_name")


@query("resolve_names_configured", NAMED_SQL + "SELECT \"offset\", 'FIX' AS schema_name, table_name FROM ev")
def resolve_names_configured(spark, d):
    return route.resolve_names(_named_events(spark, d), "FIX").select("offset", "schema_name", "table_name")


@query(
    "true_names",
    """SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS name FROM customer""",
)
def true_names(spark, d):
    lower = F.lower("c_mktsegment")
    written = F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("["), lower, F.lit("]"))).otherwise(lower)
    return logs.table(spark, d, "customer").select("c_custkey", tx.true_name(written).alias("name"))


def _mappings(spark, d):
    """One rule per nation: its machinery table feeds ALLMACH; plus a rule with blank source parts."""
    n = logs.table(spark, d, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("src_schema"), F.lit("MACHINERY").alias("src_table"),
        F.lit("T").alias("schema_name"), F.lit("ALLMACH").alias("table_name"))
    blank = spark.createDataFrame([("", "", "TS", "BUILDING")], n.schema)
    return n.unionByName(blank)


MAPPED_SQL = NAMED_SQL + """, mapped AS (SELECT "offset", CASE WHEN table_name = 'MACHINERY' THEN 'T' ELSE schema_name END AS schema_name,
  CASE WHEN table_name = 'MACHINERY' THEN 'ALLMACH' ELSE table_name END AS table_name, c_name FROM ev)
"""


def _mapped(spark, d):
    return route.map_tables(route.resolve_names(_named_events(spark, d)), _mappings(spark, d))


@query("map_tables", MAPPED_SQL + 'SELECT "offset", schema_name, table_name FROM mapped')
def map_tables(spark, d):
    return _mapped(spark, d).select("offset", "schema_name", "table_name")


@query("map_tables_twice", MAPPED_SQL + 'SELECT "offset", schema_name, table_name FROM mapped')
def map_tables_twice(spark, d):
    """Each source has two more rules: an earlier one that the later replaces, and a later one for a table that is not in the catalog."""
    rules = _mappings(spark, d)
    first = rules.withColumns({"table_name": F.lit("BUILDING"), "schema_name": F.lit("TS"), "rule": F.lit(0)}).filter("src_table <> ''")
    missing = rules.withColumns({"table_name": F.lit("NOWHERE"), "schema_name": F.lit("T"), "rule": F.lit(2)}).filter("src_table <> ''")
    every = first.unionByName(rules.withColumn("rule", F.lit(1))).unionByName(missing)
    return route.map_tables(route.resolve_names(_named_events(spark, d)), every, TARGETS).select("offset", "schema_name", "table_name")


@query(
    "map_columns",
    MAPPED_SQL + """SELECT "offset", CASE WHEN table_name = 'ALLMACH' THEN 'NAME' ELSE 'src_name' END AS column_name, c_name AS value FROM mapped""",
)
def map_columns(spark, d):
    rules = spark.createDataFrame(
        [("T", "ALLMACH", "src_name", "NAME"), ("T", "ALLMACH", "", "OTHER")],
        "schema_name string, table_name string, src_column string, column_name string")
    return route.map_columns(_mapped(spark, d), rules).select("offset", F.explode("cols").alias("column_name", "v")).select(
        "offset", "column_name", F.col("v.cur").alias("value"))


TARGETS = Catalog([
    TableSpec.of("T", "ALLMACH", {"NAME": "VARCHAR", "KEY": "SIGNED BIGINT"}, ["KEY"]),
    TableSpec.of("TS", "BUILDING", {"src_name": "VARCHAR", "KEY": "SIGNED BIGINT"}, ["KEY"]),
])


@query("known_tables", MAPPED_SQL + "SELECT \"offset\", table_name FROM mapped WHERE (schema_name, table_name) IN (('T','ALLMACH'), ('TS','BUILDING'))")
def known_tables(spark, d):
    return route.known_tables(_mapped(spark, d), TARGETS).select("offset", "table_name")


@query("unknown_tables", MAPPED_SQL + "SELECT \"offset\", table_name FROM mapped WHERE (schema_name, table_name) NOT IN (('T','ALLMACH'), ('TS','BUILDING'))")
def unknown_tables(spark, d):
    return route.unknown_tables(_mapped(spark, d), TARGETS).select("offset", "table_name")


@query(
    "bind_columns",
    MAPPED_SQL + "SELECT \"offset\", CASE WHEN table_name = 'ALLMACH' THEN 'unknown_column' END AS code FROM mapped",
)
def bind_columns(spark, d):
    """A column the target does not have makes the row bad."""
    return route.bind_columns(_mapped(spark, d), TARGETS).select("offset", F.col("error.code").alias("code"))


@query(
    "table_dispatch",
    MAPPED_SQL + """SELECT schema_name || '.' || table_name AS target, CAST(count(*) AS BIGINT) AS n FROM mapped
WHERE (schema_name, table_name) IN (('T','ALLMACH'), ('TS','BUILDING')) GROUP BY 1""",
)
def table_dispatch(spark, d):
    parts = route.split_by_table(_mapped(spark, d), TARGETS)
    counts = [df.groupBy(F.lit(name).alias("target")).agg(F.count(F.lit(1)).alias("n")) for name, df in parts.items()]
    return counts[0].unionByName(counts[1])


TYPED = TableSpec(
    "S", "USERS",
    (
        ColumnSpec("c1", "SIGNED BIGINT", 8, "", 134, False), ColumnSpec("c2", "VARCHAR", 6, "", 64),
        ColumnSpec("c3", "SIGNED SMALLINT", 2, "", 130), ColumnSpec("c4", "VARCHAR", 4, "", 64, False),
    ),
    ("c1",),
)
TYPED_SQL = "WITH " + logs.EVENTS_LOG_SQL + """,
t AS (SELECT *, CASE WHEN op = 'D' THEN NULL
  WHEN has_c2 AND length(c2) > 6 THEN 'too_long' WHEN has_c3 AND TRY_CAST(c3 AS SMALLINT) IS NULL THEN 'bad_value'
  WHEN (has_c4 AND c4 IS NULL) OR (op = 'I' AND NOT has_c4) THEN 'null_value' END AS code FROM log)
"""


@query("cast_typed", TYPED_SQL + 'SELECT seq AS "offset", op, code FROM t')
def cast_typed_query(spark, d):
    return cast_typed(logs.user_events(spark, d), TYPED).select("offset", "op", F.col("error.code").alias("code"))


@query(
    "bind_changes",
    TYPED_SQL + """SELECT seq AS "offset", op, c1, has_c2 AND op <> 'D' AS has_c2, CASE WHEN has_c2 AND op <> 'D' THEN c2 END AS c2,
  CASE WHEN has_c3 AND op <> 'D' THEN CAST(TRY_CAST(c3 AS SMALLINT) AS INT) END AS c3 FROM t WHERE code IS NULL""",
)
def bind_changes_query(spark, d):
    good, _ = bind_changes(logs.user_events(spark, d), TYPED)
    return good.select(
        F.col("seq.offset").alias("offset"), "op", F.col("d_c1").alias("c1"), F.col("c_c2").isNotNull().alias("has_c2"),
        F.col("c_c2.cur").alias("c2"), F.col("c_c3.cur").cast("int").alias("c3"))


@query(
    "project_rows",
    "WITH " + logs.EVENTS_LOG_SQL + """SELECT c1, CASE WHEN has_c2 THEN c2 END AS c2, CASE WHEN has_c3 THEN c3 END AS c3,
  CASE WHEN has_c4 THEN c4 END AS c4 FROM log WHERE op <> 'D'""",
)
def project_rows(spark, d):
    return to_row(logs.user_events(spark, d).filter(F.col("op") != "D"), logs.USERS)


@query(
    "detect_key_change",
    """SELECT o_orderkey, o_orderkey % 3 <> 0 AND o_orderstatus <> o_orderpriority AS moved FROM orders""",
)
def detect_key_change(spark, d):
    o = logs.table(spark, d, "orders")
    yes = F.lit(True)
    cols = F.create_map(
        F.lit("k1"), cell(F.col("o_orderstatus"), F.col("o_orderpriority"), yes, F.col("o_orderkey") % 3 != 0),
        F.lit("k2"), cell(F.lit("a"), F.lit("a"), yes, yes), F.lit("v"), cell(F.lit("a"), F.lit("b"), yes, yes))
    return o.select("o_orderkey", route.detect_key_change(cols, F.array(F.lit("k1"), F.lit("k2"))).alias("moved"))


@query("decode_registered", PART_SQL)
def decode_registered(spark, d):
    """A user-defined format by name: pipes instead of commas."""
    register_decoder("pipes", lambda df, job, cat: decode_delimited(df, cat["S.PART"], "|", job.encoding))
    return to_row(decode(_part_lines(spark, d, "|"), JobConfig(format="pipes"), Catalog([PART])), PART)


@query(
    "error_rows",
    """SELECT c_custkey AS "offset", CASE WHEN c_mktsegment = 'BUILDING' THEN 'unknown_op' ELSE 'bad_json' END AS code,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'unknown_op merge' ELSE 'bad_json -' END || ' @' || c_custkey || ' target=' ||
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'D/C' ELSE '?/?' END || ' op=? text=' ||
  CASE WHEN c_mktsegment = 'BUILDING' THEN '{"database":"D","table":"C","type":"merge"}' ELSE c_name END AS message
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
)
def error_rows(spark, d):
    """Undecodable messages as data, with their context."""
    c = logs.table(spark, d, "customer")
    seg = F.col("c_mktsegment")
    text = (
        F.when(seg == "BUILDING", '{"database":"D","table":"C","type":"merge"}').when(seg == "MACHINERY", F.col("c_name"))
        .otherwise('{"database":"D","table":"C","type":"insert","data":{"ID":1}}'))
    events = decode_json_image(_envelope(c, "c_custkey", F.encode(text, "UTF-8")))
    _, bad = route.split_errors(events, "skip")
    return bad.select("offset", F.col("error.code").alias("code"), route.error_text().alias("message"))
