"""Message-level golden cases: wire messages in, table rows out."""

import pytest
from pyspark.sql import functions as F

from changeflow.config import JobConfig, Mapping, Topic
from changeflow.model import Catalog, ColumnSpec, TableSpec
from changeflow.operators.route import split_errors
from changeflow.plans.batch import decode_and_route, run_batch
from changeflow.sources.decode_fixed import decode_fixed

A, B, C, D = "\x01", "\x02", "\x03", "\x04"
ONEKEY = TableSpec.of("S", "T", {"c1": "SIGNED INTEGER", "c2": "VARCHAR", "c3": "VARCHAR"}, ["c1"])
NOPK = TableSpec.of("S", "T", {"c1": "SIGNED INTEGER", "c2": "VARCHAR", "c3": "VARCHAR"})
MULTI = TableSpec.of(
    "S", "T", {"c1": "SIGNED INTEGER", "c2": "VARCHAR", "c3": "VARCHAR", "c4": "SIGNED INTEGER"}, ["c2", "c1"]
)


def ctrl(op, *cols, table="S.T"):
    """``cols``: (position, current, old); None is NULL, Ellipsis is 'no data'."""

    def val(v):
        return C if v is None else D if v is ... else f"{B}{v}"

    head = B.join(["P1", "100", "7", "9,1", "1", "8", "5"])
    return A.join([head, table, op, "2018-04-02 07:59:54.085639"] + [f"{i}{val(c)}{val(o)}" for i, c, o in cols])


def envelope(spark, messages, topic="t"):
    rows = []
    for i, m in enumerate(messages):
        t, m = m if isinstance(m, tuple) else (topic, m)
        rows.append((t, 0, i, m.encode() if isinstance(m, str) else m))
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, value binary").withColumn(
        "timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp")
    )


def run(spark, messages, spec, seed, job=None, split=None):
    job = job or JobConfig(format="ctrl", def_schema="S")
    catalog = Catalog([spec])
    table = spark.createDataFrame(seed, spec.row_schema())
    parts = [messages] if split is None else [messages[i : i + split] for i in range(0, len(messages), split)]
    batch = None
    for part in parts:
        batch = run_batch(envelope(spark, part), job, catalog, {spec.full_name: table})[spec.full_name]
        table = spark.createDataFrame(batch.table.collect(), spec.row_schema())
    return sorted((tuple(r) for r in table.collect()), key=repr), batch


def ins(*values):
    return ctrl("I", *[(i, v, ...) for i, v in enumerate(values)])


MIX_SEED = [(5, "delete", "delete"), (6, "update", "update"), (7, "insert", "insert"), (8, "updkey", "updkey")]
MIX = [
    ins(1, "aaa", "((("),
    ins(2, "bbb", ")))"),
    ins(3, "ccc", "???"),
    ins(3, "ddd", "+++"),
    ins(4, "eee", "---"),
    ctrl("D", (0, ..., 2), (1, ..., "bbb"), (2, ..., ")))")),
    ctrl("U", (0, 4, 4), (1, "uuu1", "eee")),
    ctrl("U", (0, 4, 4), (2, "uuu2", "---")),
    ins(7, "insert1", "insert2"),
    ctrl("D", (0, ..., 5), (1, ..., "delete"), (2, ..., "delete")),
    ctrl("U", (0, 6, 6), (2, "uuu1", "update")),
    ctrl("K", (0, 10, 8), (2, "kkk1", "updkey")),
    ctrl("K", (0, 9, 10), (1, "kkk2", "updkey")),
    ctrl("U", (0, 6, 6), (1, "uuu2", "update")),
]


@pytest.mark.parametrize("split", [None, 3])
def test_one_key_mix(spark, split):
    rows, _ = run(spark, MIX, ONEKEY, MIX_SEED, split=split)
    assert rows == [
        (1, "aaa", "((("), (3, "ddd", "+++"), (4, "uuu1", "uuu2"),
        (6, "uuu2", "uuu1"), (7, "insert1", "insert2"), (9, "kkk2", "kkk1"),
    ]


def test_composite_key_in_other_order(spark):
    seed = [(1, "aaa", "delete", 111), (2, "bbb", "update", 222), (3, "ccc", "insert", 333), (4, "ddd", "updkey", 444)]
    log = [
        ctrl("D", (0, ..., 1), (1, ..., "aaa")),
        ctrl("U", (0, 2, 2), (1, "bbb", "bbb"), (2, "update1", "update"), (3, 2222, 222)),
        ctrl("I", (0, 3, ...), (1, "ccc", ...), (2, "(((", ...)),
        ctrl("K", (0, 5, 4), (1, "eee", "ddd"), (2, "updkey1", "updkey")),
    ]
    rows, _ = run(spark, log, MULTI, seed)
    assert rows == [(2, "bbb", "update1", 2222), (3, "ccc", "(((", None), (5, "eee", "updkey1", 444)]


NOPK_TAIL = [
    ctrl("K", (0, 10, 8), (1, "updkey", "updkey"), (2, "kkk1", "updkey")),
    ctrl("K", (0, 9, 10), (1, "kkk2", "updkey"), (2, "kkk1", "kkk1")),
]
NOPK_WANT = [
    (1, "aaa", "((("), (3, "ccc", "???"), (3, "ddd", "+++"), (4, "uuu1", "uuu2"), (6, "uuu2", "uuu1"),
    (7, "insert", "insert"), (7, "insert1", "insert2"), (9, "kkk2", "kkk1"),
]


@pytest.mark.parametrize("split", [None, 5])
def test_without_primary_key(spark, split):
    log = MIX[:11] + NOPK_TAIL + MIX[13:]
    rows, _ = run(spark, log, NOPK, MIX_SEED, split=split)
    assert rows == NOPK_WANT


def test_without_primary_key_null_delete_matches_nothing(spark):
    log = MIX[:11] + NOPK_TAIL + MIX[13:]
    log[1] = ins(2, "bbb", None)
    log[5] = ctrl("D", (0, ..., 2), (1, ..., "bbb"), (2, ..., None))
    rows, _ = run(spark, log, NOPK, MIX_SEED)
    assert rows == sorted(NOPK_WANT + [(2, "bbb", None)], key=repr)


@pytest.mark.parametrize("first", [ins(1, "a", "b"), ctrl("U", (0, 1, 1), (1, "x", "a"))])
def test_collapse_to_empty(spark, first):
    log = [first, ctrl("K", (0, 2, 1), (1, "k", "a")), ctrl("D", (0, ..., 2))]
    rows, _ = run(spark, log, ONEKEY, [(1, "a", "b")])
    assert rows == []


def test_deletes_and_null_key(spark):
    log = [ctrl("D", (0, ..., 5)), ctrl("D", (0, ..., None)), ctrl("D", (0, ..., 5))]
    rows, batch = run(spark, log, ONEKEY, [(5, "x", "y")])
    assert rows == []
    assert [r["error"]["code"] for r in batch.rejects.collect()] == ["null_key"]


def test_key_reuse(spark):
    seed = [(i, f"I{i}", "+++") for i in range(1, 6)]
    log = [
        ctrl("U", (0, 5, 5), (1, "u5", "I5")),
        ctrl("K", (0, 14, 4), (1, "k4", "I4")),
        ctrl("U", (0, 3, 3), (1, "u3", "I3")),
        ctrl("K", (0, 4, 2), (1, "k2", "I2")),
        ctrl("K", (0, 6, 1), (1, "k1", "I1")),
    ]
    rows, _ = run(spark, log, ONEKEY, seed)
    assert rows == sorted([(i, v, "+++") for i, v in [(3, "u3"), (4, "k2"), (5, "u5"), (6, "k1"), (14, "k4")]], key=repr)


def test_routing_by_topic_schema_and_mapping(spark):
    def table(schema):
        return TableSpec.of(schema, "T1", {"c1": "SIGNED INTEGER", "c2": "VARCHAR", "c3": "VARCHAR"}, ["c1"])

    catalog = Catalog([table("S1"), table("S2"), table("S3")])
    job = JobConfig(
        format="ctrl",
        topics=[Topic("one", "S1"), Topic("two", "S2")],
        mappings=[Mapping("S3", "T1", src_schema="S1", src_table="T1")],
    )
    log = []
    for topic, base in (("one", 0), ("two", 10)):
        for i in range(1, 7):
            cols = [(0, base + i, ...), (1, "ddd", ...), (2, "+++", ...)]
            log.append((topic, ctrl("I", *cols, table="S3.T1" if i < 3 else "T1")))
    empty = {s.full_name: spark.createDataFrame([], s.row_schema()) for s in catalog}
    out = run_batch(envelope(spark, log), job, catalog, empty)
    got = {name: sorted(r["c1"] for r in b.table.collect()) for name, b in out.items()}
    assert got == {"S1.T1": [], "S2.T1": [13, 14, 15, 16], "S3.T1": [1, 2, 3, 4, 5, 6, 11, 12]}


def test_many_tables_into_one(spark):
    job = JobConfig(
        format="ctrl",
        mappings=[Mapping("S", "T", "A", "X"), Mapping("S", "T", "B", "Y")],
    )
    log = [ctrl("I", (0, i, ...), (1, "v", ...), table="A.X" if i < 3 else "B.Y") for i in range(1, 5)]
    rows, _ = run(spark, log, ONEKEY, [], job)
    assert [r[0] for r in rows] == [1, 2, 3, 4]


@pytest.mark.parametrize("delim", [",", "\t", " ", "|", "^"])
def test_delimited(spark, delim):
    spec = TableSpec.of(
        "S", "T",
        {"ser": "SIGNED NUMERIC", "name": "VARCHAR", "age": "SIGNED INTEGER", "type": "VARCHAR", "yer": "SIGNED INTEGER"},
        ["ser"],
    )
    job = JobConfig(format="", def_schema="S", def_table="T", delimiter=delim)
    lines = [delim.join(["2", '"LC1"', "29", "BC", "2013"]), delim.join(["3", "'LC2'", "30", "", ""])]
    rows, _ = run(spark, lines, spec, [], job)
    assert [(int(r[0]), *r[1:]) for r in rows] == [(2, "LC1", 29, "BC", 2013), (3, "LC2", 30, None, None)]


INT_WIDTHS = [("DataID", 4, 132), ("Type", 1, 137), ("DataTime", 4, 132), ("SysID", 1, 137), ("version", 1, 137), ("SaveTime", 4, 132)]


def fixed_spec(last):
    cols = [ColumnSpec(n, "SIGNED INTEGER", w, "", code) for n, w, code in INT_WIDTHS]
    return TableSpec("S", "T", (*cols, last))


BYTES = bytes([0, 1, 2, 3, 0x9B, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14])


def decoded(spark, spec, big_endian):
    df = decode_fixed(envelope(spark, [BYTES + b"a" * n for n in (2, 5, 6)]), spec, big_endian)
    return [
        (r["error"]["code"] if r["error"] else None, *[r["cols"][c].cur if r["cols"] else None for c in spec.column_names])
        for r in df.orderBy("offset").collect()
    ]


def test_fixed_integers_little_endian(spark):
    rows = decoded(spark, fixed_spec(ColumnSpec("Value", "SIGNED SMALLINT", 2, "", 130)), False)
    assert rows[0] == (None, "50462976", "155", "134678021", "9", "10", "235736075", "24929")
    assert [r[0] for r in rows[1:]] == ["bad_length", "bad_length"]


def test_fixed_characters_big_endian(spark):
    rows = decoded(spark, fixed_spec(ColumnSpec("Value", "VARCHAR", 5, "", 64)), True)
    want = ("66051", "155", "84281096", "9", "10", "185339150")
    assert rows == [(None, *want, "aa"), (None, *want, "aaaaa"), (None, *want, "aaaaa")]


def test_json_images_with_consecutive_key_changes(spark):
    spec = TableSpec.of(
        "S", "ACC", {"UPDATE_TIME": "TIMESTAMP", "BALANCE": "VARCHAR", "FUND_TYPE": "VARCHAR", "REMARK": "VARCHAR"},
        ["UPDATE_TIME"],
    )
    head = '{"database":"S","table":"ACC","type":"update","ts":1,"xid":2,"xoffset":1,"position":"b:1",'
    log = [
        head + '"data":{"BALANCE":0.0000,"FUND_TYPE":"CR","REMARK":null,"UPDATE_TIME":"2018-08-02 16:20:23"},"old":{"UPDATE_TIME":"2018-08-02 16:19:10"}}',
        head + '"data":{"BALANCE":0.0000,"FUND_TYPE":"FR","REMARK":null,"UPDATE_TIME":"2018-08-02 16:20:39"},"old":{"UPDATE_TIME":"2018-08-02 16:20:23","FUND_TYPE":"CR"}}',
    ]
    from datetime import datetime

    seed = [(datetime(2018, 8, 2, 16, 19, 10), "1", "CR", "x")]
    for json_null, remark in (("text", "null"), ("null", None)):
        rows, _ = run(spark, log, spec, seed, JobConfig(format="json", json_null=json_null))
        assert rows == [(datetime(2018, 8, 2, 16, 20, 39), "0.0", "FR", remark)]


def test_json_array(spark):
    spec = TableSpec.of("S", "T", {"ID": "SIGNED INTEGER", "A": "VARCHAR", "B": "VARCHAR"}, ["ID"])
    job = JobConfig(format="json_array", def_schema="S")
    log = [
        '[{"table_name":"t","operate":"insert","column":[{"A":"x"},{"B":"y"}],"key_column":[{"ID":"1"}]},'
        '{"table_name":"t","operate":"insert","column":[{"A":"p","B":"q"}],"key_column":[{"ID":"2"}]},'
        '{"table_name":"t","operate":"update","column":[{"A":"x"},{"A":"z"}],"key_column":[{"ID":"1"},{"ID":"1"}]}]',
        '[{"table_name":"t","operate":"update","column":[],"key_column":[{"ID":"1"},{"ID":"7"}]},'
        '{"table_name":"t","operate":"delete","column":[{"A":"p"}],"key_column":[{"ID":"2"}]}]',
    ]
    rows, _ = run(spark, log, spec, [], job)
    assert rows == [(7, "z", "y")]


def test_bad_rows_are_kept_apart_or_stop_the_job(spark):
    log = [ins(1, "a", "b"), "rubbish", ctrl("I", (0, 2, ...), (9, "x", ...)), ctrl("Z", (0, 1, ...))]
    catalog = Catalog([ONEKEY])
    routed = decode_and_route(envelope(spark, log), JobConfig(format="ctrl", def_schema="S"), catalog)
    good, bad = split_errors(routed, "skip")
    assert good.count() == 1
    assert sorted(r["error"]["code"] for r in bad.collect()) == ["short_message", "unknown_column", "unknown_op"]
    with pytest.raises(Exception, match="short_message|unknown"):
        split_errors(routed, "fail")[0].select("error").collect()
