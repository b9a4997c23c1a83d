"""Protobuf records built field by field, decoded to change events."""

import pytest

from changeflow.model import Catalog, TableSpec
from changeflow.operators.route import split_errors
from changeflow.sources.decode_proto import decode_proto, decode_record, read_message, record_parser
from test_golden import envelope

SPEC = TableSpec.of(
    "S", "T", {"ID": "SIGNED INTEGER", "NAME": "VARCHAR", "WHEN": "TIMESTAMP", "DELETE_TAG": "VARCHAR"}, ["ID"]
)


def varint(n):
    out = b""
    while True:
        out += bytes([n & 0x7F | (0x80 if n > 0x7F else 0)])
        n >>= 7
        if not n:
            return out


def num(field, n):
    return varint(field << 3) + varint(n)


def data(field, b):
    b = b.encode() if isinstance(b, str) else b
    return varint(field << 3 | 2) + varint(len(b)) + b


def column(field, index, name, old, new, old_null=False, new_null=False):
    body = num(1, index) + data(2, name) + num(5, int(old_null)) + num(6, int(new_null)) + data(7, old) + data(8, new)
    return data(field, body)


def record(source, op, *columns, table="S.T"):
    return num(4, source) + data(6, "x1") + num(13, op) + data(15, table) + b"".join(columns)


def full(source, op, ident=("1", "1"), name=("a", "b"), when=("", ""), tag=("1", "1"), enc="utf-8", **kw):
    names = ("ID", "NAME", "WHEN", "DELETE_TAG")
    parts = [column(16, 0, "ID", *ident)]
    for i, (n, v) in enumerate(zip(names, (ident, name, when, tag))):
        parts.append(column(17, i, n, *[x.encode(enc) for x in v], old_null=kw.get(f"{n}_old_null", False)))
    return record(source, op, *parts)


def decode(spark, messages, **kw):
    return decode_proto(envelope(spark, messages), Catalog([SPEC]), **kw).orderBy("offset").collect()


def test_operations_and_key_changes(spark):
    rows = decode(spark, [full(2, c) for c in (0, 5, 1, 15, 2, 3, 115, 10)] + [full(2, 1, ident=("1", "2"))])
    assert [r["op"] for r in rows] == ["I", "I", "U", "U", "D", "D", "K", None, "K"]
    assert rows[7]["error"]["code"] == "unknown_op"
    assert rows[0]["txn"]["xid"] == "x1"


def test_both_readers_agree():
    messages = [
        full(2, c, ident=("1", "22"), name=("a" * 200, "中"), NAME_old_null=True) for c in (0, 1, 115, 300)
    ] + [record(1, 2), b"\xff\xff", data(15, "S.T")[:-1], num(4, 2) + data(5, b"\xff"), num(4, -1 & (1 << 64) - 1)]
    runtime = record_parser()
    for m in messages:
        assert decode_record(m, "UTF8", read_message)[:10] == decode_record(m, "UTF8", runtime)[:10]
        assert bool(decode_record(m, "UTF8", read_message)[10]) == bool(decode_record(m, "UTF8", runtime)[10])


def test_null_and_empty_values(spark):
    rows = decode(
        spark,
        [
            record(1, 1, column(16, 0, "", "", "7", old_null=True), column(17, 1, "", "", "", new_null=True),
                   column(17, 2, "", "", "", new_null=True), column(17, 3, "", "x", "y", new_null=True)),
            full(2, 1, name=("", ""), when=("0000-00-00", "0000-00-00 00:00:00")),
        ],
    )
    first, second = (r["cols"] for r in rows)
    # source 1: a null old key takes the new value; null without bytes is empty; null with bytes is NULL
    assert (first["ID"].old, first["ID"].cur) == ("7", "7")
    assert (first["NAME"].cur, first["WHEN"].cur, first["DELETE_TAG"].cur) == ("", None, None)
    assert (second["NAME"].cur, second["WHEN"].old, second["WHEN"].cur) == ("", "0001-01-01", "0001-01-01 00:00:00")


def test_character_sets(spark):
    rows = decode(spark, [full(1, 0, name=("中", "国"), enc="gbk"), full(2, 0, name=("中", "国")), full(2, 0, name=("中", "国"), enc="gbk")])
    assert [r["cols"]["NAME"].cur if r["cols"] else None for r in rows] == ["国", "国", None]
    assert rows[2]["error"]["code"] == "bad_charset"


def test_bad_records(spark):
    messages = [
        b"\xff\xff", data(15, "S.T")[:-1], record(2, 0, column(17, 0, "ID", "", "1")), full(3, 0),
        record(2, 0, *[column(17, i, n, "", "1") for i, n in enumerate(("ID", "NAME", "WHEN", "NOPE"))]),
        record(2, 0, table="S.OTHER"),
    ]
    rows = decode(spark, messages)
    assert [r["error"]["code"] if r["error"] else None for r in rows] == [
        "bad_record", "bad_record", "column_count", "unknown_source", "unknown_column", None]


def test_soft_deletes(spark):
    messages = [
        full(2, 2, tag=("2", "")), full(2, 2, tag=("3", "")), full(2, 2, tag=("1", "")),
        full(2, 1, name=("a", "a"), tag=("1", "3")), full(2, 1, name=("a", "b"), tag=("1", "3")),
        full(2, 1, name=("a", "a"), tag=("", "2"), DELETE_TAG_old_null=True), full(2, 15, name=("a", "a"), tag=("1", "3")),
    ]
    kept = [r["offset"] for r in decode(spark, messages, ignore_soft_deletes=True)]
    assert kept == [2, 4, 6]
    assert len(decode(spark, messages)) == 7


def test_skip_or_fail(spark):
    events = decode_proto(envelope(spark, [full(2, 0), b"\xff"]), Catalog([SPEC]))
    good, bad = split_errors(events, "skip")
    assert (good.count(), bad.count()) == (1, 1)
    with pytest.raises(Exception, match="bad_record"):
        split_errors(events, "fail")[0].select("error").collect()
