"""Decoder for protobuf change records.

The wire format is read in Arrow batches (one pass, bytes to fields); everything after that - null rules,
zero dates, operation codes, column binding, soft deletes - is built-in column functions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from changeflow import fixed_values as fv
from changeflow.functions.text import decode_with_fallback, normalise_op, null_rule
from changeflow.model import CHANGE_EVENT_COLUMNS, Catalog
from changeflow.operators.route import resolve_names
from changeflow.session import BROADCAST_ROWS
from changeflow.sources.decode_common import cell, change_event, error, no_cols, txn

_ENTRY = (
    "struct<is_key:boolean,index:int,name:string,old_null:boolean,new_null:boolean,"
    "old_size:int,new_size:int,old_text:string,new_text:string>"
)
_DECODED = (
    "source_type int, operation_type int, csn string, xid string, trail_seq bigint, trans_flag int, "
    f"operation_time string, full_name string, n_columns int, entries array<{_ENTRY}>, failure string, "
    "extract int, begin_seq bigint, begin_rba int, rba int, trans_seq int"
)


def _varint(buf: bytes, pos: int) -> tuple[int, int]:
    value = buf[pos]
    if value < 0x80:
        return value, pos + 1
    value = shift = 0
    while True:
        byte = buf[pos]
        value |= (byte & 0x7F) << shift
        pos += 1
        if byte < 0x80:
            return value, pos
        shift += 7


_DEFAULTS = {"string": "", "bytes": b"", "bool": False, "int32": 0, "uint32": 0}


def read_message(buf: bytes, layout=fv.PROTO_RECORD) -> SimpleNamespace:
    """Fields of one protobuf message as attributes; nested ``Column`` messages become lists."""
    fields = {number: (name, kind) for name, number, kind in layout}
    out = {name: [] if kind == "Column" else _DEFAULTS[kind] for name, _, kind in layout}
    pos = 0
    while pos < len(buf):
        tag, pos = _varint(buf, pos)
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            value, pos = _varint(buf, pos)
        elif wire == 2:
            size, pos = _varint(buf, pos)
            value = buf[pos : pos + size]
            pos += size
            if pos > len(buf):
                raise ValueError("message is cut short")
        elif wire in (1, 5):
            value, pos = None, pos + (8 if wire == 1 else 4)
        else:
            raise ValueError(f"wire type {wire}")
        if number not in fields:
            continue
        name, kind = fields[number]
        if kind == "Column":
            out[name].append(read_message(value, fv.PROTO_COLUMN))
        elif kind == "string":
            out[name] = value.decode("utf-8")
        elif kind == "bool":
            out[name] = value != 0
        elif kind == "int32":
            value &= 0xFFFFFFFF
            out[name] = value - (1 << 32) if value >> 31 else value
        else:
            out[name] = value
    return SimpleNamespace(**out)


def record_parser() -> Callable[[bytes], object]:
    """The protobuf runtime where the executors have it, else ``read_message``."""
    try:
        from google.protobuf import descriptor_pb2, descriptor_pool, message, message_factory
    except ImportError:
        return read_message
    file = descriptor_pb2.FileDescriptorProto(name="changeflow_record.proto", package="changeflow", syntax="proto3")
    for title, layout in (("Column", fv.PROTO_COLUMN), ("Record", fv.PROTO_RECORD)):
        declared = file.message_type.add(name=title)
        for name, number, kind in layout:
            field = declared.field.add(name=name, number=number, label=3 if kind == "Column" else 1)
            if kind == "Column":
                field.type, field.type_name = field.TYPE_MESSAGE, ".changeflow.Column"
            else:
                field.type = getattr(field, f"TYPE_{kind.upper()}")
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    record = message_factory.GetMessageClass(pool.FindMessageTypeByName("changeflow.Record"))

    def parse(raw: bytes):
        try:
            return record.FromString(raw)
        except message.DecodeError as e:
            raise ValueError(str(e)) from e

    return parse


def _entry(column, is_key: bool, encoding: str) -> tuple:
    old, new = column.old_value, column.new_value
    old_text, new_text = decode_with_fallback(old, encoding), decode_with_fallback(new, encoding)
    if old_text is None or new_text is None:
        raise UnicodeError(f"column {column.name or column.index} is not {encoding}")
    return (
        is_key, column.index, column.name, column.old_null, column.new_null, len(old), len(new), old_text, new_text
    )


def decode_record(raw: bytes, encoding: str, parse: Callable[[bytes], object]) -> tuple:
    """One record as a row of ``_DECODED``; what is wrong with it goes to ``failure``."""
    failed, unknown = (None,) * 10, (None,) * 5
    try:
        rec = parse(raw)
        # without a setting, source 1 writes GBK and source 2 UTF-8
        codec = encoding if encoding.upper() not in ("UTF8", "UTF-8") else ("GBK" if rec.source_type == 1 else "utf-8")
        entries = [_entry(c, True, codec) for c in rec.key_column] + [_entry(c, False, codec) for c in rec.column]
        return (
            rec.source_type, rec.operation_type, rec.csn, rec.xid, rec.trail_seq, rec.trans_flag,
            rec.operation_time, rec.table_name, len(rec.column), entries, None,
            rec.extract, rec.begin_trans_trail_seq, rec.begin_trans_trail_rba, rec.trail_rba, rec.trans_seq,
        )
    except UnicodeError:
        return (*failed, "bad_charset", *unknown)
    except (ValueError, IndexError, AttributeError, TypeError):
        return (*failed, "bad_record", *unknown)


def _entries_array(lists, entry_type: pa.StructType) -> pa.ListArray:
    """Entry tuples of a batch as a list array, one Arrow column per entry field."""
    offsets, flat = [0], []
    for entries in lists:
        flat.extend(entries or ())
        offsets.append(len(flat))
    columns = zip(*flat) if flat else [()] * len(entry_type)
    fields = [pa.array(values, f.type) for values, f in zip(columns, entry_type)]
    structs = pa.StructArray.from_arrays(fields, fields=list(entry_type))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)


def decode_proto(
    df: DataFrame,
    catalog: Catalog,
    def_schema: str | None = None,
    encoding: str = fv.DEFAULT_ENCODING,
    ignore_soft_deletes: bool = False,
) -> DataFrame:
    """Protobuf change records to change events, columns already bound to catalog names."""
    spark = df.sparkSession
    envelope = [c for c in ("topic", "partition", "offset", "timestamp", "topic_schema") if c in df.columns]
    source = df.select(*envelope, F.col("value").cast("binary").alias("value"))
    schema = source.schema
    decoded_type = spark.createDataFrame([], _DECODED).schema
    out_schema = type(schema)(list(schema.fields) + list(decoded_type.fields))
    arrow_decoded = to_arrow_schema(decoded_type)

    entry_type = arrow_decoded.field("entries").type.value_type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parse = record_parser()
        for batch in batches:
            rows = [decode_record(v, encoding, parse) for v in batch.column("value").to_pylist()]
            arrays = list(batch.columns)
            for field, values in zip(arrow_decoded, zip(*rows) if rows else [()] * len(arrow_decoded)):
                if field.name == "entries":
                    arrays.append(_entries_array(values, entry_type))
                else:
                    arrays.append(pa.array(values, field.type))
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names + arrow_decoded.names)

    records = source.mapInArrow(run, out_schema)
    events = change_event(
        records,
        src_schema=F.lit(None),
        src_table=F.col("full_name"),
        op=F.lit(None),
        cols=no_cols(),
        raw=F.base64("value"),
        error=error(F.col("failure")),
        txn=txn(
            xid=F.col("xid"), csn=F.col("csn"), seq=F.col("trail_seq"),
            flag=F.col("trans_flag"), op_time=F.col("operation_time"),
            process=F.col("extract"), begin_seq=F.col("begin_seq"), begin_rba=F.col("begin_rba"), rba=F.col("rba"),
            trans_seq=F.col("trans_seq"),
        ),
        extra=[
            F.col(c)
            for c in ["source_type", "operation_type", "entries", "n_columns"]
            + (["topic_schema"] if "topic_schema" in df.columns else [])
        ],
    )
    tables = catalog.to_df(spark)
    tables = F.broadcast(tables) if len(catalog.specs) <= BROADCAST_ROWS else tables
    events = resolve_names(events, def_schema).join(tables, ["schema_name", "table_name"], "left")
    events = _bind_entries(events)
    if ignore_soft_deletes:
        events = drop_soft_deletes(events)
    drop = ["source_type", "operation_type", "entries", "n_columns", "columns", "empties", "key_columns", "has_pk"]
    return events.drop(*drop).select(*CHANGE_EVENT_COLUMNS)


def _bind_entries(events: DataFrame) -> DataFrame:
    """Column names, null rules and the operation, from the catalog row of the event's table."""
    by_index = F.col("source_type") == 1

    # each step looks things up once per entry and hands them on
    positioned = F.transform(
        "entries",
        lambda e: F.struct(
            e.alias("e"),
            F.when(by_index, e["index"] + 1)
            .otherwise(F.array_position("columns", e["name"]).cast("int"))
            .alias("p"),
        ),
    )
    described = F.transform(
        F.filter(positioned, lambda x: F.coalesce(x["p"] > 0, F.lit(False))),
        lambda x: F.struct(
            x["e"].alias("e"),
            F.try_element_at("columns", x["p"]).alias("name"),
            F.try_element_at("empties", x["p"]).alias("empty"),
        ),
    )

    def value(x, side):
        e = x["e"]
        return null_rule(
            F.col("source_type"), e[f"{side}_null"], e[f"{side}_size"], e[f"{side}_text"], x["empty"]
        )

    valued = F.transform(
        F.filter(described, lambda x: x["name"].isNotNull()),
        lambda x: F.struct(
            x["name"].alias("name"),
            (by_index & x["e"]["is_key"] & x["e"]["old_null"]).alias("keeps"),
            value(x, "new").alias("new"),
            value(x, "old").alias("old"),
        ),
    )

    # only deletes lack a current image, only inserts an old one
    def entry(x):
        # a key column whose old value is null keeps its value (source 1)
        old = F.when(x["keeps"], x["new"]).otherwise(x["old"])
        return F.struct(
            x["name"].alias("key"),
            cell(x["new"], old, F.col("op") != "D", F.col("op") != "I").alias("value"),
        )

    is_key_update = (F.col("operation_type") == 1) & F.exists(
        "entries", lambda e: e["is_key"] & (e["new_text"] != e["old_text"])
    )
    op = F.when(is_key_update, "K").otherwise(normalise_op(F.col("operation_type")))
    known_table = F.col("columns").isNotNull()
    code = (
        F.when(~F.col("source_type").isin(1, 2), "unknown_source")
        .when(op.isNull(), "unknown_op")
        .when(known_table & (F.col("source_type") != 1) & (F.col("n_columns") != F.size("columns")), "column_count")
        .when(known_table & (F.size("_v") < F.size("entries")), "unknown_column")
    )
    return (
        events.withColumn("op", op)
        .withColumn("_v", valued)
        .withColumn("error", F.coalesce("error", error(code, F.col("operation_type").cast("string"))))
        .withColumn(
            "cols",
            F.when(F.col("error").isNull() & known_table, F.map_from_entries(F.transform("_v", entry)))
            .otherwise(F.col("cols")),
        )
        .drop("_v")
    )


def soft_delete_rule(operation_type, source_type, cols):
    """Changes that only mark a row as deleted, and the deletes of rows so marked."""
    tag = F.try_element_at(cols, F.lit(fv.SOFT_DELETE_COLUMN))
    cur, old = tag["cur"], tag["old"]
    marked_delete = (operation_type == 2) & old.isin("2", "3")
    changed = F.size(
        F.map_filter(cols, lambda k, v: v["cur"].isNotNull() & ~v["cur"].eqNullSafe(v["old"]))
    )
    # changed columns are only counted for source 2
    only_tag = (operation_type == 1) & (source_type == 2) & (changed == 1) & (
        ((cur == "2") & old.isNull()) | ((cur == "3") & (old == "1"))
    )
    return F.coalesce(marked_delete, F.lit(False)) | F.coalesce(only_tag, F.lit(False))


def drop_soft_deletes(events: DataFrame) -> DataFrame:
    """Leave out soft-delete traffic. Key changes (code 115 or detected) always stay."""
    rule = soft_delete_rule(F.col("operation_type"), F.col("source_type"), F.col("cols"))
    return events.filter((F.col("op") == "K").eqNullSafe(True) | ~rule)
