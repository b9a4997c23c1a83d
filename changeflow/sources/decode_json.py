"""Decoders for the two JSON formats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow import fixed_values as fv
from changeflow.functions.text import normalise_op, normalise_text, strip_quotes
from changeflow.sources.decode_common import cell, change_event, error, txn

IMAGE_SCHEMA = (
    "database string, `table` string, type string, ts string, xid string, xoffset string, `commit` string, "
    "position string, data map<string,string>, old map<string,string>"
)
ARRAY_SCHEMA = (
    "array<struct<table_name:string,operate:string,"
    "`column`:array<map<string,string>>,key_column:array<map<string,string>>>>"
)


def _text_nulls(value, json_null: str):
    """JSON null is SQL NULL, or the text ``null`` where a target expects it so."""
    return F.coalesce(value, F.lit("null")) if json_null == "text" else value


def decode_json_image(df: DataFrame, json_null: str = "null", encoding: str = fv.DEFAULT_ENCODING) -> DataFrame:
    """One JSON object per message with the row image ``data`` and the changed columns' ``old`` values."""
    staged = df.withColumn("_text", normalise_text(F.col("value"), encoding)).withColumn(
        "_j", F.from_json("_text", IMAGE_SCHEMA)
    )

    def wrapped(field: str):
        """Values as structs: a missing key gives a null struct, a JSON null a struct with a null."""
        image = F.coalesce(F.col(f"_j.{field}"), F.create_map().cast("map<string,string>"))
        return F.transform_values(image, lambda k, v: F.struct(_text_nulls(v, json_null).alias("v")))

    cols = F.map_zip_with(
        wrapped("data"),
        wrapped("old"),
        lambda k, cur, old: cell(cur["v"], old["v"], cur.isNotNull(), old.isNotNull()),
    )
    op = normalise_op(F.col("_j.type"), "words")
    both = F.col("_j.xoffset").isNotNull() & F.col("_j.commit").isNotNull()
    code = (
        F.when(F.col("_j").isNull() | (F.col("_j.table").isNull()), "bad_json")
        .when(op.isNull(), "unknown_op")
    )
    schema = F.col("_j.database")
    if "topic_schema" in df.columns:
        schema = F.coalesce(schema, F.col("topic_schema"))
    return change_event(
        staged,
        src_schema=strip_quotes(schema),
        src_table=strip_quotes(F.col("_j.table")),
        op=op,
        cols=cols,
        raw=F.col("_text"),
        error=error(code, F.col("_j.type")),
        # commit and xoffset exclude each other; if both are there neither counts
        txn=txn(
            xid=F.col("_j.xid"),
            csn=F.col("_j.position"),
            seq=F.when(~both, F.col("_j.xoffset")),
            flag=F.when(~both, F.when(F.col("_j.commit").isNotNull(), "commit")),
            op_time=F.col("_j.ts"),
        ),
    )


def decode_json_array(
    df: DataFrame, def_schema: str | None = None, json_null: str = "null", encoding: str = fv.DEFAULT_ENCODING
) -> DataFrame:
    """A JSON array of changes per message; one change event per element, ``item`` is its position.

    An update lists old and new value of a column in turn, an insert new values, a delete old values.
    """
    text = normalise_text(F.col("value"), encoding)
    staged = (
        df.withColumn("_text", text)
        .withColumn("_list", F.from_json("_text", ARRAY_SCHEMA))
        .select("*", F.posexplode_outer("_list").alias("_item", "_e"))
        .withColumn("_op", normalise_op(F.col("_e.operate"), "words"))
    )
    none = F.lit(None).cast("string")
    yes, no = F.lit(True), F.lit(False)

    def entries_of(field: str):
        return F.flatten(F.transform(F.coalesce(F.col(f"_e.{field}"), F.array()), lambda m: F.map_entries(m)))

    def unpaired(field: str):
        """An update list must hold pairs of one column."""
        entries = entries_of(field)
        n = F.size(entries)
        firsts = F.filter(entries, lambda e, i: i % 2 == 0)
        seconds = F.filter(entries, lambda e, i: i % 2 == 1)
        strange = F.exists(F.zip_with(firsts, seconds, lambda a, b: ~a["key"].eqNullSafe(b["key"])), lambda x: x)
        return F.col("_op").isin("U", "K") & ((n % 2 != 0) | strange)

    def image(field: str):
        entries = entries_of(field)
        pairs = F.transform(
            F.sequence(F.lit(0), F.greatest(F.floor(F.size(entries) / 2).cast("int") - 1, F.lit(0))),
            lambda i: F.struct(
                F.try_element_at(entries, 2 * i + 2)["key"].alias("key"),
                cell(
                    _text_nulls(F.try_element_at(entries, 2 * i + 2)["value"], json_null),
                    _text_nulls(F.try_element_at(entries, 2 * i + 1)["value"], json_null),
                    yes,
                    yes,
                ).alias("value"),
            ),
        )
        updates = F.filter(pairs, lambda p: p["key"].isNotNull())
        is_delete = F.col("_op") == "D"
        singles = F.transform(
            entries,
            lambda e: F.struct(
                e["key"].alias("key"),
                F.when(is_delete, cell(none, _text_nulls(e["value"], json_null), no, yes))
                .otherwise(cell(_text_nulls(e["value"], json_null), none, yes, no))
                .alias("value"),
            ),
        )
        return F.when(F.col("_op").isin("U", "K"), updates).otherwise(singles)

    code = (
        F.when(F.col("_e").isNull() | F.col("_e.table_name").isNull(), "bad_json")
        .when(F.col("_op").isNull(), "unknown_op")
        .when(unpaired("column") | unpaired("key_column"), "bad_pair")
    )
    schema = F.lit(def_schema) if def_schema else F.lit(None).cast("string")
    if "topic_schema" in df.columns:
        schema = F.coalesce(schema, F.col("topic_schema"))
    return change_event(
        staged,
        src_schema=schema,
        src_table=F.upper(strip_quotes(F.col("_e.table_name"))),
        op=F.col("_op"),
        cols=F.map_from_entries(F.concat(image("column"), image("key_column"))),
        raw=F.col("_text"),
        error=error(code, F.col("_e.operate")),
        item=F.coalesce("_item", F.lit(0)),
    )
