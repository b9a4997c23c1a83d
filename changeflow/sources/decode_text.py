"""Decoders for delimited text and the control-character log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow import fixed_values as fv
from changeflow.functions.text import normalise_text
from changeflow.model import TableSpec
from changeflow.operators.route import resolve_names
from changeflow.sources.decode_common import cell, change_event, error, txn


def decode_delimited(
    df: DataFrame, spec: TableSpec, delim: str = fv.DEFAULT_DELIMITER, encoding: str = fv.DEFAULT_ENCODING
) -> DataFrame:
    """One row per message, columns by position, always an insert. Trailing empty fields are absent."""
    if len(delim) != 1:
        raise ValueError(f"the delimiter must be a single character, not {delim!r}")
    names = spec.column_names
    pattern = f"[\\{delim}]" if delim in "^]\\-[" else f"[{delim}]"
    text = normalise_text(F.col("value"), encoding)
    # drop trailing delimiters first: split() keeps trailing empty fields
    parts = F.split(F.regexp_replace(text, f"{pattern}+$", ""), pattern)
    none = F.lit(None).cast("string")
    false, true = F.lit(False), F.lit(True)
    entries = F.transform(
        F.col("_parts"), lambda v, i: F.struct(
            F.try_element_at(F.array(*[F.lit(n) for n in names]), i + 1).alias("key"),
            cell(v, none, true, false).alias("value"),
        )
    )
    too_many = F.when(F.size("_parts") > len(names), "too_many_fields")
    staged = df.withColumn("_text", text).withColumn("_parts", parts)
    return change_event(
        staged,
        src_schema=F.lit(spec.schema),
        src_table=F.lit(spec.table),
        op=F.lit("I"),
        cols=F.map_from_entries(F.slice(entries, 1, len(names))),
        raw=F.col("_text"),
        error=error(too_many, F.size("_parts").cast("string")),
    )


def decode_ctrl(df: DataFrame, def_schema: str | None = None, encoding: str = fv.DEFAULT_ENCODING) -> DataFrame:
    """Control-character log. Columns are keyed by their position in the table; bind them with ``bind_columns``.

    Message: transaction attributes, table name, operation, time, then one field per column with the column
    position, the current and the old value, each led by its tag.
    """
    data, none = fv.TAG_DATA, fv.TAG_NONE
    tags = f"[{data}-{none}]"
    staged = (
        df.withColumn("_text", normalise_text(F.col("value"), encoding))
        .withColumn("_f", F.split("_text", fv.FIELD_SEP))
        .withColumn("_t", F.split(F.col("_f")[0], fv.TAG_DATA))
    )
    op = F.try_element_at("_f", F.lit(3))
    fields = F.slice("_f", 5, F.greatest(F.size("_f") - 4, F.lit(0)))
    # per field: its parts (position, current, old) and its tags, each split off once
    pieces = F.transform(
        F.filter(fields, lambda x: F.length(x) > 0),
        lambda x: F.struct(
            F.split(x, tags).alias("p"), F.regexp_replace(x, f"[^{data}-{none}]+", "").alias("t")
        ),
    )

    def well_formed(x):
        return (F.size(x["p"]) >= 3) & x["p"][0].try_cast("int").isNotNull()

    def column(x):
        cur_tag, old_tag = F.substring(x["t"], 1, 1), F.substring(x["t"], 2, 1)
        # 'no data' reads as the empty string
        cur = F.when(cur_tag == data, x["p"][1]).when(cur_tag == none, "")
        old = F.when(old_tag == data, x["p"][2]).when(old_tag == none, "")
        # an insert has no old image and a delete no current one; elsewhere 'no data' is an empty value
        has_cur = (cur_tag != none) | (op != "D")
        has_old = (old_tag != none) | (op != "I")
        return F.struct(x["p"][0].alias("key"), cell(cur, old, has_cur, has_old).alias("value"))

    staged = staged.withColumn("_p", pieces)
    bad_field = F.exists("_p", lambda x: ~well_formed(x))
    code = (
        F.when(F.size("_f") < 4, "short_message")
        .when(F.size("_t") < 7, "short_transaction")
        .when(~op.isin("I", "U", "K", "D"), "unknown_op")
        .when(bad_field, "bad_field")
    )
    names = F.try_element_at("_f", F.lit(2))
    events = change_event(
        staged,
        src_schema=F.lit(None),
        src_table=names,
        op=op,
        cols=F.map_from_entries(F.transform(F.filter("_p", well_formed), column)),
        raw=F.col("_text"),
        error=error(code),
        txn=txn(
            xid=F.try_element_at("_t", F.lit(3)),
            csn=F.try_element_at("_t", F.lit(2)),
            seq=F.try_element_at("_t", F.lit(7)),
            flag=F.try_element_at("_t", F.lit(5)),
            op_time=F.try_element_at("_f", F.lit(4)),
            process=F.try_element_at("_t", F.lit(1)),
            local_xid=F.try_element_at("_t", F.lit(4)),
            rebuild_xid=F.try_element_at("_t", F.lit(6)),
        ),
        extra=[F.col("topic_schema")] if "topic_schema" in df.columns else None,
    )
    return resolve_names(events, def_schema)
