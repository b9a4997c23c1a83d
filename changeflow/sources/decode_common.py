"""Pieces every decoder uses: the change-event projection and column-value structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.text import strip_quotes
from changeflow.model import COLS_TYPE, ERROR_TYPE, TXN_FIELDS, TXN_TYPE


def cell(cur: Column, old: Column, has_cur: Column, has_old: Column, quoted: bool = True) -> Column:
    """Column value with quotes stripped (``quoted=False``: the values cannot hold any)."""
    clean = strip_quotes if quoted else (lambda v: v)
    return F.struct(
        clean(cur).alias("cur"), clean(old).alias("old"), has_cur.alias("has_cur"), has_old.alias("has_old")
    )


def no_cols() -> Column:
    return F.create_map().cast(COLS_TYPE)


def error(code: Column, detail: Column | None = None) -> Column:
    """Error struct where ``code`` is not null."""
    detail = F.lit(None).cast("string") if detail is None else detail
    return F.when(code.isNotNull(), F.struct(code.alias("code"), detail.alias("detail"))).cast(ERROR_TYPE)


def txn(**fields: Column) -> Column:
    empty = F.lit(None).cast("string")
    return F.struct(*[fields.get(n, empty).cast("string").alias(n) for n in TXN_FIELDS]).cast(TXN_TYPE)


def change_event(
    df: DataFrame,
    *,
    src_schema: Column,
    src_table: Column,
    op: Column,
    cols: Column,
    raw: Column,
    error: Column,
    txn: Column | None = None,
    item: Column | None = None,
    schema_name: Column | None = None,
    table_name: Column | None = None,
    extra: list[Column] | None = None,
) -> DataFrame:
    """Project decoded parts to the change-event schema. Bad rows carry no columns."""
    ts = F.col("timestamp") if "timestamp" in df.columns else F.lit(None)
    return df.select(
        "topic",
        "partition",
        F.col("offset").cast("bigint").alias("offset"),
        (F.lit(0) if item is None else item).cast("int").alias("item"),
        ts.cast(T.TimestampType()).alias("event_ts"),
        src_schema.cast("string").alias("src_schema"),
        src_table.cast("string").alias("src_table"),
        (src_schema if schema_name is None else schema_name).cast("string").alias("schema_name"),
        (src_table if table_name is None else table_name).cast("string").alias("table_name"),
        op.cast("string").alias("op"),
        F.when(error.isNull(), cols).otherwise(no_cols()).alias("cols"),
        (F.lit(None).cast(TXN_TYPE) if txn is None else txn).alias("txn"),
        raw.cast("string").alias("raw"),
        error.alias("error"),
        *(extra or []),
    )
