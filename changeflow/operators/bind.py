"""Typed binding: change events of one table -> wide change rows.

A wide change row has ``seq`` (the total order: topic, partition, offset, item), ``chunk`` (a monotone coarsening
of ``seq``), ``op``, the old key ``s_<key>``, the new key ``d_<key>`` and one ``c_<column>`` per non-key
column: a struct ``(cur, old)`` that is null when the change does not set the column. A column set to
NULL is a non-null struct whose ``cur`` is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.model import TableSpec

# Offsets per chunk: bounds the rows of one key that a single task may sort.
CHUNK_OFFSETS = 1 << 20


def src_cols(spec: TableSpec) -> list[str]:
    return [f"s_{k}" for k in spec.key_names]


def dst_cols(spec: TableSpec) -> list[str]:
    return [f"d_{k}" for k in spec.key_names]


def val_cols(spec: TableSpec) -> list[str]:
    return [f"c_{n}" for n in spec.value_names]


def order_columns(df: DataFrame, chunk_offsets: int = CHUNK_OFFSETS) -> list[Column]:
    """``seq`` and ``chunk`` from topic, partition, offset and position inside the message.

    Partition order always holds.
    """
    offset = F.col("offset").cast("bigint")
    item = F.col("item") if "item" in df.columns else F.lit(0)
    return [
        F.struct("topic", "partition", offset.alias("offset"), item.alias("item")).alias("seq"),
        F.struct("topic", "partition", F.floor(offset / chunk_offsets).alias("block")).alias("chunk"),
    ]


def typed_changes(
    df: DataFrame,
    spec: TableSpec,
    op: Column,
    old_key: dict[str, Column],
    new_key: dict[str, Column],
    values: dict[str, tuple[Column, Column]],
    olds: dict[str, Column] | None = None,
    chunk_offsets: int = CHUNK_OFFSETS,
) -> DataFrame:
    """Wide change rows straight from typed columns (``values``: column -> (is set, current value))."""
    olds = olds or {}

    def value(name: str) -> Column:
        dtype = spec.column(name).dtype
        has, cur = values[name]
        old = olds.get(name, F.lit(None))
        return F.when(has, F.struct(cur.cast(dtype).alias("cur"), old.cast(dtype).alias("old")))

    def dtype(k: str) -> str:
        return spec.column(k).dtype

    return df.select(
        *order_columns(df, chunk_offsets),
        op.alias("op"),
        *[F.coalesce(old_key[k], new_key[k]).cast(dtype(k)).alias(f"s_{k}") for k in spec.key_names],
        *[F.coalesce(new_key[k], old_key[k]).cast(dtype(k)).alias(f"d_{k}") for k in spec.key_names],
        *[value(n).alias(f"c_{n}") for n in spec.value_names],
    )


def _cell(name: str) -> Column:
    return F.col(f"x_{name}")


def _cells(spec: TableSpec) -> list[str]:
    return [f"x_{n}" for n in spec.column_names]


def _computed(**columns: Column) -> Column:
    """Columns evaluated once per row. As rows of a one-element array they are not inlined into every later use."""
    return F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))


def with_cells(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Look every column of the table up once: ``x_<column>``."""
    return df.select("*", _computed(**{f"x_{n}": F.try_element_at("cols", F.lit(n)) for n in spec.column_names}))


def with_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Old and new key of every change. A missing old key part is the current one and vice versa.

    Needs ``with_cells``.
    """

    def part(k: str, first: str, second: str) -> Column:
        v = _cell(k)
        text = F.when(v[f"has_{first}"], v[first]).when(v[f"has_{second}"], v[second])
        return text.try_cast(spec.column(k).dtype)

    is_insert, is_delete = F.col("op") == "I", F.col("op") == "D"
    keys = {}
    for k in spec.key_names:
        keys[f"s_{k}"] = F.when(is_insert, part(k, "cur", "old")).otherwise(part(k, "old", "cur"))
    for k in spec.key_names:
        keys[f"d_{k}"] = F.when(is_delete, part(k, "old", "cur")).otherwise(part(k, "cur", "old"))
    return df.select("*", _computed(**keys))


def key_changed(spec: TableSpec) -> Column:
    changed = F.lit(False)
    for k in spec.key_names:
        changed = changed | ~F.col(f"s_{k}").eqNullSafe(F.col(f"d_{k}"))
    return changed


def classify(df: DataFrame, spec: TableSpec, update_mode: str = "sparse") -> DataFrame:
    """U and K become K only if a key part really changed; ``upsert`` turns the other updates into I."""
    plain = "I" if update_mode == "upsert" and spec.has_pk else "U"
    is_update = F.col("op").isin("U", "K")
    moved = key_changed(spec) if spec.has_pk else F.lit(False)
    return df.withColumn(
        "op", F.when(is_update & moved, "K").when(is_update, plain).otherwise(F.col("op"))
    )


def _binding_error(spec: TableSpec) -> Column:
    """First binding problem of a row as an error struct, or null."""
    checks = []
    if spec.has_pk:
        for k in spec.keys:
            null_key = F.col(f"s_{k}").isNull() | F.col(f"d_{k}").isNull()
            checks.append((null_key, "null_key", k))
    sets_values = F.col("op") != "D"
    for name in spec.column_names:
        col = spec.column(name)
        v = _cell(name)
        bad = v["cur"].isNotNull() & v["cur"].try_cast(col.dtype).isNull()
        checks.append((sets_values & bad, "bad_value", name))
        if col.is_character and col.width > 0:
            checks.append((sets_values & (F.length(v["cur"]) > col.width), "too_long", name))
        if not col.nullable and name not in spec.keys:
            absent = F.coalesce(~v["has_cur"], F.lit(True))
            is_null = v["has_cur"] & v["cur"].isNull()
            checks.append((sets_values & (is_null | (F.col("op").eqNullSafe("I") & absent)), "null_value", name))
    found = F.lit(None).cast("struct<code:string,detail:string>")
    for cond, code, name in reversed(checks):
        found = F.when(cond, F.struct(F.lit(code).alias("code"), F.lit(name).alias("detail"))).otherwise(found)
    return found


def bind_changes(
    events: DataFrame,
    spec: TableSpec,
    update_mode: str = "sparse",
    chunk_offsets: int = CHUNK_OFFSETS,
) -> tuple[DataFrame, DataFrame]:
    """Cast the events of one table to its column types.

    Returns ``(changes, rejects)``: wide change rows, and the events with a null key, an uncastable,
    over-long or forbidden null value (with ``error``). One pass, no shuffle.
    """
    checked = _checked(events.filter(F.col("error").isNull()).drop("error"), spec, update_mode)

    def value(name: str) -> Column:
        dtype = spec.column(name).dtype
        v = _cell(name)
        typed = F.struct(v["cur"].try_cast(dtype).alias("cur"), v["old"].try_cast(dtype).alias("old"))
        return F.when(v["has_cur"] & (F.col("op") != "D"), typed).alias(f"c_{name}")

    good = checked.filter(F.col("error").isNull()).select(
        *order_columns(checked, chunk_offsets),
        "op",
        *src_cols(spec),
        *dst_cols(spec),
        *[value(n) for n in spec.value_names],
    )
    return good, checked.filter(F.col("error").isNotNull()).select(*events.columns)


def _checked(events: DataFrame, spec: TableSpec, update_mode: str) -> DataFrame:
    keyed = classify(with_keys(with_cells(events, spec), spec), spec, update_mode)
    return keyed.select("*", _computed(error=_binding_error(spec)))


def cast_typed(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Every event with its binding error (null if it binds), for inspection and reject counts."""
    return _checked(events.drop("error"), spec, "sparse").select(*events.columns)


def to_row(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Project events to the table's column order; absent columns are NULL."""
    return events.select(
        *[F.try_element_at("cols", F.lit(c.name))["cur"].try_cast(c.dtype).alias(c.name) for c in spec.columns]
    )
