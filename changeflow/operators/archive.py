"""Side outputs: raw archive, SQL change scripts, unload (dead-letter) archive, JDBC staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow import fixed_values as fv
from changeflow.model import ColumnSpec, TableSpec
from changeflow.operators.apply import batch_rows
from changeflow.operators.bind import dst_cols

LINE_END = fv.SQL_LINE_END
# width of the blocks of the log whose offsets share a line of the applied script
OFFSETS_PER_LINE = 1000


def _literal(value: Column, col: ColumnSpec) -> Column:
    """SQL literal: NULL as null, numbers bare, everything else in single quotes."""
    text = value if col.is_numeric else F.concat(F.lit("'"), value, F.lit("'"))
    return F.coalesce(text, F.lit("null"))


def _condition(value: Column, col: ColumnSpec) -> Column:
    return F.coalesce(F.concat(F.lit(f'"{col.name}" = '), F.when(value.isNotNull(), _literal(value, col))),
                      F.lit(f'"{col.name}" is null'))


def _statement(op: Column, target: str, names: Column, values: Column, sets: Column, where: Column) -> Column:
    return (
        F.when(op == "I", F.concat(F.lit(f"UPSERT INTO {target}("), names, F.lit(") VALUES("), values, F.lit(");")))
        .when(op.isin("U", "K"), F.concat(F.lit(f"UPDATE {target} SET "), sets, F.lit(" WHERE "), where, F.lit(";")))
        .when(op == "D", F.concat(F.lit(f"DELETE FROM {target} WHERE "), where, F.lit(";")))
    )


def to_sql_text(events: DataFrame, spec: TableSpec) -> DataFrame:
    """One SQL statement per event of a table, its offset as trailing comment; bad rows become a comment."""
    target = f'"{spec.schema}"."{spec.table}"'

    def cellof(name: str) -> Column:
        return F.try_element_at("cols", F.lit(name))

    names, values, sets, where = [], [], [], []
    for c in spec.columns:
        v, is_set = cellof(c.name), cellof(c.name)["has_cur"]
        names.append(F.when(is_set, F.lit(f'"{c.name}"')))
        values.append(F.when(is_set, _literal(v["cur"], c)))
        sets.append(F.when(is_set, F.concat(F.lit(f'"{c.name}" = '), _literal(v["cur"], c))))
    for k in spec.key_names:
        v, c = cellof(k), spec.column(k)
        old = F.when(v["has_old"], v["old"]).otherwise(v["cur"])
        where.append(F.when(v.isNotNull(), _condition(old, c)))
    statement = _statement(
        F.col("op"), target, F.concat_ws(", ", *names), F.concat_ws(", ", *values),
        F.concat_ws(", ", *sets), F.concat_ws(" AND ", *where),
    )
    bad = F.col("error").isNotNull() | (F.size("cols") == 0)
    text = F.when(bad, F.lit("-- data format error")).otherwise(statement)
    return events.select(
        "topic", "partition", "offset", "op",
        F.concat(text, F.lit("-- "), F.col("offset").cast("string")).alias("sql_text"),
    )


def net_sql_text(net: DataFrame, spec: TableSpec) -> DataFrame:
    """One SQL statement per net change (what was applied to the target)."""
    target = f'"{spec.schema}"."{spec.table}"'
    names, values, sets, where = [], [], [], []
    for c in spec.columns:
        is_key = c.name in spec.key_names
        cur = (F.col(f"d_{c.name}") if is_key else F.col(f"c_{c.name}")["cur"]).cast("string")
        is_set = F.lit(True) if is_key else F.col(f"c_{c.name}").isNotNull()
        names.append(F.when(is_set, F.lit(f'"{c.name}"')))
        values.append(F.when(is_set, _literal(cur, c)))
        sets.append(F.when(is_set, F.concat(F.lit(f'"{c.name}" = '), _literal(cur, c))))
        if is_key:
            where.append(_condition(F.col(f"s_{c.name}").cast("string"), c))
    statement = _statement(
        F.col("op"), target, F.concat_ws(", ", *names), F.concat_ws(", ", *values),
        F.concat_ws(", ", *sets), F.concat_ws(" AND ", *where),
    )
    return net.select("op", *[c for c in net.columns if c[:2] in ("s_", "d_")], statement.alias("sql_text"))


def applied_script(net: DataFrame, lineage: DataFrame, spec: TableSpec, offsets_per_line: int = OFFSETS_PER_LINE) -> DataFrame:
    """The net changes as statements, with the offsets of the changes behind them: ``topic, partition, line, sql_text`` and the keys ``d_*``.

    ``lineage``: one row per key and contributing change (``net_lineage``, ``key_change_lineage``). A statement stands at the topic and partition
    of its last change and ends with the offsets of that block of the log as a comment; a key with changes in more blocks or partitions has a
    line of offsets for each of them, so a hot key is never one cell. ``line`` is the number of the block. A key that is deleted and written
    anew has both statements, the delete first. A net change that no message made is not in the script.
    """
    keys = dst_cols(spec)
    place = ["topic", "partition", "line"]
    # at most one offset per place of a block
    offsets = F.array_join(F.transform(F.array_sort(F.collect_set("offset")), lambda o: o.cast("string")), ",")
    block = F.floor(F.col("offset") / offsets_per_line).alias("line")
    lines = lineage.groupBy(*keys, "topic", "partition", block).agg(F.concat(F.lit("-- "), offsets).alias("made_by"))
    last = lines.groupBy(*keys).agg(F.max(F.struct(*place)).alias("last"))
    # at most a delete and what comes after it
    script = net_sql_text(net, spec).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("op") != "D", "sql_text"))).alias("script"))
    full = F.transform(F.col("script.sql_text"), lambda text: F.concat(text, F.col("made_by")))
    texts = F.when(F.struct(*place) == F.col("last"), full).otherwise(F.array("made_by"))
    return lines.join(last.join(script, keys), keys).select(*keys, *place, F.explode(texts).alias("sql_text"))


def write_raw_archive(envelope: DataFrame, path: str, max_records: int = 0, mode: str = "append") -> None:
    """Raw messages by topic and partition; large partitions roll over by record count.

    ``mode="overwrite"`` with a path per batch makes a repeated batch write the same archive once.
    """
    writer = envelope.write.mode(mode).partitionBy("topic", "partition")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def write_sql_archive(
    sql: DataFrame, path: str, partition_by: list[str], max_records: int = 0, mode: str = "append"
) -> None:
    """SQL change script as text, in directories by ``partition_by`` (table, topic, partition)."""
    writer = sql.select("sql_text", *partition_by).write.mode(mode).option("lineSep", LINE_END)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.text(path)


def write_unload(
    rejects: DataFrame, path: str, reason: str | None = None, max_records: int = 0, mode: str = "append"
) -> None:
    """Rows that failed or were not applied, by reason; they count as errors in the statistics."""
    code = F.lit(reason) if reason else F.coalesce(F.col("error.code"), F.lit("unapplied"))
    writer = rejects.withColumn("reason", code).write.mode(mode).partitionBy("reason")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def jdbc_options(spec: TableSpec, url: str, driver: str, batch_size: int) -> dict[str, str]:
    """Writer options for a staging table; the batch size honours the row width."""
    return {
        "url": url,
        "driver": driver,
        "dbtable": f'"{spec.schema}"."{spec.table}_STAGING"',
        "batchsize": str(batch_rows(spec, batch_size)),
        "isolationLevel": "READ_COMMITTED",
    }


def write_jdbc(net: DataFrame, spec: TableSpec, url: str, driver: str, batch_size: int) -> None:
    """Net changes to a JDBC staging table; the database merges them from there."""
    flat = net.select(
        "op",
        *[F.col(f"s_{k}").alias(f"OLD_{k}") for k in spec.key_names],
        *[
            (F.col(f"d_{n}") if n in spec.key_names else F.col(f"c_{n}")["cur"]).alias(n)
            for n in spec.column_names
        ],
        *[F.col(f"c_{n}").isNotNull().alias(f"HAS_{n}") for n in spec.value_names],
    )
    flat.write.format("jdbc").options(**jdbc_options(spec, url, driver, batch_size)).mode("append").save()
