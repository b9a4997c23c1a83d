"""Name resolution, table and column mapping, column binding, dispatch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.model import Catalog
from changeflow.session import BROADCAST_ROWS


def resolve_names(events: DataFrame, def_schema: str | None = None) -> DataFrame:
    """Split a one-, two- or three-part ``src_table``. The configured schema beats the message's, which
    beats the topic's default."""
    parts = F.split("src_table", r"[.]")
    n = F.size(parts)
    table = F.when(n <= 3, F.element_at(parts, -1)).otherwise(parts[0])
    in_message = F.when(n.isin(2, 3), F.try_element_at(parts, F.lit(-2)))
    from_topic = F.col("topic_schema") if "topic_schema" in events.columns else F.lit(None).cast("string")
    configured = F.lit(def_schema if def_schema and "," not in def_schema else None).cast("string")
    schema = F.coalesce(configured, in_message, from_topic)
    return events.withColumns(
        {"src_schema": schema, "src_table": table, "schema_name": schema, "table_name": table}
    ).drop("topic_schema")


def map_tables(events: DataFrame, mappings: DataFrame, catalog: Catalog | None = None) -> DataFrame:
    """Source table -> target table. Blank source parts default to the target's; many may map to one.

    Of several rules for one source the last counts (by ``rule`` if the mappings have that column, else by row order). Rules
    for targets that the catalog does not have are ignored, so their events keep their own table.
    """
    order = F.col("rule") if "rule" in mappings.columns else F.monotonically_increasing_id()
    rules = mappings.select(
        F.when(F.coalesce("src_schema", F.lit("")) == "", F.col("schema_name"))
        .otherwise(F.col("src_schema")).alias("_from_schema"),
        F.when(F.coalesce("src_table", F.lit("")) == "", F.col("table_name"))
        .otherwise(F.col("src_table")).alias("_from_table"),
        "schema_name", "table_name", order.alias("_rule"),
    )
    if catalog is not None:
        rules = rules.join(_catalog_side(events, catalog), ["schema_name", "table_name"], "left_semi")
    target = F.max_by(F.struct("schema_name", "table_name"), "_rule")
    rules = rules.groupBy("_from_schema", "_from_table").agg(target.alias("_to"))
    hit = (F.col("schema_name") == F.col("_from_schema")) & (F.col("table_name") == F.col("_from_table"))
    return (
        events.join(rules, hit, "left")
        .withColumn("schema_name", F.coalesce("_to.schema_name", "schema_name"))
        .withColumn("table_name", F.coalesce("_to.table_name", "table_name"))
        .drop("_from_schema", "_from_table", "_to")
    )


def map_columns(events: DataFrame, mappings: DataFrame) -> DataFrame:
    """Rename columns per target table: ``mappings`` has schema_name, table_name, src_column, column_name.

    Entries with a blank side are ignored. The list per table is bounded by the table width.
    """
    named = mappings.filter(
        (F.coalesce("src_column", F.lit("")) != "") & (F.coalesce("column_name", F.lit("")) != "")
    )
    rules = named.groupBy("schema_name", "table_name").agg(
        F.map_from_entries(F.collect_list(F.struct("src_column", "column_name"))).alias("_names")
    )
    return (
        events.join(rules, ["schema_name", "table_name"], "left")
        .withColumn(
            "cols",
            F.when(
                F.col("_names").isNotNull(),
                F.transform_keys("cols", lambda k, v: F.coalesce(F.try_element_at("_names", k), k)),
            ).otherwise(F.col("cols")),
        )
        .select(*events.columns)
    )


def _catalog_side(df: DataFrame, catalog: Catalog) -> DataFrame:
    tables = catalog.to_df(df.sparkSession)
    return F.broadcast(tables) if len(catalog.specs) <= BROADCAST_ROWS else tables


def known_tables(events: DataFrame, catalog: Catalog) -> DataFrame:
    """Events whose target table exists."""
    return events.join(_catalog_side(events, catalog), ["schema_name", "table_name"], "left_semi").select(
        *events.columns
    )


def unknown_tables(events: DataFrame, catalog: Catalog) -> DataFrame:
    """Events whose target table does not exist (they are ignored by the job)."""
    return events.join(_catalog_side(events, catalog), ["schema_name", "table_name"], "left_anti").select(
        *events.columns
    )


def with_target(events: DataFrame, catalog: Catalog) -> DataFrame:
    """Add ``target``: the full name of the target table, or '' if there is no such table."""
    known = _catalog_side(events, catalog).select("schema_name", "table_name", F.concat_ws(".", "schema_name", "table_name").alias("_known"))
    joined = events.join(known, ["schema_name", "table_name"], "left")
    return joined.select(*events.columns, F.coalesce("_known", F.lit("")).alias("target"))


def bind_columns(events: DataFrame, catalog: Catalog, by: str = "name") -> DataFrame:
    """Bind column references to catalog names: ``position`` (0-based) or ``name``.

    A reference the table does not have makes the row bad (``unknown_column``).
    """
    joined = events.join(_catalog_side(events, catalog), ["schema_name", "table_name"], "left")
    if by == "position":
        bound = F.map_from_entries(
            F.transform(
                F.map_entries("cols"),
                lambda e: F.struct(
                    F.coalesce(
                        F.try_element_at("columns", e["key"].try_cast("int") + 1), F.concat(F.lit("?"), e["key"])
                    ).alias("key"),
                    e["value"].alias("value"),
                ),
            )
        )
        joined = joined.withColumn("cols", F.when(F.col("columns").isNotNull(), bound).otherwise(F.col("cols")))
    strange = F.array_except(F.map_keys("cols"), "columns")
    bad = F.col("columns").isNotNull() & (F.size(strange) > 0)
    found = F.when(
        bad, F.struct(F.lit("unknown_column").alias("code"), F.array_join(strange, ",").alias("detail"))
    )
    return joined.withColumn("error", F.coalesce("error", found)).select(*events.columns)


def split_by_table(events: DataFrame, catalog: Catalog) -> dict[str, DataFrame]:
    """One DataFrame per target table; each is a filter on the shared plan."""
    return {
        spec.full_name: events.filter(
            (F.col("schema_name") == spec.schema) & (F.col("table_name") == spec.table)
        )
        for spec in catalog
    }


def detect_key_change(cols: Column, key_columns: Column) -> Column:
    """True if some key column carries both values and they differ."""

    def moved(k: Column) -> Column:
        v = F.try_element_at(cols, k)
        return v["has_cur"] & v["has_old"] & ~v["cur"].eqNullSafe(v["old"])

    return F.exists(key_columns, lambda k: F.coalesce(moved(k), F.lit(False)))


def split_errors(events: DataFrame, on_error: str = "skip") -> tuple[DataFrame, DataFrame]:
    """Good and bad rows. ``fail`` makes the job stop at the first bad row instead."""
    bad = events.filter(F.col("error").isNotNull())
    if on_error == "skip":
        return events.filter(F.col("error").isNull()), bad
    # a condition, not a column: columns that nobody reads are pruned
    checked = events.filter(F.when(F.col("error").isNotNull(), F.raise_error(error_text()).cast("boolean")).otherwise(True))
    return checked, bad


def error_text() -> Column:
    """What is wrong with a bad row, where it came from and what it was."""
    def known(name: str, unknown: str = "?") -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(unknown))

    return F.concat(
        known("error.code"), F.concat(F.lit(" "), known("error.detail", "-")), F.lit(" @"), known("offset"),
        F.lit(" target="), known("schema_name"), F.lit("/"), known("table_name"), F.lit(" op="), known("op"),
        F.lit(" text="), known("raw", ""),
    )
