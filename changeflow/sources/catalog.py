"""Table catalog from metadata DataFrames (columns and keys of the target database)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow import fixed_values as fv
from changeflow.model import Catalog, ColumnSpec, TableSpec
from changeflow.session import BROADCAST_ROWS


def load_catalog(
    columns: DataFrame,
    keys: DataFrame,
    schemas: list[str] | None = None,
    tables: list[str] | None = None,
) -> DataFrame:
    """One row per target table: ordered columns, key columns in key-sequence order, ``has_pk``.

    ``columns``: schema_name, table_name, ordinal, column_name, type_code, type_name, size, charset, nullable.
    ``keys``: schema_name, table_name, key_seq, column_name. System schemas and statistic tables are left out.
    Without a primary key all columns form the key. Lists per table are bounded by the table width.
    """
    wanted = columns.filter(
        ~F.col("schema_name").isin(*fv.SYSTEM_SCHEMAS) & ~F.col("table_name").isin(*fv.STATISTIC_TABLES)
    )
    if schemas:
        wanted = wanted.filter(F.col("schema_name").isin(schemas))
    if tables:
        wanted = wanted.filter(F.col("table_name").isin(tables))
    attributes = ["ordinal", "column_name", "type_code", "type_name", "size", "charset", "nullable"]
    per_table = wanted.groupBy("schema_name", "table_name").agg(
        F.array_sort(F.collect_list(F.struct(*attributes))).alias("columns")
    )
    key_lists = keys.groupBy("schema_name", "table_name").agg(
        F.array_sort(F.collect_list(F.struct("key_seq", "column_name"))).alias("key_entries")
    )
    names = F.transform("columns", lambda c: c["column_name"])
    return per_table.join(key_lists, ["schema_name", "table_name"], "left").select(
        "schema_name",
        "table_name",
        "columns",
        F.coalesce(F.transform("key_entries", lambda k: k["column_name"]), names).alias("key_columns"),
        F.col("key_entries").isNotNull().alias("has_pk"),
    )


def catalog_specs(catalog: DataFrame, max_tables: int = BROADCAST_ROWS) -> Catalog:
    """Bring the catalog listing to the job definition. Its size is checked: one row per target table."""
    rows = catalog.limit(max_tables + 1).collect()
    if len(rows) > max_tables:
        raise ValueError(f"more than {max_tables} tables in the catalog; restrict schemas or tables")
    return Catalog(
        TableSpec(
            r["schema_name"],
            r["table_name"],
            tuple(
                ColumnSpec(
                    c["column_name"], c["type_name"], c["size"], c["charset"] or "", c["type_code"], c["nullable"]
                )
                for c in r["columns"]
            ),
            tuple(r["key_columns"]) if r["has_pk"] else (),
        )
        for r in rows
    )
