"""Table specifications and the shared row schemas."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from changeflow import fixed_values as fv

ENVELOPE_SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"

COL_VALUE = "struct<cur:string,old:string,has_cur:boolean,has_old:boolean>"
COLS_TYPE = f"map<string,{COL_VALUE}>"
# transaction attributes; a wire format fills those that it carries
TXN_FIELDS = "xid csn seq flag op_time process local_xid rebuild_xid begin_seq begin_rba rba trans_seq".split()
TXN_TYPE = "struct<" + ",".join(f"{n}:string" for n in TXN_FIELDS) + ">"
ERROR_TYPE = "struct<code:string,detail:string>"

CHANGE_EVENT_SCHEMA = (
    "topic string, partition int, offset bigint, item int, event_ts timestamp, "
    "src_schema string, src_table string, schema_name string, table_name string, "
    f"op string, cols {COLS_TYPE}, txn {TXN_TYPE}, raw string, error {ERROR_TYPE}"
)
CHANGE_EVENT_COLUMNS = (
    "topic partition offset item event_ts src_schema src_table schema_name table_name op cols txn raw error".split()
)


@dataclass(frozen=True)
class ColumnSpec:
    """One target column: catalog type name, byte size, character set."""

    name: str
    type_name: str = "VARCHAR"
    size: int = 0
    charset: str = ""
    type_code: int = 64
    nullable: bool = True
    spark_type: str = ""

    @property
    def dtype(self) -> str:
        return self.spark_type or fv.SPARK_TYPES.get(self.type_name.strip().upper(), "string")

    @property
    def is_numeric(self) -> bool:
        return self.type_name.strip().upper() in fv.NUMERIC_TYPES

    @property
    def is_character(self) -> bool:
        return self.type_name.strip().upper() in fv.CHARACTER_TYPES

    @property
    def width(self) -> int:
        """Declared width: the catalog size is in bytes of the column's character set."""
        if "UCS2" in self.charset:
            return self.size // 2
        if "UTF8" in self.charset:
            return self.size // 4
        return self.size


@dataclass(frozen=True)
class TableSpec:
    """A target table: ordered columns and key columns in key-sequence order."""

    schema: str
    table: str
    columns: tuple[ColumnSpec, ...]
    keys: tuple[str, ...] = field(default=())

    @property
    def has_pk(self) -> bool:
        return bool(self.keys)

    @property
    def key_names(self) -> list[str]:
        """Without a primary key every column is part of the key."""
        return list(self.keys) if self.keys else self.column_names

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def value_names(self) -> list[str]:
        return [n for n in self.column_names if n not in self.keys]

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.table}"

    def column(self, name: str) -> ColumnSpec:
        return next(c for c in self.columns if c.name == name)

    def row_schema(self) -> str:
        return ", ".join(f"`{c.name}` {c.dtype}" for c in self.columns)

    @staticmethod
    def of(schema: str, table: str, ddl: dict[str, str], keys: Iterable[str] = ()) -> TableSpec:
        """Short form: ``{"c1": "SIGNED INTEGER", "c2": "VARCHAR"}``."""
        return TableSpec(
            schema,
            table,
            tuple(ColumnSpec(name, type_name, 0, "", 64) for name, type_name in ddl.items()),
            tuple(keys),
        )


class Catalog:
    """The target tables of a job, addressable by ``schema.table``."""

    def __init__(self, specs: Iterable[TableSpec]):
        self.specs = {s.full_name: s for s in specs}

    def __getitem__(self, full_name: str) -> TableSpec:
        return self.specs[full_name]

    def __iter__(self):
        return iter(self.specs.values())

    def to_df(self, spark: SparkSession) -> DataFrame:
        """One row per table; job configuration, so its size is that of the catalog listing.

        ``empties`` is what an empty source value means per column.
        """
        rows = [
            (
                s.schema,
                s.table,
                s.column_names,
                ["" if c.is_character else "0" if c.is_numeric else None for c in s.columns],
                s.key_names,
                s.has_pk,
            )
            for s in self
        ]
        return spark.createDataFrame(
            rows,
            "schema_name string, table_name string, columns array<string>, empties array<string>, "
            "key_columns array<string>, has_pk boolean",
        )
