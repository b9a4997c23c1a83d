"""Versioned table snapshots on plain Parquet with an append-only commit log.

A table is split into hash buckets of its key. A batch of a table with a key writes the new state of the rows it changed (or
that they are gone) as a delta of their buckets, under a directory named after its stream and batch; appending one small file
to the commit log publishes it. Readers take for every bucket its newest full version and put the later deltas on
top, so a batch is visible as a whole or not at all, and replaying a published batch is a no-op. A bucket with many deltas is
written anew by ``compact``. A table without a key is a multiset: its full versions hold each row once with its number of copies, its
deltas hold signed numbers, and readers add them up. A batch is known by its stream and its number in that stream, because every
stream counts from 0; versions are ordered by a commit number of the whole store. The number of buckets is part of the store.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.model import Catalog, TableSpec
from changeflow.operators.nopk import add_counts, collapse, expand

COMMIT_SCHEMA = (
    "commit_seq bigint, stream_id string, batch_id bigint, table_name string, buckets array<int>, filled array<int>, deltas array<int>, "
    "status string, messages bigint, inserts bigint, updates bigint, deletes bigint, rejects bigint, committed_at timestamp"
)
LAYOUT_SCHEMA = "buckets int"
DELTA_COLUMNS = "_gone boolean, _stream string, _batch bigint"
DEFAULT_BUCKETS = 64
# the stream id of batches that no streaming query numbers
BY_HAND = "batch"
COMPACTION = "compaction"
# copies of a row of a table without a key; files without this column hold one row per copy
COPIES = "_copies"
# deltas of a bucket that are read on top of its full version before it is written anew
MAX_DELTAS = 8


class SnapshotStore:
    """``buckets``: for a new store; a store that exists keeps its number and refuses another one."""

    def __init__(self, spark: SparkSession, root: str, catalog: Catalog, buckets: int | None = None, files_per_bucket: int = 1):
        self.spark, self.root, self.catalog = spark, root.rstrip("/"), catalog
        self.files_per_bucket = files_per_bucket
        self.buckets = self._layout(buckets)

    def _layout(self, wanted: int | None) -> int:
        path = f"{self.root}/layout"
        try:
            stored = self.spark.read.schema(LAYOUT_SCHEMA).parquet(path).first()
        except AnalysisException:
            stored = None
        if stored is None:
            layout = self.spark.createDataFrame([(wanted or DEFAULT_BUCKETS,)], LAYOUT_SCHEMA)
            layout.coalesce(1).write.mode("overwrite").parquet(path)
            return wanted or DEFAULT_BUCKETS
        if wanted is not None and wanted != stored["buckets"]:
            raise ValueError(f"the store at {self.root} has {stored['buckets']} buckets, not {wanted}")
        return stored["buckets"]

    # -- commit log --------------------------------------------------------------------------------
    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMIT_SCHEMA).parquet(f"{self.root}/commits")
        except AnalysisException:
            return self.spark.createDataFrame([], COMMIT_SCHEMA)

    def published(self) -> DataFrame:
        return self.commits().filter(F.col("status") == "done")

    def is_committed(self, batch_id: int, stream_id: str = BY_HAND) -> bool:
        mine = (F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id)
        return not self.published().filter(mine).isEmpty()

    def publish(self, batch_id: int, tables: list[dict], stream_id: str = BY_HAND, status: str = "done") -> None:
        """Append the batch to the commit log: one file, written last. ``failed`` batches are listed but not read."""
        last = self.commits().agg(F.max("commit_seq")).first()[0]
        rows = [
            (
                0 if last is None else last + 1, stream_id, batch_id, t["table_name"], t.get("buckets", []), t.get("filled", []),
                t.get("deltas", []), status,
                t.get("messages", 0), t.get("inserts", 0), t.get("updates", 0), t.get("deletes", 0), t.get("rejects", 0),
            )
            for t in tables
        ]
        fields = [f for f in COMMIT_SCHEMA.split(", ") if not f.startswith("committed_at")]
        log = self.spark.createDataFrame(rows, ", ".join(fields)).withColumn("committed_at", F.current_timestamp())
        log.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    # -- buckets -----------------------------------------------------------------------------------
    def bucket(self, cols: list[str]) -> Column:
        return F.pmod(F.xxhash64(*cols), F.lit(self.buckets)).cast("int")

    def touched_buckets(self, net: DataFrame, spec: TableSpec) -> list[int]:
        """Buckets of the source and destination keys of a batch: at most ``buckets`` integers."""
        src, dst = [f"s_{k}" for k in spec.key_names], [f"d_{k}" for k in spec.key_names]
        fresh = F.col(src[0]).isNull()
        both = F.array(F.when(fresh, self.bucket(dst)).otherwise(self.bucket(src)), self.bucket(dst))
        found = net.select(F.explode(F.array_distinct(both)).alias("b")).distinct()
        return sorted(r["b"] for r in found.collect())

    # -- tables ------------------------------------------------------------------------------------
    def _directory(self, spec: TableSpec, batch_id: int, stream_id: str) -> str:
        return f"{self.root}/{spec.full_name}/stream={stream_id}/batch={batch_id}"

    def _versions(self, spec: TableSpec) -> DataFrame:
        """One row per bucket and piece to read: ``bucket, commit_seq, stream_id, batch_id, delta``."""
        mine = self.published().filter(F.col("table_name") == spec.full_name)
        place = ("commit_seq", "stream_id", "batch_id")
        full = mine.select(F.explode("buckets").alias("bucket"), F.struct(*place, "filled").alias("v"))
        full = full.groupBy("bucket").agg(F.max("v").alias("v"))
        deltas = mine.select(F.explode("deltas").alias("bucket"), *place)
        later = deltas.join(full.select("bucket", F.col("v.commit_seq").alias("full_seq")), "bucket", "left")
        later = later.filter(F.col("commit_seq") > F.coalesce("full_seq", F.lit(-1)))
        # a bucket emptied by its last full version has no directory
        kept = full.filter(F.array_contains("v.filled", F.col("bucket")))
        return kept.select("bucket", *[f"v.{c}" for c in place], F.lit(False).alias("delta")).unionByName(
            later.select("bucket", *place, F.lit(True).alias("delta"))
        )

    def _pieces(self, spec: TableSpec, buckets: list[int] | None) -> tuple[list[str], dict[str, tuple]]:
        """Folders of the full versions, and those of the deltas with their place in the commit log."""
        versions = self._versions(spec)
        if buckets is not None:
            versions = versions.filter(F.col("bucket").isin(buckets))
        full, deltas = [], {}
        # at most MAX_DELTAS + 1 rows per bucket, unless nobody compacts
        for r in versions.collect():
            path = f"{self._directory(spec, r['batch_id'], r['stream_id'])}{'/delta' * r['delta']}/bucket={r['bucket']}"
            if r["delta"]:
                deltas[path] = (r["stream_id"], r["batch_id"], r["commit_seq"])
            else:
                full.append(path)
        return full, deltas

    def read_counts(self, spec: TableSpec, buckets: list[int] | None = None) -> DataFrame:
        """The published table without a key, or only the given buckets of it: each row once, with its number of copies ``n``."""
        full, deltas = self._pieces(spec, buckets)
        schema = f"{spec.row_schema()}, `{COPIES}` bigint"
        paths = [*full, *deltas]
        table = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        copies = F.coalesce(F.col(COPIES), F.lit(1).cast("bigint"))
        return add_counts(table.select(*spec.column_names, copies.alias("n")), spec)

    def read(self, spec: TableSpec, buckets: list[int] | None = None) -> DataFrame:
        """The published table, or only the given buckets of it."""
        if not spec.has_pk:
            return expand(self.read_counts(spec, buckets), spec)
        full, deltas = self._pieces(spec, buckets)
        schema = spec.row_schema()
        table = self.spark.read.schema(schema).parquet(*full) if full else self.spark.createDataFrame([], schema)
        table = table.select(*spec.column_names)
        if not deltas:
            return table
        order = self.spark.createDataFrame(sorted(set(deltas.values())), "_stream string, _batch bigint, _seq bigint")
        changed = self.spark.read.schema(f"{schema}, {DELTA_COLUMNS}").parquet(*deltas)
        last = F.max_by(F.struct(*spec.column_names, "_gone"), "_seq").alias("last")
        newest = changed.join(order, ["_stream", "_batch"]).groupBy(*spec.key_names).agg(last).select("last.*")
        kept = table.join(newest.select(*spec.key_names), spec.key_names, "left_anti").select(*spec.column_names)
        return kept.unionByName(newest.filter(~F.col("_gone")).select(*spec.column_names))

    def write_delta(self, rows: DataFrame, gone: DataFrame, spec: TableSpec, batch_id: int, stream_id: str = BY_HAND) -> None:
        """Write the new state of changed rows and the keys of rows that are gone. Not yet visible."""
        dead = gone.select(
            *[F.col(n) if n in spec.key_names else F.lit(None).cast(rows.schema[n].dataType).alias(n) for n in spec.column_names],
            F.lit(True).alias("_gone"),
        )
        (
            rows.select(*spec.column_names, F.lit(False).alias("_gone"))
            .unionByName(dead)
            .withColumns({"_stream": F.lit(stream_id), "_batch": F.lit(batch_id).cast("bigint"), "bucket": self.bucket(spec.key_names)})
            .repartition("bucket")
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{self._directory(spec, batch_id, stream_id)}/delta")
        )

    def write_counts(self, delta: DataFrame, spec: TableSpec, batch_id: int, stream_id: str = BY_HAND) -> list[int]:
        """Write the signed numbers of copies that a batch changes in a table without a key. Not yet visible.

        Returns the buckets that hold rows.
        """
        target = f"{self._directory(spec, batch_id, stream_id)}/delta"
        self._write_buckets(delta.select(*spec.column_names, F.col("n").alias(COPIES)), spec, target, 1)
        return self._filled(spec, target)

    def compact(self, spec: TableSpec, max_deltas: int = MAX_DELTAS) -> list[int]:
        """Write buckets with more than ``max_deltas`` deltas anew; returns them."""
        many = self._versions(spec).filter("delta").groupBy("bucket").count().filter(F.col("count") > max_deltas)
        buckets = sorted(r["bucket"] for r in many.collect())
        if buckets:
            batch = self.commits().agg(F.max("commit_seq")).first()[0] + 1
            rows = self.read(spec, buckets) if spec.has_pk else self.read_counts(spec, buckets)
            filled = self.write(rows, spec, batch, COMPACTION)
            self.publish(batch, [{"table_name": spec.full_name, "buckets": buckets, "filled": filled}], COMPACTION)
        return buckets

    def write(self, table: DataFrame, spec: TableSpec, batch_id: int, stream_id: str = BY_HAND) -> list[int]:
        """Write rows under the batch's directory, one group of files per bucket. Not yet visible.

        Rows of a table without a key may come counted, with the number of copies in ``n``. Returns the buckets that hold rows.
        """
        target = self._directory(spec, batch_id, stream_id)
        # the bucket of a row is that of its typed values
        typed = [F.col(c.name).cast(c.dtype).alias(c.name) for c in spec.columns]
        if spec.has_pk:
            rows = table.select(*typed)
        else:
            counted = "n" in table.columns and "n" not in spec.column_names
            rows = table.select(*typed, "n") if counted else collapse(table.select(*typed), spec)
            rows = rows.withColumnRenamed("n", COPIES)
        self._write_buckets(rows, spec, target, self.files_per_bucket)
        return self._filled(spec, target)

    def _write_buckets(self, rows: DataFrame, spec: TableSpec, target: str, files: int) -> None:
        key = spec.key_names
        (
            rows.withColumn("bucket", self.bucket(key))
            .withColumn("_spread", F.pmod(F.hash(*key), F.lit(files)))
            .repartition("bucket", "_spread")
            .drop("_spread")
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(target)
        )

    def _filled(self, spec: TableSpec, target: str) -> list[int]:
        written = self.spark.read.schema(spec.row_schema() + ", bucket int").parquet(target)
        return sorted(r["bucket"] for r in written.select("bucket").distinct().collect())

    def load(self, table: DataFrame, spec: TableSpec, batch_id: int = -1) -> None:
        """Initial load of a table."""
        log = self.published().filter((F.col("batch_id") == batch_id) & (F.col("table_name") == spec.full_name))
        if not log.isEmpty():
            return
        filled = self.write(table, spec, batch_id)
        self.publish(
            batch_id, [{"table_name": spec.full_name, "buckets": list(range(self.buckets)), "filled": filled}]
        )
