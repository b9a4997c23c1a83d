"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed number of characters. The distinct blocks are sorted and get integer names; then the
distinct pairs of adjacent names are sorted and named, level by level, until each text has one name. Two texts have the same
(level, name) exactly if they are equal: a name stands for one string at every level, whatever its hash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import cut_lineage

BLOCK_CHARS = 4096


def normalised(text: str):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _numbered(distinct: DataFrame, order: list[str], keep: list[str]) -> DataFrame:
    """Distinct rows sorted in the partition they hash to, numbered (partition, place): unique integers, the same on a rerun."""
    return cut_lineage(distinct.sortWithinPartitions(*order).select(*keep, F.monotonically_increasing_id().alias("name")))


def block_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Row number, id, SHA-256 of the normalised text and collision-free identity ``(level, name)`` of every row.

    A null text is an empty one. Rows are told apart by ``row``, so null and repeated ids are allowed.
    """
    seed = 0
    while True:
        text = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("text"))
        cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
        # blocks move by a 128-bit key; names are given to the blocks themselves, and a key of two blocks is found below
        key = lambda b: F.unhex(F.md5(F.concat(F.lit(f"{seed}:"), b)))
        cut = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(cut)
        rows = cut_lineage(
            text.select(
                F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2("text", 256).alias("text_sha256"),
                F.transform(cut, key).alias("keys"),
            )
        )
        blocks = text.select(F.explode(cut).alias("block")).select(key(F.col("block")).alias("key"), "block").distinct()
        names = _numbered(blocks, ["block"], ["key"])
        if names.groupBy("key").count().filter("count > 1").isEmpty():
            break
        seed += 1
    level, finished = 0, []
    at = rows.select("row", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key"))
    at = cut_lineage(at.join(names, "key").select("row", "n", "pos", "name"))
    while True:
        finished.append(at.filter("n = 1").select("row", F.lit(level).alias("level"), "name"))
        pairs = (
            at.filter("n > 1")
            .groupBy("row", ((F.col("n") + 1) / 2).cast("int").alias("n"), F.floor(F.col("pos") / 2).alias("pos"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
            )
        )
        pairs = cut_lineage(pairs)
        if pairs.isEmpty():
            break
        names = _numbered(pairs.select("a", "b").distinct(), ["a", "b"], ["a", "b"])
        at = cut_lineage(pairs.join(names, ["a", "b"]).select("row", "n", "pos", "name"))
        level += 1
    named = cut_lineage(reduce(DataFrame.union, finished))
    return rows.select("row", "doc_id", "text_sha256").join(named, "row")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Equal texts are those that agree once runs of ASCII white space are one space. The row with the smallest id stays; null
    ids come last, and of rows that share the smallest id one stays. A group without any id has a null ``keep_id``.
    """
    named = cut_lineage(block_names(docs, id_col, text_col, block_chars))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    # combined before the shuffle; materialised, so that the join back can split a group with a third of all rows
    groups = cut_lineage(named.groupBy("level", "name").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size")))
    return named.join(groups, ["level", "name"]).select(
        "doc_id", F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )
