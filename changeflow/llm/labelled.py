"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(id_col: str) -> Column:
    """Rows that no classifier learns from: CRC-32 of the id as text is a multiple of 5. A row without id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, label)`` of at most ``max_rows`` labelled documents, one row per id, the first in an order of hashed ids.

    Rows without label or id and held-out rows are left out; contradicting labels of one id count as the smaller. Of several
    rows with one id, the text with the smallest hash is taken; they are combined before the shuffle. The sample's ids are broadcast:
    their number is bounded by ``max_rows``.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label).cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(sample), "doc_id")
    # equal hashes are told apart by the text, so that every evaluation takes the same one
    first = joined.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "label")).alias("first"))
    return first.select("doc_id", "first.text", "first.label")
