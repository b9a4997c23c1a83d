"""A corpus from raw documents to token files; each stage is written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changeflow.llm.common import shared_folder, table
from changeflow.llm.decontaminate import without_contaminated
from changeflow.llm.mixing import curriculum
from changeflow.llm.near_dedup import without_near_duplicates
from changeflow.llm.token_store import read_index, write_tokens
from changeflow.llm.toxicity import fit_toxicity, without_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return without_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return without_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus in training order; a document stands there as often as the mix takes it."""
    return curriculum(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in ascending order of id; one row per document and copy, read back from the files."""
    import public_tokenizers

    path = shared_folder(spark, "token-ids")
    write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return read_index(spark, path)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
]

# classifiers and token files have no SQL; the stages are tested one by one against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
