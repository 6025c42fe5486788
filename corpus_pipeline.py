"""Corpus cleaning: five stages over ``documents``, each written as Parquet and read again by the next.

Toxic documents go; repeated multi-line passages go but for their first occurrence; of near copies the one with the smallest
id stays; documents that hold a benchmark item go; what is left is encoded. All stages but the last return the columns
of ``documents``; the last adds the ids. Null texts are empty throughout and pass all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from accountweave.llm import chunk_bpe, line_chunks, order_minhash, templates, weak_toxicity
from accountweave.llm.common import ship, small_batches
from accountweave.session import checkpoint_folder


def _ready(spark: SparkSession) -> None:
    """What stages with Python workers need."""
    ship(spark)
    small_batches(spark)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, by a model fitted to those of them that have labels."""
    _ready(spark)
    return weak_toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the repeats of multi-line passages."""
    return line_chunks.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    _ready(spark)
    return order_minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    _ready(spark)
    return templates.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Columns of ``docs``, with ``n_tokens`` and ``token_ids`` (ids as little-endian unsigned 32-bit integers)."""
    _ready(spark)
    return chunk_bpe.with_ids(docs)


#: Name and function of each stage, in order.
STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding", bpe),
]

#: SQL can't express the toxicity model; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = checkpoint_folder(spark, f"staged/pipeline-{uuid.uuid4().hex}")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
