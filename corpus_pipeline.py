"""The corpus pipeline: documents become packed training sequences in five stages.

Each stage gets all rows its predecessor kept, as Parquet read again; all but the last return the
columns of documents.  The first stage learns from the labels of the documents it gets; rows whose
crc32(doc_id) mod 3 is 1 are never learnt from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from tessera.llm.common import read
from tessera.session import ensure_shared_dir, fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored 0.7 or more go."""
    ensure_shared_dir(spark)
    return toxicity.rejected_out(docs, read(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    ensure_shared_dir(spark)
    return exact_dedup.deduplicated(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by fingerprints at most 3 bits apart the one with the least id stays."""
    ensure_shared_dir(spark)
    return simhash.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside benchmark passages are cut out; documents of nothing else go."""
    ensure_shared_dir(spark)
    return decontaminate.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    ensure_shared_dir(spark)
    return packing.packed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("simhash_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Learnt scores, fingerprints and the packing have no SQL form; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all rows its predecessor kept; each result is written and read again."""
    ensure_shared_dir(spark)
    docs = read(spark, sf_dir, "documents")
    base = fresh_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
