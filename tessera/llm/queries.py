"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (
    decontaminate, exact_dedup, html_extract, minhash, packing, periodic_runs, quality, resampling, sharding, simhash, tool_calls, toxicity,
    training_order,
)
from tessera.llm.common import read
from tessera.session import ensure_shared_dir


def _over(table: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_shared_dir(spark)
        return operator(read(spark, sf_dir, table))

    return query


def _labelled(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_shared_dir(spark)
        return operator(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))

    return query


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_shared_dir(spark)
    return decontaminate.op10_decontamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_shared_dir(spark)
    return resampling.op13_importance_resampling(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": _over("pages", html_extract.op1_html_extraction),
    "op2_best_fit_packing": _over("documents", packing.op2_best_fit_packing),
    "op3_training_order": _over("documents", training_order.op3_training_order),
    "op4_quality": _labelled(quality.op4_quality),
    "op5_sharding": _over("documents", sharding.op5_sharding),
    "op6_simhash_dedup": _over("documents", simhash.op6_simhash_dedup),
    "op7_exact_dedup": _over("documents", exact_dedup.op7_exact_dedup),
    "op8_tool_calls": _over("conversations", tool_calls.op8_tool_calls),
    "op9_toxicity": _labelled(toxicity.op9_toxicity),
    "op10_decontamination": _decontamination,
    "op11_minhash_dedup": _over("documents", minhash.op11_minhash_dedup),
    "op12_periodic_runs": _over("documents", periodic_runs.op12_periodic_runs),
    "op13_importance_resampling": _resampling,
}

ORACLES: dict[str, str] = {
    "op7_exact_dedup": exact_dedup.ORACLE_SQL,
    "op8_tool_calls": tool_calls.ORACLE_SQL,
    "op10_decontamination": decontaminate.ORACLE_SQL,
    "op13_importance_resampling": resampling.ORACLE_SQL,
}
