"""The corpus pipeline: stages over documents, each written as Parquet and reread by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ferry.llm import decontaminate, lines, packing, simhash, toxicity
from ferry.llm.queries import tokenizer
from ferry.llm.tables import read, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as toxic go."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of equal and similar lines one line stays; documents stay, with the rest of their lines."""
    return lines.without_repeated_lines(docs, length="n_chars" if "n_chars" in docs.columns else None)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark windows go."""
    return decontaminate.without_documents(docs, read(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences."""
    return packing.packed(docs, tokenizer(spark))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: No stage with a trained model can be said in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
