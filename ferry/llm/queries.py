"""The registered queries of the operators, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ferry.llm import (
    alignment, decontaminate, extraction, language_model, lines, merkle, packing, personal, quality, sharding, simhash, toxicity, urls,
)
from ferry.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


def tokenizer(spark: SparkSession) -> str:
    """The vocabulary file of the packing queries; ``spark.ferry.tokenizer`` names another."""
    named = spark.conf.get("spark.ferry.tokenizer", None)
    return named or public_tokenizers.path("word_bpe_49k.json")


def vocabularies(spark: SparkSession) -> tuple[str, str]:
    """The two vocabulary files of the alignment query; ``spark.ferry.byte_tokenizer`` and ``spark.ferry.piece_tokenizer`` name others."""
    named = (spark.conf.get(f"spark.ferry.{kind}_tokenizer", None) for kind in ("byte", "piece"))
    return tuple(a or public_tokenizers.path(b) for a, b in zip(named, ("byte_bpe_50k.json", "piece_bpe_32k.model")))


@query()
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(read(spark, sf_dir, "documents"), ["doc_id", "source", "lang"], 40)


@query()
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extraction.extract(read(spark, sf_dir, "pages"))
    return pages.select("row.page_id", "row.url", "text", "n_chars")


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query()
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = lines.deduplicated(read(spark, sf_dir, "documents"))
    return edited.select("row.doc_id", "text", "n_lines", "n_removed")


@query()
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents"), tokenizer(spark))


@query()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.report(read(spark, sf_dir, "documents"))


@query(decontaminate.SQL)
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query()
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.report(read(spark, sf_dir, "documents"))


@query()
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query(urls.SQL)
def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.report(read(spark, sf_dir, "pages"))


@query(merkle.SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(read(spark, sf_dir, "documents"))


@query()
def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(read(spark, sf_dir, "documents"), *vocabularies(spark))
