"""One query per operator over the shared test tables, read whole; ``SQL`` has
the same rows as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    chat_render,
    decontaminate,
    importance_resampling,
    pu_quality,
    rule_ledger,
    secret_ledger,
    source_audit,
    source_mix,
    substring_repeats,
    url_filter,
)
from tidemark.llm.balanced_shards import balanced_shards
from tidemark.llm.html_text import extract_text
from tidemark.llm.minmax_dedup import near_duplicates
from tidemark.llm.oracle import SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, url_filter.train(pages)).select(
        "page_id", "host", "path", "rule", "verdict", "score"
    )


def op2_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    cases = chat_render.with_control_case(spark, conversations)
    return chat_render.read_back(chat_render.turn_spans(cases))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op5_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pu_quality.score(docs, pu_quality.train(docs, _table(spark, sf_dir, "labels")))


def op6_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = rule_ledger.ledger(_table(spark, sf_dir, "documents"))
    return rule_ledger.verdict(entries)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_repeats.digest(
        substring_repeats.cut_repeats(_table(spark, sf_dir, "documents"))
    )


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return decontaminate.digest(found)


def op10_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(_table(spark, sf_dir, "documents")).drop("text_id")


def op11_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return secret_ledger.digest(
        secret_ledger.findings(documents, secret_ledger.scan(documents))
    )


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(_table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


__all__ = ["QUERIES", "SQL"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_minmax_near_dedup,
        op3_chat_render,
        op4_html_text,
        op5_pu_quality,
        op6_rule_ledger,
        op7_substring_dedup,
        op8_source_mix,
        op9_decontaminate,
        op10_balanced_shards,
        op11_secret_ledger,
        op12_source_audit,
        op13_importance_resampling,
    )
}
