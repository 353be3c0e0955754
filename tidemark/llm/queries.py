"""The text operators as named queries, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe,
    decontamination,
    html_extract,
    lexical_search,
    licenses,
    line_dedup,
    ngram_join,
    personal_data,
    quality,
    repeated_spans,
    sharding,
    source_audit,
    url_filter,
)
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return quality.judged(table(spark, folder, "documents")).select(columns)


ORACLES["op2_quality_rules"] = quality.sql()


@query
def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract_text(table(spark, folder, "pages"))


@query
def op4_repeated_spans(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_spans.span_digests(table(spark, folder, "documents"))


@query
def op5_label_propagation(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, folder, "documents"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "linked"
    )


#: (verdict, host and start of the path)
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query
def op6_url_language_models(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"), URL_RULES)


@query
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.best_by_paragraph(licenses.license_matches(table(spark, folder, "documents")))


ORACLES["op7_license_scan"] = licenses.sql()


@query
def op8_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, folder, "documents"))


@query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.without_repeated_lines(table(spark, folder, "documents"), least_words=1)
    text = line_dedup.kept_text()
    return kept.select(
        "doc_id",
        "n_units",
        (F.col("n_units") - F.size("kept_units")).cast("long").alias("n_removed"),
        F.length(text).cast("long").alias("kept_chars"),
        F.sha2(text, 256).alias("kept_sha256"),
    )


ORACLES["op9_line_dedup"] = line_dedup.sql()


@query
def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query
def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.span_digests(table(spark, folder, "documents"))


@query
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.ranked_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLES["op12_lexical_search"] = lexical_search.sql()


@query
def op13_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.divergence(table(spark, folder, "documents"))


ORACLES["op13_source_audit"] = source_audit.sql()
