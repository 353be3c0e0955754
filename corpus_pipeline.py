"""From raw documents to encoded ones: five stages, each a text operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``.  What a stage decides takes effect:

1. documents that the quality rules reject go;
2. of each group of near copies, the document with the smallest id stays;
3. bytes that lie in a string of 200 found twice are cut out (a document may be
   left without text, and stays);
4. documents that hold a benchmark item go;
5. what is left is encoded.

No SQL expresses stages 2 to 5; tests compare each with a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, decontamination, ngram_join, quality, repeated_spans
from tidemark.llm.common import stored, table

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.without_near_copies(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = repeated_spans.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the bytes they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("benchmark decontamination", benchmark_leaks),
    ("byte-level BPE", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
