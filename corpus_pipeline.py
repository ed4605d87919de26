"""The corpus pipeline: language, near duplicates, benchmark leaks, source mix, token file.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.  ``run`` applies the
stages to ``documents``, each result written to the shared folder and read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surge.llm import decontaminate, language, mixing, ngram_join, tokens
from surge.llm.queries import vocabulary_file
from surge.llm.staging import staged


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null, letterless and alien texts go."""
    model = language.fit(docs, "text", "lang", "doc_id")
    return language.identify(docs, model).where(~F.col("rejected")).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.8."""
    return ngram_join.keep_one(docs, k=5, num=80, den=100)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that holds an item of ``benchmark``."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.apply_mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file set of the mixed corpus, read back: one row per document and copy."""
    return tokens.token_file_round_trip(docs, vocabulary_file(), end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_identified),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("source_mix", mix_sources),
    ("token_output", write_tokens),
]

#: The stages use trained models, exact set joins and a tokenizer: no SQL twin; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
