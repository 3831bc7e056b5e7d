"""From raw documents to packed training sequences, in five stages.

Each stage works on all documents its predecessor kept. All but the last return the columns of
``documents``. Between stages the documents are a Parquet table in the shared folder, so a lost executor
costs at most the stage that runs.

NULLs, repeated rows and ties, in every stage: a NULL text counts as empty; a row without a doc_id cannot be
told from others and stays as it is; rows of one doc_id are one document, so what is decided of it holds for
all of them, and a row that occurs several times stays as often; nothing depends on the order of rows, and
of equals the least doc_id, then the earlier line counts. Empty tables give empty results. Further columns
pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import benchmark, documents, labels, stored
from tidemark.llm.decontamination import without_benchmark
from tidemark.llm.jaccard_join import one_of_each_group
from tidemark.llm.line_dedup import without_repeated_lines
from tidemark.llm.packing import pack
from tidemark.llm.quality_rank import good_documents


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose pairwise-ranking score is below the threshold go; an empty text scores as one."""
    return good_documents(docs, labels(spark, sf_dir))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier in the corpus go, from 8 words on up to one word; all documents stay."""
    return without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the least doc_id stays; texts without words are in none."""
    return one_of_each_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, whatever its id; texts without words hold none."""
    return without_benchmark(docs, benchmark(spark, sf_dir))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of what is left, with their place in sequences of 2048 tokens; an empty text is one token."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: A learned ranking and a tokeniser are beyond SQL; tests/llm/test_pipeline.py checks every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
