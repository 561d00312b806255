"""Training corpus pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. Its result is
written as Parquet in the shared scratch folder and read again as the next
stage's documents, so a lost executor costs at most one stage. All stages but
the last return the columns of ``documents``. The stages that exchange whole
texts set the session so that a finished write or action leaves no exchange files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from papertriage.llm import bestfit_pack, decontaminate, exact_dedup, jaccard_join, language_id
from papertriage.llm.common import drop_exchanges, read
from papertriage.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or in no recognisable language go."""
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    drop_exchanges(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similarity (80 percent of their
    shingles of five words, the rule of the stages) one stays."""
    drop_exchanges(spark)
    return jaccard_join.keep_representatives(docs, threshold=80, words=5)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaked(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, packed into sequences."""
    return bestfit_pack.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("bestfit_pack", pack_sequences),
]

# language ID is a trained network, which SQL does not express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read(spark, sf_dir, "documents")
    base = scratch_path(spark, f"corpus-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
