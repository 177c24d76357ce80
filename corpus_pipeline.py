"""From raw documents to packed training sequences: each stage works on what its predecessor kept.

``STAGES`` run in order; each one's result is written as Parquet to the shared folder and read back. The
last stage returns packed pieces, the others the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daymark.llm import decontamination, exact_dedup, language, near_dedup, packing, queries
from daymark.session import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: texts without a language (no letters) go."""
    return language.keep_known(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of equal texts the largest doc_id stays."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each near-duplicate class the least doc_id stays."""
    return near_dedup.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold a benchmark item go."""
    return decontamination.drop_contaminated(docs, queries.read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: token pieces in sequences of 1,024."""
    return packing.pack_documents(docs, *queries.tokenizer_files())


STAGES = [("language", known_language), ("exact_dedup", exact_copies), ("near_dedup", near_copies),
          ("decontamination", benchmark_free), ("packing", packed)]

#: The language model and the signatures have no SQL form; tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Action: all stages over ``documents``."""
    docs = queries.read(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def register(all_queries: dict, all_oracles: dict) -> None:
    """Add the corpus queries and this pipeline to the driver's catalog."""
    all_queries.update(queries.QUERIES)
    all_oracles.update(queries.ORACLES)
    all_queries["pipeline"] = run
    if ORACLE_SQL is not None:
        all_oracles["pipeline"] = ORACLE_SQL
