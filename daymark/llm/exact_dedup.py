"""Exact duplicates through a persistent digest index, bucketed and sorted by hash (operator 3).

Only DataFrame functions. The index keeps one row per distinct text: digest, the document that stays
and the number of copies. New documents are grouped by digest (copies combine before the shuffle),
joined against the index by a sort-merge anti-join and appended; neither side of that join is shuffled
again, because both are laid out by the index's buckets.

Defined cases: null text counts as empty, and empty texts are equal to each other. Of equal texts the
largest doc_id stays; a text that an earlier batch stored keeps the document stored then. Rows that
repeat both doc_id and text are one document that was delivered twice: decisions name its id, and
``keep_first`` returns one of the rows. A null doc_id ranks below every other. Empty input gives empty
output. Extra columns are never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm.frames import fresh, join_hot, parts, thin
from daymark.session import scratch_path


def digest(text) -> "F.Column":
    """Lowercase hex SHA-256 of the text's UTF-8 bytes; null counts as empty."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


class DigestIndex:
    """A table (text_sha256, keep_id, group_size) below ``path``; reopening the path goes on with it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path, self.buckets = spark, path, buckets or parts(spark)
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.name} (text_sha256 STRING, keep_id BIGINT, group_size BIGINT) USING parquet "
                  f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Action: add the texts that the index does not hold yet. Running it again changes nothing."""
        hashed = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                             digest(F.col(f"`{text_col}`")).alias("text_sha256"))
        groups = hashed.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        new = groups.join(self.table().hint("merge"), "text_sha256", "left_anti")
        (new.repartition(self.buckets, "text_sha256").select("text_sha256", "keep_id", "group_size")
         .write.insertInto(self.name))
        self.spark.catalog.refreshTable(self.name)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", index: DigestIndex | None = None) -> DataFrame:
    """Action: one row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Without an ``index`` a new one is made in the shared folder.
    """
    spark = docs.sparkSession
    index = index or DigestIndex(spark, scratch_path(spark, "digests"))
    index.append(docs, id_col, text_col)
    total = docs.count()
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), digest(F.col(f"`{text_col}`")).alias("text_sha256"))
    met = join_hot(rows, index.table(), "text_sha256", "group_size", total)
    return met.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", index: DigestIndex | None = None) -> DataFrame:
    """Action: the rows of ``docs`` whose document stays, each once, with all their columns."""
    spark = docs.sparkSession
    index = index or DigestIndex(spark, scratch_path(spark, "digests"))
    index.append(docs, id_col, text_col)
    # Copies of one text are told apart by their ids, so the join deals them over all tasks.
    key = fresh(docs, "_stays")
    of = lambda digests, ids: F.concat_ws(":", digests, F.coalesce(ids.cast("bigint").cast("string"), F.lit("null")))
    stays = index.table().select(of(F.col("text_sha256"), F.col("keep_id")).alias(key))
    marked = docs.withColumn(key, of(digest(F.col(f"`{text_col}`")), F.col(f"`{id_col}`")))
    return marked.join(stays, key, "left_semi").dropDuplicates([key]).drop(key)
