"""Shared steps: fresh names, written intermediate tables and joins on keys that may be hot."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.session import scratch_path

#: A key is hot when it holds more than 1/HOT_SHARE of the rows, so there are fewer than HOT_SHARE of them.
HOT_SHARE = 1024


def thin(docs: DataFrame, id_col: str = "doc_id", text_col: str | None = "text") -> DataFrame:
    """(doc_id, text) of any table of documents: other columns, whatever their names, are pruned."""
    cols = [F.col(f"`{id_col}`").cast("bigint").alias("doc_id")]
    if text_col is not None:
        cols.append(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return docs.select(*cols)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet, in any case."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base


def parts(spark: SparkSession) -> int:
    """Buckets and key partitions follow the shuffle width that the cluster sets for its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, key: str, purpose: str) -> DataFrame:
    """Action: write ``df`` once to the shared folder, bucketed and sorted by ``key``, and read it back.

    Later joins on ``key`` neither shuffle nor sort it again.
    """
    spark, n = df.sparkSession, parts(df.sparkSession)
    name = f"{purpose}_{uuid.uuid4().hex}"
    (df.repartition(n, key).write.format("parquet").bucketBy(n, key).sortBy(key)
     .option("path", scratch_path(spark, purpose)).saveAsTable(name))
    return spark.table(name)


def join_hot(rows: DataFrame, groups: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` to ``groups`` (one row per key, ``weight`` rows each) without a hot task.

    Keys with more than total / HOT_SHARE rows are fewer than HOT_SHARE, so they are broadcast; rows of
    the other keys meet in an ordinary shuffle, which then holds no key above that share.
    """
    limit = max(1, total // HOT_SHARE)
    hot = groups.where(F.col(weight) > limit)
    payload = [c for c in groups.columns if c != key]
    tagged = rows.join(F.broadcast(hot.select(F.col(key), F.struct(*payload).alias("_hot"))), key, "left")
    spread = F.xxhash64(*rows.columns).cast(dict(groups.dtypes)[key])  # hot rows have found theirs; deal them out
    cold_key = F.when(F.col("_hot").isNull(), F.col(key)).otherwise(spread)
    cold = groups.where(F.col(weight) <= limit).select(F.col(key).alias("_cold"), F.struct(*payload).alias("_group"))
    met = tagged.withColumn("_cold", cold_key).join(cold, "_cold", "left")
    found = F.coalesce(F.col("_hot"), F.when(F.col("_hot").isNull(), F.col("_group")))
    return (met.withColumn("_found", found).where(F.col("_found").isNotNull())
            .select(*[F.col(c) for c in rows.columns], *[F.col(f"_found.{c}").alias(c) for c in payload]))


def join_spread(rows: DataFrame, groups: DataFrame, key: str, counted: DataFrame) -> DataFrame:
    """Action (counts): inner join of ``rows`` to ``groups`` (one row per key), many rows of one key spread over tasks.

    ``counted`` is a written table with one row for each of ``rows`` and some of their columns. Keys with more than half a task's share of the rows are fewer than twice the shuffle width. Their group is
    copied once for every such half share and their rows are dealt over the copies; all others join as they are.
    """
    limit = max(1, counted.count() // (2 * parts(rows.sparkSession)))
    counts = counted.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    hot = F.broadcast(counts.select(key, F.ceil(F.col("_n") / limit).cast("int").alias("_copies")))
    cold = rows.join(hot, key, "left_anti").join(groups, key)
    dealt = rows.join(hot, key).withColumn("_copy", F.pmod(F.xxhash64(*counted.columns), F.col("_copies")).cast("int")).drop("_copies")
    copies = groups.join(hot, key).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop("_copies")
    met = dealt.join(copies.hint("shuffle_hash"), [key, "_copy"]).drop("_copy")
    return cold.unionByName(met)


def crc_mod(id_col: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; the folds of the labelled operators."""
    return F.crc32(id_col.cast("string").cast("binary")) % modulus
