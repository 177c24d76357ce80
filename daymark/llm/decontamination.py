"""Benchmark decontamination by size-partitioned MinHash containment search (operator 2).

Only DataFrame functions. Texts are lowercased and cut into words (digits, letters and characters outside
ASCII); a shingle is five words in a row, hashed to 64 bits. Items are partitioned by size, one partition
per power of two of their number of shingles. An item's sketch is its k shingles of least hash, where k
is set by its partition so that a document that holds a share ``THRESHOLD`` of the item's shingles must
hold one of them: a document may miss at most n - ceil(THRESHOLD n) of n shingles, and k is one more than
that for the largest n of the partition. Documents are searched at their full length, since a small set
inside a large one has no Jaccard similarity to hash for; partitions whose items need more shingles than
the document has are skipped. Candidates are then verified by exact containment of their shingles.

The sketches are written first, so Spark knows their size: it broadcasts them while they are small and
falls back to a shuffle join, which splits skewed shingles, when they are not.

Defined cases: null and empty texts, and texts without words, match nothing; an item or document shorter
than five words is one shingle of all its words; repeated item rows are one item (their shingles unite),
repeated document rows are one document; null ids match nothing; empty input gives empty output; extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.frames import fresh, thin
from daymark.session import materialize

WORDS, THRESHOLD = 5, 0.8
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), GAPS), "")


def shingle_hashes(words_col: str) -> Column:
    """All five-word shingles of the array column, in order, as 64-bit hashes."""
    w = F.col(words_col)
    long_text = F.transform(F.slice(w, 1, F.greatest(F.size(w) - (WORDS - 1), F.lit(0))),
                            lambda first, i: F.xxhash64(first, *[F.get(w, i + k) for k in range(1, WORDS)]))
    return F.when(F.size(w) >= WORDS, long_text).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))


def once(df: DataFrame, name: str, value: Column, *others: str) -> DataFrame:
    """``value`` as a column that is computed once a row: the one-element generator stops the optimiser from
    copying its expression into every place, and every turn of a lambda, that reads it."""
    return df.select(*others, F.explode(F.array(value)).alias(name))


def shingled(texts: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """(name, grams) with the shingles of every text that has an id."""
    rows = thin(texts, id_col, text_col).where(F.col("doc_id").isNotNull()).withColumnRenamed("doc_id", name)
    return once(once(rows, "words", words(F.col("text")), name), "grams", shingle_hashes("words"), name)


def item_shingles(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, gram, n): the distinct shingles of each item and their number."""
    grams = shingled(items, id_col, text_col, "item_id").select("item_id", F.explode("grams").alias("gram")).distinct()
    return grams.join(grams.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")), "item_id")


def sketches(shingles: DataFrame, threshold: float) -> DataFrame:
    """(gram, item_id, least): each item's k shingles of least hash; ``least`` is the fewest shingles a match needs."""
    from pyspark.sql import Window

    part = F.floor(F.log2("n"))
    largest = F.pow(F.lit(2.0), part + 1) - 1
    k = F.floor(largest * (1 - threshold) + 1e-9) + 1
    least = F.ceil(F.pow(F.lit(2.0), part) * threshold - 1e-9)
    ranked = shingles.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(F.xxhash64("gram", F.lit(1)), "gram")))
    return ranked.where(F.col("rank") <= k).select("gram", "item_id", least.cast("int").alias("least"))


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", doc_text: str = "text",
              item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Action: (item_id, doc_id, shared, item_shingles, containment) of every item and document at or above ``threshold``."""
    known = materialize(item_shingles(items, item_id, item_text), "items")
    sketch = materialize(sketches(known, threshold), "sketches")
    found = shingled(docs, doc_id, doc_text, "doc_id")
    probes = found.withColumn("size", F.size("grams")).select("doc_id", "size", F.explode("grams").alias("gram"))
    candidates = materialize(probes.join(sketch, "gram").where("size >= least").select("doc_id", "item_id").distinct(), "candidates")
    again = shingled(docs.join(candidates.select(F.col("doc_id").alias("_candidate")).distinct(),
                               F.col(f"`{doc_id}`").cast("bigint") == F.col("_candidate"), "left_semi"), doc_id, doc_text, "doc_id")
    held = again.select("doc_id", F.explode(F.array_distinct("grams")).alias("gram")).join(known, "gram")
    shared = held.groupBy("doc_id", "item_id", "n").agg(F.countDistinct("gram").alias("shared"))
    exact = shared.join(candidates, ["doc_id", "item_id"], "left_semi")
    return (exact.where(F.col("shared") >= threshold * F.col("n") - 1e-9)
            .select("item_id", "doc_id", "shared", F.col("n").alias("item_shingles"), (F.col("shared") / F.col("n")).alias("containment")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Action: the rows whose text holds no item, with all their columns."""
    bad = fresh(docs, "_holds_item")
    found = contained(docs, items, doc_id=id_col, doc_text=text_col).select(F.col("doc_id").alias(bad)).distinct()
    return docs.join(found, docs[f"`{id_col}`"].cast("bigint") == found[bad], "left_anti")
