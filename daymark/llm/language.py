"""Language identification: multinomial naive Bayes over hashed character n-grams (operator 10).

Texts are lowercased, every run of non-letters becomes one boundary, and the bigrams and trigrams of what
is left are hashed into ``BUCKETS`` buckets. Training sums bucket counts per language over at most
``TRAIN_DOCS`` labelled documents of each language, picked by a hash of the id; counts are combined in
every task, then by a shuffle, and reach the driver as languages x BUCKETS numbers at most (64 KB a
language, which is also the proven bound of the broadcast). Scoring reads whole texts batch by batch in
numpy: sparse bucket ids per text, one gather per language, sums per text.

Defined cases: null texts and texts without letters are ``und`` with score 0; ties go to the first
language in alphabetical order; rows without a label or id train nothing, but are scored; a table
without labels gives ``und`` throughout; repeated rows are scored each; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.frames import crc_mod, fresh, thin

BUCKETS = 1 << 14
TRAIN_DOCS = 4000
FOLDS, HELD_OUT = 4, 2
CHUNK_CHARS = 2_000_000
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the bigram and of the trigram at each kept position (BUCKETS where there is none),
    the first position of each text, and the number of letters of each text."""
    wide = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(wide).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.zeros(len(wide), np.int64)
    first[1:] = np.cumsum([len(w) for w in wide])[:-1]
    letter = letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[first] = True
    start = np.concatenate([[0], np.cumsum(keep)])[first]
    is_letter = letter[keep]
    c = np.where(is_letter, codes[keep], 32).astype(np.uint32)
    n_letters = np.add.reduceat(is_letter.astype(np.int64), start)
    c1, c2 = np.append(c[1:], np.uint32(32)), np.append(c[2:], np.uint32([32, 32]))[:len(c)]
    l1, l2 = np.append(is_letter[1:], False), np.append(is_letter[2:], [False, False])[:len(c)]
    pair = c * np.uint32(0x9E3779B1) + c1 * np.uint32(0x85EBCA77)
    two, three = spread(pair), spread(pair + c2 * np.uint32(0xC2B2AE3D) + np.uint32(0x27D4EB2F))
    ok = is_letter | l1
    two[~ok] = BUCKETS
    three[~(ok & (l1 | l2))] = BUCKETS
    return two, three, start, n_letters


def spread(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint32(15))
    x = x * np.uint32(0x2C1B3C6D)
    return ((x ^ (x >> np.uint32(12))) * np.uint32(0x297A2D39) >> np.uint32(18)).astype(np.int32)


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK_CHARS characters; one longer text is a range of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def bucket_counts(labelled: DataFrame) -> DataFrame:
    """(lang, bucket, n) of a table (text, lang)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                two, three, start, _ = gram_buckets(texts[a:b])
                ends = np.append(start[1:], len(two))
                for lang, s, e in zip(langs[a:b], start, ends):
                    found = np.bincount(two[s:e], minlength=BUCKETS + 1) + np.bincount(three[s:e], minlength=BUCKETS + 1)
                    sums[lang] = sums.get(lang, 0) + found
        for lang, found in sums.items():
            bucket = np.flatnonzero(found[:BUCKETS])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(bucket), pa.string()), pa.array(bucket, pa.int32()),
                                              pa.array(found[bucket], pa.int64())], ["lang", "bucket", "n"])

    parts = labelled.mapInArrow(count, "lang string, bucket int, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", folds: int = FOLDS, held_out: int = HELD_OUT) -> tuple[list[str], np.ndarray]:
    """Action: languages in alphabetical order and log probabilities (language, bucket); the last bucket is empty.

    Learns from rows with text, language and an id outside the held-out fold, ``train_docs`` a language at most
    in expectation.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       F.col(f"`{lang_col}`").cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (crc_mod(F.col("doc_id"), folds) != held_out))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((0, BUCKETS + 1), np.float32)
    share = F.lit(0.0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, train_docs / sizes[lang]))).otherwise(share)
    picked = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 20)) < share * float(1 << 20))
    table = np.full((len(langs), BUCKETS + 1), 0.0)
    for r in bucket_counts(picked.select("text", "lang")).toLocalIterator():
        table[langs.index(r["lang"]), r["bucket"]] = r["n"]
    smooth = table[:, :BUCKETS] + 0.5
    table[:, :BUCKETS] = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    table[:, BUCKETS] = 0.0
    return langs, table.astype(np.float32)


def score_texts(texts: list[str | None], langs: list[str], table: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Predicted language and its posterior for whole texts."""
    plain = [t or "" for t in texts]
    pred, score = [], np.zeros(len(plain))
    for a, b in chunks(plain):
        two, three, start, n_letters = gram_buckets(plain[a:b])
        if not langs:
            pred += [UNKNOWN] * (b - a)
            continue
        ll = np.stack([np.add.reduceat(row[two] + row[three], start, dtype=np.float64) for row in table])
        best = ll.argmax(axis=0)
        posterior = 1.0 / np.exp(ll - ll.max(axis=0)).sum(axis=0)
        score[a:b] = np.where(n_letters > 0, posterior, 0.0)
        pred += [langs[i] if n else UNKNOWN for i, n in zip(best, n_letters)]
    return pred, score


def predict(docs: DataFrame, langs: list[str], table: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row."""
    model = docs.sparkSession.sparkContext.broadcast((langs, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = model.value
        for batch in batches:
            pred, score = score_texts(batch.column(1).to_pylist(), langs, table)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return thin(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Action (fits): doc_id, held_out, lang_pred, score for every row."""
    found = predict(docs, *fit(docs, train_docs))
    return found.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")


def keep_known(docs: DataFrame, lowest: float = 0.0, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Action (fits): the rows whose text has a language, with all their columns.

    Rejected are texts without letters and those whose best language scores below ``lowest``; without any
    language to learn, texts without letters alone.
    """
    langs, table = fit(docs, train_docs)
    if not langs:
        return docs.where(F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    model = docs.sparkSession.sparkContext.broadcast((langs, table))
    known = fresh(docs, "_known")

    @F.pandas_udf("boolean")
    def has_language(texts):
        import pandas as pd

        langs, table = model.value
        pred, score = score_texts([None if t is None else str(t) for t in texts], langs, table)
        return pd.Series([p != UNKNOWN and s >= lowest for p, s in zip(pred, score)])

    return docs.withColumn(known, has_language(F.col("text").cast("string"))).where(F.col(known)).drop(known)
