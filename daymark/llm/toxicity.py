"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text (operator 4).

Folding lowercases, maps homoglyphs to Latin letters, reads digits and signs between letters as the
letters they stand for, and turns every run of other characters into one blank. The lexicon holds whole
words and word beginnings (for languages that compound): those that separate the labelled training
documents, each weighted by its smoothed log odds. Exception phrases are a term with its neighbour word
that training shows in clean documents; a match of one blocks the terms inside it. The score is a
logistic function of the summed weights, as they are and per square root of the number of words, fitted
on the same documents.

Training reads a bounded sample: at most ``TOXIC_DOCS`` toxic and ``CLEAN_DOCS`` clean labelled
documents in expectation, picked by a hash of the id outside the held-out fold, and a lexicon of at most
``MAX_TERMS`` terms. The sample's ids are bounded by these parameters and so broadcast. Scoring reads
every whole text once.

Fixed values: the homoglyph and substitution tables.

Defined cases: null and empty texts, and texts without letters, score as a document without any term; a
document with contradicting labels counts as toxic; without both kinds of label every score is 0; rows
with a null id are scored, never trained on; repeated rows are scored each; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.frames import crc_mod, thin

TOXIC_DOCS, CLEAN_DOCS, MAX_TERMS = 4000, 8000, 4000
FOLDS, HELD_OUT, CUTOFF = 3, 1, 0.7
PREFIXES = (4, 5, 6, 7)
LEAST_DOCS, LEAST_ODDS = 8, 2.5

# Look-alike letters, and signs read as letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ⅼ": "l", "ⅰ": "i",
}
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Folded code point of every code point (32 for what is no letter), and the letters signs stand for."""
    size = 0x110000
    fold = np.full(size, 32, np.uint32)
    alpha = np.fromiter((chr(i).isalpha() for i in range(size)), bool, size)
    fold[alpha] = np.flatnonzero(alpha)
    for i in np.flatnonzero(alpha[:0x3000]).tolist() + list(range(0xFF21, 0xFF5B)):
        low = chr(i).lower()
        fold[i] = ord(low) if len(low) == 1 else i
    for i in range(0xFF41, 0xFF5B):  # full-width letters
        fold[i] = fold[i - 32] = i - 0xFF41 + ord("a")
    for look, letter in HOMOGLYPHS.items():
        fold[fold == ord(look)] = ord(letter)
    signs = np.zeros(size, np.uint32)
    for sign, letter in SUBSTITUTIONS.items():
        signs[ord(sign)] = ord(letter)
    return fold, signs


def folded(text: str) -> tuple[str, int]:
    """Folded text between blanks, one blank between words; and the number of words."""
    fold, signs = tables()
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    out = fold[codes]
    sign = signs[codes]
    at = np.flatnonzero(sign)
    if len(at):
        letter = out != 32
        inside = at[(letter[at - 1] | (sign[at - 1] > 0)) & letter[at + 1] | letter[at - 1] & (sign[at + 1] > 0)]
        out = out.copy()
        out[inside] = sign[inside]
    keep = out != 32
    keep[1:] |= out[:-1] != 32
    keep[0] = True
    out = out[keep]
    blanks = int(np.count_nonzero(out == 32))
    if out[-1] != 32:
        out = np.append(out, np.uint32(32))
        blanks += 1
    return out.tobytes().decode("utf-32-le", "surrogatepass"), max(0, blanks - 1)


@dataclass
class Lexicon:
    """Terms with weights (a leading blank starts a word, a trailing one ends it), blocked phrases, logistic terms."""

    weights: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    logistic: tuple[float, float, float] = (-30.0, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term in self.weights:
            found.add_word(term, (term, True))
        for phrase in self.exceptions:
            found.add_word(phrase, (phrase, False))
        if len(found):
            found.make_automaton()
        return found


def hits(text: str, automaton) -> list[tuple[int, int, str]]:
    """Leftmost-longest terms outside exception phrases, as (start, end, term)."""
    if not len(automaton):
        return []
    found, blocked = [], []
    for end, (term, counts) in automaton.iter(text):
        (found if counts else blocked).append((end + 1 - len(term), end + 1, term))
    if not found:
        return []
    out, reach = [], -1
    for start, end, term in sorted(found, key=lambda h: (h[0], -h[1])):
        if start >= reach and not any(b[0] <= start and end <= b[1] for b in blocked):
            out.append((start, end, term))
            reach = end - term.endswith(" ")
    return out


def evidence(text: str, lexicon: Lexicon, automaton) -> tuple[float, float]:
    """Summed weights of the text's distinct terms, as they are and per square root of its words."""
    plain, n_words = folded(text)
    total = sum(lexicon.weights[t] for t in {h[2] for h in hits(plain, automaton)})
    return total, total / math.sqrt(max(1, n_words))


def probability(seen: tuple[float, float], logistic: tuple[float, float, float]) -> float:
    z = logistic[0] + logistic[1] * seen[0] + logistic[2] * seen[1]
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def word_terms(plain: str) -> set[str]:
    """Distinct whole words and word beginnings of a folded text."""
    words = set(plain.split())
    terms = {f" {w} " for w in words}
    for n in PREFIXES:
        terms |= {f" {w[:n]}" for w in words if len(w) > n}
    return terms


def sample_of(docs: DataFrame, labels: DataFrame, toxic_docs: int, clean_docs: int) -> DataFrame:
    """(doc_id, text, toxic) of the training sample; its ids are bounded, so they are broadcast."""
    marked = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}  # two rows
    share = F.when(F.col("toxic") == 1, min(1.0, toxic_docs / max(1, sizes.get(1, 0)))).otherwise(min(1.0, clean_docs / max(1, sizes.get(0, 0))))
    ids = marked.where(F.pmod(F.xxhash64("doc_id", F.lit("lexicon")), F.lit(1 << 20)) < share * float(1 << 20))
    return thin(docs).join(F.broadcast(ids), "doc_id")


def term_counts(sample: DataFrame, per_doc) -> DataFrame:
    """(term, toxic, clean): documents with the term, combined in each task before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                sums[toxic].update(per_doc(folded(text.as_py())[0]))
        terms = list(sums[0].keys() | sums[1].keys())
        for i in range(0, len(terms), 50_000):
            some = terms[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([sums[1][t] for t in some], pa.int64()),
                                              pa.array([sums[0][t] for t in some], pa.int64())], ["term", "toxic", "clean"])

    counted = sample.select("text", "toxic").mapInArrow(count, "term string, toxic long, clean long")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS,
        max_terms: int = MAX_TERMS) -> Lexicon:
    """Action: learn terms, weights, exceptions and the logistic terms from the training sample."""
    from daymark.session import materialize

    sample = materialize(sample_of(docs, labels, toxic_docs, clean_docs), "lexicon")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}  # two rows
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Lexicon({})
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    ranked = (term_counts(sample, word_terms).where(F.col("toxic") >= min(LEAST_DOCS, max(2, toxic // 50)))
              .withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
              .orderBy((F.col("odds") * F.sqrt("toxic")).desc(), "term").limit(max_terms))
    lexicon = Lexicon({r["term"]: float(r["odds"]) for r in ranked.collect()})  # bounded by max_terms
    lexicon.exceptions = learn_exceptions(sample, lexicon, max_terms)
    model = sample.sparkSession.sparkContext.broadcast(lexicon)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = model.value
        automaton = lexicon.automaton()
        for batch in batches:
            seen = [evidence(t.as_py(), lexicon, automaton) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([s[0] for s in seen], pa.float64()), pa.array([s[1] for s in seen], pa.float64()),
                                              batch.column(1)], ["a", "b", "toxic"])

    rows = sample.select("text", "toxic").mapInArrow(measure, "a double, b double, toxic int").collect()  # the bounded sample
    x = np.array([(1.0, r["a"], r["b"]) for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    lexicon.logistic = tuple(ridge_logistic(x, y).tolist())
    return lexicon


def learn_exceptions(sample: DataFrame, lexicon: Lexicon, most: int) -> frozenset[str]:
    """A term with its neighbour word, where at least five clean documents hold the phrase and hardly a toxic one."""
    model = sample.sparkSession.sparkContext.broadcast(lexicon)

    def phrases(plain: str) -> set[str]:
        lexicon = model.value
        if not hasattr(lexicon, "_automaton"):
            lexicon._automaton = lexicon.automaton()
        out = set()
        for start, end, _ in hits(plain, lexicon._automaton):
            word_end = plain.find(" ", max(start + 1, end - 1))
            before = plain.rfind(" ", 0, start) if start else -1
            after = plain.find(" ", word_end + 1)
            if before >= 0:
                out.add(plain[before:word_end + 1])
            if after >= 0:
                out.add(plain[start:after + 1])
        return out

    found = term_counts(sample, phrases).where((F.col("clean") >= 5) & (F.col("clean") >= 10 * F.col("toxic")))
    return frozenset(r["term"] for r in found.orderBy(F.col("clean").desc(), "term").limit(most).collect())


def ridge_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Logistic coefficients by Newton steps with a small quadratic penalty."""
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - penalty * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(beta)), grad)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def score_documents(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    model = docs.sparkSession.sparkContext.broadcast(lexicon)  # bounded by MAX_TERMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = model.value
        automaton = lexicon.automaton()
        for batch in batches:
            score = [probability(evidence(t.as_py(), lexicon, automaton), lexicon.logistic) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    scored = thin(docs).mapInArrow(run, "doc_id long, score double")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Action (fits): the scores of all documents by a lexicon learned from the labels."""
    return score_documents(docs, fit(docs, labels))
