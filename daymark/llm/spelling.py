"""Grouping of spelling variants by k-d trees over letter counts (operator 12).

Two words are near if one inserted, deleted or replaced code point turns one into the other. An insertion
adds one letter to the word's letter counts, a replacement adds one and takes one away, so near words lie
at an L1 distance of at most two, one step up and one down. Letter counts are kept in unary: bit k of a
letter says whether the word has more than k of it. A split of the tree on one bit is a split of one
letter's count, the box of a subtree is the AND and the OR of its words, and the steps from a word to a box
are counted bits.

1. Runs of letters are counted in the tasks that read them, then over all documents.
2. Each length has a tree of its own: a bounded sample of words (``SAMPLE_WORDS`` in expectation, drawn by hash) places the splits, as many
   as the length's words need for cells of about ``CELL_WORDS``. Every word is dealt to its cell.
3. Every word searches the trees of its own length and of the next: boxes more than one step up or down
   are pruned, and it is sent to the cells left.
4. A cell's task builds a tree over the cell's words, searches it the same way, and compares the order of
   letters of what is left.
5. A word's form is its most frequent near word if that is at least ``RATIO`` times as frequent; forms are
   followed to the last by doubling.

All words are searched and compared: the sample only places the splits.

Defined cases: null and empty texts have no words; a null id counts as the empty string in ``<doc_id>:``;
repeated rows count each; of near words with equal n the smallest in code-point order is the form; empty
input gives empty output; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.frames import join_hot, parts, thin
from daymark.session import materialize

RUN = re.compile("[a-zÀ-ÿ]+")  # after lowering A-Z
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
SLIP = 97
SAMPLE_WORDS, CELL_WORDS, LEAF_WORDS = 100_000, 4096, 32
HELD_COUNTS, LONG_TEXT = 400_000, 4_000_000
QUERY_ROWS = 20_000
LETTERS, STEPS = 32, 4  # a to z and six classes for other letters; counts above STEPS look alike


def slipped(word: str, h: int) -> str:
    """The word without its code point h % length, where ``SLIP`` divides h."""
    if h % SLIP:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): how often each word of ``least_length`` code points or more stands in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                low = text.as_py().encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
                found = RUN.findall(low) if len(low) < LONG_TEXT else (m.group() for m in RUN.finditer(low))
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(found).items():
                    word = slipped(word, zlib.crc32(word.encode(), seed))
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) >= HELD_COUNTS:
                    yield out()
        yield out()

    return thin(docs, id_col, text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ---- letter counts and trees over them

def letter_masks(words: list[str]) -> np.ndarray:
    """Letter counts in unary, ``STEPS`` bits a letter, as two 64-bit integers a word."""
    sizes = np.array([len(w) for w in words])
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = (codes >= 97) & (codes <= 122)
    letter = np.where(plain, codes - 97, 26 + codes % 6).astype(np.int64)
    counts = np.bincount(np.repeat(np.arange(len(words)), sizes) * LETTERS + letter, minlength=len(words) * LETTERS).reshape(-1, LETTERS)
    bits = counts[:, :, None] > np.arange(STEPS)
    return np.packbits(bits.reshape(len(words), -1), axis=1).view(np.uint64)


ALL, NONE = np.full(2, ~np.uint64(0)), np.zeros(2, np.uint64)
#: Bits 0..k of the same letter as bit k, and bits k and above: what a set or a clear bit says of the others.
UPTO = np.packbits(np.array([[a // STEPS == b // STEPS and a <= b for a in range(128)] for b in range(128)]), axis=1).view(np.uint64)
FROM = np.packbits(np.array([[a // STEPS == b // STEPS and a >= b for a in range(128)] for b in range(128)]), axis=1).view(np.uint64)


class Tree:
    """A k-d tree over letter counts; ``leaves`` holds the rows of each leaf.

    With ``tight`` boxes a node's box is that of its own rows; without, it is the whole space between the
    splits, which then holds any word.
    """

    def __init__(self, masks: np.ndarray, leaf_rows: int, tight: bool):
        self.low, self.high, self.bit, self.below, self.leaf, self.leaves = [], [], [], [], [], []
        bits = np.unpackbits(masks.view(np.uint8).reshape(len(masks), 16), axis=1)
        todo = [(np.arange(len(masks)), NONE, ALL, -1, 0)]
        while todo:
            rows, low, high, parent, side = todo.pop()
            at = len(self.bit)
            if parent >= 0:
                self.below[parent][side] = at
            if tight and len(rows):
                low, high = np.bitwise_and.reduce(masks[rows]), np.bitwise_or.reduce(masks[rows])
            self.low.append(low)
            self.high.append(high)
            self.below.append([-1, -1])
            shares = bits[rows].sum(axis=0, dtype=np.int64) if len(rows) > leaf_rows else np.zeros(128, np.int64)
            best = int(np.argmax(np.minimum(shares, len(rows) - shares)))
            if not 0 < shares[best] < len(rows):  # small enough, or all rows alike
                self.bit.append(-1)
                self.leaf.append(len(self.leaves))
                self.leaves.append(rows)
                continue
            self.bit.append(best)
            self.leaf.append(-1)
            on = bits[rows, best] == 1
            todo.append((rows[on], low | UPTO[best], high, at, 1))
            todo.append((rows[~on], low, high & ~FROM[best], at, 0))

    def home(self, masks: np.ndarray) -> np.ndarray:
        """The leaf that each word belongs to."""
        out = np.zeros(len(masks), np.int64)
        bits = np.unpackbits(masks.view(np.uint8).reshape(len(masks), 16), axis=1)
        todo = [(0, np.arange(len(masks)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            on = bits[rows, self.bit[node]] == 1
            for side in (0, 1):
                if (on == side).any():
                    todo.append((self.below[node][side], rows[on == side]))
        return out

    def search(self, masks: np.ndarray, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``masks`` whose box-distance is one step up and ``down`` steps down at most)."""
        todo = [(0, np.arange(len(masks)))]
        while todo:
            node, rows = todo.pop()
            mine = masks[rows]
            rows = rows[within(self.low[node], self.high[node], mine, down)]
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                yield self.leaf[node], rows
            else:
                todo.extend((child, rows) for child in self.below[node])


def within(low: np.ndarray, high: np.ndarray, masks: np.ndarray, down: int) -> np.ndarray:
    """Whether one step up and ``down`` steps down can lead from each word into the box."""
    up_by = np.bitwise_count(low & ~masks).sum(axis=-1)
    down_by = np.bitwise_count(masks & ~high).sum(axis=-1)
    return (up_by <= 1) & (down_by <= down)


def code_points(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), length)


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether the rows, of one length or of ``long`` one more, differ by exactly one code point."""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(axis=1) == 1
    n = short.shape[1]
    ahead = np.logical_and.accumulate(short == long[:, :n], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= n


class Cells:
    """The top trees: which cell a word belongs to, and which cells it has to search."""

    def __init__(self, sample: list[str], lengths: dict[int, int], cell_words: int):
        self.trees: dict[int, tuple[int, Tree]] = {}
        by_length: dict[int, list[str]] = {}
        for word in sample:
            by_length.setdefault(len(word), []).append(word)
        first = 0
        for length, n in sorted(lengths.items()):
            words = by_length.get(length, [])
            if n > cell_words and words:
                tree = Tree(letter_masks(words), max(1, len(words) * cell_words // n), tight=False)
                self.trees[length] = first, tree
                first += len(tree.leaves)
                tree.leaves = []  # the sample's rows; only their places are needed

    def home(self, masks: np.ndarray, length: int) -> np.ndarray:
        if length not in self.trees:
            return np.full(len(masks), -length)  # one cell holds the whole length
        first, tree = self.trees[length]
        return first + tree.home(masks)

    def reach(self, masks: np.ndarray, length: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        if length not in self.trees:
            yield -length, np.arange(len(masks))
            return
        first, tree = self.trees[length]
        for leaf, rows in tree.search(masks, down):
            yield first + leaf, rows


#: Rows sent to a cell: its own words, words of its length from other cells, words one shorter.
OWN, SAME, SHORTER = 0, 1, 2
ROUTED = "cell long, kind int, word string, n long"
PAIRS = "a string, a_n long, b string, b_n long"


def near_pairs(vocabulary: DataFrame, sample_words: int = SAMPLE_WORDS, cell_words: int = CELL_WORDS) -> DataFrame:
    """Action (fits the trees): every unordered pair of near words of (word, n) once: a, a_n, b, b_n."""
    spark = vocabulary.sparkSession
    sizes = vocabulary.groupBy(F.length("word").alias("length")).count().where(F.col("count") > cell_words)
    lengths = {r["length"]: r["count"] for r in sizes.collect()}  # at most words / cell_words rows
    share = min(1.0, sample_words / max(1, vocabulary.count()))
    drawn = vocabulary.select("word").where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    sample = sorted(r["word"] for r in drawn.collect()) if lengths else []  # ``sample_words`` in expectation
    cells = spark.sparkContext.broadcast(Cells(sample, lengths, cell_words))  # a node a cell, words / cell_words of them

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.array(batch.column(0).to_pylist(), object)
            n = batch.column(1).to_numpy()
            if not len(words):
                continue
            size = np.array([len(w) for w in words])
            for length in np.unique(size).tolist():
                here = np.flatnonzero(size == length)
                masks = letter_masks(words[here].tolist())
                home = cells.value.home(masks, length)
                sent = [(home, np.full(len(here), OWN), here)]
                for kind, other, down in ((SAME, length, 1), (SHORTER, length + 1, 0)):
                    for cell, rows in cells.value.reach(masks, other, down):
                        rows = rows[home[rows] != cell] if kind == SAME else rows
                        sent.append((np.full(len(rows), cell), np.full(len(rows), kind), here[rows]))
                cell, kind, at = map(np.concatenate, zip(*sent))
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(kind, pa.int32()), pa.array(words[at], pa.string()),
                                                  pa.array(n[at], pa.int64())], ["cell", "kind", "word", "n"])

    dealt = vocabulary.mapInArrow(route, ROUTED).repartition(parts(spark), "cell")
    return dealt.sortWithinPartitions("cell", "kind").mapInArrow(within_cells, PAIRS)


class Cell:
    """One cell's words with the tree over them."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n, self.length = np.array(words, object), n, len(words[0])
        self.masks, self.codes = letter_masks(words), code_points(words, self.length)
        self.tree = Tree(self.masks, LEAF_WORDS, tight=True)

    def own_pairs(self) -> Iterator[pa.RecordBatch]:
        return self.pairs(self.words.tolist(), self.n, OWN)

    def pairs(self, words: list[str], n: np.ndarray, kind: int) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(words), QUERY_ROWS):
            yield from self.matched(words[start:start + QUERY_ROWS], n[start:start + QUERY_ROWS], kind)

    def matched(self, words: list[str], n: np.ndarray, kind: int) -> Iterator[pa.RecordBatch]:
        down = 0 if kind == SHORTER else 1
        masks, codes = letter_masks(words), code_points(words, len(words[0]))
        left, right = [], []
        for leaf, rows in self.tree.search(masks, down):
            mine = self.tree.leaves[leaf]
            box = self.masks[mine][None]
            q, p = np.nonzero(within(box, box, masks[rows][:, None], down))
            q, p = rows[q], mine[p]
            fits = one_edit(codes[q], self.codes[p])
            left.append(q[fits])
            right.append(p[fits])
        q, p = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (left, right))
        a, b = np.array(words, object)[q], self.words[p]
        once = a < b if kind != SHORTER else np.full(len(a), True)  # both words of one length find each other
        yield pa.RecordBatch.from_arrays([pa.array(a[once], pa.string()), pa.array(n[q][once], pa.int64()), pa.array(b[once], pa.string()),
                                          pa.array(self.n[p][once], pa.int64())], ["a", "a_n", "b", "b_n"])


def within_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell and kind to near pairs: a cell's own words are held, the others pass by."""
    at, own, cell = None, [], None
    for batch in batches:
        ids, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero((ids[1:] != ids[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)]):
            if a == b:
                continue
            if ids[a] != at:
                if own:
                    yield from Cell(*gathered(own)).own_pairs()
                at, own, cell = ids[a], [], None
            part = batch.slice(a, b - a)
            if kinds[a] == OWN:
                own.append(part)
                continue
            if cell is None and own:
                cell = Cell(*gathered(own))
                own = []
                yield from cell.own_pairs()
            if cell is not None:
                yield from cell.pairs(*gathered([part]), int(kinds[a]))
    if own:
        yield from Cell(*gathered(own)).own_pairs()


def gathered(batches: list[pa.RecordBatch]) -> tuple[list[str], np.ndarray]:
    return [w for b in batches for w in b.column(2).to_pylist()], np.concatenate([b.column(3).to_numpy() for b in batches])


# ---- forms

def last_forms(forms: DataFrame) -> DataFrame:
    """Action: (word, root): forms (word, form) followed to the last. A form is at least ``RATIO`` times as
    frequent as its word, so chains are logarithmic, and doubling needs the logarithm of that many rounds."""
    steps = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    total = steps.count()
    while True:
        held = steps.groupBy("root").agg(F.count(F.lit(1)).alias("weight"))
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next")).join(held, "root")
        moved = materialize(join_hot(steps, onward, "root", "weight", total).select("word", F.col("next").alias("root")), "moved")
        if moved.isEmpty():
            return steps
        steps = materialize(steps.join(moved.select("word", F.col("root").alias("next")), "word", "left")
                            .select("word", F.coalesce("next", "root").alias("root")), "forms")


def spelling_groups(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO,
                    sample_words: int = SAMPLE_WORDS, cell_words: int = CELL_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Action: one row per word: word, form, root, n, n_near, form_n."""
    counted = word_counts(docs, least_length, id_col, text_col).where(F.col("n") >= least_count)
    vocabulary = materialize(counted, "vocabulary")
    pairs = near_pairs(vocabulary, sample_words, cell_words)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("rank"), F.col("b").alias("near")).alias("best")),
        F.struct(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("rank"), F.col("a").alias("near")).alias("best")))).alias("s")).select("s.*")
    near = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best"))
    taken = -F.col("best.rank") >= ratio * F.col("n")
    words = materialize(vocabulary.join(near, "word", "left").select(
        "word", F.when(taken, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, -F.col("best.rank")).alias("form_n")), "words")
    roots = last_forms(words.where("form is not null").select("word", "form"))
    return words.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
