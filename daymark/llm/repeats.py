"""Removal of repeated byte strings through a prefix-free parse of the corpus (operator 8).

A byte goes if a ``LENGTH``-byte string over it also starts earlier: in a smaller doc_id, or further ahead
in the same document. The corpus is parsed as in prefix-free parsing: a rolling hash over ``GRAM`` bytes
sets triggers where it is least among ``REACH`` neighbours, so equal stretches are cut alike wherever
they stand. Every ``LENGTH``-byte string belongs to one phrase: the one whose trigger is the first least
among its leading ``REACH`` grams. A phrase is a run of such strings with the same trigger, and its
dictionary entry is the fingerprint of all bytes its strings cover.

1. Phrases are dealt by the fingerprint of the ``KEY`` bytes at their trigger, which equal strings share,
   and sorted by (trigger, entry, document, start): the corpus order of the dictionary. Phrases with a
   trigger seen once are done. Of equal entries all but the first go whole.
2. Only where one trigger has several entries, the bytes of each entry's first phrase meet at the trigger,
   their strings are fingerprinted and sorted, and all but the first of equal strings go.

Sorting entries and strings by 64-bit fingerprint takes the place of the two suffix arrays: only equality
of ``LENGTH`` bytes and the order of documents matter, not the alphabet's order, and sorted fingerprints
can be dealt over tasks, which one suffix array of the parse cannot.

Hot phrases are settled before the shuffle: of equal entries in one block of a task only the first moves
on, so a passage in a third of all documents sends one row per block. A trigger with many entries sends its
phrases straight to step 2, behind one mark per block, and there as fingerprints of single strings, settled
by block in the same way. Texts travel compressed.

Defined cases: null text counts as empty; documents shorter than ``LENGTH`` bytes keep all bytes; rows
that repeat doc_id and text are one document and both get its result; rows of one doc_id with different
texts are different documents, ordered among themselves by the SHA-256 of their text; null ids come before
all others; empty input gives empty output; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.frames import join_hot, parts, thin
from daymark.llm.near_dedup import mix, ranges
from daymark.operators.ordered import numbered, with_written_range
from daymark.session import materialize

LENGTH = 100
REACH = 72
KEY = LENGTH - REACH + 1
GRAM = 16
CHUNK_BYTES = 4_000_000
BLOCK_ROWS = 400_000
HOT_ENTRIES = 64
WIDE_ENTRIES = 1000
NULL_ID = -(1 << 63)
#: Kinds of rows: decided to go, to be compared by string, to be sorted, mark of a hot trigger; open and hot.
GONE, OPEN, TO_SORT, MARK, WIDE = 0, 1, 2, 3, 4
#: The two low bits of an entry are the row's kind; a span holds the first string start above the last.
ROWS = "key long, entry long, doc long, span long, context binary"
MARKS = "doc long, span long, kind int"
LOW = np.int64((1 << 32) - 1)
BASE = np.uint64(0x5851F42D4C957F2D)


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(n, BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


BYTE = mix(np.arange(1, 257, dtype=np.uint64))


class Rolling:
    """Fingerprints of any stretch of a byte array, from one running sum."""

    def __init__(self, flat: np.ndarray):
        up, self.down = powers(1 << max(22, int(len(flat)).bit_length()))
        self.sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(BYTE[flat] * up[:len(flat)], out=self.sums[1:])

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.empty(0, np.uint64)


def phrases(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Phrases of all strings of the texts: key, entry, text number, first and last string start."""
    empty = (np.empty(0, np.uint64), np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3)))
    flat = np.frombuffer(b"".join(texts), np.uint8)
    if len(flat) < LENGTH:
        return empty
    roll = Rolling(flat)
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes) - sizes
    grams = roll.all(GRAM)
    place = np.uint64(len(grams).bit_length())
    least = (grams >> place << place) | np.arange(len(grams), dtype=np.uint64)  # least hash, then leftmost
    width = 1
    while width < REACH:
        step = min(width, REACH - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    n = len(flat) - LENGTH + 1
    trigger = (least[:n] & ((np.uint64(1) << place) - np.uint64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.maximum(0, sizes - LENGTH + 1))
    start = np.concatenate([np.arange(b, b + s - LENGTH + 1) for b, s in zip(begin, sizes) if s >= LENGTH] or [np.empty(0, np.int64)])
    if not len(start):
        return empty
    mine = trigger[start]
    new = np.concatenate([[True], (mine[1:] != mine[:-1]) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    key = roll.at(mine[first], mine[first] + KEY)
    entry = mix(roll.at(start[first], start[last] + LENGTH) + (mine[first] - start[first]).astype(np.uint64))
    return key, entry, owner[first], start[first] - begin[owner[first]], start[last] - begin[owner[first]]


def settle(key, entry, doc, first, last, split_hot: bool) -> Iterator[pa.RecordBatch]:
    """One block of rows: what is decided here, and what must meet other blocks."""
    order = np.lexsort((first, doc, entry, key))
    key, entry, doc, first, last = (v[order] for v in (key, entry, doc, first, last))
    kind = np.full(len(key), TO_SORT, np.int32)
    repeat, _ = repeated(key, entry, doc, first)
    kind[repeat] = GONE
    same = np.concatenate([[False], (key[1:] == key[:-1]) & (entry[1:] == entry[:-1])])
    twin = same & ~repeat  # the same document delivered twice
    if split_hot:
        heads = np.concatenate([[True], key[1:] != key[:-1]])
        run = np.cumsum(heads) - 1
        entries = np.bincount(run, ~same)
        hot = (entries > HOT_ENTRIES)[run]
        kind[hot & (kind == TO_SORT)] = OPEN
        marks = np.flatnonzero(hot & heads)
    else:
        marks = np.empty(0, np.int64)
    places = np.flatnonzero(~twin & (kind == GONE))
    doc_gone, first_gone, last_gone = join_up(doc[places], first[places], last[places])
    rest = np.concatenate([np.flatnonzero(~twin & (kind != GONE)), marks])
    kinds = np.concatenate([np.full(len(doc_gone), GONE), kind[rest[:len(rest) - len(marks)]], np.full(len(marks), MARK)])
    doc, first, last = (np.concatenate([g, v[rest]]) for g, v in ((doc_gone, doc), (first_gone, first), (last_gone, last)))
    spread = mix(doc.astype(np.uint64))
    key = np.where(kinds < TO_SORT, spread, np.concatenate([spread[:len(doc_gone)], key[rest]]))
    entry = np.where(kinds == TO_SORT, np.concatenate([spread[:len(doc_gone)], entry[rest]]), np.uint64(0))
    entry = entry >> np.uint64(2) << np.uint64(2) | kinds.astype(np.uint64)
    yield row_batch(key, entry, doc, first, last, None)


def row_batch(key, entry, doc, first, last, contexts: list[bytes] | None) -> pa.RecordBatch:
    context = pa.nulls(len(key), pa.binary()) if contexts is None else pa.array(contexts, pa.binary())
    span = first.astype(np.int64) << 32 | last.astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(entry.view(np.int64)), pa.array(doc, pa.int64()),
                                       pa.array(span, pa.int64()), context], ["key", "entry", "doc", "span", "context"])


def join_up(doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of one document that follow each other become one."""
    if not len(doc):
        return doc, first, last
    order = np.lexsort((first, doc))
    doc, first, last = doc[order], first[order], last[order]
    reach = last + 1
    head = np.concatenate([[True], (doc[1:] != doc[:-1]) | (first[1:] != reach[:-1])])
    at = np.flatnonzero(head)
    return doc[at], first[at], last[np.append(at[1:], len(doc)) - 1]


def repeated(key, entry, doc, first) -> tuple[np.ndarray, np.ndarray]:
    """In sorted rows: whether an earlier place has the same key and entry, and the head of each such run."""
    head = np.concatenate([[True], (key[1:] != key[:-1]) | (entry[1:] != entry[:-1])]) if len(key) else np.empty(0, bool)
    lead = np.maximum.accumulate(np.where(head, np.arange(len(key)), 0)) if len(key) else np.empty(0, np.int64)
    return (doc != doc[lead]) | (first != first[lead]), head


def in_blocks(found: Iterator[tuple[np.ndarray, ...]], split_hot: bool) -> Iterator[pa.RecordBatch]:
    block, size = [], 0
    for rows in found:
        block.append(rows)
        size += len(rows[0])
        if size >= BLOCK_ROWS:
            yield from settle(*map(np.concatenate, zip(*block)), split_hot)
            block, size = [], 0
    if size:
        yield from settle(*map(np.concatenate, zip(*block)), split_hot)


def placed(rows: DataFrame) -> DataFrame:
    """(doc, doc_id, text): ``doc`` is one number per distinct (doc_id, text), growing with doc_id.

    With unique ids, counted first over ids alone, the id is that number. Otherwise all distinct pairs of id
    and text digest are numbered in order (null ids first).
    """
    unique = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col("doc_id").isNull()).isEmpty()
    if unique:
        return rows.select(F.col("doc_id").alias("doc"), "doc_id", "text")
    keyed = rows.withColumn("id", F.coalesce("doc_id", F.lit(NULL_ID))).withColumn("digest", F.sha2("text", 256))
    pairs = keyed.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("copies"))
    spread = with_written_range(pairs, ["id", "digest"], "part")
    number = numbered(spread, ["id", "digest"], F.col("part"), out="doc").select(
        F.concat_ws(":", "id", "digest").alias("pair"), "doc", "copies")
    keyed = keyed.select("doc_id", "text", F.concat_ws(":", "id", "digest").alias("pair"))
    total = int(number.agg(F.sum("copies")).first()[0])
    return materialize(join_hot(keyed, materialize(number, "numbers"), "pair", "copies", total).select("doc", "doc_id", "text"), "placed")


def bytes_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (doc, text) to settled phrase rows."""
    def rows():
        for batch in batches:
            doc, texts = batch.column(0).to_numpy(), [bytes_of(t) for t in batch.column(1).to_pylist()]
            for a, b in ranges([len(t) for t in texts], CHUNK_BYTES):
                key, entry, owner, first, last = phrases(texts[a:b])
                yield key, entry, doc[a:b][owner], first, last

    yield from in_blocks(rows(), split_hot=True)


def pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [packer.compress(bytes_of(t.as_py())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), batch.column(2)], ["doc", "packed", "doc_id"])


def unpacked(column: pa.Array) -> Iterator[bytes]:
    reader = zstandard.ZstdDecompressor()
    return (reader.decompress(p.as_py()) for p in column)


def reopen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (doc, packed, spans, wide) to rows: the bytes of open phrases at their trigger, and settled strings."""
    wide = []

    def wide_rows():
        while wide:
            yield wide.pop()

    for batch in batches:
        for doc, raw, spans, wide_spans in zip(batch.column(0).to_pylist(), unpacked(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if spans:
                at = np.array(spans, np.int64)
                first, last = at >> 32, at & LOW
                fits = last + LENGTH <= len(raw)
                first, last = first[fits], last[fits]
                if len(first):
                    yield row_batch(trigger_keys(raw, first), np.full(len(first), OPEN, np.uint64), np.full(len(first), doc), first, last,
                                    [raw[f:e + LENGTH] for f, e in zip(first.tolist(), last.tolist())])
            if wide_spans:
                start = np.unique(np.concatenate([np.arange(w >> 32, (w & int(LOW)) + 1) for w in wide_spans]))
                start = start[start + LENGTH <= len(raw)]
                if len(start):
                    prints = Rolling(np.frombuffer(raw, np.uint8)).at(start, start + LENGTH)
                    wide.append((prints, prints, np.full(len(start), doc), start, start))
        if sum(len(w[0]) for w in wide) >= BLOCK_ROWS:
            yield from in_blocks(wide_rows(), split_hot=False)
    yield from in_blocks(wide_rows(), split_hot=False)


def trigger_keys(raw: bytes, first: np.ndarray) -> np.ndarray:
    """The keys that ``phrases`` gave the phrases starting at ``first``."""
    key, _, _, starts, _ = phrases([raw])
    return key[np.searchsorted(starts, first)]


def sort_out(rows: DataFrame) -> DataFrame:
    """(doc, span, kind) of what goes and what stays open, from settled rows of all blocks."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            keys = held.column(0).to_numpy()
            other = np.flatnonzero(keys != keys[-1])  # the last key may go on in the next batch
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from judge(held.slice(0, cut))
                held = held.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield from judge(held)

    def judge(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        key, entry, doc, span = (rows.column(i).to_numpy() for i in range(4))
        kind, first, last = entry & 3, span >> 32, span & LOW
        context = rows.column(4)
        held = ~context.is_null().to_numpy()
        if held.any():
            yield from compare(doc[held], first[held], context.filter(pa.array(held)).to_pylist())
        gone, head = repeated(key, entry, doc, first)
        run = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
        sorting = kind == TO_SORT
        entries = np.bincount(run, head & sorting)[run]
        marked = (np.bincount(run, kind == MARK) > 0)[run]
        is_open = np.where(marked | (entries > WIDE_ENTRIES), WIDE, np.where(entries > 1, OPEN, -1))
        out = np.where(sorting, np.where(gone, GONE, is_open), np.where(kind == OPEN, WIDE, np.where(kind == MARK, -1, kind)))
        yield marks_batch(doc, first, last, out, (out >= 0) & ~held)

    def compare(doc: np.ndarray, first: np.ndarray, contexts: list[bytes]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(c) for c in contexts])
        ends = np.cumsum(sizes)
        count = sizes - LENGTH + 1
        owner = np.repeat(np.arange(len(sizes)), count)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        start = (ends - sizes)[owner] + inner
        prints = Rolling(np.frombuffer(b"".join(contexts), np.uint8)).at(start, start + LENGTH)
        doc, first = doc[owner], first[owner] + inner
        order = np.lexsort((first, doc, prints))
        prints, doc, first = prints[order], doc[order], first[order]
        gone, _ = repeated(prints, prints, doc, first)
        doc, first, last = join_up(doc[gone], first[gone], first[gone])
        yield marks_batch(doc, first, last, np.full(len(doc), GONE), np.ones(len(doc), bool))

    def marks_batch(doc, first, last, kind, keep) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc[keep], pa.int64()), pa.array((first << 32 | last)[keep], pa.int64()),
                                           pa.array(kind[keep], pa.int32())], ["doc", "span", "kind"])

    dealt = rows.repartition(parts(rows.sparkSession), "key")
    return dealt.sortWithinPartitions("key", "entry", "doc", "span").mapInArrow(scan, MARKS)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Action: one row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return finish(docs, id_col, text_col, "n_bytes long, n_removed long, n_spans long, kept_sha256 string",
                  lambda raw, spans, kept: (len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Action: (doc_id, text) without the removed bytes; a character cut in two is dropped."""
    return finish(docs, id_col, text_col, "text string", lambda raw, spans, kept: (kept.decode("utf-8", "ignore"),))


def finish(docs: DataFrame, id_col: str, text_col: str, schema: str, result) -> DataFrame:
    rows = placed(thin(docs, id_col, text_col))
    marks = materialize(sort_out(rows.select("doc", "text").mapInArrow(parse, ROWS)), "marks")
    packed = rows.select("doc", "text", "doc_id").mapInArrow(pack_texts, "doc long, packed binary, doc_id long")
    # Lists of spans are bounded by the length of their document.
    spans_of = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.col("span")))
    still = marks.where(F.col("kind") != GONE).groupBy("doc").agg(spans_of(OPEN).alias("spans"), spans_of(WIDE).alias("wide"))
    met = sort_out(packed.join(still, "doc").select("doc", "packed", "spans", "wide").mapInArrow(reopen, ROWS))
    gone = marks.unionByName(met).where(F.col("kind") == GONE).groupBy("doc").agg(F.collect_list("span").alias("spans"))
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in schema.split(", ")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, spans in zip(unpacked(batch.column(1)), batch.column(2).to_pylist()):
                edge = np.zeros(len(raw) + 1, np.int64)
                at = np.array(spans or (), np.int64)
                np.add.at(edge, np.minimum(len(raw), at >> 32), 1)
                np.add.at(edge, np.minimum(len(raw), (at & LOW) + LENGTH), -1)
                covered = np.cumsum(edge)[:-1] > 0
                runs = int(np.count_nonzero(covered[1:] & ~covered[:-1]) + (len(raw) > 0 and covered[0])) if len(raw) else 0
                kept = np.frombuffer(raw, np.uint8)[~covered].tobytes() if runs else raw
                out.append(result(raw, runs, kept))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([o[i] for o in out], k) for i, k in enumerate(kinds))], ["doc_id", *names])

    return packed.join(gone, "doc", "left").select("doc_id", "packed", "spans").mapInArrow(apply, "doc_id long, " + schema)
