"""First-fit-decreasing packing with a tournament tree, in randomised groups of documents (operator 9).

Documents become token ids (byte-level BPE of 50,257 ids, the vocabulary's added tokens included: a text
that holds one literally gets its id there) plus one end id, are cut at every ``size`` ids, and the pieces are dealt by a hash of (doc_id, start) into groups of about ``group_pieces`` pieces.
A group is packed by itself: pieces by falling length, each into the first sequence that still has room,
found by descending a tournament tree over the free room of the group's sequences. Full pieces take a
sequence each. Groups hold only lengths, never texts, and their number follows the number of pieces, so
no group grows with the data; a document of any length spreads over all groups.

Defined cases: null and empty texts are the end id alone; repeated rows are packed as often as they
appear (their pieces share doc_id and start); ties in length go by doc_id, start and checksum; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.frames import thin
from daymark.session import materialize

SIZE = 1024
END_ID = 0
GROUP_PIECES = 8192
MEMO_ENTRIES = 500_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
DEALT_TOGETHER = 64  # pieces


@lru_cache(maxsize=2)
def encoder(vocabulary: str, pattern: str):
    """The rank file as an encoder of byte pieces; added tokens are split off before it, in ``Encoder``."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def added_tokens(tokenizer: str) -> tuple[tuple[str, int], ...]:
    """(literal, id) of the added tokens of a ``tokenizers`` JSON file; only literals matched as they stand are known."""
    with open(tokenizer, encoding="utf-8") as file:
        whole = json.load(file)
    for t in whole["added_tokens"]:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or (t["normalized"] and whole["normalizer"]):
            raise ValueError(f"added token {t['content']!r} is not a plain literal")
    return tuple((t["content"], t["id"]) for t in whole["added_tokens"])


class Encoder:
    """Ids as little-endian uint32 bytes, remembering the ids of space-separated words.

    The pre-tokeniser never joins a space to what stands before it, so a text without two white-space
    characters in a row can be encoded word by word, each with its leading space. The memory is emptied
    when it holds ``MEMO_ENTRIES`` words. Added tokens cut the text first (the leftmost, then the longest
    one); each part between them is encoded as a text of its own, as ``tokenizers`` does.
    """

    double_space = re.compile(r"\s\s")

    def __init__(self, vocabulary: str, pattern: str, added: tuple[tuple[str, int], ...] = ()):
        self.encode, self.memo = encoder(vocabulary, pattern).encode_ordinary, {}
        self.added = {literal: np.array([i], dtype="<u4").tobytes() for literal, i in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.literals = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None

    def __call__(self, text: str) -> bytes:
        if not any(literal in text for literal in self.added):
            return self.plain(text)
        parts = self.literals.split(text)  # every second part is a literal
        return b"".join(self.added[part] if i % 2 else self.plain(part) for i, part in enumerate(parts))

    def plain(self, text: str) -> bytes:
        words = text.split(" ")
        if len(words) < 3 or self.double_space.search(text):
            return self.fresh(text)
        memo = self.memo
        tail = words[1:]
        missing = set(tail).difference(memo)
        if len(memo) + len(missing) > MEMO_ENTRIES:
            memo.clear()
            missing = set(tail)
        for word in missing:
            memo[word] = self.fresh(" " + word)
        return self.fresh(words[0]) + b"".join(map(memo.__getitem__, tail))

    def fresh(self, text: str) -> bytes:
        return np.array(self.encode(text), dtype="<u4").tobytes()


@lru_cache(maxsize=1)
def shared_encoder(vocabulary: str, pattern: str, added: tuple[tuple[str, int], ...] = ()) -> Encoder:
    return Encoder(vocabulary, pattern, added)  # a Python worker keeps its memory from task to task


def cut_pieces(docs: DataFrame, vocabulary: str, pattern: str, added: tuple[tuple[str, int], ...] = (), size: int = SIZE,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, and ``deal``, the number its group is drawn by.

    Pieces of one document share that number, those of a long document per ``DEALT_TOGETHER`` pieces. It is drawn
    from the place of the row among the rows read, so rows with one id, or none, are dealt like any others.
    """
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, row = shared_encoder(vocabulary, pattern, added), TaskContext.get().partitionId(), 0
        for batch in batches:
            out = ([], [], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                n, row = len(ids) // 4, row + 1
                for start in range(0, n, size):
                    piece = ids[4 * start:4 * (start + size)]
                    deal = zlib.crc32(f"{task}:{row}:{start // (size * DEALT_TOGETHER)}".encode())
                    for column, value in zip(out, (doc_id, start, len(piece) // 4, zlib.crc32(piece), n, deal)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "deal"])

    return thin(docs, id_col, text_col).mapInArrow(cut, PIECES + ", deal long")


class Tournament:
    """Free room of sequences 0..n-1 as leaves; every inner node holds the larger of its two children."""

    def __init__(self, n: int, room: int):
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.best = [room] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """Put ``length`` into the first leaf with room for it; returns the leaf and its room before."""
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < length:
                node += 1
        before = best[node]
        best[node] = before - length
        leaf = node - self.leaves
        while node > 1:
            node //= 2
            best[node] = max(best[2 * node], best[2 * node + 1])
        return leaf, before


def first_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, the pieces taken in the given order."""
    tree = Tournament(len(lengths), size)
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        where[i], before = tree.place(length)
        offset[i] = size - before
    return where, offset


def pack(pieces: DataFrame, size: int = SIZE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Action (counts the pieces): each piece with sequence_id and offset, gapless from 0."""
    groups = max(1, -(-pieces.count() // group_pieces))

    def pack_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        where, offset = first_fit(rows["length"].to_numpy(), size)
        return rows.assign(sequence_id=(int(key[0]) << 32) + where, offset=offset)[
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]].astype({"doc_id": "Int64"})

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("deal", F.lit("pack")), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(pack_group, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, pattern: str, added: tuple[tuple[str, int], ...] = (), size: int = SIZE,
                   group_pieces: int = GROUP_PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Action: the pieces are written once to the shared folder, then packed."""
    pieces = materialize(cut_pieces(docs, vocabulary, pattern, added, size, id_col, text_col), "pieces")
    return pack(pieces, size, group_pieces)
