"""SentencePiece encoding and decoding for merge-type vocabularies (operator 13).

A text starts as its characters, blanks written as ``MARK`` and one ``MARK`` put in front. An agenda, a heap
ordered by piece score and then by place from the left, holds every adjacent pair of symbols that together
are a piece of the vocabulary. The best pair is merged, its neighbours join the agenda, and pairs that lost
a side to an earlier merge are passed over when they come up. What is left is looked up; a symbol without
a piece becomes the pieces of its UTF-8 bytes.

No piece holds another character before a ``MARK``, and some characters are in no longer piece at all, so no
merge crosses those places: each stretch between them has an agenda of its own, and stretches met before are
read from a memo of bounded size. New stretches of one length are worked off together: their agendas are the rows
of one array, a column a pair, and the top of each is taken at every step. Long stretches have a heap.
``encode_documents`` works in Arrow batches and, on request, has the library encode the same batch and raises
where the ids or the decoded texts differ.

Memory: a text is read in parts of about ``PART_CHARS``; only a stretch without any blank is held whole by
one agenda, at some 300 bytes a character.

Defined cases: null counts as empty, which encodes as the begin and end ids and decodes as empty; ``MARK`` in
a text encodes like a blank and decodes as one, as in the library; names of control pieces in a text are
ordinary text; repeated rows and rows with null ids give a row each; empty input gives empty output; extra
columns are not read. Models with user-defined or unused pieces, a character map or another algorithm
than merges are refused with a ``ValueError``.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daymark.llm.frames import thin

MARK = "▁"
PART_CHARS = 1 << 20
MEMO_ENTRIES, MEMO_CHARS = 600_000, 32
GROUP_CHARS = 2_000_000
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
IDS = "doc_id long, ids array<int>"


class PieceModel:
    """The pieces of one model file, and encoding and decoding with them."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = proto.ModelProto.SentencePiece
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("only merge-type vocabularies without user-defined or unused pieces")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only models that keep characters and white space as they are and mark the beginning")
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.order = {p.piece: -p.score for p in model.pieces if p.type == kinds.NORMAL and len(p.piece) > 1}
        self.byte_ids = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.begin, self.end = (next(i for i, p in enumerate(model.pieces) if p.piece == name) for name in ("<s>", "</s>"))
        shown = {kinds.NORMAL: lambda p: p.piece.replace(MARK, " ").encode(), kinds.BYTE: lambda p: bytes([int(p.piece[3:-1], 16)]),
                 kinds.UNKNOWN: lambda p: model.trainer_spec.unk_surface.encode(), kinds.CONTROL: lambda p: b""}
        self.shown = [shown[p.type](p) for p in model.pieces]
        self.is_byte = [p.type == kinds.BYTE for p in model.pieces]
        self.hidden = [i for i, p in enumerate(model.pieces) if p.type == kinds.CONTROL]
        self.marked = [p.type == kinds.NORMAL and p.piece.startswith(MARK) for p in model.pieces]
        if any(MARK in piece.lstrip(MARK) for piece in self.order):
            raise ValueError("a piece holds a blank after another character")
        joined = re.escape("".join(sorted({c for piece in self.order for c in piece} - {MARK})))
        self.stretches = re.compile(f"{MARK}*[{joined}]+|{MARK}+|[^{joined}{MARK}]+").findall
        self.memo: dict[str, bytes] = {}
        self.fit_pairs()

    def fit_pairs(self) -> None:
        """Every pair of symbols that together are a piece: sorted keys, the piece's symbol and its order."""
        singles = sorted({c for piece in self.order for c in piece} - self.ids.keys())
        self.symbols = {**self.ids, **{c: max(self.ids.values()) + 1 + i for i, c in enumerate(singles)}}
        self.last, other = max(self.ids.values()), max(self.symbols.values()) + 1  # ``other``: all further characters
        self.width = other + 1
        self.code_symbol = np.full(0x110000, other, np.int32)
        for piece, at in self.symbols.items():
            if len(piece) == 1:
                self.code_symbol[ord(piece)] = at
        found = [(self.symbols[piece[:k]] * self.width + self.symbols[piece[k:]], at, self.order[piece])
                 for piece, at in self.ids.items() for k in range(1, len(piece)) if piece[:k] in self.symbols and piece[k:] in self.symbols]
        keys, made, order = (np.array(v) for v in zip(*sorted(found)))
        self.pair_keys, self.pair_made, self.pair_order = keys.astype(np.int64), made.astype(np.int32), order.astype(np.float64)

    def looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, order) of the pieces that pairs of symbols make; the order is infinite where they make none."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_made[at], -1), np.where(hit, self.pair_order[at], np.inf)

    def merged_rows(self, stretches: list[str]) -> np.ndarray:
        """The symbols left of stretches of one length, a row each, filled up with -1: one agenda a row.

        Column k of the agendas is the pair of the symbols k and k + 1. The least order, leftmost of equals, is
        the top; merging it closes up the row and changes the two pairs beside it.
        """
        n, length = len(stretches), len(stretches[0])
        codes = np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32).reshape(n, length)
        symbols = self.code_symbol[codes]
        made, order = self.looked_up(symbols[:, :-1], symbols[:, 1:])
        out = np.full((n, length), -1, np.int32)
        rows = np.arange(n)
        while len(rows) and symbols.shape[1] > 1:
            top = order.argmin(axis=1)
            here = np.arange(len(rows))
            on = np.isfinite(order[here, top])
            out[rows[~on], :symbols.shape[1]] = symbols[~on]
            rows, symbols, made, order, top = rows[on], symbols[on], made[on], order[on], top[on]
            here = np.arange(len(rows))
            width = symbols.shape[1]
            symbols[here, top] = made[here, top]
            # Close up: the right symbol and one pair go, and every row is one shorter.
            symbols = np.take_along_axis(symbols, np.arange(width - 1) + (np.arange(width - 1) > top[:, None]), axis=1)
            close = np.arange(width - 2) + (np.arange(width - 2) >= top[:, None])
            made, order = (np.take_along_axis(v, close, axis=1) for v in (made, order))
            for side, fits in ((top - 1, top > 0), (top, top < width - 2)):
                r, at = here[fits], side[fits]
                made[r, at], order[r, at] = self.looked_up(symbols[r, at], symbols[r, at + 1])
        out[rows, :symbols.shape[1]] = symbols
        return out

    def learn(self, stretches: set[str]) -> dict[str, bytes]:
        """The ids of stretches that the memo lacks: short ones are added to it, the others are returned."""
        by_length: dict[int, list[str]] = {}
        for stretch in stretches:
            by_length.setdefault(len(stretch), []).append(stretch)
        passing = {}
        for length, some in by_length.items():
            if length > MEMO_CHARS:
                passing.update((s, self.stretch_ids(s)) for s in some)
                continue
            for start in range(0, len(some), 50_000):
                part = some[start:start + 50_000]
                left = self.merged_rows(part)
                sizes, plain = (left >= 0).sum(axis=1).tolist(), (left <= self.last).all(axis=1).tolist()
                packed, step = left.astype("<i4").tobytes(), 4 * length
                for i, stretch in enumerate(part):
                    self.memo[stretch] = packed[i * step:i * step + 4 * sizes[i]] if plain[i] else self.stretch_ids(stretch)
        return passing

    def merged(self, stretch: str) -> list[str]:
        """The symbols left when the agenda is empty."""
        symbols, size, order = list(stretch), len(stretch), self.order
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        agenda = []
        for left in range(size - 1):
            piece = stretch[left:left + 2]
            if piece in order:
                agenda.append((order[piece], left, left + 1, piece))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            # A side merged away is empty; one that grew makes the pair longer than the piece.
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(piece):
                continue
            symbols[left], symbols[right] = piece, ""
            follower, leader = after[right], before[left]
            after[left] = follower
            if follower < size:
                before[follower] = left
                longer = piece + symbols[follower]
                if longer in order:
                    heapq.heappush(agenda, (order[longer], left, follower, longer))
            if leader >= 0:
                longer = symbols[leader] + piece
                if longer in order:
                    heapq.heappush(agenda, (order[longer], leader, left, longer))
        return [s for s in symbols if s]

    def stretch_ids(self, stretch: str) -> bytes:
        """Ids of one stretch, little-endian 32 bits each."""
        known, ids = self.ids, []
        for symbol in self.merged(stretch):
            at = known.get(symbol)
            if at is not None:
                ids.append(at)
            elif self.byte_ids:
                ids.extend(self.byte_ids[b] for b in symbol.encode("utf-8"))
            else:
                ids.append(self.unknown)
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """All ids of a text, with the begin and end ids."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text; new stretches of some ``GROUP_CHARS`` characters are worked off together."""
        found: list[list[bytes]] = [[] for _ in texts]
        group, held = [], 0
        for i, text in enumerate(texts):
            for part in parts_of(text):
                group.append((i, self.stretches(part)))
                held += len(part)
                if held >= GROUP_CHARS:
                    self.work_off(group, found)
                    group, held = [], 0
        self.work_off(group, found)
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        return [np.frombuffer(b"".join([begin, *parts, end]), "<u4") for parts in found]

    def work_off(self, group: list[tuple[int, list[str]]], found: list[list[bytes]]) -> None:
        seen = set().union(*(stretches for _, stretches in group))
        if len(self.memo) + len(seen) > MEMO_ENTRIES:
            self.memo.clear()  # bounds the memory of a worker; results do not depend on it
        passing, memo = self.learn(seen.difference(self.memo)), self.memo
        for i, stretches in group:
            found[i].append(b"".join([memo.get(s) or passing[s] for s in stretches]))

    def decode(self, ids: Sequence[int] | np.ndarray) -> str:
        """The text of any ids; bytes that form no character give one replacement character each."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        raw = b"".join(map(self.shown.__getitem__, ids))
        first = next((i for i in ids if self.shown[i]), None)
        at = 1 if first is not None and self.marked[first] else 0
        inner = ids[1:-1]
        if not any(i in inner for i in self.hidden):  # a control piece parts the bytes around it
            try:
                return raw[at:].decode("utf-8")
            except UnicodeDecodeError:
                pass
        return self.decode_runs(ids)[at:]

    def decode_runs(self, ids: list[int]) -> str:
        out, run = [], b""
        for i in ids:
            if self.is_byte[i]:
                run += self.shown[i]
                continue
            out += [replaced(run), self.shown[i].decode()]
            run = b""
        return "".join([*out, replaced(run)])


def replaced(run: bytes) -> str:
    """UTF-8 with one replacement character for each byte that belongs to no character."""
    out = []
    while run:
        for n in (1, 2, 3, 4):
            try:
                out.append(run[:n].decode("utf-8"))
                run = run[n:]
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            run = run[1:]
    return "".join(out)


def parts_of(text: str) -> Iterator[str]:
    """The marked text, cut before blanks that follow another character; empty texts have no part."""
    start, n = 0, len(text)
    while start < n:
        end = n
        if n - start > PART_CHARS:
            at = text.find(" ", start + PART_CHARS)
            while at > 0 and text[at - 1] in (" ", MARK):
                at = text.find(" ", at + 1)
            end = at if at > 0 else n
        part = text[start:end].replace(" ", MARK)
        yield part if start else MARK + part
        start = end


@lru_cache(maxsize=2)
def model_at(path: str) -> PieceModel:
    """One model and memo a worker, whatever number of tasks it runs."""
    return PieceModel(path)


@lru_cache(maxsize=2)
def library_at(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def checked(path: str, ids: list[np.ndarray], decoded: list[str], texts: list[str]) -> None:
    """Raise unless the library gives the same ids and decoded texts for this batch."""
    library = library_at(path)
    for mine, shown, text, its in zip(ids, decoded, texts, library.encode(texts, add_bos=True, add_eos=True, num_threads=1)):
        if mine.tolist() != its or library.decode(its) != shown:
            raise ValueError(f"encoding differs from the library at a text that starts with {text[:60]!r}")


def encode_documents(docs: DataFrame, path: str, check: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row: the whole encoding, begin and end ids included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = model.encode_all(texts)
            if check:
                checked(path, ids, [model.decode(i) for i in ids], texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return thin(docs, id_col, text_col).mapInArrow(run, IDS)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of a table (doc_id, ids); null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(path)
        for batch in batches:
            texts = [model.decode(i or ()) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encoding_digests(docs: DataFrame, path: str, check: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = model.encode_all(texts)
            decoded = [model.decode(i) for i in ids]
            if check:
                checked(path, ids, decoded, texts)
            digests = [[hashlib.sha256(b).hexdigest() for b in bs] for bs in ([i.tobytes() for i in ids], [d.encode("utf-8") for d in decoded])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(i) for i in ids], pa.int64()),
                                              *(pa.array(d, pa.string()) for d in digests)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return thin(docs, id_col, text_col).mapInArrow(run, RESULT)
