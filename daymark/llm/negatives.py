"""Hard-negative mining on lists that anchors of one cluster share (operator 11).

Vectors are quantised to integers, so scores are exact inner products. Anchors are clustered by direction;
a cluster's centre and the widest angle of its members bound, for every candidate, the score that any
member can have with it: norm x cos(max(0, angle to the centre - widest angle)). Per cluster the candidates
are sorted by that bound once; every member walks the list until the bound of what is left certifies that
nothing after it can enter its result. Two walks are made: one for the positives, the best rows of the
anchor's label, and one for the negatives, the best rows of other labels in the score window of each positive.

The rows are dealt into blocks, packed as arrays; a task holds one block and the anchors stream past it,
cluster by cluster, so a block's list is sorted once a cluster. The best of each block meet in a window over
at most k rows a block. Anchors times blocks are moved, never rows times anchors.

Clusters are fitted on a sample of ``SAMPLE`` anchors in expectation, drawn by hash; every anchor belongs to one, and every row is in a list. A
bound is exact whatever the centres are, so clusters decide the work alone.

Defined cases: rows with a null id, a null label, a null vector, a null or non-finite component (or one that
leaves the range of doubles when scaled) take no part; of rows that share an id one takes part, that
of the largest (label, vector), so repeated rows count once; vectors of different lengths are compared as if
zeros followed the shorter; an anchor without positives or without rows in a window gives no rows; ties
go to the smaller id; scores that doubles cannot hold are compared as Python integers, beyond 64 bits they are
returned (and windows are set) as the nearest long; empty input gives empty output; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from daymark.llm.frames import parts
from daymark.session import materialize

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, OF = 30, 90, 100  # the window: LOW * positive <= OF * negative <= HIGH * positive
SAMPLE, CLUSTERS, ROUNDS = 8192, 64, 8
PACK_ROWS, LEAST_BLOCK, MOST_BLOCK = 2048, 4096, 1 << 19
GROUP_ANCHORS = 512
FIRST_STEP, LAST_STEP = 256, 4096
EXACT = 2.0 ** 52
SLACK = 1e-9

BLOCKS = "block long, kind int, cluster int, widest double, ids binary, labels binary, size int, vectors binary, slots binary"
FOUND = "anchor_id long, slot_id long, slot_score long, other_id long, score long"


# ---- quantised rows

def taking_part(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, vector) of the rows that take part; the vector in doubles, not scaled yet."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < float("inf")))
    plain = rows.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").cast("bigint").alias("label"), vector.alias("vector"))
    plain = plain.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & sound)
    return plain.groupBy("id").agg(F.max(F.struct("label", "vector")).alias("row")).select("id", "row.*")


def quantised(vectors: list[np.ndarray]) -> np.ndarray:
    """Scaled and floored components as doubles, zeros after the shorter vectors."""
    out = np.zeros((len(vectors), max((len(v) for v in vectors), default=0)))
    for row, v in zip(out, vectors):
        row[:len(v)] = np.floor(SCALE * np.asarray(v, np.float64))
    return out


def widened(*tables: np.ndarray) -> list[np.ndarray]:
    width = max(t.shape[1] for t in tables)
    return [t if t.shape[1] == width else np.pad(t, ((0, 0), (0, width - t.shape[1]))) for t in tables]


def norms_of(vectors: np.ndarray) -> np.ndarray:
    """Lengths, safe for components of any size."""
    top = np.abs(vectors).max(axis=1, initial=0.0)
    scale = np.where(top > 0, top, 1.0)
    return np.sqrt(((vectors / scale[:, None]) ** 2).sum(axis=1)) * scale


def directions(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; zero vectors stay zero."""
    top = np.abs(vectors).max(axis=1, initial=0.0, keepdims=True)
    unit = vectors / np.where(top > 0, top, 1.0)
    length = np.linalg.norm(unit, axis=1, keepdims=True)
    return unit / np.where(length > 0, length, 1.0)


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products: by doubles where they hold them exactly, else by Python's integers."""
    if exact:
        return a @ b.T
    whole = lambda t: np.array([[int(x) for x in row] for row in t], object).reshape(t.shape)
    return whole(a) @ whole(b).T


# ---- clusters of anchors

def centres_of(sample: np.ndarray, clusters: int) -> np.ndarray:
    """Unit centres by spherical k-means from evenly spaced rows of the sample."""
    unit = directions(sample)
    unit = unit[np.abs(unit).sum(axis=1) > 0]
    if not len(unit):
        return np.zeros((1, max(1, sample.shape[1])))
    k = max(1, min(clusters, int(np.sqrt(len(unit) / 2)) or 1))
    centres = unit[np.linspace(0, len(unit) - 1, k).astype(int)]
    for _ in range(ROUNDS):
        near = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        moved = directions(sums)
        centres = np.where(np.abs(moved).sum(axis=1, keepdims=True) > 0, moved, centres)
    return centres


def fitted_centres(anchors: DataFrame, sample: int, clusters: int) -> np.ndarray:
    share = min(1.0, sample / max(1, anchors.count()))
    drawn = anchors.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("id", "vector")
    rows = sorted(drawn.collect(), key=lambda r: r["id"])  # ``sample`` in expectation
    return centres_of(quantised([r["vector"] for r in rows]), clusters)


# ---- packing

def unpack(binary, kind=np.int64) -> np.ndarray:
    return np.frombuffer(binary, kind)


def matrix(binary, size: int) -> np.ndarray:
    flat = np.frombuffer(binary, np.float32 if size < 0 else np.float64)
    return flat.reshape(abs(size), len(flat) // max(1, abs(size)))


def packed_vectors(vectors: np.ndarray) -> tuple[int, bytes]:
    """(size, bytes): as 32-bit floats, told by a negative size, where they hold the integers exactly."""
    small = vectors.astype(np.float32)
    if (small == vectors).all():
        return -len(vectors), small.tobytes()
    return len(vectors), vectors.tobytes()


def row_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """Packs of rows, each with the block it belongs to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(0).to_numpy()
            for b in np.unique(block).tolist():
                part = batch.filter(pa.array(block == b))
                for start in range(0, part.num_rows, PACK_ROWS):
                    some = part.slice(start, PACK_ROWS)
                    size, vectors = packed_vectors(quantised([np.asarray(v) for v in some.column(3).to_pylist()]))
                    yield pack_row(b, 0, -1, 0.0, some.column(1).to_numpy().tobytes(), some.column(2).to_numpy().tobytes(), size, vectors, b"")

    dealt = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), "id", "label", "vector")
    return dealt.repartition(min(blocks, 4 * parts(rows.sparkSession)), "block").mapInArrow(run, BLOCKS)


def pack_row(block, kind, cluster, widest, ids, labels, size, vectors, slots) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([block], pa.int64()), pa.array([kind], pa.int32()), pa.array([cluster], pa.int32()), pa.array([widest], pa.float64()),
        pa.array([ids], pa.binary()), pa.array([labels], pa.binary()), pa.array([size], pa.int32()), pa.array([vectors], pa.binary()),
        pa.array([slots], pa.binary())], ["block", "kind", "cluster", "widest", "ids", "labels", "size", "vectors", "slots"])


def clustered(anchors: DataFrame, centres: np.ndarray) -> DataFrame:
    """Anchors with their cluster and the cosine to its centre."""
    held = anchors.sparkSession.sparkContext.broadcast(centres)  # at most CLUSTERS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, centres = widened(directions(quantised([np.asarray(v) for v in batch.column(2).to_pylist()])), held.value)
            cosine = unit @ centres.T
            near = cosine.argmax(axis=1)
            # A zero vector scores 0 with every row: it needs no angle.
            best = np.where(np.abs(unit).sum(axis=1) > 0, cosine[np.arange(len(unit)), near], 1.0) if len(unit) else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(best)], ["id", "label", "vector", "cluster", "cosine"])

    return anchors.mapInArrow(run, "id long, label long, vector array<double>, cluster int, cosine double")


def anchor_groups(anchors: DataFrame, blocks: int) -> DataFrame:
    """Packs of at most ``GROUP_ANCHORS`` anchors of one cluster, one copy for every block.

    ``anchors`` holds id, label, vector, cluster, widest and slots (flat: id, score of each positive).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = batch.column(3).to_numpy()
            for c in np.unique(cluster).tolist():
                part = batch.filter(pa.array(cluster == c))
                for start in range(0, part.num_rows, GROUP_ANCHORS):
                    some = part.slice(start, GROUP_ANCHORS)
                    size, vectors = packed_vectors(quantised([np.asarray(v) for v in some.column(2).to_pylist()]))
                    slots = some.column(5).to_pylist()
                    flat = np.array([x for s in slots for x in s], np.int64)
                    counts = np.array([len(s) // 2 for s in slots], np.int64)
                    yield pack_row(-1, 1, c, some.column(4)[0].as_py(), some.column(0).to_numpy().tobytes(), some.column(1).to_numpy().tobytes(),
                                   size, vectors, np.concatenate([counts, flat]).tobytes())

    dealt = anchors.select("id", "label", "vector", "cluster", "widest", "slots").repartition(parts(anchors.sparkSession), "cluster", F.pmod(F.xxhash64("id"), F.lit(64)))
    packs = dealt.sortWithinPartitions("cluster").mapInArrow(run, BLOCKS)
    return packs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        F.col("block").cast("long").alias("block"), *[c.split()[0] for c in BLOCKS.split(", ")[1:]])


# ---- walks

@dataclass
class Block:
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    def __post_init__(self):
        self.norms = norms_of(self.vectors)
        self.units = directions(self.vectors)
        self.order = self.bounds = None

    def share_list(self, centre: np.ndarray, widest: float) -> None:
        """Sort the candidates by the bound on what any member of a cluster scores with them, once a cluster."""
        units, centre = widened(self.units, centre[None])
        angle = np.arccos(np.clip(units @ centre[0], -1.0, 1.0))
        bound = self.norms * np.cos(np.minimum(np.pi, np.maximum(0.0, angle - widest - 1e-7)))
        self.order = np.argsort(-bound, kind="stable")
        self.bounds = bound[self.order]


class Best:
    """The best k (score, then smaller id) of every slot, from any number of offers."""

    def __init__(self, slots: int, k: int):
        self.k, self.slots = k, slots
        self.slot, self.score, self.id = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        self.least = np.full(slots, -np.inf)

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(v) for v in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot = slot[order]
        heads = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        place = np.arange(len(slot)) - np.repeat(heads, np.diff(np.append(heads, len(slot))))
        keep = place < self.k
        self.slot, self.score, self.id = slot[keep], score[order][keep], ids[order][keep]
        full = place[keep] == self.k - 1
        self.least[self.slot[full]] = self.score[full].astype(np.float64)


def walk(block: Block, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, owner: np.ndarray, same_label: bool, k: int,
         floor: np.ndarray, window) -> Best:
    """Walk the shared list for every slot (``owner`` is its anchor); ``window(slot, score)`` says what counts.

    A slot ends when the bound of the rest, times its anchor's norm, lies below its k-th best or its ``floor``.
    """
    vectors, candidates = widened(vectors, block.vectors)
    norms = norms_of(vectors)
    exact = norms.max(initial=0.0) * block.norms.max(initial=0.0) < EXACT
    best = Best(len(owner), k)
    start, step, active = 0, FIRST_STEP, np.arange(len(owner))
    while start < len(block.order) and len(active):
        reach = block.bounds[start] * norms[owner[active]]
        reach = reach + np.abs(reach) * SLACK + 1e-6
        active = active[reach >= np.maximum(best.least[active], floor[active])]
        if not len(active):
            break
        rows = block.order[start:start + step]
        who, back = np.unique(owner[active], return_inverse=True)
        scores = products(vectors[who], candidates[rows], exact)
        fits = (labels[who][:, None] == block.labels[rows][None]) == same_label
        fits &= ids[who][:, None] != block.ids[rows][None]
        mine = scores[back]
        ok = fits[back] & (mine >= best.least[active][:, None])
        slot, at = np.nonzero(ok)
        found = mine[slot, at]
        if window is not None:
            held = window(active[slot], found)
            slot, at, found = slot[held], at[held], found[held]
        best.offer(active[slot], found, block.ids[rows[at]])
        start, step = start + len(rows), min(LAST_STEP, step * 2)
    return best


def as_longs(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([max(-(2 ** 63), min(2 ** 63 - 1, int(s))) for s in scores], np.int64)
    return scores.astype(np.int64)


def walks(blocks: DataFrame, groups: DataFrame, centres: np.ndarray, negatives: bool, k: int, window: tuple[int, int, int]) -> DataFrame:
    """Each block's best per slot: FOUND rows, at most k a slot and block."""
    held = blocks.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, packs, block, cluster = None, [], None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != at:
                    at, packs, block, cluster = row["block"], [], None, None
                if row["kind"] == 0:
                    packs.append((unpack(row["ids"]), unpack(row["labels"]), matrix(row["vectors"], row["size"]).astype(np.float64)))
                    continue
                if not packs and block is None:
                    continue  # a block without rows
                if block is None:
                    block = Block(np.concatenate([p[0] for p in packs]), np.concatenate([p[1] for p in packs]), np.concatenate(widened(*(p[2] for p in packs))))
                    packs = []
                if row["cluster"] != cluster:
                    cluster = row["cluster"]
                    block.share_list(held.value[cluster], row["widest"])
                yield from matched(block, row)

    def matched(block: Block, row: dict) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = unpack(row["ids"]), unpack(row["labels"]), matrix(row["vectors"], row["size"]).astype(np.float64)
        slots = unpack(row["slots"])
        if negatives:
            counts, pairs = slots[:len(ids)], slots[len(ids):].reshape(-1, 2)
            owner = np.repeat(np.arange(len(ids)), counts)
            low, high, of = window
            floors, tops = pairs[:, 1] * float(low) / of, pairs[:, 1].astype(object)

            def inside(slot, score):
                if score.dtype != object and np.abs(pairs[:, 1]).max(initial=0) < EXACT / 128:
                    lines = pairs[slot, 1].astype(np.float64)
                    return (low * lines <= of * score) & (of * score <= high * lines)
                return np.array([low * t <= of * int(s) <= high * t for s, t in zip(score, tops[slot])], bool)

            best = walk(block, ids, labels, vectors, owner, False, k, floors - np.abs(floors) * SLACK - 1e-6, inside)
            slot_ids, slot_scores = pairs[best.slot, 0], pairs[best.slot, 1]
        else:
            owner = np.arange(len(ids))
            best = walk(block, ids, labels, vectors, owner, True, k, np.full(len(ids), -np.inf), None)
            slot_ids = slot_scores = np.zeros(len(best.slot), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids[owner[best.slot]]), pa.array(slot_ids), pa.array(slot_scores), pa.array(best.id),
                                          pa.array(as_longs(best.score))], ["anchor_id", "slot_id", "slot_score", "other_id", "score"])

    dealt = blocks.unionByName(groups).repartition(parts(blocks.sparkSession), "block").sortWithinPartitions("block", "kind", "cluster")
    return dealt.mapInArrow(run, FOUND)


def top(found: DataFrame, keys: list[str], k: int, out: str) -> DataFrame:
    """The k best of all blocks; a window holds at most k rows a block."""
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), "other_id")
    return found.withColumn(out, F.row_number().over(order)).where(F.col(out) <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int, int] = (LOW, HIGH, OF), sample: int = SAMPLE, clusters: int = CLUSTERS) -> DataFrame:
    """Action: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` holds (id, label, vector) as ``taking_part`` gives them, one row an id; ``is_anchor`` tells
    the anchors among them.
    """
    rows = materialize(rows.select("id", "label", "vector"), "vectors")
    total = rows.count()
    size = min(MOST_BLOCK, max(LEAST_BLOCK, total // parts(rows.sparkSession)))
    blocks = max(1, -(-total // size))
    packs = materialize(row_blocks(rows, blocks), "blocks")
    anchors = rows.where(is_anchor)
    centres = fitted_centres(anchors, sample, clusters)
    placed = materialize(clustered(anchors, centres), "anchors")
    widest = placed.groupBy("cluster").agg(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.min("cosine")))).alias("widest"))
    placed = placed.join(F.broadcast(widest), "cluster")  # at most CLUSTERS rows
    none = F.array().cast("array<bigint>")
    first = walks(packs, anchor_groups(placed.withColumn("slots", none), blocks), centres, False, positives, window)
    best = materialize(top(first, ["anchor_id"], positives, "place").select("anchor_id", F.col("other_id").alias("slot"), "score"), "positives")
    slots = best.groupBy("anchor_id").agg(F.flatten(F.collect_list(F.array("slot", "score"))).alias("slots"))  # at most ``positives`` each
    groups = anchor_groups(placed.join(slots, placed["id"] == slots["anchor_id"]), blocks)
    found = top(walks(packs, groups, centres, True, negatives, window), ["anchor_id", "slot_id"], negatives, "rank")
    return found.select("anchor_id", F.col("slot_id").alias("positive_id"), "rank", F.col("other_id").alias("negative_id"),
                        F.col("slot_score").alias("positive_score"), F.col("score").alias("negative_score"))
