"""Near-duplicates by DartMinHash signatures, banded joining and exact verification (operator 5).

Elements are the document's distinct shingles of five words (lowercased; a shorter text is one shingle),
weighted 1 each, or by their count (``weights="count"``). Every element throws darts: a Poisson process
of unit rate over the region weight x rank, seeded by the element's hash alone, so the same element
throws the same darts in every document. A dart counts where its weight lies below the element's weight;
a coordinate hash sends it to one of ``BANDS`` x ``ROWS`` coordinates, and each coordinate keeps the
earliest dart. Two documents agree on a coordinate with the probability of their weighted Jaccard
similarity; a document needs about k ln k darts, not k per element.

Documents with equal shingles become one class representative first. Representatives that share a band
are compared with the band's centre, the member that shares its bands with most others; pairs of similarity
``THRESHOLD`` or more (computed exactly over the shingle sets) link. After components are found, buckets that
still hold two components have their pairs across components compared. A member is then held by its
difference from the centre, the few shingles that only one of the two has: two members similar enough, one
of them not linked to the centre, must share part of their differences, so pairs are formed on a prefix of
them only (``differences``). No link between texts that share a band is lost, and members that lie
around a centre in different directions, however many, form no pairs.
A pair of similarity 0.8 shares a band with probability 1 - (1 - 0.8^5)^26 > 0.9999.

Defined cases: null and empty texts, and texts without words, have no shingles and stay alone; repeated
rows (same id) are one document, their text the largest; ties in class go to the smallest doc_id; rows
with a null id are left alone by ``keep_one`` and absent from ``near_duplicates``; empty input gives
empty output; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.frames import bucketed, fresh, join_hot, join_spread, thin
from daymark.llm.graph import components
from daymark.session import materialize

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 26, 5
ODD = 8  # longs of an odd sketch
CHUNK_BYTES = 3_000_000
SLOTS = 1 << 18  # of 64 bits each: the most rows of the filter that picks the texts to read again
KEYS = "doc_id long, set_hi long, set_lo long, n long"


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, and the number of words of each text.

    A word is a run of digits, letters and characters outside ASCII; texts are lowercased first.
    """
    raw = [t.lower().encode("utf-8", "surrogatepass") + b"\n" for t in texts]
    flat = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    word = WORD[flat]
    starts = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    chars = np.flatnonzero(word)
    begins = np.concatenate([[True], np.diff(chars) > 1])
    place = chars - np.repeat(starts, np.diff(np.append(np.flatnonzero(begins), len(chars))))
    power = mix(np.arange(int(place.max()) + 1, dtype=np.uint64) + np.uint64(1)) | np.uint64(1)
    value = (flat[chars].astype(np.uint64) + np.uint64(1)) * power[place]
    first = np.flatnonzero(place == 0)
    hashes = mix(np.add.reduceat(value, first))
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], ends])))
    return hashes, counts


WORD = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
TURNS = [np.uint64(t) for t in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def shingles(texts: list[str]) -> list[np.ndarray]:
    """Hashes of all five-word shingles of each text, in order."""
    hashes, counts = word_hashes(texts)
    long_ones = np.zeros(max(0, len(hashes) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        long_ones += hashes[k:len(hashes) - WORDS + 1 + k] * TURNS[k] if len(long_ones) else 0
    long_ones = mix(long_ones)
    out, at = [], 0
    for n in counts.tolist():
        if n >= WORDS:
            out.append(long_ones[at:at + n - WORDS + 1])
        elif n:
            short = sum((hashes[at + k:at + k + 1] * TURNS[k] for k in range(n)), np.uint64(n) * np.ones(1, np.uint64))
            out.append(mix(short ^ np.uint64(0xD6E8FEB86659FD93)))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def dart_signatures(elements: np.ndarray, weights: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """Signature (document, coordinate): the id of the earliest dart of each coordinate.

    ``doc`` is the document of each element; every document has at least one element of positive weight.
    """
    mass = np.bincount(doc, weights, n_docs)
    signature = np.zeros((n_docs, k), np.uint64)
    todo, budget = np.arange(n_docs), k * (np.log(k) + 2)
    while len(todo):
        chosen = np.zeros(n_docs, bool)
        chosen[todo] = True
        use = chosen[doc]
        flat, rank, dart = throw(elements[use], weights[use], doc[use], budget / mass, k)
        order = np.argsort(-rank, kind="stable")
        got = np.zeros(n_docs * k, bool)
        got[flat] = True
        signature.reshape(-1)[flat[order]] = dart[order]  # the last write, the earliest dart, stays
        todo = todo[~got.reshape(n_docs, k)[todo].all(axis=1)]
        budget *= 2
    return signature


def throw(elements, weights, doc, reach, k):
    """All darts that count with rank below the document's ``reach``: (document * k + coordinate, rank, dart id)."""
    out = []
    low, high, slab = 0.0, 1.0, 0
    while len(elements):  # slabs of weight [0,1), [1,2), [2,4), ...
        seed = mix(elements + np.uint64(slab * int(TURNS[1]) % 2 ** 64))
        w, d, limit = weights, doc, reach[doc]
        rank = np.zeros(len(seed))
        step = 0
        while len(seed):
            step += 1
            draw = mix(seed + np.uint64(step * int(TURNS[0]) % 2 ** 64))
            rank = rank - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53) / (high - low)
            alive = rank < limit
            seed, w, d, limit, rank, draw = (v[alive] for v in (seed, w, d, limit, rank, draw))
            second = mix(draw ^ TURNS[2])
            height = low + (second >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 * (high - low)
            counts = height < w
            ids = mix(second + TURNS[3])[counts]
            out.append((d[counts] * k + (ids % np.uint64(k)).astype(np.int64), rank[counts], ids))
        low, high, slab = high, high * 2, slab + 1
        heavy = weights > low
        elements, weights, doc = elements[heavy], weights[heavy], doc[heavy]
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def band_values(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit value per band, different in every band."""
    turned = signature.reshape(len(signature), bands, rows) * (mix(np.arange(rows, dtype=np.uint64) + np.uint64(7)) | np.uint64(1))
    return mix(turned.sum(axis=2, dtype=np.uint64) + mix(np.arange(bands, dtype=np.uint64) + np.uint64(99)))


def odd_sketch(grams: np.ndarray) -> np.ndarray:
    """One bit per residue: whether the set holds an odd number of grams there.

    The sketches of two sets differ in the bits of their symmetric difference's sketch, so in no more bits
    than that difference has grams.
    """
    bits = np.bincount((grams.view(np.uint64) % np.uint64(64 * ODD)).astype(np.int64), minlength=64 * ODD) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def ranges(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if sizes:
        yield start, len(sizes)


def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]]:
    """Of (doc_id, text) batches, in chunks: the ids and each text's distinct shingles with their counts."""
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for a, b in ranges([len(t) for t in texts], CHUNK_BYTES):
            yield batch.column(0).slice(a, b - a), [np.unique(s, return_counts=True) for s in shingles(texts[a:b])]


def key_columns(ids: pa.Array, found: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
    """doc_id, the two halves of the set's key, and its size."""
    key = [(mix(f[0] + TURNS[4]).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(f[0] ^ TURNS[2])) if len(f[0]) else np.uint64(0)) for f in found]
    return [ids, *(pa.array(np.array([k[i] for k in key], np.uint64).view(np.int64)) for i in (0, 1)), pa.array([len(f[0]) for f in found], pa.int64())]


def long_lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts), pa.int64()))


def signed(docs: DataFrame, weights: str = "set", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, set_hi, set_lo, n, bands) of a table (doc_id, text); texts without words have n = 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in chunked(batches):
            sizes = np.array([len(f[0]) for f in found])
            full = np.flatnonzero(sizes)
            values = np.zeros((len(found), bands), np.uint64)
            if len(full):
                doc = np.repeat(np.arange(len(full)), sizes[full])
                mass = np.concatenate([found[i][1] for i in full]).astype(float) if weights == "count" else np.ones(len(doc))
                elements = np.concatenate([found[i][0] for i in full])
                signature = dart_signatures(elements, mass, doc, len(full), bands * rows)
                values[full] = band_values(signature, bands, rows)
            yield pa.RecordBatch.from_arrays([*key_columns(ids, found), long_lists(list(values.view(np.int64)))],
                                             ["doc_id", "set_hi", "set_lo", "n", "bands"])

    return docs.mapInArrow(run, f"{KEYS}, bands array<long>")


def gram_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, set_hi, set_lo, n, odd, grams) of a table (doc_id, text): the shingles themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in chunked(batches):
            grams = [f[0].view(np.int64) for f in found]
            yield pa.RecordBatch.from_arrays([*key_columns(ids, found), long_lists([odd_sketch(g) for g in grams]), long_lists(grams)],
                                             ["doc_id", "set_hi", "set_lo", "n", "odd", "grams"])

    return docs.mapInArrow(run, f"{KEYS}, odd array<long>, grams array<long>")


def likely_in(docs: DataFrame, ids: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is among ``ids`` (doc), and a few others.

    A filter of ``slots`` rows of 64 bits, whatever the number of ids, is broadcast; with very many ids it lets
    all rows pass, which costs time and changes nothing.
    """
    slot = lambda id_: F.pmod(F.xxhash64(id_), F.lit(slots))
    bit = lambda id_: F.pmod(F.shiftrightunsigned(F.xxhash64(id_), 32), F.lit(64)).cast("int")
    marks = ids.select(slot("doc").alias("_slot"), F.expr("shiftleft(1L, cast(pmod(shiftrightunsigned(xxhash64(doc), 32), 64) as int))").alias("_mark"))
    held = marks.groupBy("_slot").agg(F.bit_or("_mark").alias("_mark"))
    return docs.withColumn("_slot", slot("doc_id")).join(F.broadcast(held), "_slot").where(
        F.getbit("_mark", bit("doc_id")) == 1).select(*docs.columns)


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of a written table whose shingle sets have a Jaccard similarity of ``threshold`` or more, exactly."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("right"))
    # A centre's set meets its pairs in many tasks, whichever side it is on.
    return join_spread(join_spread(pairs, left, "a", pairs), right, "b", pairs).where(jaccard("left", "right") >= threshold).select("a", "b")


def jaccard(left: str, right: str):
    shared = F.size(F.array_intersect(left, right))
    return shared / (F.size(left) + F.size(right) - shared)


def postings(reps: DataFrame) -> DataFrame:
    return reps.select(F.col("rep").alias("doc"), "n", F.explode("bands").alias("bucket"))


def near_sizes(a: str, b: str, threshold: float):
    """Sets of similarity ``threshold`` differ in size by that factor at most."""
    return F.least(a, b) >= threshold * F.greatest(a, b) - 1e-9


def differences(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Postings of the prefixes of each member's difference from its centre: centre, gram, doc, n, root,
    odd (sketch), far, size (of the difference) and place (of the gram in it).

    Two sets x and y reach the threshold t when |x ^ y| <= b (|x| + |y|) with b = (1 - t) / (1 + t). With the
    differences X and Y from one centre c, |x ^ y| = |X| + |Y| - 2 |X & Y|, so they must share
    (|X| + |Y| - b (|x| + |y|)) / 2 grams. Whatever y is, that is at least |X| - b (|x| + |x| / t); where x is
    linked to the centre, y is not (``far``), |Y| > b (|y| + |c|), and it is at least (|X| + b (|c| - |x|)) / 2;
    and never less than 1. Of sets that share k grams, the prefixes without the last k - 1 share one. Grams
    that the centre lacks come first, since fewer members have them.
    """
    b = (1 - threshold) / (1 + threshold)
    mine = sets.select(F.col("doc_id").alias("doc"), "odd", F.col("grams").alias("mine"))
    its = sets.select(F.col("doc_id").alias("centre"), F.col("grams").alias("its"))
    held = join_spread(members.join(mine, "doc"), its, "centre", members).select(
        "centre", "centre_n", "doc", "n", "root", "odd", F.concat(F.array_except("mine", "its"), F.array_except("its", "mine")).alias("grams"))
    held = held.withColumn("size", F.size("grams")).withColumn("far", F.col("size") > b * (F.col("n") + F.col("centre_n")) - 1e-6)
    any_partner = F.ceil(F.col("size") - b * F.col("n") * (1 + 1 / threshold) - 1e-6)
    far_partner = F.ceil((F.col("size") + b * (F.col("centre_n") - F.col("n"))) / 2 - 1e-6)
    shared = F.greatest(F.lit(1), any_partner, F.when(~F.col("far"), far_partner))
    prefix = F.slice("grams", F.lit(1), F.greatest(F.lit(0), F.col("size") - shared + 1).cast("int"))
    return held.select("centre", "doc", "n", "root", "odd", "far", "size", F.posexplode(prefix).alias("place", "gram"))


def apart(postings: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of different components whose differences from a centre may share enough grams.

    At their first common gram, the grams from there on must suffice for what the pair has to share, and the
    odd sketches may not prove more grams that only one of the two has than the threshold allows.
    """
    b = (1 - threshold) / (1 + threshold)
    x, y = postings.where("far").alias("x"), postings.alias("y")
    apart_by = sum((F.bit_count(F.col("x.odd")[i].bitwiseXOR(F.col("y.odd")[i])) for i in range(ODD)), F.lit(0))
    allowed = b * (F.col("x.n") + F.col("y.n")) + 1e-6
    needed = (F.col("x.size") + F.col("y.size") - b * (F.col("x.n") + F.col("y.n"))) / 2 - 1e-6
    left = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    met = x.join(y, (F.col("x.centre") == F.col("y.centre")) & (F.col("x.gram") == F.col("y.gram"))
                 & (F.col("x.root") != F.col("y.root")) & near_sizes("x.n", "y.n", threshold) & (left >= needed)
                 & (~F.col("y.far") | (F.col("x.doc") < F.col("y.doc"))) & (apart_by <= allowed))
    return met.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, weights: str = "set", id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Action: one row per document: doc_id, class_id (least doc_id of its class), rep_id (least with the
    same shingles), n_shingles, n_checked_links (links of its representative among the pairs that were compared)."""
    rows = thin(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    docs_thin = materialize(signed(rows, weights), "signed")
    repeated = not docs_thin.groupBy("doc_id").count().where("count > 1").isEmpty()
    if repeated:
        docs_thin = materialize(docs_thin.groupBy("doc_id").agg(F.max(F.struct("n", "set_hi", "set_lo", "bands")).alias("s")).select("doc_id", "s.*"), "signed")
    total = docs_thin.count()
    classes = docs_thin.where("n > 0").groupBy(F.concat_ws(":", "set_hi", "set_lo", "n").alias("set_key")).agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.min_by("bands", "doc_id").alias("bands"), F.count(F.lit(1)).alias("copies"))
    reps = materialize(classes.select("set_key", "rep", "n", "copies", "bands"), "reps")
    member = join_hot(docs_thin.select("doc_id", "n", F.concat_ws(":", "set_hi", "set_lo", "n").alias("set_key")),
                      reps.select("set_key", "rep", "copies"), "set_key", "copies", total).select("doc_id", "n", "rep")

    # One pass over the band buckets: every member against the bucket's centre. The centre is the member whose
    # buckets are the largest: the text that the others of a group were made from shares most with them.
    sizes = postings(reps).groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(join_hot(postings(reps), materialize(sizes, "sizes"), "bucket", "size", max(1, total)), "shared")
    # The shingles are needed of these documents only; their texts are read again instead of keeping all sets.
    sets = bucketed(gram_sets(likely_in(rows, shared.select("doc").distinct())), "doc_id", "shingles")
    if repeated:
        sets = sets.groupBy("doc_id").agg(F.max(F.struct("n", "set_hi", "set_lo", "odd", "grams")).alias("s")).select("doc_id", "s.*")
    popular = shared.groupBy("doc").agg(F.sum("size").alias("popularity"))
    ranked = shared.join(popular.hint("merge"), "doc")
    centres = ranked.groupBy("bucket").agg(F.max(F.struct("popularity", F.xxhash64("doc", "bucket").alias("h"), "doc", "n")).alias("c"), F.first("size").alias("size"))
    buckets = materialize(centres.select("bucket", F.col("c.doc").alias("centre"), F.col("c.n").alias("centre_n"), "size"), "buckets")
    met = join_hot(shared.select("bucket", "doc", "n"), buckets, "bucket", "size", max(1, total))
    star = met.where((F.col("doc") != F.col("centre")) & near_sizes("n", "centre_n", threshold)).select(
        F.least("doc", "centre").alias("a"), F.greatest("doc", "centre").alias("b")).distinct()
    checked = materialize(star, "pairs")
    links = materialize(verified(checked, sets, threshold), "links")
    roots = materialize(components(links), "roots")

    # Buckets that still hold two components: pairs across them, apart from those already compared.
    placed = met.join(roots.withColumnRenamed("node", "doc").hint("merge"), "doc", "left").select("bucket", "doc", "n", "centre", "centre_n", F.coalesce("root", "doc").alias("root"))
    placed = materialize(placed, "placed")
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    members = materialize(placed.join(mixed, "bucket", "left_semi").where("doc <> centre").drop("bucket").distinct(), "members")
    across = materialize(apart(materialize(differences(members, sets, threshold), "differences"), threshold), "across")
    more = verified(materialize(across.join(checked, ["a", "b"], "left_anti"), "across"), sets, threshold)
    links = materialize(links.unionByName(more), "links")
    roots = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_checked_links"))
    known = reps.select("rep").join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").join(degree, "rep", "left")
    known = known.join(reps.select("rep", "copies"), "rep").withColumnRenamed("rep", "rep_id")
    classed = join_hot(member.withColumnRenamed("rep", "rep_id"), known, "rep_id", "copies", total)
    alone = docs_thin.where("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("rep_id"),
                                            F.lit(0).cast("bigint").alias("n_shingles"), F.lit(0).cast("bigint").alias("n_checked_links"))
    return classed.select("doc_id", F.coalesce("root", "rep_id").alias("class_id"), "rep_id", F.col("n").alias("n_shingles"),
                          F.coalesce("n_checked_links", F.lit(0)).cast("bigint").alias("n_checked_links")).unionByName(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Action: the rows of each class's least doc_id, with all their columns."""
    drop_id = fresh(docs, "_dropped")
    dropped = near_duplicates(docs, id_col=id_col, text_col=text_col).where("doc_id <> class_id").select(F.col("doc_id").alias(drop_id))
    return docs.join(dropped, docs[f"`{id_col}`"].cast("bigint") == dropped[drop_id], "left_anti")
