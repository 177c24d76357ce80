"""Hard negatives, spelling variants and piece encoding against brute force and the library."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import negatives, pieces, queries, spelling

CLASH = "id bigint, slots string, cell int, word string, kind int"


@pytest.fixture(scope="module")
def piece_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# ---- hard negatives

def brute_negatives(rows, anchor, positives=5, top=10):
    best = {}
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not np.isfinite(256 * x) for x in vector):
            continue
        key = (label, [float(x) for x in vector])
        best[i] = max(best.get(i, key), key)
    whole = {i: (label, [int(np.floor(256 * x)) for x in v]) for i, (label, v) in best.items()}
    score = lambda a, b: sum(x * y for x, y in zip(whole[a][1], whole[b][1]))
    out = set()
    for a in (i for i in whole if anchor(i)):
        order = sorted((-score(a, i), i) for i in whole if i != a)
        for ps, p in [(-s, i) for s, i in order if whole[i][0] == whole[a][0]][:positives]:
            held = [(-s, i) for s, i in order if whole[i][0] != whole[a][0] and 30 * ps <= -100 * s <= 90 * ps]
            out |= {(a, p, r, i, ps, s) for r, (s, i) in enumerate(held[:top], 1)}
    return out


def mined(spark, rows, divisor, **more):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, slots string, cluster int")
    return {tuple(r) for r in negatives.hard_negatives(negatives.taking_part(df), F.col("id") % divisor == 0, **more).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()}


@pytest.mark.parametrize("kind", ["spread", "tight", "ties"])
def test_negatives_equal_brute_force(spark, kind):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(4, 12))
    rows = []
    for i in range(600):
        v = rng.normal(size=12)
        if kind == "tight":
            v = centres[i % 4] + 0.1 * v
        if kind == "ties":
            v = np.round(v) / 2
        rows.append((i, int(rng.integers(3)), (v / (1 if kind == "ties" else np.linalg.norm(v))).tolist()))
    rows += rows[:50]  # delivered twice
    assert mined(spark, rows, 7) == brute_negatives(rows, lambda i: i % 7 == 0) != set()


def test_negatives_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(i % 2), rng.normal(size=4).tolist()) for i in range(60)]
    rows += [(100, None, [1.0] * 4), (101, 0, None), (102, 0, [1.0, None, 0.0, 0.0]), (103, 1, [float("nan")] * 4), (104, 1, [float("inf")] * 4),
             (None, 1, [9.0] * 4), (200, 0, [0.0] * 4), (201, 0, []), (202, 1, [1.0, 2.0]), (203, 0, [0.5] * 6), (3, 1, [2.0] * 4), (300, 1, [1e307] * 4)]
    assert mined(spark, rows, 3) == brute_negatives(rows, lambda i: i % 3 == 0)
    assert mined(spark, rows[:0] + [(1, 1, [1.0])], 3) == set()
    assert mined(spark, [(0, 1, [1.0]), (3, 0, [1.0])], 3) == set()


def test_scores_that_doubles_cannot_hold_rank_exactly(spark):
    big = float(2 ** 22)
    rows = [(0, 0, [big, 1.0]), (3, 0, [big, 0.25]), (4, 1, [big * 0.875, 3.0]), (5, 1, [big * 0.875, 2.0]), (6, 1, [big * 0.875, -1.0])]
    got = {(r[0], r[1], r[2], r[3]) for r in mined(spark, rows, 100)}
    assert got == {(a, p, k, n) for a, p, k, n, *_ in brute_negatives(rows, lambda i: i % 100 == 0)} and len(got) == 3


def test_lists_end_early_on_tight_clusters():
    """The certificate saves work: few of the candidates of a far cluster are scored."""
    rng = np.random.default_rng(1)
    centres = negatives.directions(rng.normal(size=(20, 32)))
    rows = negatives.quantised(list(np.repeat(centres, 1000, axis=0) + 0.02 * rng.normal(size=(20000, 32))))
    block = negatives.Block(np.arange(20000), np.zeros(20000, np.int64), rows)
    member = rows[:8]
    block.share_list(centres[0], 0.2)
    seen, plain = [], negatives.products
    negatives.products = lambda a, b, exact: seen.append(len(b)) or plain(a, b, exact)
    try:
        best = negatives.walk(block, np.arange(8), np.zeros(8, np.int64), member, np.arange(8), True, 5, np.full(8, -np.inf), None)
    finally:
        negatives.products = plain
    assert sum(seen) < 4000
    want = np.argsort(-(member @ rows.T), axis=1)[:, :7]
    assert {int(i) for i in best.id[best.slot == 0]} <= set(want[0].tolist())


def test_negatives_on_the_tables_equal_sql(spark, small):
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{small}/embeddings.parquet'")
    got = queries.op11(spark, small)
    want = duck.execute(queries.ORACLES["op11_hard_negatives"]).fetchall()
    names = [c[0] for c in duck.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want) != []


# ---- spelling variants

def brute_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_groups(words):
    cuts = {}
    for w in words:
        for k in range(len(w)):
            cuts.setdefault(w[:k] + "*" + w[k + 1:], set()).add(w)
            cuts.setdefault(w[:k] + w[k + 1:], set()).add(w)
    near = {w: set() for w in words}
    for pattern, group in cuts.items():
        if "*" in pattern:
            for w in group:
                near[w] |= group - {w}
        elif pattern in words:
            for w in group:
                near[w].add(pattern)
                near[pattern].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def test_groups_on_the_tables_equal_brute_force(spark, small):
    rows = duckdb.execute(f"select doc_id, text from '{small}/documents.parquet'").fetchall()
    got = {tuple(r) for r in queries.op12(spark, small).collect()}
    assert got == brute_groups(brute_words(rows)) and any(r[1] != r[2] and r[1] for r in got)


@pytest.mark.parametrize("cell_words", [4, 60, 4096])
def test_groups_of_close_words_equal_brute_force(spark, cell_words):
    """Many words around few stems, small cells, accents, long runs; every link crosses cells somewhere."""
    rng = random.Random(cell_words)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(5, 9))) for _ in range(12)] + ["a" * 40]
    words = list(stems)
    for _ in range(500):
        w = list(rng.choice(words[-80:] + stems))
        at = rng.randrange(len(w))
        kind = rng.randrange(3)
        w[at:at + (kind != 0)] = [] if kind == 2 and len(w) > 5 else [rng.choice("abcdeéÿx")]
        words.append("".join(w))
    rows = [(i, " ".join(w for w in words for _ in range(rng.choice([1, 1, 3, 9])))) for i in range(4)]
    rows += [(None, "Hello HELLO hello"), (7, None), (8, ""), (9, "x" * 3000 + " " + "ÀÉÎ " * 3), rows[0]]
    df = spark.createDataFrame([(*r, None, None, 1, "w", 2) for r in rows], "doc_id long, text string, " + CLASH)
    got = [tuple(r) for r in spelling.spelling_groups(df, sample_words=120, cell_words=cell_words).collect()]
    want = brute_groups(brute_words(rows))
    assert len(got) == len(want) and set(got) == want


def test_groups_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_groups(empty).count() == 0
    assert spelling.spelling_groups(spark.createDataFrame([(1, "a b c"), (None, None)], "doc_id long, text string")).count() == 0


def test_boxes_never_lose_a_word():
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(3000)})
    masks = spelling.letter_masks(words)
    for tight in (True, False):
        tree = spelling.Tree(masks, 16, tight)
        home = np.zeros(len(words), np.int64)
        for leaf, rows in enumerate(tree.leaves):
            home[rows] = leaf
        assert (tree.home(masks) == home).all()
        reached = {(leaf, q) for leaf, rows in tree.search(masks, 1) for q in rows.tolist()}
        near = [(a, b) for a in range(0, 3000, 60) for b in range(len(words)) if sum(x != y for x, y in zip(words[a], words[b])) == 1]
        assert near and all((home[b], a) in reached for a, b in near if a < len(words))


# ---- pieces

PARTS = ["a", "b", "the", "ing", " ", "  ", "   ", "\n", "\t", "▁", "é", "丝", "😀", "<s>", "</s>", "<0x0A>", "\x00", "�", "1", "99", "Zq", "…",
         "é", "​", " the", " in", "ㅎ", "unbelievable", "ＡＢ"]


def test_encoding_equals_the_library(piece_path):
    model, library, rng = pieces.PieceModel(piece_path), pieces.library_at(piece_path), random.Random(4)
    for _ in range(20_000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(14)))
        ids = model.encode(text).tolist()
        assert ids == library.encode(text, add_bos=True, add_eos=True), text
        assert model.decode(ids) == library.decode(ids), text


def test_decoding_of_any_ids_equals_the_library(piece_path):
    model, library, rng = pieces.PieceModel(piece_path), pieces.library_at(piece_path), random.Random(5)
    for _ in range(20_000):
        ids = [rng.choice([0, 1, 2, 259, 29871, rng.randrange(3, 259), rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randrange(9))]
        assert model.decode(ids) == library.decode(ids), ids


def test_long_texts_are_read_in_parts(piece_path, monkeypatch):
    model, library = pieces.PieceModel(piece_path), pieces.library_at(piece_path)
    monkeypatch.setattr(pieces, "PART_CHARS", 50)
    text = "word  and ▁ more\n" * 300 + "x" * 2000 + " " * 500 + "end" * 40
    assert len(list(pieces.parts_of(text))) > 20
    assert model.encode(text).tolist() == library.encode(text, add_bos=True, add_eos=True)
    monkeypatch.setattr(pieces, "MEMO_ENTRIES", 3)
    assert pieces.PieceModel(piece_path).encode(text).tolist() == model.encode(text).tolist()


def test_digests_on_the_tables(spark, small, piece_path):
    rows = duckdb.execute(f"select doc_id, text from '{small}/documents.parquet'").fetchall()
    library = pieces.library_at(piece_path)
    want = set()
    for i, text in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert {tuple(r) for r in queries.op13(spark, small).collect()} == want


def test_pieces_of_odd_rows_and_the_round_trip(spark, piece_path):
    rows = [(None, None), (1, ""), (2, " lead and trail "), (2, " lead and trail "), (3, "tab\tnew\nline  ▁x"), (4, "😀" * 50)]
    df = spark.createDataFrame([(*r, 1, "s", 0, "w", 2) for r in rows], "doc_id long, text string, " + CLASH)
    encoded = pieces.encode_documents(df, piece_path, check=True)
    back = sorted((r["doc_id"] or 0, r["text"]) for r in pieces.decode_documents(encoded, piece_path).collect())
    assert back == sorted((i or 0, (t or "").replace("▁", " ")) for i, t in rows)
    assert pieces.encoding_digests(df.limit(0), piece_path).count() == 0


def test_the_check_finds_a_difference(piece_path):
    model = pieces.PieceModel(piece_path)
    ids = model.encode("a text")
    with pytest.raises(ValueError, match="differs"):
        pieces.checked(piece_path, [ids[:-1]], ["a text"], ["a text"])
    with pytest.raises(ValueError, match="differs"):
        pieces.checked(piece_path, [ids], ["another"], ["a text"])
