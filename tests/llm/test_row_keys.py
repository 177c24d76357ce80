"""Repeat removal where ids are null, shared or repeated, and toxicity without any term."""

import hashlib
import random

import pytest

from daymark.llm import repeats, toxicity


def brute(rows):
    """Removed bytes per distinct (id, text), by every 100-byte string."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    seen, out = set(), {}
    for i, text in order:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for k in range(len(raw) - 99):
            if raw[k:k + 100] in seen:
                gone[k:k + 100] = [True] * 100
            seen.add(raw[k:k + 100])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out[i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()] = rows.count((i, text))
    return out


def sample(seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab cdé") for _ in range(rng.randrange(60, 260))) for _ in range(9)]
    text = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(0, 5)))
    rows = [(rng.choice([None, 3, 3, 4, 5, 6, 7, 1 << 62, -8]), text()) for _ in range(40)]
    return rows + rows[:6] + [(None, None), (3, ""), (3, None)]


@pytest.mark.parametrize("seed", range(2))
def test_shared_and_null_ids_equal_brute_force(spark, seed):
    rows = [(i, t or "") for i, t in sample(seed)]
    got = {}
    for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[tuple(r)] = got.get(tuple(r), 0) + 1
    assert got == brute(rows)


def test_the_two_crashes_of_shared_ids(spark):
    a, b = (" ".join(f"{w}{i * 7 % 101}q{i}" for i in range(60)) for w in "uz")
    for shared in (None, 3):
        df = spark.createDataFrame([(shared, a), (shared, b), (7, a), (9, b + " and more")], "doc_id long, text string")
        gone = {r["doc_id"]: r["n_removed"] for r in repeats.remove_repeats(df).collect()}
        assert gone[7] == len(a) and gone[9] == len(b) and gone[shared] == 0


def test_toxicity_without_any_term(spark):
    texts = spark.createDataFrame([(i, "the same plain words") for i in range(38)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(38)], "doc_id long, toxic int")
    rows = toxicity.toxicity(texts, labels).collect()
    assert len(rows) == 38 and len({r["score"] for r in rows}) == 1
