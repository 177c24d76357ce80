"""Nulls, empty texts, ties, repeated rows, empty tables and clashing columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daymark.llm import decontamination, exact_dedup, language, licenses, near_dedup, packing, personal_data, queries, repeats, secrets, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, bands int, _digest string"
LONG = " ".join(f"word{i % 97}x{i % 89}" for i in range(3000))
ROWS = [(1, None, None, None, None, "a", 1, "x"), (2, "", "en", "s", 0, None, None, None), (3, "... 123 !!", "en", "s", 9, "a", 1, "x"),
        (4, LONG, "en", "s", 1, "a", 1, "x"), (5, LONG, "fr", "s", 1, "a", 1, "x"), (5, LONG, "fr", "s", 1, "a", 1, "x"),
        (6, "tiny text", "en", None, 1, "a", 1, "x"), (None, "no id at all", "en", "s", 1, "a", 1, "x")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def tables(spark, odd):
    labels = spark.createDataFrame([(2, 1), (4, 0), (4, None), (None, 1)], "doc_id bigint, toxic int")
    items = spark.createDataFrame([(1, LONG[:300]), (1, LONG[:300]), (2, None), (3, "")], "item_id bigint, text string")
    files = queries.tokenizer_files()
    return {
        "licenses": licenses.scan_documents, "contained": lambda d: decontamination.contained(d, items), "exact": exact_dedup.exact_groups,
        "toxicity": lambda d: toxicity.toxicity(d, labels), "near": near_dedup.near_duplicates, "secrets": secrets.scan_documents,
        "personal": personal_data.find, "repeats": repeats.remove_repeats, "packing": lambda d: packing.pack_documents(d, *files),
        "language": language.identify,
    }


NAMES = ("licenses", "contained", "exact", "toxicity", "near", "secrets", "personal", "repeats", "packing", "language")


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_and_empty_tables(odd, tables, name):
    rows = tables[name](odd).collect()
    assert tables[name](odd.limit(0)).count() == 0
    if name in ("licenses", "toxicity", "secrets", "personal", "repeats", "language", "exact"):
        assert len(rows) == len(ROWS)


def test_defined_results(odd):
    exact = {(r["doc_id"], r["text_sha256"]): r for r in exact_dedup.exact_groups(odd).collect()}
    assert {r["keep_id"] for (i, _), r in exact.items() if i in (1, 2)} == {2}
    assert {r["keep_id"] for (i, _), r in exact.items() if i in (4, 5)} == {5}
    near = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(odd).collect()}
    assert near == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6}
    gone = {r["doc_id"]: r["n_removed"] for r in repeats.remove_repeats(odd).collect()}
    assert gone[5] == len(LONG) and gone[1] == gone[2] == gone[6] == 0
    assert {r["doc_id"]: r["lang_pred"] for r in language.identify(odd).collect()}[1] == "und"


def test_stages_keep_columns_and_drop_what_they_must(spark, odd):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, "/root/testdata/sf0.001")
        assert out.columns == odd.columns
    ids = sorted(r[0] or 0 for r in exact_dedup.keep_first(odd).select("doc_id").collect())
    assert ids == [0, 2, 3, 5, 6]
    assert sorted(r[0] or 0 for r in near_dedup.keep_one(odd).select("doc_id").collect()) == [0, 1, 2, 3, 4, 6]
    assert language.keep_known(odd).where(F.col("doc_id").isin(1, 2)).count() == 0


def test_index_goes_on(spark, odd, tmp_path):
    first = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
    first.append(odd)
    before = first.table().count()
    again = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
    again.append(odd)
    assert again.table().count() == before == 5


def test_weighted_signatures_estimate_weighted_similarity():
    elements = near_dedup.mix(np.arange(1, 401, dtype=np.uint64))
    a, b = np.ones(400), np.ones(400)
    b[:200] = 3.0
    rows = near_dedup.dart_signatures(np.concatenate([elements, elements]), np.concatenate([a, b]), np.repeat([0, 1], 400), 2, 2000)
    assert abs((rows[0] == rows[1]).mean() - 400 / 800) < 0.05


def test_near_copies_around_the_threshold_equal_brute_force(spark):
    """Edits of one text, many of them just too far from it and from each other: all pairs, no link lost."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(4000)}" for _ in range(160)]
    common = [rng.randrange(160) for _ in range(6)]  # places that many copies change alike
    texts = {}
    for i in range(150):
        words = list(base)
        for p in rng.sample(range(160), rng.randrange(1, 7)):
            words[p] = f"x{rng.randrange(10 ** 6)}"
        for p in rng.sample(common, rng.randrange(0, 5)):
            words[p] = f"same{p}"
        texts[i] = " ".join(words)
    sets = {i: set(s.tolist()) for i, s in zip(texts, near_dedup.shingles(list(texts.values())))}
    root, links = {i: i for i in texts}, 0
    for i in texts:
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links += 1
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    got = near_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert links > 150 and 10 < len(set(root.values())) < 150
    assert {r["doc_id"]: r["class_id"] for r in got} == root


def test_odd_sketches_never_overstate_a_difference():
    rng = np.random.default_rng(3)
    for n in (1, 40, 3000):
        a, b = (np.unique(rng.integers(-2 ** 63, 2 ** 63 - 1, n, np.int64)) for _ in "ab")
        b = np.unique(np.concatenate([a[: n // 2], b]))
        x, y = near_dedup.odd_sketch(a), near_dedup.odd_sketch(b)
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= len(np.setxor1d(a, b))
