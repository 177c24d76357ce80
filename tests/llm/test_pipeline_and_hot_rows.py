"""The pipeline against brute force, stage by stage, and rows that share an id."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daymark.llm import exact_dedup, language, packing, queries
from daymark.session import materialize

SIZES = packing.SIZE


def word_sets(text):
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").lower())
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


@pytest.fixture(scope="module")
def stages(spark, small):
    """What each stage of the pipeline read and kept."""
    docs, out = queries.read(spark, small), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, small), f"test-{name}")
        out.append((name, docs.collect(), after.collect()))
        docs = after
    return {name: (before, after) for name, before, after in out}


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_language_stage(stages):
    before, after = stages["language"]
    assert ids(after) == sorted(r["doc_id"] for r in before if any(c.isalpha() for c in r["text"] or ""))


def test_exact_stage(stages):
    before, after = stages["exact_dedup"]
    best = {}
    for r in before:
        best[r["text"]] = max(best.get(r["text"], r["doc_id"]), r["doc_id"])
    assert ids(after) == sorted(best.values())


def test_near_stage(stages):
    before, after = stages["near_dedup"]
    sets = {r["doc_id"]: word_sets(r["text"]) for r in before}
    root, postings = {i: i for i in sets}, defaultdict(list)
    for i, s in sets.items():
        for g in s:
            postings[g].append(i)
    pairs = {(a, b) for held in postings.values() for x, a in enumerate(held) for b in held[x + 1:]}
    for a, b in pairs:
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = {k: low if v == high else v for k, v in root.items()}
    assert ids(after) == sorted(i for i, r in root.items() if i == r)


def test_decontamination_stage(spark, small, stages):
    before, after = stages["decontamination"]
    items = [s for s in (word_sets(r["text"]) for r in queries.read(spark, small, "benchmark").collect()) if s]
    held = {r["doc_id"]: word_sets(r["text"]) for r in before}
    assert ids(after) == sorted(i for i, s in held.items() if not any(len(s & t) >= 0.8 * len(t) - 1e-9 for t in items))


def test_packing_stage(stages):
    before, after = stages["packing"]
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, rooms = defaultdict(list), defaultdict(list)
    for r in after:
        pieces[r["doc_id"]].append(r)
        rooms[r["sequence_id"]].append(r)
    assert set(pieces) == set(ids(before))
    for doc in before:
        whole = tokenizer.encode(doc["text"] or "", add_special_tokens=False).ids + [0]
        mine = sorted(pieces[doc["doc_id"]], key=lambda r: r["start"])
        assert [r["start"] for r in mine] == [sum(r["length"] for r in mine[:k]) for k in range(len(mine))]
        assert {r["doc_tokens"] for r in mine} == {len(whole)} == {sum(r["length"] for r in mine)}
        for r in mine:
            assert r["ids_crc32"] == zlib.crc32(np.array(whole[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
    for held in rooms.values():
        held.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in held] == [sum(r["length"] for r in held[:k]) for k in range(len(held))]
        assert sum(r["length"] for r in held) <= SIZES


def test_run_equals_its_stages(spark, small, stages):
    counted = lambda rows: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert counted(corpus_pipeline.run(spark, small).collect()) == counted(stages["packing"][1])


def test_a_table_without_languages_keeps_its_texts(spark):
    df = spark.createDataFrame([(1, "plain words", None), (2, "123 !!", None), (3, None, None)], "doc_id long, text string, lang string")
    assert ids(language.keep_known(df).collect()) == [1]


def test_pieces_without_ids_and_copies_are_dealt_over_all_groups(spark):
    rng = random.Random(2)
    rows = [(None, "word " * rng.randrange(1, 30)) for _ in range(900)] + [(7, "the same row")] * 900 + [(8, "long " * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = packing.cut_pieces(df, *queries.tokenizer_files())
    out = packing.pack(materialize(pieces, "pieces"), group_pieces=100)
    groups = out.groupBy(F.shiftright("sequence_id", 32).alias("g")).count()
    sizes = [r["count"] for r in groups.collect()]
    assert len(sizes) >= 18 and max(sizes) < 260 and sum(sizes) == pieces.count()
    held = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m"))
    assert held.where(f"n > {SIZES} or n <> m").count() == 0


def test_kept_copies_are_dealt_by_id(spark):
    df = spark.createDataFrame([(i, "one text") for i in range(500)] + [(None, "one text"), (499, "one text"), (None, "other"), (None, "other")],
                               "doc_id long, text string")
    out = exact_dedup.keep_first(df)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in out.collect()) == [(False, 499, "one text"), (True, 0, "other")]
