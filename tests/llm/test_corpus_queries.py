"""Every corpus query against a brute-force version, over whole tables."""

import hashlib
import re
import zlib

import duckdb
import pytest
from tokenizers import Tokenizer

from daymark.llm import licenses, near_dedup, queries
from tools.check import TABLES, table_of


@pytest.fixture(scope="module")
def docs(small):
    rows = duckdb.execute(f"select doc_id, text from '{small}/documents.parquet' order by doc_id").fetchall()
    return {i: t or "" for i, t in rows}


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, small, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    df = queries.QUERIES[name](spark, small)
    got = table_of(df.columns, df.collect())
    duck.execute(queries.ORACLES[name])
    assert got == table_of([c[0] for c in duck.description], duck.fetchall())


def test_license_base(spark, small, docs):
    got = by_id(queries.op1(spark, small))
    assert set(got) == set(docs)
    for i, text in docs.items():
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        places = []
        labels = set()
        for phrase, label in licenses.BASE.items():
            want = phrase.split()
            here = [k for k in range(len(words)) if words[k:k + len(want)] == want]
            places += here
            labels |= {label} if here else set()
        row = got[i]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert (row["first_word"], row["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert row["base_labels"] == ",".join(sorted(labels)) and labels <= set(row["labels"].split(",")) | set()
        assert 0 <= row["score"] <= 1


def digest(spans, order):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda s: (s[0], order.index(s[1])))).encode()).hexdigest()


def test_secret_base(spark, small, docs):
    got = by_id(queries.op6(spark, small))
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for i, text in docs.items():
        spans = [(m.start(2), "assign", m.end(2)) for m in assign.finditer(text) if len(m.group(2)) >= 6]
        spans += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
        spans += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
        assert got[i]["base_sha256"] == digest(spans, ("assign", "access", "hex"))
        for a, k, b in spans:
            assert f"{k}:{a}:{b}" in got[i]["spans"].split(",")


def luhn(number):
    d = [int(c) for c in re.sub("[^0-9]", "", number)][::-1]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def test_personal_data_base(spark, small, docs):
    got = by_id(queries.op7(spark, small))
    n = lambda m: len(re.sub("[^0-9]", "", m.group()))
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= n(m) <= 19 and luhn(m.group())),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= n(m) <= 15),
    }
    for i, text in docs.items():
        spans = [(m.start(), k, m.end()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text) if ok(m)]
        assert [got[i][f"n_{k}"] for k in kinds] == [sum(s[1] == k for s in spans) for k in kinds]
        assert got[i]["base_sha256"] == digest(spans, tuple(kinds))
        assert {f"{k}:{a}:{b}" for a, k, b in spans} <= set(got[i]["spans"].split(","))


def test_near_duplicates_equal_brute_force(spark, small, docs):
    sets = {i: set(s.tolist()) for i, s in zip(docs, near_dedup.shingles(list(docs.values())))}
    parent = {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = list(docs)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    got = by_id(queries.op5(spark, small))
    assert {i: root(i) for i in docs} == {i: r["class_id"] for i, r in got.items()}


def test_repeat_removal_equals_brute_force(spark, small, docs):
    got, seen = by_id(queries.op8(spark, small)), set()
    for i, text in docs.items():
        raw = text.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if raw[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(raw[p:p + 100])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = len(re.findall(b"\x01+", gone))
        assert tuple(got[i])[1:] == (len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest())


def test_packing_round_trip(spark, small, docs):
    import numpy as np
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.op9(spark, small).collect()
    pieces, room = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        room.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text in docs.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            part = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    for places in room.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(r["length"] for r in rows) > 0.97 * 1024 * len(room)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = dict(duckdb.execute(f"select doc_id, lang from '{sf}/documents.parquet'").fetchall())
    toxic = dict(duckdb.execute(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall())
    found = [r for r in queries.op10(spark, sf).collect() if r["held_out"]]
    assert {r["doc_id"] for r in found} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in found) >= 0.98 * len(found)
    scored = [r for r in queries.op4(spark, sf).collect() if r["held_out"] and r["doc_id"] in toxic]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in scored)
    hit = [r for r in scored if r["predicted"]]
    assert sum(toxic[r["doc_id"]] for r in hit) >= 0.9 * len(hit)
    assert sum(toxic[r["doc_id"]] for r in hit) >= 0.5 * sum(toxic[r["doc_id"]] for r in scored)
