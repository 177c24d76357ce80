"""Spelled-out addresses and account codes of a sound form appear in the spans of op7; unsound ones do not."""

import random

from daymark.llm import personal_data


def iban(rng, good):
    body = "".join(rng.choice("0123456789") for _ in range(18))
    check = 98 - int("".join(str(int(c, 36)) for c in body + "DE00")) % 97
    return f"DE{check if good else (check + rng.randrange(1, 90)) % 97:02d}{body}"


def test_spelled_addresses_and_accounts_are_found(spark):
    rng, texts, want, never = random.Random(1), {}, {}, {}
    word = lambda n: "".join(rng.choice("bcdfghklmnprst") for _ in range(n))
    forms = ("{}(at){}.com", "{} (at) {} (dot) org", "{}[at]{}[dot]de", "{}(at)mail.{}.co.uk")
    for i in range(480):
        spelled = rng.choice(forms).format(word(6), word(8)) if i % 2 else f"{word(5)} (at) {word(6)}. {word(7)}"
        code = iban(rng, i % 2 == 1)
        texts[i] = f"Write to {spelled} or {word(4)}@{word(5)}.net, pay {code} now, page {rng.randrange(10 ** 6, 10 ** 7)}."
        spans = {f"{g}:{texts[i].index(v)}:{texts[i].index(v) + len(v)}" for g, v in (("spelled", spelled), ("account", code))}
        (want if i % 2 else never)[i] = spans
    rows = personal_data.find(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    got = {r["doc_id"]: set(r["spans"].split(",")) for r in rows}
    base = {i: {s for s in got[i] if s.split(":")[0] in personal_data.KINDS} for i in got}
    clash = lambda i, s: any(int(b.split(":")[1]) < int(s.split(":")[2]) and int(b.split(":")[2]) > int(s.split(":")[1]) for b in base[i])
    for i, spans in want.items():
        assert {s for s in spans if not clash(i, s)} <= got[i], texts[i]
    assert sum(len(spans & got[i]) for i, spans in never.items()) <= 0.05 * 480


def test_trees_and_cutoffs_see_every_candidate(spark, monkeypatch):
    sizes = {}
    real = personal_data.materialize

    def counted(df, purpose):
        out = real(df, purpose)
        sizes[purpose] = out.count()
        return out

    monkeypatch.setattr(personal_data, "materialize", counted)
    rows = [(i, " ".join(f"10.{i % 256}.{j}.{i % 7} x{j}" for j in range(60))) for i in range(600)]
    assert personal_data.find(spark.createDataFrame(rows, "doc_id long, text string")).where("n_ip = 60").count() == 600
    assert sizes["proposals"] > 30_000 and sizes["candidates"] == sizes["proposals"]
