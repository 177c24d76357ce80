"""License detections against every rule on the whole text, and the time long notices take."""

import random
import time

import pytest

from daymark.llm import licenses

PIECES = ["MIT License", "Apache   License,\n Version 2.0", "GNU General Public\nLicense version 3.0", "gpl-2.0", "released into the public\ndomain", "all rights\nreserved",
          "licensed under the terms of the BSD", "SPDX-License-Identifier: MIT", "cc by-sa 4.0", "Creative Commons Attribution Share Alike 3.0", "license: isc", "word", "x",
          "permission is hereby\tgranted, free of charge, to any person obtaining a copy", "eclipse public" + " " * 300 + "license", "mozilla public license 2.0", "lgpl v2.1"]


def by_all_rules(text):
    """Every rule without gates; then accepted in order, suppressed inside what is accepted, pair by pair."""
    low = text.encode().lower().decode()
    found = {(m.start(), m.end(), rule) for rule in licenses.rules() for m in rule.pattern.finditer(low)}
    kept = []
    for d in sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].name)):
        if not any(s <= d[0] and d[1] <= e for s, e, _ in kept):
            kept.append(d)
    return sorted((s, e, r.name) for s, e, r in kept)


@pytest.mark.parametrize("seed", range(60))
def test_detections_equal_all_rules(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(PIECES) + rng.choice([" ", "\n", ", ", " ", ". ", "  \t "]) for _ in range(rng.randrange(0, 14)))
    got = licenses.scan(text)[-1]
    assert [(d["start"], d["end"], d["rule"]) for d in got] == by_all_rules(text)


@pytest.mark.parametrize("text,label", [
    ("all rights\nreserved", "proprietary"), ("released into the public\ndomain", "public-domain"), ("placed to the public domain", "public-domain"),
    ("eclipse public" + " " * 5000 + "license", "epl"), ("gnu\ngeneral\tpublic license", "gpl"), ("bsd-3\nclause license", "bsd-3-clause")])
def test_white_space_does_not_hide_a_license(text, label):
    assert label in licenses.scan(text)[5].split(",")


def test_long_notices_take_time_in_proportion():
    licenses.scan("gpl-2.0 mit license " * 10)
    for notice in ("gpl-2.0 mit license ", "licensed under the apache license, version 2.0 \n"):
        started = time.perf_counter()
        row = licenses.scan(notice * (1_000_000 // len(notice)))
        assert time.perf_counter() - started < 20 and row[1] > 10_000


def test_partly_overlapping_detections_both_stay():
    text = "spdx-license-identifier: mit license"
    rules = {d["rule"] for d in licenses.scan(text)[-1]}
    assert rules == {r for _, _, r in by_all_rules(text)} and len(rules) == 2
