"""License scan by ordered signature rules behind a keyword prefilter (operator 1).

Every rule is a regular expression over the ASCII-lowercased text with a priority, a label, a confidence
and a keyword that any match must contain. One Aho-Corasick pass over the text finds the keywords that
occur; only their rules run, over the whole text, where a literal of the rule's own stands too. Any white space
parts the words of a signature. Detections are then resolved: by priority, then length, then start; one
that lies inside an accepted detection is suppressed. The base phrases (``mit
license``, ``apache license``, ``general public license`` as consecutive words) are counted on their own
and are never suppressed.

The rule table is built from license families (names, versions, SPDX forms) times the forms in which
texts cite them. Fixed values: base phrases and labels, license names and SPDX identifiers.

Defined cases: null counts as empty; an empty text has no words, null first and last word, empty labels
and score 0; repeated rows are scanned each; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daymark.llm.frames import thin

# Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, detections array<struct<label:string,start:int,end:int,rule:string,confidence:double>>")

NAMES = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")
DETECTION = pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("rule", pa.string()), ("confidence", pa.float64())])

# SPDX family, pattern of the name in running text, versions (empty: unversioned).
FAMILIES = (
    ("apache", r"apache(?: software)?", ("1.0", "1.1", "2.0")),
    ("mit", r"mit|expat|x11", ()),
    ("gpl", r"gnu general public|gnu gpl|gpl", ("1.0", "2.0", "3.0")),
    ("lgpl", r"gnu (?:lesser|library) general public|lgpl", ("2.0", "2.1", "3.0")),
    ("agpl", r"gnu affero general public|affero general public|agpl", ("1.0", "3.0")),
    ("gfdl", r"gnu free documentation|gfdl", ("1.1", "1.2", "1.3")),
    ("bsd-2-clause", r"bsd[ -]2[ -]clause|simplified bsd|freebsd", ()),
    ("bsd-3-clause", r"bsd[ -]3[ -]clause|new bsd|revised bsd|modified bsd", ()),
    ("bsd-4-clause", r"bsd[ -]4[ -]clause|original bsd", ()),
    ("0bsd", r"0bsd|zero[ -]clause bsd", ()),
    ("bsd", r"bsd", ()),
    ("isc", r"isc|internet systems consortium", ()),
    ("mpl", r"mozilla public|mpl", ("1.0", "1.1", "2.0")),
    ("epl", r"eclipse public|epl", ("1.0", "2.0")),
    ("edl", r"eclipse distribution|edl", ("1.0",)),
    ("cddl", r"common development and distribution|cddl", ("1.0", "1.1")),
    ("cpl", r"common public|cpl", ("1.0",)),
    ("eupl", r"european union public|eupl", ("1.0", "1.1", "1.2")),
    ("cecill", r"cecill(?:-[bc])?", ("1.0", "2.0", "2.1")),
    ("artistic", r"artistic|perl artistic", ("1.0", "2.0")),
    ("bsl", r"boost software|bsl", ("1.0",)),
    ("unlicense", r"unlicense|the unlicense", ()),
    ("wtfpl", r"wtfpl|do what the fuck you want to public", ("2.0",)),
    ("zlib", r"zlib(?:/libpng)?", ()),
    ("libpng", r"libpng", ("2.0",)),
    ("python", r"python software foundation|psf", ("2.0",)),
    ("ruby", r"ruby", ()),
    ("php", r"php", ("3.0", "3.01")),
    ("postgresql", r"postgresql", ()),
    ("openssl", r"openssl", ()),
    ("ofl", r"sil open font|open font|ofl", ("1.0", "1.1")),
    ("upl", r"universal permissive|upl", ("1.0",)),
    ("ms-pl", r"microsoft public|ms-pl", ()),
    ("ms-rl", r"microsoft reciprocal|ms-rl", ()),
    ("osl", r"open software|osl", ("1.0", "2.0", "2.1", "3.0")),
    ("afl", r"academic free|afl", ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("apsl", r"apple public source|apsl", ("1.0", "1.1", "2.0")),
    ("ipl", r"ibm public", ("1.0",)),
    ("ncsa", r"university of illinois/ncsa|ncsa", ()),
    ("w3c", r"w3c(?: software)?", ()),
    ("zpl", r"zope public|zpl", ("1.1", "2.0", "2.1")),
    ("sspl", r"server side public|sspl", ("1.0",)),
    ("busl", r"business source|busl", ("1.1",)),
    ("elastic", r"elastic", ("2.0",)),
    ("odbl", r"open database|odbl", ("1.0",)),
    ("pddl", r"public domain dedication and license|pddl", ("1.0",)),
    ("mulan", r"mulan (?:psl|permissive software)", ("1.0", "2.0")),
    ("vim", r"vim", ()),
    ("tcl", r"tcl/tk|tcl", ()),
    ("curl", r"curl", ()),
    ("hpnd", r"historical permission notice and disclaimer|hpnd", ()),
    ("json", r"json", ()),
    ("beerware", r"beer-?ware", ()),
)
CREATIVE_COMMONS = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")  # fixed values, as are the next two
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
CC_WORDS = {"by": "attribution", "sa": "share ?alike", "nc": "non-?commercial", "nd": "no ?derivative(?:s| works)?"}
CLAUSES = (  # fixed values: sentences that only these texts contain
    ("mit", "permission is hereby granted, free of charge, to any person obtaining a copy", "permission"),
    ("isc", "permission to use, copy, modify, and/or distribute this software for any purpose", "permission"),
    ("bsd", "redistribution and use in source and binary forms, with or without modification", "redistribution"),
    ("gpl", "this program is free software: you can redistribute it and/or modify it", "redistribute"),
    ("gpl", "this program is free software; you can redistribute it and/or modify it", "redistribute"),
    ("lgpl", "this library is free software; you can redistribute it and/or", "redistribute"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("zlib", "this software is provided 'as-is', without any express or implied warranty", "as-is"),
    ("bsl", "boost software license - version", "boost"),
    ("public-domain", "(?:released|placed|dedicated) (?:in)?to the public domain", "domain"),
    ("proprietary", "all rights reserved", "reserved"),
)


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int
    confidence: float
    keyword: str
    needs: tuple[str, ...]  # one of these stands in any match; none: no such literals
    pattern: re.Pattern


def spaced(pattern: str) -> str:
    """The pattern with any white space where it has a blank."""
    return pattern.replace("[ -]", "\0").replace(" ?", r"\s*").replace(" ", r"\s+").replace("\0", r"[\s-]")


def _rule(name: str, label: str, priority: int, confidence: float, keyword: str, pattern: str, needs: tuple[str, ...] = ()) -> Rule:
    return Rule(name, label, priority, confidence, keyword, needs, re.compile(rf"(?<![0-9a-z]){spaced(pattern)}(?![0-9a-z])"))


def literals(names: str) -> tuple[str, ...]:
    """The first word of each of the alternatives of a family's names."""
    return tuple(re.match("[0-9a-z]+", n)[0] for n in re.sub(r"\([^)]*\)", "", names).split("|"))


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """The ordered rules: SPDX tags first, then clauses, versioned names, unversioned names, bare mentions."""
    out = []
    for label, name, versions in FAMILIES:
        own = literals(name)
        for v in versions:
            digits = re.escape(v.removesuffix(".0")) + (r"(?:\.0)?" if v.endswith(".0") else "")
            only = rf"(?:only|or-later|\+)"
            spdx = re.escape(f"{label}-{v}")
            out += [
                _rule(f"{label}-{v}-spdx", f"{label}-{v}", 100, 1.0, "spdx", rf"spdx-license-identifier:\s*{spdx}(?:-?{only})?"),
                _rule(f"{label}-{v}-name", f"{label}-{v}", 80, 0.95, "licen", rf"(?:{name})\s+licen[cs]e,?\s+(?:version\s+|v\.?\s*)?{digits}", own),
                _rule(f"{label}-{v}-short", f"{label}-{v}", 70, 0.85, label.split("-")[0], rf"{re.escape(label)}[ -]?v?{digits}(?:-?{only})?"),
            ]
        out += [
            _rule(f"{label}-spdx", label, 95, 1.0, "spdx", rf"spdx-license-identifier:\s*{re.escape(label)}"),
            _rule(f"{label}-under", label, 65, 0.9, "under", rf"(?:licensed|released|distributed|available)\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?(?:{name})(?:\s+licen[cs]e)?", own),
            _rule(f"{label}-name", label, 60, 0.8, "licen", rf"(?:{name})\s+licen[cs]e", own),
            _rule(f"{label}-field", label, 55, 0.7, "licen", rf"licen[cs]e['\"]?\s*[:=]\s*['\"]?(?:{name})", own),
        ]
    for kind in CREATIVE_COMMONS:
        words = r"[\s,-]+".join(CC_WORDS[k] for k in kind.split("-"))
        for v in CC_VERSIONS:
            out += [
                _rule(f"cc-{kind}-{v}-spdx", f"cc-{kind}-{v}", 90, 1.0, "cc", rf"cc[ -]{kind}[ -]{re.escape(v)}"),
                _rule(f"cc-{kind}-{v}-url", f"cc-{kind}-{v}", 90, 1.0, "creativecommons", rf"creativecommons\.org/licenses/{kind}/{re.escape(v)}"),
                _rule(f"cc-{kind}-{v}-name", f"cc-{kind}-{v}", 75, 0.9, "creative", rf"creative\s+commons\s+{words}\s+(?:licen[cs]e\s+)?{re.escape(v)}"),
            ]
    out += [_rule("cc0", "cc0-1.0", 90, 1.0, "cc0", r"cc0(?:[ -]1\.0)?")]
    out += [_rule(f"clause-{i}", label, 85, 0.9, keyword, text)
            for i, (label, text, keyword) in enumerate(CLAUSES)]
    return tuple(sorted(out, key=lambda r: (-r.priority, r.name)))


@lru_cache(maxsize=1)
def by_keyword() -> tuple["re.Pattern", dict[str, list[Rule]]]:
    import ahocorasick

    gates: dict[str, list[Rule]] = {}
    for rule in rules():
        gates.setdefault(rule.keyword, []).append(rule)
    automaton = ahocorasick.Automaton()
    for word in gates:
        automaton.add_word(word, word)
    automaton.make_automaton()
    return automaton, gates


def resolve(found: set[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Accept by priority, length, start, name; suppress what lies inside an accepted detection.

    A tree over the starts holds the furthest end among accepted detections that start there or before.
    """
    starts = sorted({start for start, _, _ in found})
    place = {start: i + 1 for i, start in enumerate(starts)}
    furthest = [-1] * (len(starts) + 1)
    kept = []
    for start, end, rule in sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].name)):
        at, reach = place[start], -1
        while at:
            reach = max(reach, furthest[at])
            at &= at - 1
        if reach >= end:
            continue
        kept.append((start, end, rule))
        at = place[start]
        while at < len(furthest):
            furthest[at] = max(furthest[at], end)
            at += at & -at
    return sorted(kept, key=lambda d: (d[0], d[1], d[2].name))


#: Bytes of words after lowercasing: digits, letters and everything outside ASCII.
WORD = np.array([0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
GAP = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
BASE_PATTERNS = {label: re.compile(rb"(?<![0-9a-z\x80-\xff])" + GAP.join(w.encode() for w in phrase.split()) + rb"(?![0-9a-z\x80-\xff])")
                 for phrase, label in BASE.items()}


def scan(text: str) -> tuple:
    """One text's row, without its id."""
    raw = text.encode("utf-8", "surrogatepass")
    flat = np.frombuffer(raw, np.uint8)
    word = WORD[flat]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    n_words = int(np.count_nonzero(starts))
    low = raw.lower()
    places, labels = [], set()
    if b"license" in low:
        for label, pattern in BASE_PATTERNS.items():
            here = [m.start() for m in pattern.finditer(low)]
            places += here
            if here:
                labels.add(label)
    first = last = None
    if places:
        first, last = (int(np.count_nonzero(starts[:p])) for p in (min(places), max(places)))
    lowered = low.decode("utf-8", "surrogatepass")
    automaton, gates = by_keyword()
    found, stands = set(), {}
    for word in {word for _, word in automaton.iter(lowered)}:
        for rule in gates[word]:
            for literal in rule.needs:
                if literal not in stands:
                    stands[literal] = literal in lowered
            if not rule.needs or any(stands[n] for n in rule.needs):
                found |= {(m.start(), m.end(), rule) for m in rule.pattern.finditer(lowered)}
    kept = resolve(found)
    every = sorted(labels | {rule.label for _, _, rule in kept})
    score = 1.0
    for _, _, rule in kept:
        score *= 1.0 - rule.confidence
    score = max(1.0 - score, 0.9 if places else 0.0)
    return (n_words, len(places), first, last, ",".join(sorted(labels)), ",".join(every), score,
            [{"label": r.label, "start": s, "end": e, "rule": r.name, "confidence": r.confidence} for s, e, r in kept])


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document; ``detections`` holds the accepted rule matches with code point offsets."""
    kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), pa.list_(DETECTION))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(t.as_py()) for t in batch.column(1)]
            cols = [batch.column(0), *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", *NAMES])

    return thin(docs, id_col, text_col).mapInArrow(run, SCHEMA)
