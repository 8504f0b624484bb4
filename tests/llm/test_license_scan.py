"""License detection against a plain scan with Python's expressions."""

import re

import pytest

import __spark_entry__
from cofan.llm import license_scan

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(text, phrases=license_scan.PHRASES):
    words = WORD.findall((text or "").translate(UPPER))
    s = " " + "".join(w + " " for w in words)
    base = []
    for phrase, label in phrases:
        p = phrase.split()
        base += [(k, label) for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
    hits = []
    for place, (_, label, priority, rx) in enumerate(license_scan.rules()):
        for m in re.finditer(rx, s):
            start = s[: m.start()].count(" ")
            hits.append((start, -(start + m[0].count(" ")), priority, place, label))
    hits.sort()
    kept = [h for k, h in enumerate(hits) if not any(g[2] <= h[2] and -g[1] >= -h[1] for g in hits[:k])]
    score = 1.0 if base else license_scan.CONFIDENCE[min(h[2] for h in kept)] if kept else 0.0
    places = [k for k, _ in base]
    return (
        len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in base})),
        ",".join(sorted({x for _, x in base} | {h[4] for h in kept})), score, [(h[0], -h[1], h[4], h[2]) for h in kept],
    )


def shown(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score, [tuple(x) for x in r.detections])


def test_every_expression_holds_its_gate():
    rules = license_scan.rules()
    assert len(rules) >= 250 and len({r[1] for r in rules}) >= 100
    for gate, _, priority, rx in rules:
        plain = rx.replace("licen[cs]e", "licen").replace("(?:", "").replace("(", "")
        assert gate.strip() in plain and priority in license_scan.CONFIDENCE, rx


TEXTS = [
    None, "", " ... ", "The MIT License", "Released UNDER THE MIT LICENSE, under the mit license.", "under the mit  license-under the mit license",
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "cc by nc cc by-nc 4.0 CC BY-NC-SA 4.0 cc-by", "xcc by nc", "cc by ncx", "the permit license mit",
    "GNU General Public License, version 3 or any later version", "gpl-2.0 gplv3 GPL v2 lgpl-2.1", "SPDX-License-Identifier: GPL-2.0-or-later",
    "SPDX-License-Identifier: MIT", "Kİ UNDER THE MİT LICENSE under the mit license", "é under the MIT licence ß ÀÉ", "all rights reserved " * 700,
    "bsd 3-clause license, new BSD license; mozilla public license 2.0", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "creativecommons.org/licenses/by-nc-sa/4.0 Creative Commons Attribution-ShareAlike 4.0", "licence apache 2 and the Unlicense", "a" * 200_000 + " cc by nc",
]


def test_detections_equal_a_plain_scan(spark):
    df = spark.createDataFrame([(k, t, "x", 1.5, None) for k, t in enumerate(TEXTS)], "doc_id long, text string, w string, score double, rules string")
    got = sorted(license_scan.scan(df).collect(), key=lambda r: r.doc_id)
    assert got[0].w == "x" and len(got) == len(TEXTS)
    for r, t in zip(got, TEXTS):
        assert shown(r) == brute(t), t
    assert license_scan.scan(df.limit(0)).count() == 0


def test_phrases_that_overlap_themselves(spark):
    phrases = [("a b a", "aba"), ("b a b", "bab")]
    text = "a b a b a. x a-b-a"
    r = license_scan.scan(spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string"), phrases=phrases).collect()
    assert [shown(x) for x in r] == [brute(text, phrases)] * 2 and r[0].n_base == 4


@pytest.mark.parametrize("name", ["op13_license_scan"])
def test_query_equals_a_plain_scan(spark, name):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = __spark_entry__.queries()[name](spark, SF).collect()
    assert len(got) == len(docs) and sum(r.n_base > 0 for r in got) > 10
    gates = sorted({g for g, *_ in license_scan.rules()})
    for r in got:
        t = docs[r.doc_id]
        s = " ".join(["", *WORD.findall((t or "").translate(UPPER)), ""])
        if any(g in s for g in gates):
            assert tuple(r)[1:] == brute(t)[:7]
        else:
            assert (r.n_words, r.n_base, r.labels, r.score) == (len(s.split()), 0, "", 0.0)
