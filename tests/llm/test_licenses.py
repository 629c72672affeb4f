"""License rules and their resolution, against a plain scan of words."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logtide.llm import license_scan
from logtide.llm.license_rules import BASE, GENERIC, RULES, pattern_of

SEPARATORS = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in SEPARATORS.split(lower) if w]


def plain(text):
    """(n_words, n_base, first, last, base labels, labels) by looking at every rule in the whole text."""
    words = words_of(text)
    spaced = " " + "".join(f" {w} " for w in words) + " "
    found = []
    for i, rule in enumerate(RULES):
        for m in re.finditer(pattern_of(rule), spaced):
            first = spaced[: m.start()].count(" ") // 2
            found.append((first, first + m.group().count(" ") // 2, rule.priority, i, rule))
    kept = [d for d in found if not any(
        e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2] and (e[1] - e[0] > d[1] - d[0] or (e[2], e[3]) < (d[2], d[3])) for e in found)]
    base = [d for d in found if d[4].base]
    named = {d[4].label for d in base} | {d[4].label for d in kept if d[2] < GENERIC}
    labels = named or {d[4].label for d in kept}
    starts = [d[0] for d in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({d[4].label for d in base})), ",".join(sorted(labels)))


def scanned(docs):
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
    return sorted(map(tuple, license_scan.digest(license_scan.scan(docs)).select(*columns).collect()), key=repr)


TEXTS = [
    None, "", "  ...  ", "Released under the MIT License.", "mit", "MIT\nLICENSE mit-license", "gnu general public licensé",
    "This work is licensed under the GNU General Public License, version 3 or later",
    "Apache License, Version 2.0; Apache License", "CC BY-SA 4.0 and CC-BY", "all rights reserved", "All rights reserved. MIT License",
    "SPDX-License-Identifier: GPL-2.0-or-later", "http://www.apache.org/licenses/LICENSE-2.0 İ MIT license", "İ" * 50 + " mit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit license " * 50, "GNU GENERAL PUBLIC LICENSE gnu general public license v2",
]


def test_scan_equals_a_plain_one(spark, documents):
    rows = [*enumerate(TEXTS), (None, TEXTS[3]), (3, TEXTS[3])]
    docs = documents(*[(i, t, "en", "s") for i, t in rows])
    assert scanned(docs) == sorted([(i, *plain(t)) for i, t in rows], key=repr)


@pytest.mark.parametrize("ahead", [0, 2040, 2046, 2047, 2048, 4095, 6000])
def test_long_texts_are_scanned_in_stretches(spark, documents, ahead):
    text = "w " * ahead + "Apache License 2.0 " + "v " * 3000 + "GNU General Public License, version 2, " * 700
    assert scanned(documents((1, text, "en", "s"))) == [(1, *plain(text))]


def test_no_rows_give_no_rows(spark, documents):
    assert scanned(documents()) == []


def test_detections_tell_what_contains_what(spark, documents):
    row = license_scan.scan(documents((1, "GNU General Public License version 3", "en", "s"))).first()
    assert row._row.kept == 1 and row._row.size == 0.5  # extra columns are passed on
    whole = {(d["label"], d["first"], d["last"], d["kept"]) for d in row.detections}
    assert ("gpl-3.0", 0, 5, True) in whole and ("gpl", 0, 3, False) in whole


def test_there_are_hundreds_of_rules_with_a_known_order():
    assert len(RULES) > 300 and RULES[: len(BASE)] == BASE
    assert {r.priority for r in RULES} == {1, 2, 3, GENERIC}
    assert len({(r.label, r.pattern) for r in RULES}) == len(RULES)


@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_every_match_of_a_rule_holds_its_keyword_and_is_short(data):
    rule = data.draw(st.sampled_from(RULES))
    text = data.draw(st.from_regex(re.compile(pattern_of(rule).replace("[^ ]+", "[a-z0-9]+"), re.ASCII), fullmatch=True))
    words = text.split()
    assert rule.keyword in words and len(words) < license_scan.MARGIN


def test_every_rule_matches_its_shortest_text_with_its_keyword():
    for rule in RULES:
        text = re.sub(r"\( ?\[\^ \]\+\)\{(\d+),\d+\}", lambda g: " w" * int(g[1]), rule.pattern)
        text = re.sub(r"\(([^()|]*)\|[^()]*\)(?!\?)", r"\1", re.sub(r"\([^()]*\)\?", "", re.sub(r"\([^()]*\)\?", "", text)))
        text = re.sub(r".\?", "", re.sub(r"\[(.)[^\]]*\]", r"\1", text.replace("[^ ]+", "w"))).strip()
        assert re.fullmatch(rule.pattern, text) and rule.keyword in text.split(), rule


def test_everything_stays_within_the_row(spark, documents, plan_of):
    plan = plan_of(license_scan.digest(license_scan.scan(documents((1, "x", "en", "s"), parts=1))))
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan and "Sort" not in plan
