"""Whole texts of every rule: a scan finds what the rules find, whatever other words there are."""

import re

import pytest
from ledgerloom.llm import licenses


def text_of(pattern: str) -> str:
    """The shortest text that a rule's pattern describes: each optional part left out, of alternatives the first."""
    text = pattern.removeprefix("(?<= )").removesuffix("(?= )")
    text = re.sub(r"\(\?!.*?\)\)", "", text).replace(r"(?:19|20)\d\d", "2020").replace("(?:[^ ]+ ){0,", "@{0,")
    text = re.sub(r"@\{0,\d\}\?", "", text)
    while "(?:" in text:
        text = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)(\?)?", lambda m: "" if m[2] else m[1], text)
    return re.sub(r".\?", "", text).replace("[cs]", "c")


def test_a_scan_finds_what_the_rules_find():
    met = 0
    for rule in licenses.rules():
        for text in (own := text_of(rule.pattern.pattern.decode()), own.replace(" ", "\r\n"), own.upper().replace(" ", "-")):
            line = licenses.normalised(text.encode())
            assert rule.pattern.search(line), (rule, text)
            want = len(line.split()), licenses.base_places(line), licenses.detections(line)
            assert licenses.scan(text.encode()) == want, text
            met += bool(want[2])
    assert met > 1_500


@pytest.mark.parametrize(
    ("text", "label"),
    [("Apache-2.0", "apache-2.0"), ("This code is MIT.", "mit"), ("to the public\r\ndomain", "public-domain"), ("bsd 3", "bsd-3")],
)
def test_names_without_other_words(text, label):
    assert [d[2] for d in licenses.scan(text.encode())[2]] == [label]


def every_pair(line):
    """The same suppression, each hit against all that were taken."""
    hits = []
    for keyword, own in licenses._by_keyword():
        if keyword in line:
            for rule in own:
                hits += [(-rule.priority, m.start() - m.end(), m.start(), m.end(), rule.label, rule.weight) for m in rule.pattern.finditer(line)]
    kept = []
    for priority, _, s, e, label, weight in sorted(hits):
        if not any(a <= s and e <= b for a, b, *_ in kept):
            kept.append((s, e, label, -priority, weight))
    return [(line[:s].count(b" ") - 1, line[:e].count(b" "), label, p, w) for s, e, label, p, w in sorted(kept)]


def test_suppression_and_places_are_those_of_all_pairs():
    import random

    mix = random.Random(3)
    parts = [text_of(r.pattern.pattern.decode() if isinstance(r.pattern.pattern, bytes) else r.pattern.pattern) for r in licenses.rules()]
    for _ in range(60):
        words = " ".join(mix.choice([*mix.sample(parts, 8), "some words", "all rights reserved", "cc by", "mit"]) for _ in range(12))
        line = licenses.normalised(words.encode())
        assert licenses.detections(line) == every_pair(line)


def test_a_megabyte_of_notices_takes_seconds():
    import time

    text = b"Licensed under the Apache License, Version 2.0 (the License). All rights reserved. Released under the MIT license.\n" * 9_000
    began = time.process_time()
    n, base, found = licenses.scan(text)
    assert len(base) >= 9_000 and len(found) >= 18_000 and n > 100_000
    assert time.process_time() - began < 30
