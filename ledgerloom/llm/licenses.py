"""License detection with ordered signature rules.

A text becomes its words (see ``common.WORD``) with one blank between them, and
the rules are regular expressions over that.  A rule is tried only where one of
its keywords occurs.  Detections are taken by priority, then length, then place;
one whose words all lie within a detection taken before is suppressed.

The rules are built from licence families (name, spellings, versions) and
contexts (tag, notice, statement, mention): some hundreds of signatures.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD_BYTES, at_hand, slices, texts_of

#: Phrases that are found wherever their words stand consecutively, and their labels (fixed by the contract).
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    weight: float
    keyword: bytes
    pattern: re.Pattern[bytes]


#: Families: label, keyword, spelling as words, versions ("" where none is named). A dot is a blank between words.
FAMILIES = (
    ("apache", "apache", r"apache(?: software)?(?: license| licence)?", ("", "1.0", "1.1", "2.0")),
    ("mit", "mit", r"mit(?: x11)?", ("",)),
    ("x11", "x11", r"x11", ("",)),
    ("bsd", "bsd", r"(?:modified |new |simplified |revised )?bsd", ("", "0", "1", "2", "3", "4")),
    ("gpl", "general", r"(?:gnu )?general public license", ("", "1.0", "2.0", "3.0")),
    ("gpl", "gpl", r"(?:gnu )?gpl", ("", "1.0", "2.0", "3.0")),
    ("lgpl", "lesser", r"(?:gnu )?(?:lesser|library) general public license", ("", "2.0", "2.1", "3.0")),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", ("", "2.0", "2.1", "3.0")),
    ("agpl", "affero", r"(?:gnu )?affero general public license", ("", "1.0", "3.0")),
    ("agpl", "agpl", r"(?:gnu )?agpl", ("", "1.0", "3.0")),
    ("gfdl", "documentation", r"(?:gnu )?free documentation license", ("", "1.1", "1.2", "1.3")),
    ("mpl", "mozilla", r"mozilla public license", ("", "1.0", "1.1", "2.0")),
    ("epl", "eclipse", r"eclipse public license", ("", "1.0", "2.0")),
    ("cddl", "common", r"common development and distribution license", ("", "1.0", "1.1")),
    ("cpl", "common", r"common public license", ("", "1.0")),
    ("eupl", "european", r"european union public licen[cs]e", ("", "1.0", "1.1", "1.2")),
    ("artistic", "artistic", r"(?:perl )?artistic", ("", "1.0", "2.0")),
    ("afl", "academic", r"academic free license", ("", "1.1", "2.0", "2.1", "3.0")),
    ("osl", "open", r"open software license", ("", "1.0", "2.0", "2.1", "3.0")),
    ("isc", "isc", r"isc", ("",)),
    ("zlib", "zlib", r"zlib(?: libpng)?", ("",)),
    ("bsl", "boost", r"boost software license", ("", "1.0")),
    ("busl", "business", r"business source license", ("", "1.0", "1.1")),
    ("unlicense", "unlicense", r"unlicense", ("",)),
    ("wtfpl", "wtfpl", r"wtfpl", ("", "1", "2")),
    ("psf", "python", r"python software foundation license", ("", "2")),
    ("postgresql", "postgresql", r"postgresql", ("",)),
    ("ofl", "ofl", r"(?:sil )?(?:open font license|ofl)", ("", "1.0", "1.1")),
    ("ofl", "font", r"(?:sil )?open font license", ("", "1.0", "1.1")),
    ("upl", "universal", r"universal permissive license", ("", "1.0")),
    ("odbl", "database", r"open database license", ("", "1.0")),
    ("odc-by", "attribution", r"open data commons attribution license", ("", "1.0")),
    ("pddl", "domain", r"public domain dedication(?: and license)?", ("", "1.0")),
    ("ms-pl", "microsoft", r"microsoft public license", ("",)),
    ("ms-rl", "microsoft", r"microsoft reciprocal license", ("",)),
    ("cc0", "cc0", r"cc0", ("", "1.0")),
    ("cc0", "zero", r"creative commons zero", ("", "1.0")),
    ("sspl", "server", r"server side public license", ("", "1")),
    ("elastic", "elastic", r"elastic license", ("", "1.0", "2.0")),
    ("json", "json", r"json license", ("",)),
    ("openssl", "openssl", r"openssl", ("",)),
    ("vim", "vim", r"vim license", ("",)),
    ("ruby", "ruby", r"ruby license", ("",)),
    ("php", "php", r"php license", ("", "3.0", "3.01")),
    ("w3c", "w3c", r"w3c(?: software)?(?: notice and)?", ("",)),
    ("zpl", "zope", r"zope public license", ("", "2.0", "2.1")),
    ("ipl", "ibm", r"ibm public license", ("", "1.0")),
    ("npl", "netscape", r"netscape public license", ("", "1.0", "1.1")),
    ("qpl", "q", r"q public license", ("", "1.0")),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", ("",)),
)
#: Creative Commons: terms after "by", and versions.
CC_TERMS = ("", "sa", "nc", "nd", "nc-sa", "nc-nd")
CC_VERSIONS = ("", "1.0", "2.0", "2.5", "3.0", "4.0")
CC_NAMES = {"sa": r"share ?alike", "nc": r"non ?commercial", "nd": r"no ?deriv(?:s|atives|ative works)"}
#: Notices that name no family: label, keyword, words.
NOTICES = (
    ("reserved", "reserved", r"all rights (?:are )?reserved"),
    ("public-domain", "reserved", r"no rights reserved"),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)\d\d"),
    ("copyright", "copyrighted", r"copyrighted material"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("proprietary", "permission", r"(?:reproduced|copied|distributed|used) without (?:the )?(?:prior |express )*(?:written )?permission"),
    ("public-domain", "domain", r"(?:in|into|to) the public domain"),
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification"),
    ("zlib", "provided", r"this software is provided as is without any express or implied warranty in no event"),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("apache", "apache", r"you may not use this file except in compliance with the license"),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    ("wtfpl", "fuck", r"do what the fuck you want to public license"),
    ("bsl", "boost", r"distributed under the boost software license"),
    ("warranty", "warranty", r"provided as is without warranty of any kind"),
    ("no-ai-training", "training", r"not be used (?:for|to) (?:ai |machine learning )?train(?:ing)?"),
)
_GIVEN = (
    r"(?:(?:dual |multi )?licen[cs]ed|released|distributed|available|published|provided|covered|governed|offered|"
    r"redistributed|shared|used|copied|modified)"
)
_UNDER = r" (?:[^ ]+ ){0,3}?(?:under|by) (?:the )?(?:terms of (?:the )?)?(?:either )?"


def _version(version: str) -> str:
    """A version as words; a trailing zero may be missing."""
    if not version:
        return ""
    major, _, minor = version.partition(".")
    tail = f" {minor}" if minor and minor != "0" else "(?: 0)?" if minor else ""
    return rf"(?: (?:public )?licen[cs]e)?(?: version| v| clause)? v?{major}{tail}"


def _contexts(label: str, keyword: str, name: str, version: str) -> Iterator[Rule]:
    """A family's rules, from the most to the least specific."""
    full = label + (f"-{version}" if version else "")
    versioned = name + _version(version) + ("" if version else r"(?: licen[cs]e)?")
    more = 1 if version else 0
    spdx = full.replace("-", " ").replace(".", " ")
    for priority, weight, pattern in (
        (90 + more, 0.99, rf"spdx license identifier {spdx}"),
        (70 + more, 0.95, rf"{_GIVEN}{_UNDER}{versioned}"),
        (50 + more, 0.85, rf"(?:this|the) (?:[^ ]+ ){{0,4}}?(?:is|are) (?:[^ ]+ ){{0,2}}?{versioned}"),
        (30 + more, 0.6, rf"{versioned}(?: licen[cs]e)?" if version else rf"{name} licen[cs]e" if "licen" not in name else name),
    ):
        yield Rule(full, priority, weight, keyword.encode(), re.compile(rf"(?<= )(?:{pattern})(?= )".encode()))


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules by priority."""
    found = [r for label, key, name, versions in FAMILIES for v in versions for r in _contexts(label, key, name, v)]
    for terms in CC_TERMS:
        short = "cc by" + "".join(f" {t}" for t in terms.split("-") if t)
        long = "creative commons attribution" + "".join(f" {CC_NAMES[t]}" for t in terms.split("-") if t)
        end = "" if terms.endswith(("sa", "nd")) else r"(?! (?:nc|sa|nd)(?= ))"
        for version in CC_VERSIONS:
            label = "-".join(filter(None, ["cc-by", terms, version]))
            for key, name in ((b"cc", short), (b"commons", long)):
                words = name + end + (rf"(?: license)? {version.replace('.', ' ')}" if version else "")
                more = 2 * len(terms.split("-")) * bool(terms) + bool(version)
                for priority, weight, pattern in ((74 + more, 0.95, rf"{_GIVEN}{_UNDER}{words}"), (34 + more, 0.7, words)):
                    found.append(Rule(label, priority, weight, key, re.compile(rf"(?<= )(?:{pattern})(?= )".encode())))
    found += [
        Rule(label, 60, 0.8, key.encode(), re.compile(rf"(?<= )(?:{words})(?= )".encode())) for label, key, words in NOTICES
    ]
    return tuple(sorted(found, key=lambda r: -r.priority))


def normalised(text: bytes) -> bytes:
    """The words with one blank before, between and after them."""
    return b" " + b" ".join(text.translate(WORD_BYTES).split()) + b" "


class _Places:
    """The number of the word at a place of a line: how many blanks are before it."""

    def __init__(self, line: bytes):
        self.blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)

    def word(self, place: int) -> int:
        return int(np.searchsorted(self.blanks, place))


class _Kept:
    """Whether an interval lies within one that was kept: the greatest end by start, in a binary indexed tree."""

    def __init__(self, starts: list[int]):
        self.starts = sorted(set(starts))
        self.end = [-1] * (len(self.starts) + 1)

    def holds(self, start: int, end: int) -> bool:
        i = bisect_right(self.starts, start)
        while i:
            if self.end[i] >= end:
                return True
            i &= i - 1
        return False

    def add(self, start: int, end: int) -> None:
        i = bisect_right(self.starts, start)
        while i < len(self.end):
            self.end[i] = max(self.end[i], end)
            i += i & -i


def base_places(line: bytes) -> list[tuple[int, str]]:
    """Start word and label of each base phrase; ``line`` as ``normalised`` gives it."""
    found = []
    for phrase, label in BASE:
        key = b" " + phrase.encode() + b" "
        at = line.find(key)
        while at >= 0:
            found.append((at, label))
            at = line.find(key, at + 1)
    places = _Places(line) if found else None
    return sorted((places.word(at), label) for at, label in found)


@lru_cache(maxsize=1)
def _by_keyword() -> tuple[tuple[bytes, tuple[Rule, ...]], ...]:
    found: dict[bytes, list[Rule]] = {}
    for rule in rules():
        found.setdefault(rule.keyword, []).append(rule)
    return tuple((k, tuple(v)) for k, v in found.items())


def detections(line: bytes) -> list[tuple[int, int, str, int, float]]:
    """Start word, end word, label, priority and weight of what is left after suppression, in the order of the text."""
    hits = []
    for keyword, own in _by_keyword():
        if keyword not in line:
            continue
        for rule in own:
            for m in rule.pattern.finditer(line):
                hits.append((-rule.priority, m.start() - m.end(), m.start(), m.end(), rule.label, rule.weight))
    if not hits:
        return []
    kept: list[tuple[int, int, str, int, float]] = []
    within = _Kept([h[2] for h in hits])
    for priority, _, start, end, label, weight in sorted(hits):
        if not within.holds(start, end):
            within.add(start, end)
            kept.append((start, end, label, -priority, weight))
    places = _Places(line)
    return [
        (places.word(s) - 1, places.word(e), label, priority, weight) for s, e, label, priority, weight in sorted(kept)
    ]


def scan(text: bytes) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, str, int, float]]]:
    """Words, base places and detections of one text."""
    line = normalised(text)
    return len(line.split()), base_places(line), detections(line)


_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, detections array<struct<start:int,end:int,label:string,priority:int,weight:double>>"
)
_DETECTION = pa.list_(
    pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("priority", pa.int32()), ("weight", pa.float64())]
    )
)


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch):
            out: list[tuple] = []
            for text in texts_of(piece):
                n, base, more = scan(text)
                starts = [s for s, _ in base]
                own = {label for _, label in base}
                score = max([0.9 if base else 0.0, *(w for *_, w in more)])
                out.append(
                    (
                        n,
                        len(base),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted(own)),
                        ",".join(sorted(own | {d[2] for d in more})),
                        score,
                        [dict(zip(("start", "end", "label", "priority", "weight"), d, strict=True)) for d in more],
                    )
                )
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _DETECTION]
            columns = [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).cast(pa.int64()), *columns],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"],
            )


def license_scan(documents: DataFrame) -> DataFrame:
    """Licence labels and their places for each row of ``documents`` (``doc_id, text``; other columns are ignored).

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` are of the base
    phrases alone; ``labels`` adds those of the detections; ``score`` is the
    weight of the surest.  A NULL or empty text has no words, no labels (empty
    strings) and score 0; NULL and repeated ids keep their rows.
    """
    at_hand(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        _scanned, _SCHEMA
    )
