"""Phrases against counting every one."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from ledgerloom.llm.collocations import collocations, phrase_counts


def brute(rows, top=2000, least=30):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(" ".join(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        good = {p: a for p, a in counts.items() if a >= least and " " in p}
        gone = set()
        for p, a in good.items():
            words = p.split(" ")
            for k in range(2, len(words)):
                for i in range(len(words) - k + 1):
                    q = " ".join(words[i : i + k])
                    if 100 * a >= 80 * counts[q]:
                        gone.add(q)
        scored = []
        for p, a in good.items():
            if p not in gone:
                words = p.split(" ")
                cuts = [(counts[" ".join(words[:k])], counts[" ".join(words[k:])]) for k in range(1, len(words))]
                score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
                scored.append((-score, -a, p.encode(), a, l, r, score))
        for rank, (_, _, p, a, l, r, score) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), a, l, r, n[lang], score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    words = ["The", "of", "red", "é x", "NEW", "york", "city", "a\x1fb", "z"]
    out = [("en", "new york city hall, " * 3_000), (None, "x y z!"), ("en", None), (None, ""), ("de", " .,; \t")]
    for i in range(400):
        parts = rng.choice(words, int(rng.integers(1, 60)))
        ends = rng.choice([" ", "  ", "\t", ", ", "\n", ".", " \x0b"], len(parts), p=[0.6, 0.1, 0.1, 0.1, 0.04, 0.03, 0.03])
        out.append((["en", "de", None, "und"][i % 4], "".join(a + b for a, b in zip(parts, ends, strict=True))))
    return out


@pytest.mark.parametrize("budget", [1 << 21, 400, 20])
def test_phrases(spark, rows, budget):
    """One group, and groups so small that prefixes of all lengths are over the budget."""
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "lang string, text string, n int, phrase string")
    got = [tuple(r) for r in collocations(docs.repartition(7), budget=budget).collect()]
    want = brute(rows)
    assert sorted(got) == want and len(want) > 150
    few = collocations(docs, top=5, least=3, budget=budget).collect()
    assert sorted(tuple(r) for r in few) == brute(rows, 5, 3)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations(docs).count() == 0
    counts, words = phrase_counts(spark.createDataFrame([("a", None)], "lang string, text string"))
    assert counts.count() == 0 and words.count() == 0
