"""The whole pipeline on a small table: stages against what they say, on odd rows too."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as P  # noqa: E402

RNG = np.random.default_rng(12)
CALM = [f"{a}{b}" for a in ("wood", "river", "stone", "field", "cloud") for b in "abcdefghijklmnopqrst"]
RUDE = [f"rude{x}" for x in "abcdefghijklmnopqrst"]
BENCH = " ".join(f"item{i}" for i in range(30))


def words(n, bag=CALM):
    return " ".join(RNG.choice(bag, n))


@pytest.fixture
def tables(spark, folder):
    docs, marks = [], []
    for i in range(1, 400):
        bad = i % 8 == 0
        docs.append((i, words(60) + (" " + words(20, RUDE) if bad else ""), "en"))
        marks.append((i, int(bad)))
    base = words(80)
    docs += [
        (1_000, base, "en"),
        (1_001, base.replace(base.split()[40], "changed", 1), "en"),
        (1_002, base, "en"),
        (1_003, words(50) + " " + BENCH + " " + words(50), "en"),
        (1_004, words(70) + " " + words(30, RUDE), "en"),
        # One id, two texts: each is judged by its own.
        (1_005, words(50) + " " + BENCH, "en"),
        (1_005, words(66) + " clean one", "en"),
        (1_006, base, "en"),
        (1_006, words(67) + " clean two", "en"),
        # Without an id.
        (None, base, "en"),
        (None, words(68) + " clean three", None),
        (None, words(9) + " " + BENCH, None),
        # One row twice.
        *[(1_007, words(69) + " clean four", "en")] * 2,
    ]
    docs += [(1_008, None, None), (1_009, "", "en"), (1_010, "0123 456 !!", "en")]
    rows = spark.createDataFrame([(*d, "s") for d in docs], "doc_id long, text string, lang string, source string")
    rows.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, BENCH)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_run(spark, folder, tables):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in P.STAGES[:-1]:
        docs = P.stored(stage(spark, docs, folder), name)
        assert docs.columns == columns
        left[name] = [(r.doc_id, r.text) for r in docs.collect()]
    toxic = {i for i, t, *_ in tables if i and t and "rude" in t}
    kept = {i for i, _ in left["toxicity"]}
    assert len(toxic & kept) <= 2 and {1_000, 1_003, 1_005, 1_007, 1_008, 1_009, None} <= kept
    assert not {1_008, 1_009, 1_010} & {i for i, _ in left["language_id"]}
    texts = [t for _, t in left["near_duplicates"]]
    base = [t for i, t, *_ in tables if i == 1_000][0]
    assert sum(t.split()[:30] == base.split()[:30] for t in texts) == 1
    for n in ("one", "two", "three", "four"):
        assert sum(t.endswith(f"clean {n}") for t in texts) == 1
    assert sum(BENCH in t for t in texts) >= 2
    texts = [t for _, t in left["decontamination"]]
    assert not any(BENCH in t for t in texts)
    assert all(sum(t.endswith(f"clean {n}") for t in texts) == 1 for n in ("one", "two", "three", "four"))
    clean = {i for i, t, *_ in tables if i and i < 400 and i % 8}
    assert len(clean & {i for i, _ in left["decontamination"]}) >= 0.97 * len(clean)
    whole = P.run(spark, folder)
    assert whole.count() == len(left["decontamination"]) and whole.where("NOT same_text").count() == 0


def test_an_empty_table(spark, folder, tables):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
