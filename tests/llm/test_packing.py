"""Packing: every token once and in order, no sequence over its size, few sequences."""

import zlib

import numpy as np
import pytest
from ledgerloom.llm.packing import best_configuration, configurations, grouped, pack, plan, sequences
from ledgerloom.llm.tokenizing import tokenizer_path

RNG = np.random.default_rng(6)
LENGTHS = {
    "none": [],
    "one": [5],
    "small": RNG.integers(1, 60, 3_000),
    "all": RNG.integers(1, 101, 4_000),
    "large": RNG.integers(26, 101, 4_000),
    "thirds": [*[34] * 500, *[33] * 1_000],
    "pairs": [*[51] * 400, *[49] * 400, *[100] * 30],
    "fours": RNG.integers(21, 30, 2_000),
}


def filled(rows, counts):
    places = {}
    for length in np.flatnonzero(counts):
        own = rows[rows[:, 0] == length]
        assert (own[:, 1] == np.r_[0, np.cumsum(own[:, 2])[:-1]]).all() and own[:, 2].sum() == counts[length]
    for length, _, n, first, offset in rows.tolist():
        for k in range(n):
            places.setdefault(first + k, []).append((offset, length))
    return places


@pytest.mark.parametrize("name", LENGTHS)
def test_plan(name):
    counts = np.bincount(np.array(LENGTHS[name], int), minlength=101)
    for ways in (((2, 16), (3, 16), (4, 16)), ((3, 8),), ((4, 5),)):
        places = filled(plan(counts, 100, ways), counts)
        assert sorted(places) == list(range(len(places)))
        for parts in places.values():
            parts.sort()
            assert [o for o, _ in parts] == np.r_[0, np.cumsum([n for _, n in parts])[:-1]].tolist()
            assert sum(n for _, n in parts) <= 100
    bound = -(-int((counts * np.arange(101)).sum()) // 100)
    if name in ("small", "all", "thirds", "pairs"):
        assert len(filled(plan(counts, 100), counts)) <= 1.01 * bound + 1
    if name == "fours":
        assert len(filled(plan(counts, 100), counts)) <= 1.03 * bound


def test_configurations_are_the_least():
    """Against all configurations of a few sizes."""
    sizes, numbers = np.array([45, 37, 31, 23]), np.array([97, 610, 395, 211])
    worth, best = best_configuration(sizes, np.array([0.5, 0.4, 0.33, 0.2]), 100)
    every = [c for c in np.ndindex(3, 3, 4, 5) if np.dot(c, sizes) <= 100]
    assert abs(worth - max(np.dot(c, [0.5, 0.4, 0.33, 0.2]) for c in every)) < 1e-9 and tuple(best) in every
    columns, times = configurations(sizes, numbers, 100)
    assert (columns @ times <= numbers).all() and (numbers - columns @ times < 4 * columns.max()).all()
    assert times.sum() <= 452.25 and (columns.T @ sizes <= 100).all()
    got, n = grouped(np.array([9, 7, 5, 2]), np.array([10, 1, 1, 4]), 4)
    assert got.tolist() == [9, 2] and n.tolist() == [12, 4]


def test_pack(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    texts = [" ".join(f"w{x}" for x in RNG.integers(0, 999, int(n))) for n in RNG.integers(0, 40, 60)]
    texts += [None, "", "a b c " * 20_000, "same", "same", "<|endoftext|> œuvre 漢字"]
    rows = [(i if i % 7 else None, t, "x", i) for i, t in enumerate(texts)]
    rows.append(rows[3])
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, offset int").repartition(5)
    found = pack(docs, size=64, with_ids=True).cache()
    want = []
    for i, t, *_ in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range((len(ids) - 1) % 64 + 1, len(ids) + 1, 64)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            want.append((i or 0, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    got = found.collect()
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    whole = {r.sequence_id: r.ids for r in sequences(found).collect()}
    assert all(whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids for r in got)
    assert sum(map(len, whole.values())) == sum(w[3] for w in want) and max(map(len, whole.values())) <= 64
    assert len(whole) <= -(-sum(w[3] for w in want) // 64) + 2
    assert pack(docs.limit(0)).count() == 0
