"""Periodic runs against the definition, tried at every place and period."""

import numpy as np
import pytest
from ledgerloom.llm.periodic import periodic_runs, runs_of, without_repeats, word_codes


def brute(words, least=24, periods=3):
    n, out, taken = len(words), [], set()
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, periods * q) and (i, length) not in taken:
                taken.add((i, length))  # a greater period of the same stretch is not its smallest
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_texts():
    rng = np.random.default_rng(2)
    out = [[], [0], [0] * 23, [0] * 24, [0] * 200, [0, 1] * 40, [0] * 30 + [1] * 30, ([0] * 9 + [1]) * 8]
    out.append((([0, 1, 1] * 9 + [2]) * 4 + [3]) * 3)
    for _ in range(150):
        words = []
        while len(words) < 120:
            block = rng.integers(0, int(rng.integers(1, 6)), int(rng.integers(1, 12))).tolist()
            words += block * int(rng.integers(1, 9))
            if rng.random() < 0.5:
                words += rng.integers(0, 9, int(rng.integers(0, 3))).tolist()
        out.append(words)
    a, b = [0], [0, 1]
    for _ in range(9):
        a, b = b, b + a
    return [*out, b]


@pytest.mark.parametrize(("least", "periods"), [(24, 3), (6, 3), (10, 4)])
def test_runs_are_those_of_the_definition(least, periods):
    texts = some_texts()
    codes = np.array([w for t in texts for w in t], np.int64)
    runs, owner = runs_of(codes, np.array([len(t) for t in texts]), least, periods)
    total = 0
    for i, t in enumerate(texts):
        want = brute(t, least, periods)
        assert [tuple(r) for r in runs[owner == i].tolist()] == want, t
        total += len(want)
    assert total > 100


def test_words_and_what_is_left():
    texts = [b"", b"  a b\t\x0bc\x1f d\r\n", "é x y".encode(), b"a b"]
    codes, counts = word_codes(texts)
    assert counts.tolist() == [len(t.split()) for t in texts]
    assert len(set(codes.tolist())) == len({w for t in texts for w in t.split()})
    text = b"x " + b"a b c " * 10 + b"a y"
    runs, _ = runs_of(*word_codes([text]))
    assert runs.tolist() == [[1, 31, 3]]
    assert without_repeats(text, runs) == b"x a b c y"


def test_long_repeats_take_little_time():
    line = " ".join(f"w{i}" for i in range(16)).split()
    rng = np.random.default_rng(1)
    texts = [["a"] * 60_000, line * 4_000, [w for i in range(4_000) for w in (*line, str(rng.integers(0, 99)))]]
    codes, counts = word_codes([" ".join(t).encode() for t in texts])
    runs, owner = runs_of(codes, counts)
    assert runs[owner == 0].tolist() == [[0, 60_000, 1]]
    assert runs[owner == 1].tolist() == [[0, 64_000, 16]]


def test_rows(spark):
    rows = [
        (1, "a b " * 20, "x", 1),
        (1, "a b " * 20, "x", 1),
        (None, None, None, None),
        (2, "", "x", 2),
        (3, "z " * 50_000, "x", 3),
        (4, "no run here", "x", 4),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int")
    got = periodic_runs(docs).collect()
    seen = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=str)
    assert seen == sorted(
        [
            (1, 40, [(0, 40, 2)], "a b"),
            (1, 40, [(0, 40, 2)], "a b"),
            (0, 0, [], ""),
            (2, 0, [], ""),
            (3, 50_000, [(0, 50_000, 1)], "z"),
            (4, 3, [], "no run here"),
        ],
        key=str,
    )
    assert periodic_runs(docs.limit(0)).count() == 0


def test_query(spark, folder):
    """The whole query against its definition, word by word."""
    import hashlib
    import zlib

    from ledgerloom.llm.queries import op12_periodic_runs

    rng = np.random.default_rng(4)
    texts = [" \t".join(f"w{x}" for x in rng.integers(0, 300, int(rng.integers(0, 120)))) + "\n" for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b " * 30), (900, None), (901, ""), (902, "é " * 40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    want = []
    for i, t in rows:
        words = (t or "").split()
        n = len(words)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if j < a else words[a + (j - a) % p] for j, w in enumerate(words)]
        runs = brute(words)
        best = sorted(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))[:1]
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        digest = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        want.append(
            (i, len(runs), *(best[0] if best else (None,) * 3), best[0][1] * 1000 // best[0][2] if best else None)
            + tuple(hashlib.sha256(x.encode()).hexdigest() for x in (digest, left))
        )
    got = [tuple(r) for r in op12_periodic_runs(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(w[1] for w in want) > 15
