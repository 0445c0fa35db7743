"""The text operators against brute force, the libraries, and on odd rows."""

import math
import zlib

import numpy as np
import pytest
from ledgerloom.llm import licenses, minhash, neighbours, token_files
from ledgerloom.llm.common import at_hand
from ledgerloom.llm.decontamination import contaminated
from ledgerloom.llm.language import SuffixAutomaton, language_id
from ledgerloom.llm.pieces import decoded, encoded, piece_model, piece_model_path
from ledgerloom.llm.token_counts import token_counts
from ledgerloom.llm.tokenizing import tokenizer_path
from ledgerloom.llm.toxicity import toxicity
from ledgerloom.llm.url_templates import url_filter

ODD = [
    (1, "Hello, world! It's 42 <|endoftext|> naïve   x"),
    (2, None),
    (3, ""),
    (None, "no id at all"),
    (4, "Hello, world! It's 42 <|endoftext|> naïve   x"),
    (4, "œuvre “quoted” 漢字 😀\n\n\tend "),
    (5, "word " * 30_000),
    (6, "!!! ... ,,"),
]


@pytest.fixture
def odd(spark):
    at_hand(spark)
    rows = [(i, t, "en" if i else None, "x", "y") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, n_tokens string")


@pytest.fixture
def none(odd):
    return odd.limit(0)


def test_token_counts(odd, none):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path())
    want = sorted((i or 0, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t in ODD)
    got = token_counts(odd).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    assert {r.over_limit for r in got if r.doc_id == 5} == {True}
    assert token_counts(none).count() == 0


def test_token_files(odd, none, folder):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path())
    want, start = [], 0
    for i, t in sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i or 0, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_files.token_files(odd, folder=f"{folder}/a").collect()
    assert sorted((r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    assert token_files.token_files(none, folder=f"{folder}/b").count() == 0


def test_grammar_round_trip():
    rng = np.random.default_rng(3)
    for n, top in ((0, 5), (1, 5), (5_000, 3), (5_000, 400), (4_000, 1)):
        ids = rng.integers(0, top, n)
        lengths = np.array([n // 3, 0, n - n // 3])
        row = token_files.block_row(ids, lengths, [1, 2, 3], 0, 500)
        assert (token_files.decode_block(row) == ids).all()
        ends = np.cumsum(lengths)
        for i in range(3):
            assert (token_files.decode_document(row, i) == ids[ends[i] - lengths[i] : ends[i]]).all()


def test_pieces_are_the_librarys(odd, none):
    model = piece_model(piece_model_path())
    got = encoded(odd).collect()
    assert sorted(tuple(r.ids) for r in got) == sorted(tuple(model.library.encode(t or "")) for _, t in ODD)
    assert all(r.same_text for r in got)
    text = "thntblere " * 40 + "averyveryverylongwordwithoutablank" * 9
    assert [i for p in model.search(model.normal(text)) for i in model.ids_of(p)] == model.library.encode(text)
    back = sorted(r.text for r in decoded(encoded(odd)).collect())
    assert back == sorted(t or "" for _, t in ODD)
    assert encoded(none).count() == 0


def test_near_duplicates(spark, odd, none):
    base = [f"w{i}" for i in range(120)]
    near = base[:60] + ["other"] + base[61:]
    far = [f"v{i}" for i in range(120)]
    rows = [(10, " ".join(base)), (11, " ".join(near)), (12, " ".join(base)), (13, " ".join(far)), (14, "short"), (15, "Short!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.representative) for r in minhash.near_duplicates(docs).collect()}
    assert minhash.similarity(rows[0][1].encode(), rows[1][1].encode()) >= 0.8
    assert got == {10: (10, True), 11: (10, False), 12: (10, False), 13: (13, True), 14: (14, True), 15: (14, False)}
    assert minhash.near_duplicates(odd).count() == len(ODD)
    assert minhash.near_duplicates(none).count() == 0


def test_maps_prove_only_what_is_unlike(spark):
    rng = np.random.default_rng(4)
    texts = [b"", b"a", b"a a a a a a a a"]
    for _ in range(30):
        base = rng.integers(0, 40, int(rng.integers(5, 400))).tolist()
        texts += [" ".join(f"t{w if rng.random() > p else 99}" for w in base).encode() for p in (0, 0.01, 0.03, 0.3)]
    doc, value, count = minhash.shingles(texts)
    maps = minhash.parity_maps(doc, value, count, len(texts))
    size = np.bincount(doc, count, len(texts)).astype(int)
    rows = [(i, m.tolist(), int(s)) for i, (m, s) in enumerate(zip(maps, size, strict=True))]
    df = spark.createDataFrame(rows, "i int, map array<long>, size long")
    near = df.alias("l").join(df.alias("r"), minhash.F.expr("l.i < r.i AND l.i + 4 > r.i"))
    like = minhash.may_be_like("l.map", "r.map", "l.size", "r.size", 0.8)
    kept = {(r[0], r[1]): r[2] for r in near.select("l.i", "r.i", like).collect()}
    alike = {p for p in kept if minhash.similarity(texts[p[0]], texts[p[1]]) >= 0.8}
    assert alike and all(kept[p] for p in alike)
    assert not all(kept.values())


def test_near_duplicates_of_a_family_at_the_threshold(spark, odd):
    """Edited copies of one text, some like it and some only like another copy: classes as brute force has them."""
    rng = np.random.default_rng(7)
    base, rows = [f"w{i}" for i in range(100)], []
    for i in range(60):
        copy = list(rows[-1][1].split() if i % 3 == 2 else base)
        for place in rng.choice(100, int(rng.integers(1, 5)), replace=False):
            copy[place] = f"new{i}x{place}"
        rows.append((i, " ".join(copy)))
    root = list(range(60))
    for i in range(60):
        for j in range(i):
            if minhash.similarity(rows[i][1].encode(), rows[j][1].encode()) >= 0.8:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert 5 < len(set(root)) < 60
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == dict(enumerate(root))


def test_darts_meet_with_the_weighted_similarity():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 4, 200), rng.integers(0, 4, 200)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    e = np.arange(200).astype(np.uint64)
    doc = np.r_[np.zeros(200, int), np.ones(200, int)]
    keep = np.r_[a, b] > 0
    got = minhash.darts(doc[keep], np.r_[e, e][keep], np.r_[a, b][keep], 2, 4096)
    assert abs((got[0] == got[1]).mean() - want) < 0.03


def test_contaminated(spark, odd, none):
    item = " ".join(f"Item{i}" for i in range(40))
    edited = item.replace("Item39", "changed")
    items = spark.createDataFrame([(1, item), (2, "two words"), (3, None), (None, item)], "item_id long, text string")
    rows = [
        (1, "before " * 300 + item.upper() + " after" * 300),
        (2, edited),
        (3, item.replace("Item20", "x").replace("Item10", "y").replace("Item30", "z")),
        (4, "it has two, words here"),
        (5, None),
        (None, item),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.first_word, round(r.similarity, 3)) for r in contaminated(docs, items).collect()}
    assert got == {(1, 1): (300, 1.0), (2, 1): (0, round(35 / 37, 3)), (4, 2): (2, 1.0)}
    assert contaminated(odd, items.limit(0)).count() == 0
    assert contaminated(none, items).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((900, 16)).round(2)
    x[5] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2100, [0.0] * 16), (2200, [float("nan")] * 16), (2300, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    at_hand(spark)
    got: dict = {}
    for r in neighbours.nearest(df).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 900, 100))
    met = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(900), d)) if i != q][:10]
        met += len(set(order) & {v for v, _ in found.values()})
        assert all(math.isclose(s, d[v]) for v, s in found.values())
        assert [s for _, (_, s) in sorted(found.items())] == sorted(s for _, s in found.values())
    assert got[0][1] == (5, 0.0)
    assert met >= 81
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_language(spark, odd, none):
    rows = [(i, f"the cat and the dog number {'abc'[i % 3]} were here", "en") for i in range(40)]
    rows += [(100 + i, f"der hund und die katze {'abc'[i % 3]} waren hier", "de") for i in range(40)]
    docs = spark.createDataFrame([*rows, (500, "42 !", "en"), (501, None, "de")], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id(docs).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert got[500].lang_pred == got[501].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert language_id(odd).count() == len(ODD)
    assert language_id(none).count() == 0
    text = "abracadabra abra"
    automaton = SuffixAutomaton(text)
    for t in ("abra", "cadabrax", "xyz", "braabra"):
        for i in range(len(t)):
            want = max(k for k in range(len(t) - i + 1) if t[i : i + k] in text)
            assert automaton.longest_match(t, i) == want


def test_licenses(odd, none):
    text = b"CC BY, all rights reserved. Licensed under the GNU General Public License, version 3 or Apache-2.0; cc by"
    n, base, more = licenses.scan(text)
    assert n == 20
    assert base == [(0, "cc-by"), (2, "reserved"), (9, "gpl"), (18, "cc-by")]
    assert "gpl-3.0" in {d[2] for d in more}
    assert not any(a != b and b[0] <= a[0] and a[1] <= b[1] for a in more for b in more)
    got = {(r.doc_id, r.n_words): r for r in licenses.license_scan(odd).collect()}
    assert got[(2, 0)].labels == "" and got[(2, 0)].first_word is None and got[(5, 30_000)].score == 0
    assert licenses.license_scan(none).count() == 0
    assert len(licenses.rules()) > 300


def test_toxicity(spark, odd, none):
    rng = np.random.default_rng(2)
    rows, marks = [], []
    for i in range(600):
        bad = i % 6 == 0
        words = [f"w{k}" for k in rng.integers(0, 300, 30)] + (["nastyword"] if bad else [])
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    held = [(got[i].predicted, t) for i, t in marks if got[i].held_out]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)
    assert {r.predicted for r in toxicity(odd, labels.limit(0)).collect()} == {0}
    assert toxicity(none, labels).count() == 0


def test_url_filter(spark):
    rows = [
        (1, "https://a.Example.NET/en/x?q#f"),
        (2, "http://b.net/en/1"),
        (3, "http://example.com/de/5"),
        (4, "http://notexample.com/de/5"),
        (5, "http://x.org/fr/9"),
        (6, None),
        (7, "no scheme"),
        (8, "http://x.net"),
        (8, "http://x.net/a"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter(pages).where("page_id < 8").collect())
    assert got == [
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "b.net", "/en/1", "net/", "block"),
        (3, "example.com", "/de/5", "example.com/de/", "block"),
        (4, "notexample.com", "/de/5", None, "allow"),
        (5, "x.org", "/fr/9", "org/fr/", "allow"),
        (6, "", "", None, "allow"),
        (7, "", "", None, "allow"),
    ]
    many = spark.createDataFrame([(i, f"http://h.org/p/{i}") for i in range(40)], "page_id long, url string")
    marks = spark.createDataFrame([(i, True) for i in range(20)], "page_id long, bad boolean")
    assert {r.verdict for r in url_filter(many, [], marks).collect()} == {"block"}
    assert url_filter(pages.limit(0)).count() == 0


def test_grammar_is_as_deep_as_the_repeats():
    """Rounds go on until no pair is frequent: a long repeat leaves few symbols, and no frequent pair."""
    ids = np.tile(np.arange(8), 20_000)
    symbols, rules, lengths = token_files.repair(ids, 100)
    assert len(symbols) < 40 and lengths.max() >= 8_192
    assert (token_files.expand(symbols, rules, 100) == ids).all()
    rng = np.random.default_rng(8)
    symbols, _, _ = token_files.repair(rng.integers(0, 30, 50_000), 100)
    _, counts = np.unique(np.stack([symbols[:-1], symbols[1:]]), axis=1, return_counts=True)
    assert counts.max() < token_files.LEAST


def toxic_table(spark, copies=1):
    rng = np.random.default_rng(9)
    calm, rude = [f"calm{i}" for i in range(300)], [f"rude{i}" for i in range(40)]
    docs, marks = [], []
    for i in range(900):
        bad = i % 6 == 0
        words = [*rng.choice(calm, 40), *(rng.choice(rude, 12) if bad else [])]
        docs.append((i, " ".join(rng.permutation(words))))
        marks.append((i, int(bad) if i % 2 == 0 else None))
    docs += [(None, "rude1 rude2 rude3"), (5_000, None), (5_001, "")]
    schema = "doc_id long, text string, positive string, features string"
    return (
        spark.createDataFrame([(*d, "x", "y") for d in docs for _ in range(copies)], schema),
        spark.createDataFrame(marks, "doc_id long, toxic int"),
    )


def test_toxic_documents_are_found(spark):
    """Held-out documents, labelled or not."""
    docs, labels = toxic_table(spark)
    got = toxicity(docs, labels).collect()
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert len(held) > 100 and len(got) == docs.count()
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) >= 0.97 * len(held)
    assert all(r.predicted == 0 for r in got if r.doc_id in (5_000, 5_001))


def test_copies_of_rows_teach_toxicity_nothing(spark):
    once = {r.doc_id: r.score for r in toxicity(*toxic_table(spark)).collect()}
    often = toxicity(*toxic_table(spark, 3)).collect()
    assert len(often) == 3 * len(once) and all(abs(r.score - once[r.doc_id]) < 1e-9 for r in often)
    docs, labels = toxic_table(spark)
    assert toxicity(docs.limit(0), labels).count() == 0
    assert {r.predicted for r in toxicity(docs, labels.limit(0)).collect()} == {0}
