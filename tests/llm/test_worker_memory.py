"""What Python workers hold stays small, whatever ran in them before."""

import gc
import random
import tracemalloc
import weakref

import pyarrow as pa

import corpus_pipeline
from ledgerloom.llm import minhash, pieces
from ledgerloom.llm.common import BATCH_ROWS, Codes, with_text, worker_cache
from ledgerloom.llm.language import SuffixAutomaton


def test_automaton_is_small_and_complete():
    dice = random.Random(3)
    text = " ".join("".join(dice.choice("etaoinshrdluäé漢") for _ in range(dice.randint(1, 9))) for _ in range(4_000))
    tracemalloc.start()
    automaton = SuffixAutomaton(text)
    gc.collect()
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 250 * len(text)
    for _ in range(300):
        start = dice.randrange(len(text))
        part = text[start : start + dice.randint(1, 12)] + dice.choice("ez漢")
        want = next(n for n in range(len(part), -1, -1) if part[:n] in text)
        assert automaton.longest_match(part, 0) == want


def test_model_goes_when_another_operator_begins():
    model = weakref.ref(pieces.piece_model(pieces.piece_model_path()))
    assert model() is pieces.piece_model(pieces.piece_model_path())
    worker_cache("another", None, dict)
    gc.collect()
    assert model() is None


def test_codes_are_bounded_by_letters_too():
    codes = Codes(lambda key: [len(key)])
    codes.MOST_HELD = 1_000
    assert codes["x" * 2_000] == 0
    codes.trim()
    assert not codes and not codes.sizes and codes["ab"] == 0


def test_pairs_are_compared_in_slices():
    n = 1_000
    batch = pa.RecordBatch.from_pydict(
        {
            "a": pa.array([b"%d" % i for i in range(n)], pa.binary()),
            "b": pa.array([b"-%d" % i for i in range(n)], pa.binary()),
            "text_a": [f"one two three four five six {i}" for i in range(n)],
            "text_b": [f"one two three four five six {i}" if i % 2 else "other words stand here today" for i in range(n)],
        }
    )
    out = list(minhash._verified(iter([batch]), 0.8))
    assert max(x.num_rows for x in out) <= 128
    assert [r["a"] for x in out for r in x.to_pylist()] == [b"%d" % i for i in range(1, n, 2)]


def test_text_goes_to_workers_once_in_small_batches(spark):
    docs = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")
    rows, column = with_text(docs, docs.columns)
    assert rows.columns == docs.columns and column == "text"
    rows, column = with_text(docs, ["doc_id"])
    assert rows.columns == ["doc_id", column] and rows.first()[column] == "a b"
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        assert corpus_pipeline.encode_pieces(spark, docs, "").first()["n_chars"] == 3
        assert int(spark.conf.get(name)) == BATCH_ROWS
        spark.conf.set(name, "10")
        corpus_pipeline.encode_pieces(spark, docs, "")
        assert spark.conf.get(name) == "10"
    finally:
        spark.conf.set(name, before)
