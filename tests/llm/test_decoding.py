"""Whether the ids give a document again is judged by decoding them."""

import corpus_pipeline
from ledgerloom.llm.pieces import decoded

TEXTS = {1: "load ▁▂▃▁ now", 2: " a  b ", 3: "漢字 😀\n\n\tend ", 4: "▁", 5: None}


def test_same_text_is_what_decoding_gives(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")
    ids = corpus_pipeline.encode_pieces(spark, docs, "")
    back = {r.doc_id: r.text for r in decoded(ids).collect()}
    got = {r.doc_id: r.same_text for r in ids.collect()}
    assert got == {i: back[i] == (t or "") for i, t in TEXTS.items()}
    assert got == {1: False, 2: True, 3: True, 4: False, 5: True}
