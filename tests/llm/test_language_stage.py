"""The language stage of the pipeline."""

import random

import corpus_pipeline

EN = "the old cat and the young dog were walking home from the market when it began to rain and nobody was there"
DE = "der alte hund und die junge katze gingen vom markt nach hause als es zu regnen begann und niemand war dort"
PL = "wszyscy ludzie rodzą się wolni i równi pod względem swej godności oraz swych praw"


def test_unlearnt_languages_and_junk_go(spark):
    rng = random.Random(3)

    def some(text: str) -> str:
        return " ".join(rng.choice(text.split()) for _ in range(40))

    rows = [(i, some(EN), "en") for i in range(40)] + [(100 + i, some(DE), "de") for i in range(40)]
    rows += [(i + 200, t, None) for i, t in enumerate((some(EN), "the dog", "Und die Katze!"))]
    junk = " ".join("".join(rng.choice("qwxzkvjp") for _ in range(6)) for _ in range(30))
    rows += [(i + 300, t, None) for i, t in enumerate((PL, junk, "съешь ещё этих мягких булок", "42 !", None, "q" * 100))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, docs, "").collect()}
    assert kept == {r[0] for r in rows if r[0] < 300}


def test_all_stay_if_nothing_is_labelled(spark):
    docs = spark.createDataFrame([(1, EN, None), (2, "42", None), (3, None, "en"), (4, "!", "en")], "doc_id long, text string, lang string")
    assert corpus_pipeline.keep_known_languages(spark, docs, "").count() == 4
    assert corpus_pipeline.keep_known_languages(spark, docs.limit(0), "").count() == 0
