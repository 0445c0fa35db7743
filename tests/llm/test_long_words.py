"""A word has no greatest length."""

from ledgerloom.llm.language import language_id


def test_one_unbroken_run_of_letters(spark):
    rows = [(i, f"the cat and the dog number {'abc'[i % 3]} were here", "en") for i in range(40)]
    rows += [(900, "q" * 320_000, None), (901, "я" * 310_000, None)]
    got = {r.doc_id: r for r in language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert len(got) == 42
    assert got[900].lang_pred == got[901].lang_pred == "en"
