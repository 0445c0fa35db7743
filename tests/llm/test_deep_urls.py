"""Templates reach to the last segment of a path."""

from ledgerloom.llm.url_templates import url_filter


def test_a_bad_template_of_many_segments(spark):
    def word(i: int) -> str:
        return "".join("abcdefghij"[int(d)] for d in str(100 + i))

    rows = [(i, f"http://h.org/2021/03/05/section/part/slug-{word(i)}/end") for i in range(40)]
    rows += [(100 + i, f"http://h.org/2021/03/05/section/good/{word(i)}") for i in range(40)]
    trap = "/x" * 700
    rows += [(200, f"http://trap.org{trap}/a"), (201, "http://trap.org/y"), (202, "http://deep.org/a/b/c/d/e/f/g/h")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = spark.createDataFrame([(i, i < 100) for i in (*range(20), *range(100, 120))], "page_id long, bad boolean")
    got = {r.page_id: (r.template, r.verdict) for r in url_filter(pages, [], marks).collect()}
    assert {got[i] for i in range(40)} == {("/{n}/{n}/{n}/section/part/*/end", "block")}
    assert {got[100 + i] for i in range(40)} == {("/{n}/{n}/{n}/section/good/*", "allow")}
    assert got[200][0].endswith("/x" * 600 + "/a") and got[202] == ("/a/b/c/d/e/f/g/h", "allow")
