import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import combine
from ledgerloom.operators.combine import dedup_counts, except_rows, repeat_rows, union_evolving
from ledgerloom.operators.lookup import fallback_lookup, lookup, restrict_to_keys, within_parameters
from ledgerloom.operators.mutate import delete_where, patch, replace_group, upsert
from ledgerloom.operators.numbering import TOP_K_ROWS, number_rows, paginate
from ledgerloom.operators.profile import distinct_row_count, key_check, rowcount_status
from ledgerloom.operators.sizing import BROADCAST_LIMIT_BYTES, broadcast_if_few, broadcast_if_small, estimated_bytes


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- lookups -----------------------------------------------------------------


def test_lookup_null_keys_never_match(spark):
    facts = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    table = spark.createDataFrame([("a", "A"), (None, "none")], "k string, v string")
    assert tuples(lookup(facts, table, ["k"], ["v"])) == [(1, "a", "A"), (2, None, None), (3, "z", None)]


def test_lookup_any_case_and_composite(spark):
    facts = spark.createDataFrame([("Aa", 1), ("aA", 2)], "k string, n int")
    table = spark.createDataFrame([("AA", 1, "x")], "k string, m int, v string")
    assert tuples(lookup(facts, table, {"k": "k", "n": "m"}, ["v"], case_insensitive=True)) == [("Aa", 1, "x"), ("aA", 2, None)]
    by_name = lookup(facts, table, ["k"], ["v"], case_insensitive=True)
    assert tuples(by_name) == [("Aa", 1, "x"), ("aA", 2, "x")]


def test_fallback_only_for_the_unknown(spark):
    facts = spark.createDataFrame([(1, "Unknown", "ABC-1"), (2, "org1", "ABC-2"), (3, "Unknown", "ZZZ-1"), (4, None, "ABC-3")], "id int, org string, plan string")
    xref = spark.createDataFrame([("ABC", "org2")], "code string, o string")
    orgs = spark.createDataFrame([("org1", "B1"), ("org2", "B2")], "o string, book string")
    out = fallback_lookup(facts, "org", "Unknown", "plan", 3, xref, "code", "o", orgs, "o", "book", "final_org", "final_book")
    assert {r["id"]: (r["final_org"], r["final_book"]) for r in out.collect()} == {
        1: ("org2", "B2"),
        2: ("org1", "B1"),
        3: (None, None),
        4: (None, None),
    }


def test_restrict_compares_as_text_and_keeps_multiplicity(spark):
    df = spark.createDataFrame([("P", "1"), ("P", "2")], "p string, e string")
    keys = spark.createDataFrame([("P", 1), ("P", 1)], "p string, e int")
    assert tuples(restrict_to_keys(df, keys, {"p": "p", "e": "e"})) == [("P", "1"), ("P", "1")]


def test_parameter_period_open_and_closed(spark):
    days = spark.createDataFrame([(dt.date(2020, 12, d),) for d in (1, 31)], "d date")
    params = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2020, 12, 31))], "s date, e date")
    assert within_parameters(days, "d", params, "s", "e").count() == 1
    assert within_parameters(days, "d", params, "s", "e", closed=True).count() == 2
    for bad in (params.union(params), params.limit(0)):
        with pytest.raises(ValueError, match="exactly one row"):
            within_parameters(days, "d", bad, "s", "e")


def test_broadcast_needs_a_proven_size(spark):
    small, large = spark.range(10), spark.range(10**9)
    assert estimated_bytes(small) < BROADCAST_LIMIT_BYTES < estimated_bytes(large)
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_if_small(small)) and not hinted(broadcast_if_small(large))
    assert not hinted(broadcast_if_few(large, 100))
    unknown = spark.createDataFrame([(1,)], "n int")
    assert hinted(broadcast_if_few(unknown, 100))


# --- numbering ----------------------------------------------------------------


def test_numbers_are_consecutive_in_order_despite_a_hot_value(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.4 else f"v{rng.randrange(50)}", rng.randrange(3)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(7)
    got = number_rows(df, "k desc", "no", 5).collect()
    assert sorted(r["no"] for r in got) == list(range(5, 3005))
    ordered = [(r["k"], r["n"]) for r in sorted(got, key=lambda r: r["no"])]
    assert ordered == sorted(sorted(rows, key=lambda r: r[1]), key=lambda r: r[0], reverse=True)


def test_a_single_repeated_row_is_spread_over_partitions(spark):
    df = spark.range(2000).select(F.lit(1).alias("x"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # tiny partitions would be merged again
    try:
        numbered = number_rows(df, "x", "no")
    finally:
        spark.conf.set(setting, "true")
    assert sorted(r["no"] for r in numbered.collect()) == list(range(1, 2001))
    sizes = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1000


def test_pages_partition_the_result(spark):
    df = spark.range(107).select((F.col("id") % 10).alias("k"), F.col("id").cast("string").alias("COL A"))
    pages = [paginate(df, start, 25, "`COL A` asc") for start in range(1, 151, 25)]
    rows = [tuple(r) for p in pages for r in p.orderBy("RowNum").collect()]
    assert [r[2] for r in rows] == list(range(1, 108))
    assert [r[1] for r in rows] == sorted(str(i) for i in range(107))
    assert pages[-1].count() == 0


def test_deep_page_equals_shallow_definition(spark):
    df = spark.range(TOP_K_ROWS + 300).select((F.col("id") * 7919 % 10007).alias("v"), "id")
    deep = paginate(df, TOP_K_ROWS + 1, 50, "v desc").orderBy("RowNum").collect()
    want = sorted(((i * 7919 % 10007, i) for i in range(TOP_K_ROWS + 300)), key=lambda t: (-t[0], t[0], t[1]))
    assert [(r["v"], r["id"]) for r in deep] == want[TOP_K_ROWS : TOP_K_ROWS + 50]


# --- sets -----------------------------------------------------------------------


def test_except_rows_is_a_multiset_difference(spark, monkeypatch):
    monkeypatch.setattr(combine, "COPIES_PER_PIECE", 7)
    rng = random.Random(3)
    left = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None])) for _ in range(500)]
    right = [(rng.choice(["a", None, "c"]), rng.choice([1, None])) for _ in range(120)]
    got = except_rows(spark.createDataFrame(left, "x string, y int"), spark.createDataFrame(right, "p string, q int"))
    want = Counter(left)
    want.subtract(Counter(r for r in right))
    assert Counter(tuple(r) for r in got.collect()) == +want


def test_repeated_rows_are_written_in_pieces(spark):
    df = spark.createDataFrame([("x", 25_001), ("y", 0), ("z", 1)], "k string, n bigint")
    out = repeat_rows(df, "n")
    assert {r["k"]: r["count"] for r in out.groupBy("k").count().collect()} == {"x": 25_001, "z": 1}


def test_union_and_dedup(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("x", 2.0)], "s string, d double")
    assert tuples(union_evolving([a, b])) == [(1, "x", None), (None, "x", 2.0)]
    twice = a.union(a)
    assert tuple(dedup_counts(twice).first()) == (2, 1)


def test_counts_treat_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None)], "a int, b int")
    assert distinct_row_count(df).first()[0] == 2
    assert tuple(key_check(df, ["a"]).first()) == (3, 2, False)
    assert tuple(key_check(df.limit(0), ["a"]).first()) == (0, 0, True)
    assert tuple(rowcount_status(df.limit(0)).first()) == ("ERROR", "INVALID", 0)


# --- mutation --------------------------------------------------------------------


def merge(table, changes):
    return upsert(
        table,
        changes,
        ["k"],
        {"v": F.col("change.v")},
        {"k": F.col("k"), "v": F.col("v"), "who": F.lit("new")},
    )


def test_upsert(spark):
    table = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old"), (None, 3, "old")], "k string, v int, who string")
    changes = spark.createDataFrame([("b", 20), ("c", 30), (None, 40)], "k string, v int")
    once = merge(table, changes)
    assert tuples(once) == tuples(
        spark.createDataFrame(
            [("a", 1, "old"), ("b", 20, "old"), (None, 3, "old"), ("c", 30, "new"), (None, 40, "new")],
            "k string, v int, who string",
        )
    )
    known = changes.where("k is not null")
    assert tuples(merge(merge(table, known), known)) == tuples(merge(table, known))


def test_upsert_rejects_two_changes_for_one_row(spark):
    table = spark.createDataFrame([("a", 1, "old")], "k string, v int, who string")
    twice = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    with pytest.raises(Exception, match="several changes"):
        merge(table, twice).collect()
    fresh = spark.createDataFrame([("z", 2), ("z", 3)], "k string, v int")
    assert merge(table, fresh).count() == 3


def test_upsert_scope(spark):
    table = spark.createDataFrame([("a", 1, "s1"), ("a", 1, "s2")], "k string, v int, who string")
    changes = spark.createDataFrame([("a", 9)], "k string, v int")
    out = upsert(table, changes, ["k"], {"v": F.col("change.v")}, {"k": F.col("k")}, F.col("who") == "s1")
    assert tuples(out) == [("a", 1, "s2"), ("a", 9, "s1")]


def test_delete_replace_patch(spark):
    df = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "c string, n int")
    assert Counter(tuples(delete_where(df, F.col("c") == "x"))) == Counter([(None, 2), ("y", 3)])
    new = spark.createDataFrame([("x", 9)], "c string, n int")
    assert Counter(tuples(replace_group(df, new, F.col("c") == "x"))) == Counter([("x", 9), (None, 2), ("y", 3)])
    assert patch(df, F.col("c") == "y", {"n": F.lit(0)}).where("c = 'y'").first()["n"] == 0


def test_a_query_binds_its_frame_alone(spark):
    """The user's own view stays; queries with common table expressions, comments and braces; calls at once."""
    from concurrent.futures import ThreadPoolExecutor

    from ledgerloom.operators.project import full_query

    spark.range(3).createOrReplaceTempView("dataset")
    try:
        df = spark.range(10).withColumnRenamed("id", "N")
        assert full_query(df, "SELECT max(N) AS m FROM dataset;").first().m == 9
        text = "/* with */ -- {x}\n WITH big AS (SELECT * FROM dataset WHERE N > 4) SELECT count(*) AS c, '{a}' AS t FROM big"
        assert tuple(full_query(df, text).first()) == (5, "{a}")
        nested = "SELECT count(*) AS c FROM (SELECT a.N FROM dataset a JOIN dataset b ON a.N = b.N) x"
        assert full_query(df, nested).first().c == 10
        assert spark.table("dataset").count() == 3
        frames = [spark.range(n).withColumnRenamed("id", "N") for n in range(1, 9)]
        with ThreadPoolExecutor(4) as pool:
            counts = list(pool.map(lambda f: full_query(f, "SELECT count(*) AS c FROM dataset").first().c, frames * 3))
        assert counts == [*range(1, 9)] * 3
        assert [t.name for t in spark.catalog.listTables() if t.isTemporary] == ["dataset"]
    finally:
        spark.catalog.dropTempView("dataset")
