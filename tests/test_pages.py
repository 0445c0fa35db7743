"""Pages over a kept order: the rows of the sorted frame, from the blocks that the page touches."""

import re

import pytest
from ledgerloom.operators.numbering import paginate
from ledgerloom.operators.pages import keep_order, page
from ledgerloom.plans.rule_jobs import keep_rule_pages
from pyspark.sql import functions as F


@pytest.fixture
def rows(spark):
    return spark.range(1_000).select(F.pmod(F.hash("id"), F.lit(50)).alias("COL A"), "id", F.lit(None).cast("string").alias("x"))


def test_pages_are_those_of_a_sort(spark, rows, folder):
    assert keep_order(rows, f"{folder}/p", "`COL A` desc", block_rows=70) == 1_000
    for start, size in ((1, 25), (60, 30), (70, 1), (71, 140), (990, 50), (2_000, 10), (5, 0)):
        got = page(spark, f"{folder}/p", start, size)
        want = paginate(rows, start, size, "`COL A` desc") if size else rows.limit(0)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), (start, size)
        assert size == 0 or got.columns == want.columns


def test_a_page_reads_its_blocks_alone(spark, rows, folder):
    keep_order(rows, f"{folder}/p", block_rows=70)
    got = page(spark, f"{folder}/p", 65, 10)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*page_block#\d+L? >= 0[^\]]*page_block#\d+L? <= 1", plan)
    # Listed files of the scan after pruning: those of two blocks of fifteen.
    assert {re.search(r"page_block=(\d+)", f)[1] for f in got.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {"0", "1"}
    assert "Exchange" not in plan and "Sort" not in plan


def test_no_rows_and_a_new_order(spark, rows, folder):
    assert keep_order(rows.limit(0), f"{folder}/p") == 0
    assert page(spark, f"{folder}/p", 1, 10).count() == 0
    assert keep_rule_pages(rows, f"{folder}/p", "id desc") == 1_000
    assert [r.id for r in page(spark, f"{folder}/p", 1, 3).orderBy("RowNum").collect()] == [999, 998, 997]
    keep_rule_pages(rows, f"{folder}/p", " null ")
    first = page(spark, f"{folder}/p", 1, 1_000).orderBy("RowNum").collect()
    assert [r["COL A"] for r in first] == sorted(r["COL A"] for r in first)
