"""The shape of physical plans: what must hold at any scale."""

import re

import pytest

from ledgerloom.queries import QUERIES


def plan(spark, data, name):
    return QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, filters",
    [
        ("premium_report", ["GreaterThanOrEqual(l_shipdate,1996-01-01", "EqualTo(l_returnflag,R)"]),
        ("premium_by_line", ["GreaterThanOrEqual(l_shipdate,", "IsNotNull(l_shipdate)"]),
        ("param_range_join", ["GreaterThanOrEqual(l_shipdate,", "LessThan(l_shipdate,"]),
        ("dynamic_filter", ["GreaterThan(o_totalprice,100000.0)", "EqualTo(o_orderstatus,F)"]),
        ("file_sql_scan", ["GreaterThan(o_totalprice,1000.0)"]),
    ],
)
def test_filters_reach_the_scan(spark, data, name, filters):
    df = QUERIES[name](spark, data)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    for f in filters:
        assert f in text, f


def test_only_needed_columns_are_read(spark, data):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, data, "pk_check"))
    assert set(schemas) == {"l_orderkey:bigint,l_linenumber:int", "o_orderkey:bigint"}


@pytest.mark.parametrize("name", ["enrich_lookup", "case_override", "keylist_join", "role_columns", "star_publish", "import_rules"])
def test_small_lookups_do_not_shuffle_the_facts(spark, data, name):
    text = plan(spark, data, name)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("name", ["unpivot_rules", "exposure_base", "normalize_dates", "stringify", "align_schema", "split_labels"])
def test_narrow_operators_have_no_exchange(spark, data, name):
    text = plan(spark, data, name)
    assert "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize("name", ["number_rows", "paginate_deep", "assign_group_ids"])
def test_numbering_orders_no_whole_table_in_one_partition(spark, data, name):
    text = plan(spark, data, name)
    for window in re.findall(r"Window \[.*", text):
        assert "__size" in window, window

