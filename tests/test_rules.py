import datetime as dt
from dataclasses import replace
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.schemas import SchemaMismatch
from ledgerloom.operators import rules as R
from ledgerloom.plans import rule_jobs as J
from ledgerloom.plans import selection as Sel
from ledgerloom.plans.ingest import ENRICHMENTS, References, subject_snapshot
from ledgerloom.plans.premium import Line, premium_by_line, premium_report
from ledgerloom.queries.mapping import metadata
from ledgerloom.sinks.versions import read_current

COLUMNS = R.RuleColumns({1: "A", 2: "B"}, {11: "trg#7_X", 12: "trg#8_Y Z"})
WIDE = "mapping_rule_column_group_id bigint, A string, B string, `trg#7_X` string, `trg#8_Y Z` string"


def counts(df):
    return Counter(tuple(r) for r in df.collect())


def wide(spark, rows):
    return spark.createDataFrame(rows, WIDE)


def to_long(df):
    return R.unpivot_rules(df, {n: i for i, n in COLUMNS.source.items()}, {n: i for i, n in COLUMNS.target.items()})


def test_pivot_of_unpivot_is_the_same(spark):
    df = wide(spark, [(1, "a", "", "x", None), (2, "b", "c", None, "y")])
    long = to_long(df)
    assert long.count() == 8
    assert counts(R.pivot_rules(long, COLUMNS.source, COLUMNS.target)) == counts(df)


def test_names_and_roles():
    assert R.target_of("trg#12_A_B") == ("12", "A_B") and R.target_of("A") is None
    assert R.columns_by_target([R.GROUP, "A", "trg#7_X", "trg#7_Y"]) == {"src": ["A"], "7": ["X", "Y"]}
    assert R.mapping_roles("Key to Attribute") == ("Key", "Attribute")
    assert R.mapping_roles("Expression Mapping") == ("Attribute", "Attribute")


def test_rule_columns_follow_the_rule_set_type(spark):
    meta = metadata(spark)
    assert R.rule_columns(meta, 1) == R.RuleColumns(
        {501: "C_NAME", 502: "C_MKTSEGMENT"}, {601: "trg#11_SEGMENT", 602: "trg#11_GRADE"}
    )
    assert R.rule_columns(meta, 2) == R.RuleColumns({511: "C_NAME"}, {611: "trg#21_N_NAME"})


def test_full_outer_meets_null_keys_and_keeps_copies(spark):
    data = spark.createDataFrame([("a", None), ("a", None), ("n", "n")], "A string, B string")
    rules = spark.createDataFrame([(1, "a", ""), (2, "gone", "x")], "mapping_rule_column_group_id int, A string, B string")
    got = R.rules_full_outer(data, rules, ["A", "B"])
    assert counts(got) == Counter({("a", "", 1): 2, ("n", "n", None): 1, ("gone", "x", 2): 1})


def test_semi_and_anti_make_the_whole(spark):
    rules = wide(spark, [(1, "a", None, "x", None), (2, "b", "q", "x", "y"), (3, "c", "q", None, None)])
    data = spark.createDataFrame([("a", ""), ("c", "q"), ("c", "q")], "A string, B string")
    missing = {r[R.GROUP] for r in R.missing_rules(rules, data, ["A", "B"]).collect()}
    flagged = R.with_presence(rules, data, ["A", "B"], "there")
    assert missing == {2}
    assert {r[R.GROUP] for r in flagged.where("there").collect()} | missing == {1, 2, 3}
    assert flagged.count() == 3


def flagged_long(df):
    return to_long(df).withColumns({R.MISSING_SOURCE: F.lit(1), R.MISSING_TARGET: F.lit(1)})


def validate(spark, rules, source, x, y):
    return J.validate_rules(
        flagged_long(wide(spark, rules)),
        COLUMNS,
        spark.createDataFrame(source, "A string, B string"),
        {"7": spark.createDataFrame(x, "X string"), "8": spark.createDataFrame(y, "`Y Z` string")},
        "Attribute to Attribute",
    )


def test_validation_reports_every_target(spark):
    rules = [(1, "a", "", "x", "y"), (2, "gone", "b", "x", None), (3, "a", "", "lost", "lost"), (4, "a", "", None, None)]
    result = validate(spark, rules, [("a", None)], [("x",)], [("y",)])
    found = {r["scope"]: r["missing_rules"] for r in result.findings.collect()}
    assert found == {"source": 1, "target 1": 1, "target 2": 1}
    flags = {(r[R.GROUP], r[R.MISSING_SOURCE], r[R.MISSING_TARGET]) for r in result.rules.collect()}
    assert flags == {(1, 0, 0), (2, 1, 0), (3, 0, 1), (4, 0, 0)}
    assert result.status() == J.JobResult("INVALID", "Missing rows in source")


def test_validation_clears_flags_when_all_is_there(spark):
    result = validate(spark, [(1, "a", "", "x", "y")], [("a", "")], [("x",)], [("y",)])
    assert result.status().status == "VALID"
    assert {(r[R.MISSING_SOURCE], r[R.MISSING_TARGET]) for r in result.rules.collect()} == {(0, 0)}
    assert tuple(result.status().as_row(spark).first()) == ("VALID", "", None)


def test_validation_of_other_columns_flags_every_rule(spark):
    rules = flagged_long(wide(spark, [(1, "a", "", "x", "y"), (2, "b", "", "x", "y")])).withColumn(R.MISSING_SOURCE, F.lit(0))
    source = spark.createDataFrame([("a",)], "A string")
    targets = {"7": spark.createDataFrame([("x",)], "X string"), "8": spark.createDataFrame([("y",)], "`Y Z` string")}
    result = J.validate_rules(rules, COLUMNS, source, targets, "Attribute to Attribute")
    assert result.status().status == "INVALID" and result.status().status_desc.startswith("Source columns don't match")
    assert [tuple(r) for r in result.findings.collect()] == [(0, "source", 2)]
    assert {(r[R.MISSING_SOURCE], r[R.MISSING_TARGET]) for r in result.rules.collect()} == {(1, 1)}
    # A key rule needs only its own columns in the data.
    wider = spark.createDataFrame([("a", "", "more"), ("b", "", "more")], "A string, B string, C string")
    assert J.validate_rules(rules, COLUMNS, wider, targets, "Key to Attribute").status().status == "VALID"
    lost = {**targets, "8": spark.createDataFrame([("y",)], "OTHER string")}
    unfit = J.validate_rules(rules, COLUMNS, wider, lost, "Key to Attribute")
    assert unfit.status().status_desc.startswith("Target 2 columns don't match")
    assert {(r[R.MISSING_SOURCE], r[R.MISSING_TARGET]) for r in unfit.rules.collect()} == {(0, 1)}


def test_labels_may_hold_any_character(spark):
    df = wide(spark, [(1, "a", "b", "x", None)])
    long = R.unpivot_rules(df, {"A": "it's/A\\n", "B": 'say "B"'}, {"trg#7_X": "T/X"})
    assert {r[R.SOURCE_ID] for r in long.collect()} == {"it's/A\\n", 'say "B"'}


# --- expression -------------------------------------------------------------------

ONE = R.RuleColumns({1: "A", 2: "B"}, {11: "trg#7_X"})
TABLE = (
    f"mapping_rule_key bigint, {R.GROUP} bigint, {R.SOURCE_ID} bigint, {R.SOURCE_VALUE} string, {R.TARGET_ID} bigint, "
    f"{R.TARGET_VALUE} string, {R.MISSING_SOURCE} int, {R.MISSING_TARGET} int, begin_date timestamp, end_date timestamp, "
    "curr_ind string, active_ind string, update_date timestamp, created_by string, updated_by string"
)


def by_expression(spark, table, rows, expression, mode):
    source = spark.createDataFrame(rows, "A string, B int")
    now = F.lit("2025-01-31 00:00:00").cast("timestamp")
    return J.rules_by_expression(table, source, expression, ONE, "me", mode, now)


def wide_values(df):
    return {
        (r[R.GROUP], r["A"], r["B"], r["trg#7_X"]) for r in R.pivot_rules(df, ONE.source, ONE.target).collect()
    }


def test_expression_save_then_edit(spark):
    empty = spark.createDataFrame([], TABLE)
    saved = by_expression(spark, empty, [("p", 1), ("q", 2), ("r", None)], "CASE WHEN B > 0 THEN 'pos' END", "SAVE")
    saved = saved.checkpoint()
    assert wide_values(saved) == {(0, "p", "1", "pos"), (1, "q", "2", "pos")}
    row = saved.first()
    assert (row["curr_ind"], row["created_by"], row[R.MISSING_SOURCE]) == ("Y", "me", 0)
    assert row["end_date"] == dt.datetime(9999, 12, 31) and row["begin_date"] == dt.datetime(2025, 1, 31)

    expression = "CASE WHEN B = 2 THEN 'two' WHEN B > 0 THEN 'pos' END"
    edited = by_expression(spark, saved, [("q", 2), ("p", 1), ("s", 5)], expression, "EDIT").checkpoint()
    # q keeps its id, s follows the highest, p is unchanged.
    assert wide_values(edited) == {(0, "p", "1", "pos"), (1, "q", "2", "two"), (2, "s", "5", "pos")}
    again = by_expression(spark, edited, [("q", 2), ("p", 1), ("s", 5)], expression, "EDIT")
    assert counts(again) == counts(edited)

    # A vanished source row and an expression that turned NULL leave their rules alone.
    kept = by_expression(spark, edited, [("p", 1)], "CASE WHEN B > 9 THEN 'x' END", "EDIT")
    assert wide_values(kept) == wide_values(edited)
    replaced = by_expression(spark, edited, [("p", 1)], "'only'", "SAVE")
    assert wide_values(replaced) == {(0, "p", "1", "only")}


def test_an_edit_reads_its_source_once(spark):
    """Rows that pass a counting function: the source once, the rule table four times (state, rules, update, match)."""
    counters = {name: spark.sparkContext.accumulator(0) for name in ("source", "table")}

    def counted(name):
        seen = counters[name]

        @F.udf("string")
        def same(x):
            seen.add(1)
            return x

        return same

    source = [(c, i) for i, c in enumerate("abcdefgh")]
    table = by_expression(spark, spark.createDataFrame([], TABLE), source, "'old'", "SAVE").checkpoint()
    n = table.count()
    watched = table.withColumn(R.SOURCE_VALUE, counted("table")(R.SOURCE_VALUE)).withColumn(
        "curr_ind", F.when(F.col(R.SOURCE_VALUE).isNull(), "?").otherwise(F.col("curr_ind"))
    )
    rows = spark.createDataFrame([*source, ("new", 9)], "A string, B int")
    rows = rows.select(counted("source")("A").alias("A"), "B")
    edited = J.rules_by_expression(watched, rows, "CASE WHEN B > 3 THEN 'new' ELSE 'old' END", ONE, "me")
    values = edited.collect()
    assert len(values) == n + 2 and sum(r[R.TARGET_VALUE] == "new" for r in values) == 10
    assert counters["source"].value == len(source) + 1
    assert counters["table"].value <= 4 * n


def test_expression_edit_without_rules_starts_at_zero(spark):
    got = by_expression(spark, spark.createDataFrame([], TABLE), [("p", 1)], "'v'", "EDIT")
    assert wide_values(got) == {(0, "p", "1", "v")}


def test_expression_needs_one_target(spark):
    with pytest.raises(SchemaMismatch, match="more than 1 column"):
        J.expression_changes(spark.createDataFrame([("p", "q")], "A string, B string"), "'x'", COLUMNS)


def test_preview_is_ordered_and_keeps_unmapped(spark):
    source = spark.createDataFrame([("b", 1), ("a", 2)], "A string, B int")
    got = J.preview_expression(source, "CASE WHEN B = 1 THEN 'x' END", "T", 1)
    assert [tuple(r) for r in got.collect()] == [("a", "2", None)]


# --- import and export ----------------------------------------------------------------


def sheet(spark, folder, text):
    with open(f"{folder}/import.csv", "w", encoding="utf-8") as f:
        f.write(text)
    return J.read_import(spark, f"{folder}/import.csv")


def test_a_large_sheet_is_read_by_many_tasks(spark, folder):
    """The same rows in the same order, split or not; part files follow one another by name."""
    import os

    os.makedirs(f"{folder}/sheet.csv")
    head = 'Source,,Target\nC_NAME,"C\nX",SEGMENT\n'
    for k in range(3):
        with open(f"{folder}/sheet.csv/part-{k}.csv", "w") as f:
            f.write((head if k == 0 else "") + "".join(f'C{k}-{i},"two\nlines, ""{i}""",{"" if i % 3 else "x"}\n' for i in range(20)))
    whole = J.read_import(spark, f"{folder}/sheet.csv")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        split = J.read_import(spark, f"{folder}/sheet.csv")
        assert split.data.columns == whole.data.columns and split.source_columns == whole.source_columns
        got = [tuple(r) for r in split.data.orderBy(R.GROUP).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert got == [tuple(r) for r in whole.data.orderBy(R.GROUP).collect()] and len(got) == 60


def test_import_three_header_rows(spark, folder):
    got = sheet(
        spark,
        folder,
        'Sources,,Targets,,\nCustomers,,Segments,,Nations\nc_name,c_mktsegment,segment,trg#11_grade,n_name\n'
        'C1,,NA,g1,\n"C,2","two\nlines",,"",n2\nC3,x,y,,\n',
    )
    assert got.layout == 1
    assert got.source_columns == ["CUSTOMERS/C_NAME", "CUSTOMERS/C_MKTSEGMENT"]
    assert got.target_columns == ["SEGMENTS/SEGMENT", "SEGMENTS/TRG#11_GRADE", "NATIONS/N_NAME"]
    meta = metadata(spark)
    rows = J.import_rows(got, R.role_columns(meta, 1, True), R.role_columns(meta, 1, False))
    values = {(r[R.GROUP], r[R.SOURCE_ID], r[R.SOURCE_VALUE], r[R.TARGET_ID], r[R.TARGET_VALUE]) for r in rows.collect()}
    # The blank target of row 1 and the set the rules do not know are left out.
    assert values == {
        (0, 501, "C1", 601, "NA"),
        (0, 502, "", 601, "NA"),
        (0, 501, "C1", 602, "g1"),
        (0, 502, "", 602, "g1"),
        (2, 501, "C3", 601, "y"),
        (2, 502, "x", 601, "y"),
    }


def test_import_two_header_rows_and_wrong_start(spark, folder):
    got = sheet(spark, folder, "Source,,Target\nC_NAME,C_MKTSEGMENT,SEGMENT\nC1,m,s\n")
    assert (got.layout, got.target_columns) == (2, ["TARGET/SEGMENT"])
    meta = metadata(spark)
    rows = J.import_rows(got, R.role_columns(meta, 1, True), R.role_columns(meta, 1, False))
    assert {(r[R.SOURCE_ID], r[R.TARGET_ID]) for r in rows.collect()} == {(501, 601), (502, 601)}
    with pytest.raises(SchemaMismatch, match="first cell"):
        sheet(spark, folder, "Other,,Target\nA,B,C\n")


def test_import_replaces_only_its_set_and_may_be_empty(spark, folder):
    got = sheet(spark, folder, "Source,,Target\nC_NAME,C_MKTSEGMENT,SEGMENT\nC1,m,\n")
    table = spark.createDataFrame([(1, 0, 501, "old", 601, "old"), (2, 0, 511, "other", 611, "other")], TABLE.split(f", {R.MISSING_SOURCE}")[0])
    meta = metadata(spark)
    in_set = F.col(R.SOURCE_ID).isin(501, 502)
    out = J.import_rules(table, got, R.role_columns(meta, 1, True), R.role_columns(meta, 1, False), in_set, "me")
    assert [r[R.SOURCE_VALUE] for r in out.collect()] == ["other"]


def test_export_joins_null_keys(spark):
    source = spark.createDataFrame([("a", None), ("b", "c")], "A string, B string")
    rules = spark.createDataFrame([(1, "a", None, "x", "u")], f"{R.GROUP} int, A string, B string, `trg#7_X` string, updated_by string")
    headers = [J.ExportHeader("A", "SOURCES", "S", "A"), J.ExportHeader("B", "SOURCES", "S", "B"), J.ExportHeader("trg#7_X", "TARGETS", "T", "X")]
    got = J.export_rules(source, rules, ["A", "B"], "Expression Mapping", {}, headers, sort_order="A")
    assert got.columns == ["SOURCES#S#A", "SOURCES#S#B", "TARGETS#T#X"]
    assert [tuple(r) for r in got.collect()] == [("a", "", "x"), ("b", "c", None)]


def test_rows_to_json(spark):
    df = spark.createDataFrame([("x", None, None, 1)], "`b.c` string, a string, n int, m int")
    text = J.rows_to_json(df).first()["json"]
    assert list(json.loads(text).items()) == [("a", ""), ("b.c", "x"), ("m", 1)]


def test_a_page_without_an_order_follows_the_first_column(spark):
    view = spark.createDataFrame([(None, "n"), (3, "c"), (5, "e")], f"{R.GROUP} int, A string")
    got = J.rule_page(view, 1, 2).orderBy("RowNum").collect()
    assert [r["A"] for r in got] == ["n", "c"]
    assert [r["A"] for r in J.rule_page(view, 1, 2, f"{R.GROUP} desc").orderBy("RowNum").collect()] == ["e", "c"]


# --- selection sets -------------------------------------------------------------------


def test_selection_set_errors(spark, folder):
    data, out = f"{folder}/d", f"{folder}/o"
    spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string").write.parquet(data)
    repeated = Sel.publish_selection_set(spark, data, out, key=["K"])
    assert repeated.status == "ERROR" and "not unique" in repeated.status_desc
    assert Sel.publish_selection_set(spark, data, out, "K,V", key=["K", "V"]).status == "OK"
    other = Sel.refresh_selection_set(spark, data, out, columns="K")
    assert (other.status, other.status_desc) == ("ERROR", "Mismatched columns")
    assert Sel.refresh_selection_set(spark, data, out, columns="K,V", conditions="V = 'x'").data.count() == 1
    assert read_current(spark, out).dtypes == [("K", "string"), ("V", "string")]
    assert [tuple(r) for r in read_current(spark, out).collect()] == [("1", "x")]


def test_definitions(spark, folder):
    sel, out = f"{folder}/s", f"{folder}/m"
    spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "A string, B string").write.parquet(sel)
    made = Sel.create_definition(spark, sel, out)
    assert (made.status, made.row_cnt) == ("VALID", 2)
    assert Sel.refresh_definition(spark, sel, out).row_cnt == 3
    assert Sel.refresh_definition(spark, sel, out, conditions="B IS NULL").row_cnt == 0
    assert Sel.refresh_definition(spark, sel, out, "A").status == "INVALID"


# --- premium and ingest ------------------------------------------------------------------


def transactions(spark, rows, column="premium", kind="double"):
    days = [(p, e, dt.date(2025, 1, 1), x, dt.date(2025, 1, 1), c, v) for p, e, x, c, v in rows]
    return spark.createDataFrame(
        days,
        "policy_number string, endorsement_number string, policy_effective_date date, policy_expiration_date date, "
        f"transaction_effective_date date, commit_date date, {column} {kind}",
    )


def test_report_closed_period_null_premium_and_expiration(spark):
    a, b = dt.date(2026, 1, 1), dt.date(2026, 2, 1)
    last = dt.date(2025, 6, 30)
    rows = [("P", "1", a, last, 5.0), ("P", "1", b, last, 5.0), ("Q", "1", a, last, None), (None, "1", a, last, 9.0), ("R", "1", a, dt.date(2025, 7, 1), 9.0)]
    lines = [Line("liability", transactions(spark, rows), ("premium",))]
    report = premium_report(lines, "2025-01-01", "2025-06-30")
    assert sorted((r["policy_number"], r["total_gross_premium"]) for r in report.collect()) == [("P", 5.0), ("P", 5.0), ("Q", 0.0)]
    compat = premium_report(lines, "2025-01-01", "2025-06-30", reference_compat=True)
    assert sorted((r["policy_number"], r["total_gross_premium"]) for r in compat.collect()) == [("P", 5.0), ("Q", 0.0)]
    assert premium_report(lines, "2025-01-01", "2025-06-30", closed=False).count() == 0


def test_premium_by_line_compares_numbers_with_text(spark):
    last = dt.date(2020, 12, 31)
    lines = [Line("crime", transactions(spark, [("P", "1", last, last, "7.5"), ("P", "2", last, last, "1")], "pro_rate", "string"), ("pro_rate",))]
    keys = spark.createDataFrame([("P", 1)], "policy_number string, endorsement_number int")
    params = spark.createDataFrame([(dt.date(2020, 1, 1), last)], "start_date date, end_date date")
    got = premium_by_line(lines, keys, params).collect()
    assert [(r["source_table"], r["endorsement_number"], r["total_gross_premium"]) for r in got] == [("crime", "1", 7.5)]
    assert premium_by_line(lines, keys, params, closed=False).count() == 0


def refs(spark):
    return References(
        spark.createDataFrame([("O1", "BK", "AC", "SP", "CA")], "organization string, book string, account_name string, specialty_program string, carrier string"),
        spark.createDataFrame([("cov", "GL")], "coverage string, LOB string"),
        spark.createDataFrame([("BK", "GL", "T", "S", "d", "dd")], "book string, LOB string, TPA string, descriptors_source_coverage string, cov_desc string, cov_desc_detail string"),
    )


def test_claims_composite_lookup_needs_the_earlier_ones(spark):
    raw = spark.createDataFrame(
        [("1", "O1", "cov", "T", "S", "30SEP2024"), ("2", "O9", "cov", "T", "S", " "), ("3", "O1", None, "T", "S", "44957")],
        "claim_number string, organization string, coverage string, TPA string, descriptors_source_coverage string, claim_last_updated_date_char string",
    )
    got = subject_snapshot("claims", raw, refs(spark), dt.date(2024, 12, 31))
    assert got.columns[:6] == ["as_of", "book", "account_name", "specialty_program", "carrier", "LOB"]
    assert got.columns[-3:] == ["claim_last_updated_date", "cov_desc", "cov_desc_detail"]
    rows = {r["claim_number"]: (r["book"], r["LOB"], r["cov_desc"], r["claim_last_updated_date"]) for r in got.collect()}
    assert rows == {
        "1": ("BK", "GL", "d", dt.date(2024, 9, 30)),
        "2": (None, "GL", None, None),
        "3": ("BK", None, None, dt.date(2023, 1, 31)),
    }


def test_policy_and_premium_overrides(spark):
    policy = spark.createDataFrame(
        [("1", "O1", "900001", "cov", "15"), ("2", "O1", "0", "EPL/POL", "n/a"), ("3", "O1", None, "none", "")],
        "policy_number string, organization string, billing_code string, primary_coverage string, sub_producer_commission_char string",
    )
    got = ENRICHMENTS["policy"](policy, replace(refs(spark), program_by_billing_code={"900001": "Orchard"}))
    assert {r["policy_number"]: (r["specialty_program"], r["LOB"], r["sub_producer_commission"]) for r in got.collect()} == {
        "1": ("Orchard", "GL", 0.15),
        "2": ("SP", "EPL/POL", None),
        "3": ("SP", None, None),
    }
    premium = spark.createDataFrame(
        [("1", "O1", "Not Selected", "2020", "x", "2024-09-30"), ("2", "O1", "cov", "", "7", "30SEP2024")],
        "policy_number string, organization string, coverage string, model_year_char string, unit_number_char string, premium_created_date_char string",
    )
    got = ENRICHMENTS["premium"](premium, refs(spark))
    day = dt.date(2024, 9, 30)
    assert {r["policy_number"]: (r["LOB"], r["model_year"], r["unit_number"], r["premium_created_date"]) for r in got.collect()} == {
        "1": ("Not Selected", 2020.0, None, day),
        "2": ("GL", None, 7.0, day),
    }


def test_organization_target_has_the_updated_date(spark):
    raw = spark.createDataFrame([("O", "30SEP2024", "2024-09-30")], "organization string, org_last_updated_date_char string, organization_created_date_char string")
    row = subject_snapshot("organization", raw, None, dt.date(2024, 12, 31)).first()
    day = dt.date(2024, 9, 30)
    assert (row["organization_last_updated_date"], row["organization_created_date"]) == (day, day)


@pytest.mark.parametrize("most", [R.MAX_RULE_COLUMNS, 5, 2])
def test_rules_are_published_without_a_shuffle_of_rules(spark, data, monkeypatch, most):
    """A few jobs to reduce the column graph; the rules themselves meet broadcasts alone."""
    from ledgerloom.queries.mapping import both_sets

    monkeypatch.setattr(R, "MAX_RULE_COLUMNS", most)
    context = spark.sparkContext
    rules = both_sets(spark, data).checkpoint()
    context.setJobGroup("publish", "publish")
    published = J.published_rules(rules, metadata(spark), 1)
    built = len(context.statusTracker().getJobIdsForGroup("publish"))
    context.setLocalProperty("spark.jobGroup.id", None)
    plan = published._jdf.queryExecution().executedPlan().toString()
    if most > 2:
        assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert most <= 5 or built <= 15
    assert published.count() == rules.where(F.col(R.SOURCE_ID).isin(501, 502)).count() > 0
    assert J.published_rules(rules, metadata(spark), 99).count() == 0
