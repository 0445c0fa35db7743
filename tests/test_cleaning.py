import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import schemas as S
from ledgerloom.functions.headers import canonical_headers, canonical_names, quoted
from ledgerloom.functions.values import (
    blank_for_null,
    clean_rows,
    month_end,
    month_end_date,
    nfc,
    parsed_number,
    percent_as_fraction,
    rejects,
    repaired_date,
    stringified,
    typed,
)
from ledgerloom.operators.project import (
    any_present,
    drop_embedded_headers,
    filter_where,
    full_query,
    project,
)
from ledgerloom.plans.ingest import exposure_base


@pytest.mark.parametrize(
    "header, name",
    [
        ("Policy #", "policy_number"),
        ("InceptionDate", "policy_effective_date"),
        ("#RatEmp", "num_rat_emp"),
        ("# of Units", "num__of_units".replace("__", "_")),
        ("Commission %", "commission_perc"),
        ("State.1", "state_1"),
        ("Fire & Theft", "fire_AND_theft"),
        ("Limit / Deductible", "limit_OR_deductible"),
        ("A/B", "a_OR_b"),
        ("Limit (see tab)", "limit"),
        ("Loss - Paid", "loss_paid"),
        ("Insured's Name", "insureds_name"),
        ("  Zip  ", "zip"),
        (" PolicyAggregateLimit", "policy_aggregate_limit"),
    ],
)
def test_canonical_name(header, name):
    assert canonical_names([header]) == [name]


def test_clashing_headers_stay_unique_and_keep_their_place():
    assert canonical_names(["Policy", "Policy Number", "Policy #", "", "x"]) == [
        "policy_number",
        "policy_number_",
        "policy_number__",
        "col_3",
        "x",
    ]


def test_alias_map_repairs_a_broken_column(spark):
    df = spark.createDataFrame([("1",)], ["`;verning_class_code".replace("`", "")])
    assert canonical_headers(df, {";verning_class_code": "governing_class_code"}).columns == ["governing_class_code"]


def test_dates_are_repaired_and_never_raise(spark):
    texts = ["2024-09-30", "30SEP2024", "09/30/2024", "44957", "2024-09-30 10:00:00", "", "n/a", "Policy Effective Date", "2024-13-01", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(repaired_date(F.col("t"))).collect()]
    day = dt.date(2024, 9, 30)
    assert got == [day, day, day, dt.date(2023, 1, 31), day, None, None, None, None, None]


def test_dates_lose_nothing(spark):
    """Every way a date arrives, and what the others are."""
    want = {
        "9/30/2024 1:05 PM": dt.date(2024, 9, 30),
        "09/30/24": dt.date(2024, 9, 30),
        "1/2/99 00:00:00": dt.date(1999, 1, 2),
        "12/31/69": dt.date(2069, 12, 31),
        "1": dt.date(1899, 12, 31),
        "02/30/24": "unreadable",
        "09/30/2024 noon": "unreadable",
        "2024": "year",
        "1999.0": "year",
        "0": "unreadable",
        "1899": dt.date(1905, 3, 13),
        "  ": None,
        None: None,
    }
    rows = [(i, t, t) for i, t in enumerate(want)]
    df = typed(spark.createDataFrame(rows, "i int, `the day` string, _c string"), ["the day"], ["_c"])
    got = {}
    for r in df.orderBy("i").collect():
        lost = [x.reason for x in r._rejects if x.column == "the day"]
        assert len(lost) <= 1 and not (lost and r["the day"])
        got[list(want)[r.i]] = lost[0] if lost else r["the day"]
    assert got == want
    lost = rejects(df, ["i"]).where("column = '_c'").collect()
    assert {r.raw for r in lost} == {t for t in want if t and "/" in t} and {r.reason for r in lost} == {"unreadable"}
    assert rejects(typed(spark.range(3))).count() == 0


@pytest.mark.parametrize(
    "day, back, want",
    [
        (dt.date(2025, 1, 15), 1, dt.date(2024, 12, 31)),
        (dt.date(2025, 3, 31), 1, dt.date(2025, 2, 28)),
        (dt.date(2024, 3, 1), 1, dt.date(2024, 2, 29)),
        (dt.date(2025, 1, 1), 14, dt.date(2023, 11, 30)),
        (dt.date(2025, 12, 5), 0, dt.date(2025, 12, 31)),
    ],
)
def test_month_end_rolls_over_the_year(spark, day, back, want):
    assert month_end_date(day, back) == want
    assert spark.range(1).select(month_end(day, back)).first()[0] == want


def test_numbers(spark):
    df = spark.createDataFrame([("15",), ("",), ("n/a",), (None,), (" 2.5 ",)], "t string")
    assert [r[0] for r in df.select(parsed_number(F.col("t"))).collect()] == [15.0, None, None, None, 2.5]
    assert df.select(percent_as_fraction(F.col("t"))).first()[0] == 0.15


def test_stringified_types(spark):
    row = (
        1,
        None,
        122345.0,
        dt.date(2024, 1, 2),
        dt.datetime(2024, 1, 2, 3, 4, 5, 60),
        decimal.Decimal("1.50"),
        True,
        "x",
    )
    df = spark.createDataFrame(
        [row], "a int, b int, c double, `d.e f` date, t timestamp, m decimal(5,2), z boolean, s string"
    ).withColumn("n", F.col("t").cast("timestamp_ntz"))
    out = stringified(df)
    assert {t for _, t in out.dtypes} == {"string"}
    assert tuple(out.first()) == (
        "1",
        None,
        "122345.0",
        "2024-01-02 00:00:00.000000",
        "2024-01-02 03:04:05.000060",
        "1.50",
        "true",
        "x",
        "2024-01-02 03:04:05.000060",
    )


def test_blank_for_null_and_clean_rows(spark):
    df = spark.createDataFrame([("a\nb", None, 1), (None, "x", 2)], "p string, q string, n int")
    assert [tuple(r) for r in blank_for_null(df).collect()] == [("a\nb", "", 1), ("", "x", 2)]
    assert [tuple(r) for r in clean_rows(df).collect()] == [("a, b", None, 1)]


def test_nfc(spark):
    df = spark.createDataFrame([("é",), (None,), ("x",)], "t string")
    assert [r[0] for r in df.select(nfc("t")).collect()] == ["é", None, "x"]


def test_project_and_filter_optional_text(spark):
    df = spark.createDataFrame([(1, 2)], "`1.SECTOR NAME` int, B int")
    assert project(df, "`1.SECTOR NAME`").columns == ["1.SECTOR NAME"]
    assert project(df, "1.SECTOR NAME, B").columns == df.columns
    for nothing in (None, "", "null", "*", []):
        assert project(df, nothing).columns == df.columns
    for nothing in (None, "", "  ", "null"):
        assert filter_where(df, nothing).count() == 1
    assert filter_where(df, "B > 5").count() == 0


def test_full_query_leaves_no_view(spark):
    df = spark.range(5)
    out = full_query(df, "SELECT max(id) AS m FROM dataset;")
    assert out.first()["m"] == 4
    assert not spark.catalog.tableExists("dataset")


def test_embedded_headers(spark):
    df = spark.createDataFrame([("a", "b"), ("p", None), ("a", "q"), (None, "Label")], "a string, b string")
    assert drop_embedded_headers(df).count() == 3
    assert [r["b"] for r in drop_embedded_headers(df, {"b": "Label"}).collect()] == ["b", None, "q"]


def test_any_present(spark):
    df = spark.createDataFrame([(None, 1), (None, None)], "`a b` string, n int")
    assert [r[0] for r in df.select(any_present(["a b", "n"])).collect()] == [True, False]


def test_exposure_base(spark):
    limits = "building_limit, contents_limit, time_element_limit, stock, personal_stock, eq_limit, flood_limit".split(", ")
    schema = "lob string, expos_eff_dt date, expos_exp_dt date, value double, " + ", ".join(f"{c} double" for c in limits)
    a, b = dt.date(2024, 1, 1), dt.date(2024, 12, 31)
    rows = [
        ("AL", a, b, 7.0, *[1.0] * 7),
        ("Property", a, b, 7.0, *[None] * 7),
        ("Property", a, b, 7.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0),
        ("GL", a, b, None, *[1.0] * 7),
        (None, a, b, 9.0, *[1.0] * 7),
    ]
    df = spark.createDataFrame(rows, schema).select(exposure_base(F.col("lob")).alias("e"))
    assert df.dtypes == [("e", "double")]
    assert [r["e"] for r in df.collect()] == [1.0, 0.0, 28.0, 0.0, 9.0]


@pytest.mark.parametrize(
    "name, precision, scale, want",
    [
        ("int", 10, 0, T.IntegerType()),
        ("BIGINT", None, None, T.LongType()),
        ("smallint", None, None, T.ShortType()),
        ("tinyint", None, None, T.ByteType()),
        ("bit", None, None, T.BooleanType()),
        ("decimal", 11, 2, T.DecimalType(11, 2)),
        ("numeric", None, None, T.DecimalType(38, 0)),
        ("money", 19, 4, T.DecimalType(19, 4)),
        ("smallmoney", 10, 4, T.DecimalType(10, 4)),
        ("float", 53, None, T.DoubleType()),
        ("real", 24, None, T.FloatType()),
        ("date", None, None, T.DateType()),
        ("datetime2", None, None, T.TimestampType()),
        ("time", None, None, T.StringType()),
        ("varbinary", None, None, T.BinaryType()),
        ("uniqueidentifier", None, None, T.StringType()),
        ("geography", None, None, T.StringType()),
    ],
)
def test_spark_type(name, precision, scale, want):
    assert S.spark_type(name, precision, scale) == want


def test_schema_from_metadata_keeps_ordinal_order(spark):
    rows = [(2, "b", "float", None, None, "NO"), (1, "a", "decimal", 9, 3, "YES")]
    meta = spark.createDataFrame(
        rows, "ORDINAL_POSITION int, COLUMN_NAME string, DATA_TYPE string, NUMERIC_PRECISION int, NUMERIC_SCALE int, IS_NULLABLE string"
    )
    assert S.schema_from_metadata(meta) == T.StructType(
        [T.StructField("a", T.DecimalType(9, 3), True), T.StructField("b", T.DoubleType(), False)]
    )


def test_alignment_reports_dropped_and_missing(spark):
    df = spark.createDataFrame([("1", "x", "n/a")], "a string, extra string, n string")
    got = S.align(df, T.StructType.fromDDL("n double, A int, gone date"))
    assert (got.dropped, got.missing) == (["extra"], ["gone"])
    assert [tuple(r) for r in got.data.collect()] == [(None, 1, None)]
    assert got.data.columns == ["n", "A", "gone"]


def test_schema_gate_ignores_nullability_and_raises_on_type(spark):
    df = spark.range(1)
    assert S.schema_gate(df, T.StructType([T.StructField("id", T.LongType(), True)])) is df
    with pytest.raises(S.SchemaMismatch):
        S.schema_gate(df, T.StructType.fromDDL("id int"))


def test_column_mismatch():
    assert S.column_mismatch(["a", "b"], ["b", "a"], "Attribute") is None
    assert "don't match" in S.column_mismatch(["a", "b"], ["a"], "Attribute")
    assert S.column_mismatch(["a", "b"], ["a"], "Key") is None
    assert "don't match" in S.column_mismatch(["a"], ["a", "b"], "Key")
    assert S.column_mismatch([], [], "Other") == "Unknown option: Other"


def test_describe_columns(spark):
    df = spark.createDataFrame([(1, "x")], "a int, `b c` string")
    assert [tuple(r) for r in S.describe_columns(df).orderBy("position").collect()] == [
        (0, "A", "int", True),
        (1, "B C", "string", True),
    ]
    with pytest.raises(S.SchemaMismatch):
        S.describe_columns(df.toDF("a", "b,c"))


def test_reference_schemas_are_valid(spark):
    for ddl in S.REFERENCE_TABLES.values():
        assert S.empty_frame(spark, ddl).count() == 0


def test_quoted():
    assert quoted("a`b") == "`a``b`"
