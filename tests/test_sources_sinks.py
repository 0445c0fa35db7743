import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.schemas import SchemaMismatch
from ledgerloom.operators.profile import file_listing, table_sizes
from ledgerloom.plans.bordereaux import bordereaux_load
from ledgerloom.sinks import tables as K
from ledgerloom.sources import files as S
from ledgerloom.sources.jdbc import Database, SplitBy, scan_options
from ledgerloom.sources.records import csv_lines, file_headers


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_robust_scan(spark, folder):
    path = write(f"{folder}/a.csv", 'a,b\n1,"x\ny"\n2,"say ""hi"", ok"\n3\n,""\n')
    df = S.csv_robust(spark, path)
    assert df.dtypes == [("a", "string"), ("b", "string")]
    got = {r["a"]: r["b"] for r in df.collect()}
    assert got["1"] == "x\ny" and got["2"] == 'say "hi", ok' and got["3"] is None
    bad = S.csv_robust(spark, path, corrupt=True).where(F.col(S.CORRUPT).isNotNull())
    assert [r["a"] for r in bad.collect()] == ["3"]


@pytest.mark.parametrize(
    "text, spans",
    [
        ('a,b\n1,"x"\n2,"p ""q"" r"\n"",\n', False),
        ('a,b\n1,"x\ny"\n', True),
        ('a,b\n1,5" pipe\n', True),
        ('a,b\n1,x"y,"abc\nd"\n', True),
        ("a,b\n1,2\n", False),
        ("a,b\r\n1,2\r\n", False),
        ("a,b\n1,x\ry\n", True),
        ("a,b\n1,2\n   \n3,4\n", True),
    ],
)
def test_multi_line_check(spark, folder, text, spans):
    path = write(f"{folder}/a.csv", text)
    assert S.records_span_lines(spark, path) is spans
    if not spans:
        assert rows(S.csv_robust(spark, path, multi_line=False)) == rows(S.csv_robust(spark, path, multi_line=True))


def test_typed_columns_are_found_by_name(spark, folder):
    schema = "k int, v string, day date"
    path = write(f"{folder}/a.csv", "v,day,k\nx,2024-01-31,1\n")
    assert rows(S.csv_typed(spark, path, schema)) == [(1, "x", dt.date(2024, 1, 31))]
    for header in ("v,day", "v,day,k,more"):
        odd = write(f"{folder}/{len(header)}.csv", f"{header}\n")
        with pytest.raises(SchemaMismatch):
            S.csv_typed(spark, odd, schema)


def test_files_are_checked_before_they_are_split(spark, folder):
    spanning = write(f"{folder}/m/a.csv", 'a,b\n1,"x\ny"\n')
    plain = write(f"{folder}/p/a.csv", 'a,b\n1,"x"\n')
    assert rows(S.csv_robust(spark, spanning)) == [("1", "x\ny")]
    assert rows(S.csv_robust(spark, plain)) == [("1", "x")]


def test_blank_and_null_can_be_told_apart(spark, folder):
    path = write(f"{folder}/a.csv", 'k,v\n1,""\n2,\\N\n')
    assert rows(S.csv_typed(spark, path, "k int, v string", blanks_are_null=False)) == [(1, ""), (2, None)]


def test_positional_scan_checks_the_width(spark, folder):
    path = write(f"{folder}/a.csv", "1,2024-01-02\nx,never\n")
    got = S.csv_positional(spark, path, T.StructType.fromDDL("n int, d date"))
    assert rows(got) == [(1, dt.date(2024, 1, 2)), (None, None)]
    with pytest.raises(SchemaMismatch):
        S.csv_positional(spark, path, T.StructType.fromDDL("n int"))


def test_xml_by_two_row_tags(spark, folder):
    text = '<g:Root xmlns:g="u"><g:Rec id="1"><g:Amount>2.5</g:Amount></g:Rec><g:Rec id="2"><g:Amount>3</g:Amount></g:Rec></g:Root>'
    path = write(f"{folder}/a.xml", text)
    recs = S.xml_rows(spark, path, "g:Rec")
    assert sorted(r["_id"] for r in recs.collect()) == [1, 2]
    assert S.xml_rows(spark, path, "g:Root").count() == 1


def test_latest_runs_compare_numbers_and_keep_partition_columns(spark, folder):
    data = [("a", "x", 9, 1), ("a", "x", 10, 2), ("a", "y", 9, 3), ("b", "x", 2, 4), ("b", "x", 11, 5), ("b", "x", 100, 6)]
    df = spark.createDataFrame(data, "p string, q string, process_run_key int, v int")
    df.write.partitionBy("p", "q", "process_run_key").parquet(f"{folder}/d")
    got = S.latest_runs(spark, f"{folder}/d")
    assert set(got.columns) == {"p", "q", "process_run_key", "v"}
    assert sorted(r["v"] for r in got.collect()) == [2, 3, 6]
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()


def test_latest_runs_without_runs_and_with_many_partitions(spark, folder):
    spark.range(3).write.parquet(f"{folder}/plain")
    assert S.latest_runs(spark, f"{folder}/plain").count() == 3
    many = spark.range(110).select((F.col("id") % 55).alias("p"), (F.col("id") % 2).alias("process_run_key"), "id")
    many.write.partitionBy("p", "process_run_key").parquet(f"{folder}/many")
    got = S.latest_runs(spark, f"{folder}/many")
    assert got.where("process_run_key <> 1").count() == 0
    assert got.select("p").distinct().count() == 55


def test_landing_preference(spark, folder):
    for name in ("FEED_Partner_CLAIM_LAND_20241231.CSV", "FEED_Programs_CLAIM_LAND_20241231.CSV", "FEED_CLAIM_LAND_20241130.CSV"):
        write(f"{folder}/{name}", "a\n1\n")
    pick = lambda suffix: S.landing_file(spark, folder, "claims", suffix).rsplit("/", 1)[-1]
    assert pick("20241231") == "FEED_Programs_CLAIM_LAND_20241231.CSV"
    assert pick("20241130") == "FEED_CLAIM_LAND_20241130.CSV"
    with pytest.raises(FileNotFoundError):
        pick("20240101")
    own = S.landing_file(spark, folder, "claims", "20241231", pattern="FEED_Partner_{word}{prefix}_LAND_{suffix}.CSV")
    assert own.endswith("FEED_Partner_CLAIM_LAND_20241231.CSV")


def test_grid_ignores_other_files(spark, folder):
    write(f"{folder}/2019/crime-bordereaux-2019.csv", "Policy #\n1\n")
    write(f"{folder}/2019/crime-bordereaux-deduped-2019.csv", "Policy #,Extra\n2,x\n")
    write(f"{folder}/2020/crime-bordereaux-special-2020.csv", "Policy #\n3\n")
    write(f"{folder}/2019/unknown-bordereaux-2019.csv", "Policy #\n4\n")
    write(f"{folder}/2018/crime-bordereaux-2018.csv", "Policy #\n5\n")
    write(f"{folder}/2019/Crime-bordereaux-2020.CSV", "Policy #\n6\n")
    got = lambda **k: sorted((r["policy_number"], r["year"]) for r in S.grid_load(spark, folder, ["crime"], **k).collect())
    assert got(years=[2019, 2020]) == [("1", 2019)]
    assert got() == [("1", 2019), ("5", 2018)]
    assert got(variant="deduped") == [("2", 2019)]
    with pytest.raises(FileNotFoundError):
        S.grid_load(spark, folder, ["crime"], [2011])
    seen = S.grid_files(spark, folder, ["crime"], [2019, 2020]).collect()
    assert sorted((r.path.rsplit("/", 1)[-1], r.left_out or "") for r in seen) == [
        ("Crime-bordereaux-2020.CSV", "name"),
        ("crime-bordereaux-2018.csv", "year"),
        ("crime-bordereaux-2019.csv", ""),
        ("crime-bordereaux-deduped-2019.csv", "variant"),
        ("crime-bordereaux-special-2020.csv", "variant"),
        ("unknown-bordereaux-2019.csv", "line"),
    ]


def test_repeated_and_missing_headers_keep_their_place(spark, folder):
    write(f"{folder}/crime-bordereaux-2019.csv", 'Policy,Policy Number,,"Policy",state,State\n1,2,3,4,5,6\n')
    got = S.grid_load(spark, folder, ["crime"], [2019])
    assert got.columns == ["policy_number", "policy_number_", "col_2", "policy_number__", "state", "state_", "line", "year"]
    assert tuple(got.first())[:6] == ("1", "2", "3", "4", "5", "6")


def test_sheets_can_keep_a_skipped_workbook(spark, folder):
    for book, sheet in (("EPLI 2020", "EPLI"), ("~$b", "Crime"), ("b", "Equipment Breakdown"), ("b", "Notes"), ("b", "EXCESS")):
        write(f"{folder}/{book}/{sheet}.csv", f"Policy #\n{book}{sheet}\n")
    routed = lambda *a: S.sheet_files(spark, folder, *a).where("left_out IS NULL").collect()
    assert sorted(r["line"] for r in routed(["epli"])) == ["equipment_breakdown", "umbrella"]
    assert sorted(r["line"] for r in routed()) == ["epli", "equipment_breakdown", "umbrella"]
    left = S.sheet_files(spark, folder, ["epli"]).where("left_out IS NOT NULL").collect()
    assert sorted((r["workbook"], r["left_out"]) for r in left) == [
        ("EPLI 2020", "skipped"),
        ("b", "unknown"),
        ("~$b", "temporary"),
    ]
    rows_ = S.consolidate_sheets(spark, folder, aliases={"Policy #": "policy"}).collect()
    assert sorted((r["policy"], r["line"]) for r in rows_) == [
        ("EPLI 2020EPLI", "epli"),
        ("bEXCESS", "umbrella"),
        ("bEquipment Breakdown", "equipment_breakdown"),
    ]


def test_bordereaux_load_grows_by_columns_and_repairs(spark, folder):
    head = "Policy Number,InceptionDate"
    write(f"{folder}/in/2019/crime-bordereaux-2019.csv", f"{head}\nA,2019-01-31\nA,2019-01-31\nB,44957\nPolicy Number,Policy Effective Date\n")
    write(f"{folder}/in/2020/crime-bordereaux-2020.csv", f'{head},Notes\nC,01/31/2020,"two\nlines"\n')
    got = bordereaux_load(spark, f"{folder}/in", f"{folder}/out", ["crime"], [2019])
    assert "notes" not in got.columns
    got = bordereaux_load(spark, f"{folder}/in", f"{folder}/out", ["crime"], [2020])
    assert sorted((r["policy_number"], r["policy_effective_date"], r["notes"]) for r in got.collect()) == [
        ("A", dt.date(2019, 1, 31), None),
        ("B", dt.date(2023, 1, 31), None),
        ("C", dt.date(2020, 1, 31), "two\nlines"),
    ]


def test_overwrite_self(spark, folder):
    path = f"{folder}/t"
    K.overwrite(spark.range(10), path)
    K.overwrite_self(spark.read.parquet(path).where("id > 6"), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [7, 8, 9]


def test_snapshot_is_idempotent_and_checked(spark, folder):
    path, target = f"{folder}/s", T.StructType.fromDDL("id bigint, as_of date")
    stamp = lambda d: spark.range(3).withColumn("as_of", F.lit(d))
    K.store_snapshot(stamp(dt.date(2024, 1, 31)), path, target)
    K.store_snapshot(stamp(dt.date(2024, 2, 29)), path, target)
    K.store_snapshot(stamp(dt.date(2024, 2, 29)), path, target)
    assert spark.read.parquet(path).count() == 6


def test_single_file_export_only_if_asked_for(spark, folder):
    parts = lambda p: sum(f.startswith("part-") for f in os.listdir(p))
    df = spark.range(100).repartition(4)
    K.export_csv(df, f"{folder}/one", single_file=True)
    assert parts(f"{folder}/one") == 1
    K.export_csv(df, f"{folder}/many")
    assert parts(f"{folder}/many") == 4
    assert spark.read.csv(f"{folder}/many", header=True).count() == 100


def test_newest_run_of_partitions_without_a_positive_key(spark, folder):
    rows = spark.sql("SELECT * FROM VALUES ('a', 3, 1), ('a', 5, 2), ('b', NULL, 3), ('c', -2, 4), ('c', NULL, 5) AS t(line, process_run_key, x)")
    rows.write.partitionBy("line", "process_run_key").parquet(f"{folder}/runs")
    assert sorted(r.x for r in S.latest_runs(spark, f"{folder}/runs").collect()) == [2, 3, 4]


def test_table_sizes_of_directories(spark, folder):
    spark.range(100).repartition(3).write.parquet(f"{folder}/t1")
    spark.range(4).withColumn("p", F.col("id") % 2).coalesce(1).write.partitionBy("p").parquet(f"{folder}/t2")
    got = {r["table_name"]: (r["num_files"], r["location"]) for r in table_sizes(file_listing(spark, folder, "*.parquet")).collect()}
    assert got == {"t1": (3, f"file:{folder}/t1"), "t2": (2, f"file:{folder}/t2")}


def test_jdbc_options():
    db = Database("jdbc:x:y", {"user": "u"})
    assert scan_options(db, "dbo.t") == {"user": "u", "url": "jdbc:x:y", "dbtable": "dbo.t"}
    got = scan_options(db, "SELECT a FROM t;", SplitBy("a", 1, 100, 8))
    assert got["dbtable"] == "(SELECT a FROM t) q"
    assert (got["partitionColumn"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == ("a", "1", "100", "8")


def test_what_a_file_says_is_worked_out_once_per_file(spark, folder):
    write(f"{folder}/in/crime-bordereaux-2019.csv", "Policy Number,line\nA,x\n")
    write(f"{folder}/in/a%20+b/cyber-bordereaux-2020.csv/part-0.csv", 'Policy Number\n"B\nB"\n')
    write(f"{folder}/in/a%20+b/cyber-bordereaux-2020.csv/part-1.csv", "Policy Number\nC\n")
    got = S.grid_load(spark, f"{folder}/in", ["crime", "cyber"])
    assert sorted(tuple(r) for r in got.select("policy_number", "line", "year").collect()) == [
        ("A", "crime", 2019),
        ("B\nB", "cyber", 2020),
        ("C", "cyber", 2020),
    ]
    # No expression on the path where the rows are, only on the side that is sent to them.
    joins = got._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1:]
    sides = [join.split("+- Project [__file", 1) for join in joins]
    assert len(sides) == 3 and all("regexp" in files and "regexp" not in rows_ and "decode" not in rows_ for rows_, files in sides)


def test_headers_are_found_without_a_sort(spark, folder):
    text = "\r\n  \r\n" + "Policy,Notes\r\n" + 'A,"x, y"\r\n' * 3
    write(f"{folder}/a.csv", text)
    write(f"{folder}/b.csv", 'Policy\n"A\n1"\n')
    heads = file_headers(csv_lines(spark, folder))
    plan = heads._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" in plan
    got = {r.file.rsplit("/", 1)[-1]: (r.header, r.open_header, r.spanning) for r in heads.collect()}
    assert got == {"a.csv": ("Policy,Notes", False, True), "b.csv": ("Policy", False, True)}
