"""A month's file against the stored table: what fits, how, and what is refused."""

import datetime as dt
import os

import pytest
from ledgerloom.functions.schemas import SchemaMismatch, gated, holds
from ledgerloom.plans.ingest import append_stored, ingest_month
from ledgerloom.queries.jobs import described
from ledgerloom.sinks import versions as V
from pyspark.sql import types as T

DDL = T.StructType.fromDDL
DATES = {"org_last_updated_date_char": "varchar", "organization_created_date_char": "varchar"}


def actions(new, stored, evolve=False):
    target, changes = gated(DDL(new), stored and DDL(stored), evolve)
    return target.simpleString(), {c.name: c.action for c in changes}


def test_what_becomes_of_columns(spark):
    assert actions("a int", None) == ("struct<a:int>", {"a": "added"})
    new, stored = "B int, d double, a bigint, e string", "a int, b string, c date"
    assert actions("B int, d double, a int", stored) == (
        "struct<a:int,b:string,c:date>",
        {"a": "kept", "b": "cast", "c": "filled", "d": "dropped"},
    )
    assert actions(new, stored, True) == (
        "struct<a:bigint,b:string,c:date,d:double,e:string>",
        {"a": "widened", "b": "cast", "c": "filled", "d": "added", "e": "added"},
    )
    for evolve, bad in ((False, "a bigint"), (True, "a string"), (True, "c string"), (True, "c timestamp")):
        with pytest.raises(SchemaMismatch, match=bad.split()[0]):
            actions(bad, stored, evolve)


def test_types_that_hold_others(spark):
    t = lambda s: DDL(f"x {s}")[0].dataType
    yes = [("bigint", "int"), ("double", "int"), ("decimal(12,2)", "int"), ("decimal(12,4)", "decimal(8,2)"), ("int", "int")]
    no = [("int", "bigint"), ("double", "bigint"), ("decimal(8,2)", "int"), ("decimal(8,4)", "decimal(8,2)"), ("date", "string")]
    assert all(holds(t(a), t(b)) for a, b in yes) and not any(holds(t(a), t(b)) for a, b in no)


def land(folder, suffix, header, row):
    path = f"{folder}/in/FEED_ORGANIZATION_LAND_{suffix}.CSV"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(f"{header},{','.join(DATES)}\n{row},2024-01-31,2024-01-31\n")


def month(spark, folder, suffix, types, evolve=False):
    reference = dt.datetime.strptime(suffix, "%Y%m%d").date() + dt.timedelta(days=5)
    return ingest_month(
        spark, "organization", f"{folder}/in", described(spark, {**types, **DATES}), None, f"{folder}/t", reference, evolve=evolve
    )


def test_months_of_other_shapes(spark, folder):
    land(folder, "20240131", "organization,size", "a,1")
    land(folder, "20240229", "organization,size,note", "b,5000000000,n")
    land(folder, "20240331", "organization", "c")
    assert {c.action for c in month(spark, folder, "20240131", {"organization": "varchar", "size": "int"}).changes} == {"added"}
    wide = {"organization": "varchar", "size": "bigint", "note": "varchar"}
    with pytest.raises(SchemaMismatch, match="size: bigint for int"):
        month(spark, folder, "20240229", wide)
    assert V.read_snapshots(spark, f"{folder}/t").count() == 1
    second = month(spark, folder, "20240229", wide, evolve=True)
    assert {c.name: c.action for c in second.changes if c.action != "kept"} == {"size": "widened", "note": "added"}
    third = month(spark, folder, "20240331", {"organization": "varchar"})
    assert {c.name: c.action for c in third.changes if c.action != "kept"} == {"size": "filled", "note": "filled"}
    for _ in range(2):
        rows = V.read_snapshots(spark, f"{folder}/t").orderBy("organization").collect()
        assert [(r.organization, r["size"], r.note) for r in rows] == [("a", 1, None), ("b", 5_000_000_000, "n"), ("c", None, None)]
        month(spark, folder, "20240229", wide, evolve=True)  # a repeated month replaces itself
    assert third.report().count() == len(third.changes)


def test_a_file_is_appended_in_the_stored_schema(spark, folder):
    path = f"{folder}/a.csv"
    with open(path, "w") as f:
        f.write("v,k\nx,2\ny,bad\n")
    with pytest.raises(FileNotFoundError):
        append_stored(spark, path, f"{folder}/t")
    spark.createDataFrame([(1, "old")], "k int, v string").write.parquet(f"{folder}/t")
    got = append_stored(spark, path, f"{folder}/t")
    assert got.dtypes == [("k", "int"), ("v", "string")]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "old"), (2, "x"), (None, "y")]


def test_a_table_without_a_kept_schema_has_that_of_its_files(spark, folder):
    assert V.stored_schema(spark, f"{folder}/t") is None
    spark.createDataFrame([(1, "x")], "id int, as_of string").write.partitionBy("as_of").parquet(f"{folder}/t")
    assert V.stored_schema(spark, f"{folder}/t").simpleString() == "struct<id:int,as_of:string>"
