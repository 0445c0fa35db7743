"""CSV records that span lines, joined by many tasks, against Spark's reader of whole files."""

import numpy as np
import pytest
from ledgerloom.sources import files as S
from ledgerloom.sources import records as R
from pyspark.sql import functions as F


def write(path, text):
    import os

    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


@pytest.fixture
def small_splits(spark):
    """Blocks of a few lines."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def cell(rng):
    text = "".join(rng.choice(list('ab ,"\n'), int(rng.integers(0, 7))))
    plain = "".join(c for c in text if c not in ",\n")
    kind = rng.random()
    if kind < 0.5:
        return '"' + text.replace('"', '""') + '"'
    if kind < 0.85:
        return plain.replace('"', "")
    return plain if kind < 0.95 else f'"{plain.replace(chr(34), "")}"x"y'


def whole(spark, path, schema):
    return [tuple(r) for r in spark.read.schema(schema).csv(path, multiLine=True, quote='"', escape='"').collect()]


def test_records_are_those_of_the_whole_file_reader(spark, folder, small_splits):
    rng = np.random.default_rng(5)
    for k in range(12):
        text = "".join(",".join(cell(rng) for _ in range(3)) + "\n" for _ in range(int(rng.integers(1, 30))))
        text = text.replace("\n", "\r\n") if k % 4 == 1 else text.rstrip("\n") if k % 4 == 2 else text
        text = text.replace("b", "\n\n", 1) if k % 4 == 0 else text
        path = write(f"{folder}/{k}.csv", text)
        lines = R.csv_lines(spark, path)
        assert len(text) < 300 or lines.select("block").distinct().count() > 3
        got = R.parsed(R.csv_records(lines), ["_c0", "_c1", "_c2"]).orderBy("number").collect()
        assert [tuple(r)[2:] for r in got] == whole(spark, path, "_c0 string, _c1 string, _c2 string"), repr(text)
        assert [r.number for r in got] == list(range(len(got)))


def test_a_field_over_many_blocks_and_a_quote_never_closed(spark, folder, small_splits):
    long = "\n".join(f"line {i}, and" for i in range(80))
    path = write(f"{folder}/a.csv", f'a,b\n1,"{long}"\n2,"x"\n  \n\n3,"open\nto the end\n')
    got = S.csv_robust(spark, path).collect()
    want = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"').collect()
    # The line end that closes the file is no part of an open field here.
    want = [(r.a, r.b.removesuffix("end\n") + "end" if r.a == "3" else r.b) for r in want]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(got) == 4


def test_each_file_is_read_in_its_own_way(spark, folder, small_splits):
    """Plain, spanning, spanning but small, and ended by bare carriage returns, in one scan."""
    write(f"{folder}/in/a b%.csv", "a,b\n1,2\n")
    write(f"{folder}/in/b.csv", 'a,b\n3,"x\ny"\n4\n' + '7,"p\nq"\n' * 20)
    write(f"{folder}/in/d.csv", 'a,b\n8,"x\ny"\n')
    write(f"{folder}/in/c.csv", "a,b\r5,6\r")
    df = S.csv_robust(spark, f"{folder}/in", corrupt=True)
    assert sorted((r.a, r.b, r[S.CORRUPT]) for r in df.collect()) == [
        ("1", "2", None),
        ("3", "x\ny", None),
        ("4", None, "4"),
        ("5", "6", None),
        *[("7", "p\nq", None)] * 20,
        ("8", "x\ny", None),
    ]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan and "FileScan text" in plan


def test_a_spanning_file_is_read_by_many_tasks(spark, folder):
    text = F.concat(F.lit('line\n"quoted", '), F.col("id").cast("string"))
    rows = spark.range(20_000).select("id", text.alias("t")).coalesce(1)
    rows.write.option("header", True).option("escape", '"').csv(f"{folder}/t")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = S.csv_robust(spark, f"{folder}/t")
        assert R.csv_lines(spark, f"{folder}/t").rdd.getNumPartitions() > 5
        assert df.where("t = concat('line\n\"quoted\", ', id)").distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def jobs(spark, work):
    """Number of Spark jobs that ``work`` runs."""
    context = spark.sparkContext
    group = f"count-{np.random.default_rng().integers(1 << 60)}"
    context.setJobGroup(group, group)
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group))


def test_headers_of_all_files_come_in_one_pass(spark, folder):
    for n in (5, 50):
        for i in range(n):
            extra = ",Extra" if i % 2 else ""
            write(f"{folder}/{n}/crime-bordereaux-{2000 + i}.csv", f"Policy #{extra}\n{i}{',x' if i % 2 else ''}\n")
    assert jobs(spark, lambda: S.grid_load(spark, f"{folder}/5", ["crime"])) == jobs(
        spark, lambda: S.grid_load(spark, f"{folder}/50", ["crime"])
    )
    got = S.grid_load(spark, f"{folder}/50", ["crime"])
    assert got.columns == ["policy_number", "line", "year", "extra"]
    assert sorted((int(r.policy_number), r.year, r.extra) for r in got.collect()) == [
        (i, 2000 + i, "x" if i % 2 else None) for i in range(50)
    ]


def test_a_header_over_two_lines(spark, folder):
    write(f"{folder}/crime-bordereaux-2019.csv", '"Policy\n#",b\n1,2\n')
    write(f"{folder}/crime-bordereaux-2020.csv", "")
    got = S.grid_load(spark, folder, ["crime"])
    assert [tuple(r) for r in got.select("b", "line", "year").collect()] == [("2", "crime", 2019)]
