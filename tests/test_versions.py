"""Publication in versions: failures between the steps, versions kept, plans run once."""

import os

import pytest
from ledgerloom.plans import selection as Sel
from ledgerloom.sinks import tables as K
from ledgerloom.sinks import versions as V
from pyspark.sql import functions as F


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_a_table_may_read_itself_and_old_versions_go(spark, folder):
    path = f"{folder}/t"
    assert V.publish(spark.range(10), path) == (None, 10)
    for least in (2, 4, 6):
        V.publish(V.read_current(spark, path).where(f"id >= {least}"), path)
    assert ids(V.read_current(spark, path)) == [6, 7, 8, 9]
    assert len([v for v in os.listdir(path) if v.startswith("v-")]) == 2
    assert V.publish(spark.range(0), path) == (None, 0)
    assert V.read_current(spark, path).count() == 0


@pytest.mark.parametrize("step", ["overwrite", "replace", "rename"])
def test_a_failure_before_the_last_step_leaves_the_old_rows(spark, folder, monkeypatch, step):
    path = f"{folder}/t"
    V.publish(spark.range(3), path)
    real = V._Folder.replace

    def fail(*a, **k):
        raise OSError("injected")

    if step == "overwrite":
        monkeypatch.setattr(V, "overwrite", fail)
    elif step == "replace":
        monkeypatch.setattr(V._Folder, "replace", fail)
    else:
        # The new text is there beside the pointer, the rename is not.
        def half(self, name, text):
            stream = self.system.create(self.path(f"{name}.half"), False)
            stream.write(text.encode())
            stream.close()
            fail()

        monkeypatch.setattr(V._Folder, "replace", half)
    with pytest.raises(OSError, match="injected"):
        V.publish(spark.range(100), path)
    assert ids(V.read_current(spark, path)) == [0, 1, 2]
    monkeypatch.undo()
    assert V._Folder.replace is real
    V.publish(spark.range(5), path)
    assert V.read_current(spark, path).count() == 5


def test_overwrite_self_fails_before_it_renames(spark, folder):
    path = f"{folder}/t"
    K.overwrite(spark.range(3), path)
    bad = spark.read.parquet(path).select(F.raise_error(F.lit("injected")).cast("int").alias("id"))
    with pytest.raises(Exception, match="injected"):
        K.overwrite_self(bad, path)
    assert ids(spark.read.parquet(path)) == [0, 1, 2]


def test_rows_without_versions_are_read_as_they_are(spark, folder):
    K.overwrite(spark.range(4), f"{folder}/plain")
    assert V.current(spark, f"{folder}/plain") is None
    assert V.read_current(spark, f"{folder}/plain").count() == 4


def test_the_plan_of_a_selection_set_runs_once(spark, folder):
    """Its rows pass an accumulator on their way to the files, and only there."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(x):
        seen.add(1)
        return x

    rows = spark.range(50).select(counted("id").alias("ID").alias("ID"))
    reason, n = V.publish(rows, f"{folder}/o", check=lambda w: None if w.distinct().count() == 50 else "no")
    assert (reason, n, seen.value) == (None, 50, 50)
    reason, n = V.publish(rows, f"{folder}/o", check=lambda w: "refused")
    assert reason == "refused" and V.read_current(spark, f"{folder}/o").count() == 50
    assert len([v for v in os.listdir(f"{folder}/o") if v.startswith("v-")]) == 1


def test_exports_are_counted_by_their_write(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return f"{x}\n"

    tables = {"a": spark.range(7).select(counted("id").alias("t")), "b": spark.range(0)}
    got = K.export_tables(spark, tables, folder).collect()
    assert sorted(map(tuple, got)) == [("a", 7), ("b", 0)] and seen.value == 7


def test_a_refused_key_keeps_the_former_set(spark, folder):
    data, out = f"{folder}/d", f"{folder}/o"
    spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string").write.parquet(data)
    assert Sel.publish_selection_set(spark, data, out, "K,V", key=["K", "V"]).row_cnt == 2
    assert Sel.publish_selection_set(spark, data, out, "K,V", key=["K"]).status == "ERROR"
    assert V.read_current(spark, out).count() == 2
