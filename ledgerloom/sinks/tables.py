"""Parquet tables as directories."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.headers import quoted
from ledgerloom.functions.schemas import align_schema, schema_gate

# Partitions that a task writes at once.  A parquet file under way holds up to a row group in memory.
OPEN_FILES = 8
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def files_at_once(spark: SparkSession, files: int = OPEN_FILES) -> Iterator[None]:
    """Partitioned writes as rows come, with so many files of a task open at once.

    Else every task first sorts all its rows by partition, which takes memory with the rows;
    now only the rows that a task has left when it meets one partition more are sorted.
    """
    former = spark.conf.get(_WRITERS, None)
    spark.conf.set(_WRITERS, max(files, int(former or 0)))
    try:
        yield
    finally:
        if former is None:
            spark.conf.unset(_WRITERS)
        else:
            spark.conf.set(_WRITERS, former)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table that the frame itself does not read."""
    writer = df.write.option("compression", "snappy").mode("overwrite")
    with files_at_once(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_self(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table that the frame may read.

    The new rows are written beside it and the directories are swapped, so the
    plan keeps its input until the new table is complete.  Between the two renames
    there is no table at the path; ``versions.publish`` has no such moment.
    """
    path = path.rstrip("/")
    mark = uuid.uuid4().hex
    fresh, former = f"{path}__new_{mark}", f"{path}__old_{mark}"
    overwrite(df, fresh, partition_by)
    context = df.sparkSession.sparkContext
    as_path = context._jvm.org.apache.hadoop.fs.Path
    system = as_path(path).getFileSystem(context._jsc.hadoopConfiguration())

    def rename(source: str, target: str) -> None:
        if system.exists(as_path(source)) and not system.rename(as_path(source), as_path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    rename(path, former)
    try:
        rename(fresh, path)
    except BaseException:
        rename(former, path)
        raise
    system.delete(as_path(former), True)
    df.sparkSession.catalog.refreshByPath(path)


def append_evolving(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows that may bring new columns; read back with a merged schema."""
    writer = df.write.mode("append")
    with files_at_once(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that occur in the frame."""
    with files_at_once(df.sparkSession):
        (
            df.write.option("compression", "snappy")
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .partitionBy(*partition_by)
            .parquet(path)
        )


def store_snapshot(df: DataFrame, path: str, target=None, cluster_by: Sequence[str] = ()) -> None:
    """Store one ``as_of`` snapshot: aligned to the target, checked, idempotent.

    Running a month again replaces its partition instead of doubling it.
    """
    if target is not None:
        df = schema_gate(align_schema(df, target), target)
    if cluster_by:
        df = df.sortWithinPartitions(*[quoted(c) for c in cluster_by])
    overwrite_partitions(df, path, ["as_of"])


def save_external(df: DataFrame, name: str, path: str) -> None:
    """A catalog table over files at a path of the caller's choice."""
    df.write.option("path", path).mode("overwrite").saveAsTable(name)


def load_reference(spark: SparkSession, csv_path: str, schema: str, path: str) -> DataFrame:
    """Full refresh of a reference table from CSV with the table's own schema."""
    df = spark.read.schema(schema).csv(csv_path, header=True, escape='"')
    overwrite(df, path)
    return spark.read.parquet(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header.

    One file per task, or, if asked for, a single one, which one task writes whatever the size.
    """
    if single_file:
        df = df.coalesce(1)
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def export_tables(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Every table as CSV below a folder; returns the number of rows per table, counted by the write itself."""
    counts = []
    for name, df in tables.items():
        rows = Observation()
        export_csv(df.observe(rows, F.count(F.lit(1)).alias("n")), f"{folder.rstrip('/')}/{name}")
        counts.append((name, rows.get["n"]))
    return spark.createDataFrame(counts, "table_name string, row_cnt bigint")
