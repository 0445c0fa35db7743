"""Tables that stay readable whatever happens while they are replaced.

A version is a folder of its own below the table's path, complete before anyone
sees it.  Which version counts is the text of one small file, and replacing that
file is the last step and a single one: a writer that fails before leaves the old
rows, one that fails after leaves the new ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sinks.tables import overwrite

POINTER = "_current"


class _Folder:
    """The file system calls that the pointer needs."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark.sparkContext._jvm, path.rstrip("/")
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.system = self.path().getFileSystem(self.conf)

    def path(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def read(self, name: str) -> str | None:
        if not self.system.exists(self.path(name)):
            return None
        stream = self.system.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write beside the file and rename over it, which is one step for its readers."""
        fresh = f"{name}.{uuid.uuid4().hex}"
        stream = self.system.create(self.path(fresh), False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        kind = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path().toUri(), self.conf)
        files.rename(self.path(fresh), self.path(name), options)

    def versions(self) -> list[str]:
        """Names of the version folders, the oldest first."""
        if not self.system.exists(self.path()):
            return []
        found = [s for s in self.system.listStatus(self.path()) if s.getPath().getName().startswith("v-")]
        return [s.getPath().getName() for s in sorted(found, key=lambda s: (s.getModificationTime(), s.getPath().getName()))]

    def drop(self, name: str) -> None:
        self.system.delete(self.path(name), True)


SCHEMA = "_schema.json"


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema that a table of snapshots keeps beside them, else that of its files; None if there is no table."""
    folder = _Folder(spark, path)
    text = folder.read(SCHEMA)
    if text is not None:
        return T.StructType.fromJson(json.loads(text))
    if not folder.system.exists(folder.path()):
        return None
    return spark.read.option("mergeSchema", True).parquet(path).schema


def keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Set the schema in which ``read_snapshots`` gives the rows of all snapshots, old ones too."""
    folder = _Folder(spark, path)
    folder.system.mkdirs(folder.path())
    folder.replace(SCHEMA, schema.json())


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All snapshots in the table's schema: NULL for columns that one lacks, narrower types as the wider ones."""
    schema = stored_schema(spark, path)
    if schema is None:
        raise FileNotFoundError(path)
    return spark.read.schema(schema).parquet(path)


def stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> tuple[str, int]:
    """Write a version that no reader sees yet; its folder's name and number of rows, counted by the write."""
    name, rows = f"v-{uuid.uuid4().hex}", Observation()
    counted = df.observe(rows, F.count(F.lit(1)).alias("n"))
    overwrite(counted, f"{path.rstrip('/')}/{name}", partition_by)
    return name, rows.get["n"]


def commit(spark: SparkSession, path: str, name: str, keep: int = 2) -> None:
    """Let the version count; of the others the newest stay, ``keep`` versions in all, for readers that are under way.

    A version that another writer is still staging is among the newest; more writers
    at once than ``keep`` need a larger one.
    """
    folder = _Folder(spark, path)
    folder.replace(POINTER, name)
    others = [v for v in folder.versions() if v != name]
    for old in others[: max(0, len(others) - max(keep, 1) + 1)]:
        folder.drop(old)


def current(spark: SparkSession, path: str) -> str | None:
    """Path of the version that counts; None if the path holds no versions."""
    name = _Folder(spark, path).read(POINTER)
    return None if name is None else f"{path.rstrip('/')}/{name.strip()}"


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The version that counts, or the parquet files themselves of a table without versions."""
    return spark.read.parquet(current(spark, path) or path)


def publish(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    check: Callable[[DataFrame], str | None] | None = None,
    keep: int = 2,
) -> tuple[str | None, int]:
    """Replace a table that the frame may read; the reason why not, if ``check`` finds one, and the number of rows.

    ``check`` gets the rows as written, so the plan runs once; when it objects, the
    version is dropped and the former one goes on counting.
    """
    spark = df.sparkSession
    name, rows = stage(df, path, partition_by)
    # The schema is given: an empty version has no file to tell it.
    reason = check(spark.read.schema(df.schema).parquet(f"{path.rstrip('/')}/{name}")) if check else None
    if reason is None:
        commit(spark, path, name, keep)
    else:
        _Folder(spark, path).drop(name)
    return reason, rows
