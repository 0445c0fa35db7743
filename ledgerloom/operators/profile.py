"""Counts, key checks and table profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.headers import quoted


def table_profile(tables: Mapping[str, DataFrame], day: Mapping[str, str], environment: str) -> DataFrame:
    """Row count and latest year of every table."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("total_row"), F.max(F.year(F.col(quoted(day[name])))).cast("bigint").alias("max_year")
        ).select("total_row", "max_year", F.lit(environment).alias("envi"), F.lit(name).alias("table_name"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def distinct_years(df: DataFrame, day: str) -> DataFrame:
    return (
        df.select(F.year(F.col(quoted(day))).cast("bigint").alias("year_distinct"))
        .distinct()
        .orderBy(F.col("year_distinct").desc())
    )


def distinct_row_count(df: DataFrame) -> DataFrame:
    """Number of different whole rows; NULL counts as a value."""
    return df.distinct().agg(F.count(F.lit(1)).alias("row_cnt"))


def key_check(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, different keys, and whether the key is unique."""
    per_key = df.groupBy(*[F.col(quoted(c)) for c in key]).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("row_cnt"), F.count(F.lit(1)).alias("key_cnt")
    ).select("row_cnt", "key_cnt", (F.col("row_cnt") == F.col("key_cnt")).alias("is_unique"))


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys that occur more than once."""
    return (
        df.groupBy(*[F.col(quoted(c)) for c in key])
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def rowcount_status(df: DataFrame) -> DataFrame:
    """Row count with a status: an empty result is an invalid one."""
    return df.agg(F.count(F.lit(1)).alias("rowcount")).select(
        F.when(F.col("rowcount") > 0, "OK").otherwise("ERROR").alias("status"),
        F.when(F.col("rowcount") > 0, "").otherwise("INVALID").alias("status_desc"),
        "rowcount",
    )


def file_listing(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """Path, size and directory partition values of files; their content is not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path).drop("content")


# A file, or a directory of part files that may lie in partition directories.
TABLE_OF_PATH = r"^(.*?/([^/=]+?)(?:\.[A-Za-z]+)?)(?:/[^/=]+=[^/]*)*(?:/part-[^/]*)?$"


def table_sizes(files: DataFrame) -> DataFrame:
    """Bytes, files and location per table, largest first, from a file listing."""
    mb = 1024.0 * 1024.0
    return (
        files.groupBy(
            F.regexp_extract("path", TABLE_OF_PATH, 2).alias("table_name"),
            F.regexp_extract("path", TABLE_OF_PATH, 1).alias("location"),
        )
        .agg(F.sum("length").alias("size_in_bytes"), F.count(F.lit(1)).alias("num_files"))
        .select(
            "table_name",
            "size_in_bytes",
            F.round(F.col("size_in_bytes") / mb, 2).alias("size_in_mb"),
            F.round(F.col("size_in_bytes") / (mb * 1024.0), 2).alias("size_in_gb"),
            "num_files",
            "location",
        )
        .orderBy(F.col("size_in_bytes").desc(), "table_name")
    )
