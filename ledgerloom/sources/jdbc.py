"""Database scans and writes; the driver class and URL are the caller's."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Database:
    url: str
    properties: dict[str, str] = field(default_factory=dict)


@dataclass
class SplitBy:
    """A numeric or date column whose range is read in parallel pieces."""

    column: str
    lower: object
    upper: object
    pieces: int


def scan_options(db: Database, table_or_query: str, split: SplitBy | None = None) -> dict[str, str]:
    """Reader options; a query is passed as a derived table, so filters are still pushed into it."""
    text = table_or_query.strip().rstrip(";")
    is_query = text.lower().startswith(("select ", "select\n"))
    options = {**db.properties, "url": db.url, "dbtable": f"({text}) q" if is_query else text}
    if split is not None:
        options.update(
            partitionColumn=split.column,
            lowerBound=str(split.lower),
            upperBound=str(split.upper),
            numPartitions=str(split.pieces),
        )
    return options


def jdbc_scan(spark: SparkSession, db: Database, table_or_query: str, split: SplitBy | None = None) -> DataFrame:
    """A table or a pushed query; without a split it is read by one task."""
    return spark.read.format("jdbc").options(**scan_options(db, table_or_query, split)).load()


def jdbc_overwrite(df: DataFrame, db: Database, table: str, connections: int = 8) -> None:
    """Replace a database table, with a bounded number of connections."""
    (
        df.write.format("jdbc")
        .options(**db.properties, url=db.url, dbtable=table, truncate="true", numPartitions=str(connections))
        .mode("overwrite")
        .save()
    )


def sync_from_database(spark: SparkSession, db: Database, tables: dict[str, str], split: dict[str, SplitBy] | None = None) -> None:
    """Full refresh of parquet paths (table -> path) from database tables."""
    for table, path in tables.items():
        jdbc_scan(spark, db, table, (split or {}).get(table)).write.mode("overwrite").parquet(path)


def sync_to_database(spark: SparkSession, db: Database, tables: dict[str, str]) -> None:
    """Full refresh of database tables (table -> path) from parquet paths."""
    for table, path in tables.items():
        jdbc_overwrite(spark.read.parquet(path), db, table)
