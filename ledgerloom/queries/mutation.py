"""Upserts, replacements and deletes as recomputed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.mutate import delete_where, replace_group, upsert
from ledgerloom.queries.registry import query, table


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").where("c_nationkey < 15").select("c_custkey", "c_name", "c_acctbal", F.lit("first").alias("updated_by"))


def account_changes(spark: SparkSession, folder: str) -> DataFrame:
    """New balances for rich customers; those of nation 20 and up come without a key."""
    return table(spark, folder, "customer").where("c_acctbal > 2000").select(
        F.when(F.col("c_nationkey") < 20, F.col("c_custkey")).alias("c_custkey"),
        "c_name",
        (F.col("c_acctbal") * 2).alias("c_acctbal"),
    )


@query(
    "upsert",
    """WITH target AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey < 15),
source AS (SELECT CASE WHEN c_nationkey < 20 THEN c_custkey END AS c_custkey, c_name, c_acctbal * 2 AS c_acctbal FROM customer WHERE c_acctbal > 2000)
SELECT COALESCE(s.c_custkey, t.c_custkey) AS c_custkey, COALESCE(t.c_name, s.c_name) AS c_name,
round(COALESCE(s.c_acctbal, t.c_acctbal), 2) AS c_acctbal,
CASE WHEN t.c_custkey IS NULL THEN 'inserted' WHEN s.c_custkey IS NULL THEN 'first' ELSE 'updated' END AS updated_by
FROM target t FULL OUTER JOIN source s ON t.c_custkey = s.c_custkey""",
)
def upsert_query(spark: SparkSession, folder: str) -> DataFrame:
    merged = upsert(
        accounts(spark, folder),
        account_changes(spark, folder),
        ["c_custkey"],
        update={"c_acctbal": F.col("change.c_acctbal"), "updated_by": F.lit("updated")},
        insert={
            "c_custkey": F.col("c_custkey"),
            "c_name": F.col("c_name"),
            "c_acctbal": F.col("c_acctbal"),
            "updated_by": F.lit("inserted"),
        },
    )
    return merged.withColumn("c_acctbal", F.round("c_acctbal", 2))


@query(
    "replace_group",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL SELECT o_orderkey, 0, 'R' FROM orders""",
)
def replace_group_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_returnflag"
    )
    new = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.lit(0).cast("bigint").alias("l_linenumber"), F.lit("R").alias("l_returnflag")
    )
    return replace_group(rows, new, F.col("l_returnflag") == "R")


@query(
    "delete_where",
    """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer
WHERE nullif(c_mktsegment, 'BUILDING') IS DISTINCT FROM 'MACHINERY'""",
)
def delete_where_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return delete_where(rows, F.col("segment") == "MACHINERY")
