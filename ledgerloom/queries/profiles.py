"""Counts, key checks, set operations, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.combine import dedup_counts, dedup_rows, except_rows, union_distinct, union_evolving
from ledgerloom.operators.numbering import first_rows, number_rows, paginate
from ledgerloom.operators.pages import keep_order, page
from ledgerloom.operators.profile import (
    distinct_row_count,
    distinct_years,
    key_check,
    repeated_keys,
    rowcount_status,
    table_profile,
)
from ledgerloom.plans.selection import coverage, exposed_rowcount, target_values
from ledgerloom.queries.registry import day, query, table
from ledgerloom.session import scratch_path

DATED = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


@query(
    "table_profile",
    " UNION ALL ".join(
        f"SELECT count(*) AS total_row, CAST(max(year({c})) AS BIGINT) AS max_year, 'test' AS envi, '{t}' AS table_name FROM {t}"
        for t, c in DATED.items()
    ),
)
def table_profile_query(spark: SparkSession, folder: str) -> DataFrame:
    return table_profile({t: table(spark, folder, t) for t in DATED}, DATED, "test")


@query(
    "union_distinct",
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS y, o_orderstatus AS status FROM orders
UNION SELECT CAST(year(l_shipdate) AS BIGINT), l_linestatus FROM lineitem""",
)
def union_distinct_query(spark: SparkSession, folder: str) -> DataFrame:
    year = lambda c: F.year(c).cast("bigint").alias("y")
    return union_distinct(
        [
            table(spark, folder, "orders").select(year("o_orderdate"), F.col("o_orderstatus").alias("status")),
            table(spark, folder, "lineitem").select(year("l_shipdate"), F.col("l_linestatus").alias("status")),
        ]
    )


@query(
    "distinct_years",
    "SELECT DISTINCT CAST(year(l_shipdate) AS BIGINT) AS year_distinct FROM lineitem ORDER BY 1 DESC",
)
def distinct_years_query(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_years(table(spark, folder, "lineitem"), "l_shipdate")


@query(
    "distinct_row_count",
    "SELECT count(*) AS row_cnt FROM (SELECT DISTINCT l_orderkey, nullif(l_linenumber, 7) FROM lineitem)",
)
def distinct_row_count_query(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_row_count(
        table(spark, folder, "lineitem").select("l_orderkey", F.nullif("l_linenumber", F.lit(7)).alias("n"))
    )


@query(
    "mapping_coverage",
    "SELECT count(*) AS row_cnt FROM (SELECT DISTINCT p_brand, p_type, nullif(p_size, 1) FROM part)",
)
def mapping_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return coverage(table(spark, folder, "part").select("p_brand", "p_type", F.nullif("p_size", F.lit(1)).alias("size")))


@query(
    "pk_check",
    """SELECT 'lineitem' AS table_name, count(*) AS row_cnt,
(SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS key_cnt,
count(*) = (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS is_unique FROM lineitem
UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey), count(*) = count(DISTINCT o_orderkey) FROM orders""",
)
def pk_check(spark: SparkSession, folder: str) -> DataFrame:
    checks = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"]}
    parts = [
        key_check(table(spark, folder, t), key).select(F.lit(t).alias("table_name"), "*") for t, key in checks.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "repeated_keys",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS occurrences
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def repeated_keys_query(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]).withColumn(
        "l_linenumber", F.col("l_linenumber").cast("bigint")
    )


@query(
    "rowcount_status",
    """SELECT 'OK' AS status, '' AS status_desc, count(*) AS rowcount FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'ERROR', 'INVALID', count(*) FROM orders WHERE o_orderstatus = 'none'""",
)
def rowcount_status_query(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    filled = exposed_rowcount(orders, "o_orderstatus = 'F'")
    return filled.unionByName(rowcount_status(orders.where("o_orderstatus = 'none'")))


@query(
    "dedup_rows",
    "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, CAST(year(l_shipdate) AS BIGINT) AS y FROM lineitem",
)
def dedup_rows_query(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_rows(
        table(spark, folder, "lineitem").select(
            "l_partkey", "l_suppkey", "l_returnflag", F.year("l_shipdate").cast("bigint").alias("y")
        )
    )


@query(
    "dedup_counts",
    """SELECT count(*) AS rows_before,
(SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS rows_after FROM lineitem""",
)
def dedup_counts_query(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_counts(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "except_rows",
    """SELECT l_returnflag, l_linestatus, nullif(CAST(l_linenumber AS BIGINT), 7) AS n FROM lineitem
EXCEPT ALL
SELECT 'R', o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' THEN 3 END FROM orders""",
)
def except_rows_query(spark: SparkSession, folder: str) -> DataFrame:
    """Few distinct rows with very many copies each, on both sides."""
    rows = table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", F.nullif(F.col("l_linenumber").cast("bigint"), F.lit(7)).alias("n")
    )
    gone = table(spark, folder, "orders").select(
        F.lit("R"), "o_orderstatus", F.when(F.col("o_orderpriority") != "5-LOW", F.lit(3)).cast("bigint")
    )
    return except_rows(rows, gone)


@query(
    "union_evolve",
    """SELECT o_orderkey AS key, o_orderstatus AS status, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS event_type FROM orders
UNION ALL SELECT event_id, CAST(NULL AS VARCHAR), value, event_type FROM events
UNION ALL SELECT c_custkey, CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR) FROM customer""",
)
def union_evolve(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount")
    )
    events = table(spark, folder, "events").select(
        "event_type", F.col("value").alias("amount"), F.col("event_id").alias("key")
    )
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"))
    return union_evolving([orders, events, customers])


PAGE_SQL = """SELECT o_orderkey, o_custkey, o_totalprice, RowNum FROM (
SELECT o_orderkey, o_custkey, o_totalprice,
CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey, o_custkey) AS BIGINT) AS RowNum FROM orders)"""


def priced(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("paginate", PAGE_SQL + " WHERE RowNum >= 101 AND RowNum < 151")
def paginate_query(spark: SparkSession, folder: str) -> DataFrame:
    return paginate(priced(spark, folder), 101, 50, "o_totalprice desc")


@query("paginate_deep", PAGE_SQL + " WHERE RowNum >= 12001 AND RowNum < 12501")
def paginate_deep(spark: SparkSession, folder: str) -> DataFrame:
    """A page beyond the top-k bound: numbered in parallel, then cut out."""
    return paginate(priced(spark, folder), 12001, 500, "o_totalprice desc")


@query("page_kept", PAGE_SQL + " WHERE RowNum >= 951 AND RowNum < 1101")
def page_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The order is kept in blocks of a thousand rows; the page reads the two that it touches."""
    path = scratch_path(spark, "pages")
    keep_order(priced(spark, folder), path, "o_totalprice desc", block_rows=1_000)
    return page(spark, path, 951, 150)


@query("number_rows", PAGE_SQL)
def number_rows_query(spark: SparkSession, folder: str) -> DataFrame:
    return number_rows(priced(spark, folder), "o_totalprice desc", "RowNum")


@query(
    "limited_preview",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 100""",
)
def limited_preview(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_extendedprice"
    )
    return first_rows(rows, 100, "l_extendedprice desc")


@query(
    "target_values",
    """SELECT DISTINCT p_brand AS "P_BRAND", p_type AS "P_TYPE" FROM part WHERE p_size > 10 ORDER BY 1, 2 LIMIT 100""",
)
def target_values_query(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").toDF(*[c.upper() for c in table(spark, folder, "part").columns])
    wanted = parts.where("P_SIZE > 10")
    return target_values(wanted, "P_BRAND,P_TYPE", "")


@query(
    "distinct_dates",
    "SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day FROM orders",
)
def distinct_dates(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(day("o_orderdate").alias("order_day")).distinct().orderBy(F.desc("order_day"))
