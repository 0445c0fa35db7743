"""Premium reports: policy transactions are order lines and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import restrict_to_keys, within_parameters
from ledgerloom.plans.premium import Line, premium_by_line, premium_report
from ledgerloom.queries.registry import day, query, table

YEAR = ("1996-01-01", "1996-12-31")


def transactions_of(items: DataFrame, premium: dict) -> DataFrame:
    shipped = F.col("l_shipdate").cast("date")
    return items.select(
        F.col("l_orderkey").cast("string").alias("policy_number"),
        F.col("l_linenumber").cast("string").alias("endorsement_number"),
        shipped.alias("policy_effective_date"),
        F.add_months(shipped, 12).alias("policy_expiration_date"),
        shipped.alias("transaction_effective_date"),
        shipped.alias("commit_date"),
        *[c.alias(n) for n, c in premium.items()],
    )


def lines(spark: SparkSession, folder: str) -> list[Line]:
    items = table(spark, folder, "lineitem")
    price = F.col("l_extendedprice")
    flag = lambda f: items.where(F.col("l_returnflag") == f)
    ordered = F.col("o_orderdate").cast("date")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("policy_number"),
        F.lit("0").alias("endorsement_number"),
        ordered.alias("policy_effective_date"),
        F.add_months(ordered, 12).alias("policy_expiration_date"),
        ordered.alias("transaction_effective_date"),
        ordered.alias("commit_date"),
        F.col("o_totalprice").alias("coverage_premium"),
    )
    unreadable = F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(price.cast("string"))
    return [
        Line(
            "agricultural",
            transactions_of(flag("R"), {"coverage_premium": price, "terrorism_premium": F.nullif("l_tax", F.lit(0.0))}),
            ("coverage_premium", "terrorism_premium"),
        ),
        Line("commercial_auto", transactions_of(flag("A"), {"prorated_prem": price}), ("prorated_prem",)),
        Line("crime", transactions_of(flag("N"), {"pro_rate": unreadable}), ("pro_rate",)),
        Line("property", orders, ("coverage_premium",)),
    ]


LINES_SQL = """
combined AS (
  SELECT 'agricultural' AS source_table, CAST(l_orderkey AS VARCHAR) AS policy_number,
         CAST(l_linenumber AS VARCHAR) AS endorsement_number, CAST(l_shipdate AS DATE) AS eff,
         CAST(l_shipdate AS DATE) AS commit_date,
         COALESCE(l_extendedprice, 0) + COALESCE(l_tax, 0) AS gross_premium
  FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  SELECT 'commercial_auto', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
         CAST(l_shipdate AS DATE), CAST(l_shipdate AS DATE), COALESCE(l_extendedprice, 0)
  FROM lineitem WHERE l_returnflag = 'A'
  UNION ALL
  SELECT 'crime', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
         CAST(l_shipdate AS DATE), CAST(l_shipdate AS DATE),
         CASE WHEN l_linenumber = 7 THEN 0 ELSE COALESCE(l_extendedprice, 0) END
  FROM lineitem WHERE l_returnflag = 'N'
  UNION ALL
  SELECT 'property', CAST(o_orderkey AS VARCHAR), '0',
         CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE), COALESCE(o_totalprice, 0)
  FROM orders
)"""


@query(
    "premium_report",
    f"""WITH {LINES_SQL}
SELECT policy_number, endorsement_number,
       strftime(eff, '%m-%d-%Y') AS policy_effective_date,
       strftime(eff + INTERVAL 12 MONTH, '%m-%d-%Y') AS policy_expiration_date,
       strftime(eff, '%m-%d-%Y') AS transaction_effective_date,
       strftime(commit_date, '%m-%d-%Y') AS commit_datetime,
       round(sum(gross_premium), 2) AS total_gross_premium
FROM combined
WHERE commit_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
GROUP BY policy_number, endorsement_number, eff, commit_date""",
)
def premium_report_query(spark: SparkSession, folder: str) -> DataFrame:
    report = premium_report(lines(spark, folder), *YEAR)
    return report.withColumn("total_gross_premium", F.round("total_gross_premium", 2))


@query(
    "premium_report_compat",
    f"""WITH {LINES_SQL}
SELECT DISTINCT policy_number, endorsement_number,
       strftime(eff, '%m-%d-%Y') AS policy_effective_date,
       strftime(eff, '%m-%d-%Y') AS transaction_effective_date,
       strftime(commit_date, '%m-%d-%Y') AS commit_datetime,
       round(sum(gross_premium), 2) AS total_gross_premium
FROM combined
WHERE commit_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
GROUP BY policy_number, endorsement_number, eff, commit_date""",
)
def premium_report_compat_query(spark: SparkSession, folder: str) -> DataFrame:
    report = premium_report(lines(spark, folder), *YEAR, reference_compat=True)
    return report.withColumn("total_gross_premium", F.round("total_gross_premium", 2))


def urgent_policies(spark: SparkSession, folder: str) -> DataFrame:
    """The policy list: urgent orders, endorsement 1 (a number, where the data has text)."""
    return (
        table(spark, folder, "orders")
        .where(F.col("o_orderpriority") == "1-URGENT")
        .select(F.col("o_orderkey").alias("policy_number"), F.lit(1).alias("endorsement_number"))
    )


def period(spark: SparkSession, folder: str) -> DataFrame:
    """One parameter row: from the first shipping day to the last ordering day."""
    shipped = table(spark, folder, "lineitem").agg(F.min(F.col("l_shipdate").cast("date")).alias("start_date"))
    ordered = table(spark, folder, "orders").agg(F.max(F.col("o_orderdate").cast("date")).alias("end_date"))
    return shipped.select("start_date", ordered.scalar().alias("end_date"))


PARAMETERS_SQL = """
policy_list AS (SELECT o_orderkey AS policy_number, 1 AS endorsement_number FROM orders WHERE o_orderpriority = '1-URGENT'),
params AS (SELECT (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem) AS start_date,
                  (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) AS end_date)"""


@query(
    "premium_by_line",
    f"""WITH {LINES_SQL}, {PARAMETERS_SQL}
SELECT source_table, c.policy_number, c.endorsement_number, CAST(commit_date AS VARCHAR) AS commit_date,
       round(sum(gross_premium), 2) AS total_gross_premium
FROM combined c
JOIN policy_list p ON c.policy_number = CAST(p.policy_number AS VARCHAR)
                  AND c.endorsement_number = CAST(p.endorsement_number AS VARCHAR)
JOIN params ON commit_date >= start_date AND commit_date <= end_date
GROUP BY source_table, c.policy_number, c.endorsement_number, commit_date""",
)
def premium_by_line_query(spark: SparkSession, folder: str) -> DataFrame:
    report = premium_by_line(lines(spark, folder), urgent_policies(spark, folder), period(spark, folder))
    return report.withColumn("commit_date", day("commit_date")).withColumn(
        "total_gross_premium", F.round("total_gross_premium", 2)
    )


@query(
    "keylist_join",
    f"""WITH {PARAMETERS_SQL}
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
FROM lineitem JOIN policy_list ON l_orderkey = policy_number AND l_linenumber = endorsement_number""",
)
def keylist_join(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem")
    listed = restrict_to_keys(
        items, urgent_policies(spark, folder), {"l_orderkey": "policy_number", "l_linenumber": "endorsement_number"}
    )
    return listed.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_extendedprice", day("l_shipdate").alias("l_shipdate")
    )


@query(
    "param_range_join",
    f"""WITH {PARAMETERS_SQL}
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
FROM lineitem JOIN params ON CAST(l_shipdate AS DATE) >= start_date AND CAST(l_shipdate AS DATE) < end_date""",
)
def param_range_join(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").withColumn("shipped", F.col("l_shipdate").cast("date"))
    found = within_parameters(items, "shipped", period(spark, folder), "start_date", "end_date")
    return found.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), day("shipped").alias("l_shipdate"))
