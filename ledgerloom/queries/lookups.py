"""Enrichment joins: nations and regions stand for organizations and books."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import fallback_lookup, lookup
from ledgerloom.operators.mutate import patch
from ledgerloom.queries.registry import query, table


@query(
    "enrich_lookup",
    """SELECT s_suppkey, s_name, s_acctbal, n_name AS account_name, r_name AS book
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_name <> 'NATION_3'
LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def enrich_lookup(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").where(F.col("n_name") != "NATION_3")
    found = lookup(
        table(spark, folder, "supplier"), nations, {"s_nationkey": "n_nationkey"}, {"n_name": "account_name", "n_regionkey": "region"}
    )
    found = lookup(found, table(spark, folder, "region"), {"region": "r_regionkey"}, {"r_name": "book"})
    return found.select("s_suppkey", "s_name", "s_acctbal", "account_name", "book")


@query(
    "enrich_lookup_any_case",
    """SELECT c_custkey, n_nationkey AS found FROM (SELECT c_custkey, 'Nation_' || c_nationkey AS organization FROM customer)
LEFT JOIN nation ON lower(organization) = lower(n_name)""".replace("n_nationkey AS found", "CAST(n_nationkey AS BIGINT) AS found"),
)
def enrich_lookup_any_case(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.concat(F.lit("Nation_"), F.col("c_nationkey").cast("string")).alias("organization")
    )
    nations = table(spark, folder, "nation").withColumn("n_nationkey", F.col("n_nationkey").cast("bigint"))
    found = lookup(customers, nations, {"organization": "n_name"}, {"n_nationkey": "found"}, case_insensitive=True)
    return found.select("c_custkey", "found")


@query(
    "enrich_composite",
    """WITH described AS (
  SELECT DISTINCT r_name AS book, o_orderpriority AS lob, o_orderstatus AS tpa, c_mktsegment AS source
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey WHERE o_totalprice > 300000 AND o_orderstatus <> 'P')
SELECT o_orderkey, r_name AS book, nullif(o_orderpriority, '5-LOW') AS lob,
  d.book || ':' || d.lob AS cov_desc, d.tpa || ':' || d.source AS cov_desc_detail
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN described d ON r_name = d.book AND nullif(o_orderpriority, '5-LOW') = d.lob
  AND o_orderstatus = d.tpa AND c_mktsegment = d.source""",
)
def enrich_composite(spark: SparkSession, folder: str) -> DataFrame:
    with_book = lookup(
        table(spark, folder, "orders"), table(spark, folder, "customer"), {"o_custkey": "c_custkey"}, ["c_nationkey", "c_mktsegment"]
    )
    with_book = lookup(with_book, table(spark, folder, "nation"), {"c_nationkey": "n_nationkey"}, ["n_regionkey"])
    with_book = lookup(with_book, table(spark, folder, "region"), {"n_regionkey": "r_regionkey"}, {"r_name": "book"})
    described = (
        with_book.where((F.col("o_totalprice") > 300000) & (F.col("o_orderstatus") != "P"))
        .select(
            "book",
            F.col("o_orderpriority").alias("lob"),
            F.col("o_orderstatus").alias("tpa"),
            F.col("c_mktsegment").alias("source"),
        )
        .distinct()
        .withColumn("cov_desc", F.concat_ws(":", "book", "lob"))
        .withColumn("cov_desc_detail", F.concat_ws(":", "tpa", "source"))
    )
    claims = with_book.withColumn("lob", F.nullif("o_orderpriority", F.lit("5-LOW")))
    found = lookup(
        claims,
        described,
        {"book": "book", "lob": "lob", "o_orderstatus": "tpa", "c_mktsegment": "source"},
        ["cov_desc", "cov_desc_detail"],
    )
    return found.select("o_orderkey", "book", "lob", "cov_desc", "cov_desc_detail")


def policies(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as policies: small ones have no known organization, only a plan code."""
    return table(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_size") <= 25, "Unknown").otherwise(F.col("p_brand")).alias("organization"),
        F.concat_ws("-", "p_type", "p_name").alias("marketing_plan"),
        F.col("p_name").alias("program"),
    )


def plan_codes(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "part")
        .where(F.col("p_type") != "PROMO")
        .groupBy(F.left("p_type", F.lit(3)).alias("plan_code"))
        .agg(F.min("p_brand").alias("plan_organization"))
    )


def organizations(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "part")
        .groupBy(F.col("p_brand").alias("ref_organization"))
        .agg(F.concat(F.lit("BOOK "), F.max("p_name")).alias("book"))
    )


FALLBACK_SQL = """policies AS (SELECT p_partkey, CASE WHEN p_size <= 25 THEN 'Unknown' ELSE p_brand END AS organization,
    p_type || '-' || p_name AS marketing_plan, p_name AS program FROM part),
codes AS (SELECT left(p_type, 3) AS plan_code, min(p_brand) AS plan_organization FROM part WHERE p_type <> 'PROMO' GROUP BY 1),
orgs AS (SELECT p_brand AS ref_organization, 'BOOK ' || max(p_name) AS book FROM part GROUP BY 1),
effective AS (SELECT policies.*, organization AS final_organization FROM policies WHERE organization <> 'Unknown'
  UNION ALL SELECT policies.*, plan_organization FROM policies LEFT JOIN codes ON plan_code = left(marketing_plan, 3)
  WHERE organization = 'Unknown'),
found AS (SELECT effective.*, (SELECT orgs.book FROM orgs WHERE ref_organization = final_organization) AS final_book
  FROM effective)"""


def with_fallback(spark: SparkSession, folder: str) -> DataFrame:
    return fallback_lookup(
        policies(spark, folder),
        key="organization",
        unknown="Unknown",
        code="marketing_plan",
        code_length=3,
        cross_reference=plan_codes(spark, folder),
        cross_code="plan_code",
        cross_value="plan_organization",
        table=organizations(spark, folder),
        table_key="ref_organization",
        take="book",
        key_out="final_organization",
        take_out="final_book",
    )


@query(
    "fallback_lookup",
    f"WITH {FALLBACK_SQL} SELECT p_partkey, organization, marketing_plan, program, final_organization, final_book FROM found",
)
def fallback_lookup_query(spark: SparkSession, folder: str) -> DataFrame:
    return with_fallback(spark, folder)


@query(
    "patch_update",
    f"""WITH {FALLBACK_SQL} SELECT p_partkey, marketing_plan, program,
CASE WHEN organization = 'Unknown' AND program LIKE 'small%' THEN final_organization ELSE organization END AS organization FROM found""",
)
def patch_update(spark: SparkSession, folder: str) -> DataFrame:
    """Only unknown organizations of one kind of program are updated."""
    patched = patch(
        with_fallback(spark, folder),
        (F.col("organization") == "Unknown") & F.col("program").startswith("small"),
        {"organization": F.col("final_organization")},
    )
    return patched.select("p_partkey", "organization", "marketing_plan", "program")
