"""Projections, predicates, text repair and schema alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.headers import canonical_headers, upper_headers
from ledgerloom.functions.schemas import align_schema, describe_columns, empty_frame, schema_gate
from ledgerloom.functions.values import (
    OPEN_END_DATE,
    blank_for_null,
    clean_rows,
    month_end,
    nfc,
    normalize_dates,
    parse_dates,
    parsed_number,
    percent_as_fraction,
    rejects,
    stringified,
    typed,
)
from ledgerloom.operators.lookup import lookup
from ledgerloom.operators.profile import rowcount_status
from ledgerloom.operators.project import (
    any_present,
    case_override,
    drop_embedded_headers,
    expression_column,
    filter_where,
    full_query,
    project,
    within,
)
from ledgerloom.plans.ingest import exposure_base
from ledgerloom.plans.rule_jobs import rows_to_json
from ledgerloom.queries.registry import day, query, table, text
from ledgerloom.session import scratch_path


@query(
    "project_upper",
    "SELECT c_custkey AS C_CUSTKEY, c_name AS C_NAME, c_mktsegment AS C_MKTSEGMENT FROM customer",
)
def project_upper(spark: SparkSession, folder: str) -> DataFrame:
    return project(upper_headers(table(spark, folder, "customer")), "C_CUSTKEY, C_NAME, C_MKTSEGMENT")


@query(
    "dynamic_filter",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'",
)
def dynamic_filter(spark: SparkSession, folder: str) -> DataFrame:
    found = filter_where(table(spark, folder, "orders"), "o_totalprice > 100000 AND o_orderstatus = 'F'")
    return filter_where(found, "null").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "full_query",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS order_cnt, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY o_orderstatus, o_orderpriority""",
)
def full_query_query(spark: SparkSession, folder: str) -> DataFrame:
    return full_query(
        table(spark, folder, "orders"),
        """SELECT o_orderstatus, o_orderpriority, count(*) AS order_cnt, round(sum(o_totalprice), 2) AS total
        FROM dataset GROUP BY o_orderstatus, o_orderpriority;""",
    )


@query(
    "expression_column",
    """SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size,
CASE WHEN p_size > 25 THEN 'BIG' WHEN p_size > 5 THEN 'MID' END AS "SIZE CLASS.1" FROM part""",
)
def expression_column_query(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_name", F.col("p_size").cast("bigint").alias("p_size"))
    return expression_column(parts, "CASE WHEN p_size > 25 THEN 'BIG' WHEN p_size > 5 THEN 'MID' END", "SIZE CLASS.1")


@query(
    "predicates",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE (o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31')
   OR (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-01-01')
   OR (COALESCE(nullif(o_orderstatus, 'P'), nullif(o_orderpriority, '5-LOW')) IS NULL)
   OR (nullif(o_orderstatus, 'O') IS DISTINCT FROM o_orderstatus AND o_totalprice > 400000)""",
)
def predicates(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumns(
        {
            "status_or_null": F.nullif("o_orderstatus", F.lit("P")),
            "priority_or_null": F.nullif("o_orderpriority", F.lit("5-LOW")),
            "changed_status": F.nullif("o_orderstatus", F.lit("O")),
        }
    )
    ordered = F.col("o_orderdate").cast("date")
    date = lambda d: F.to_date(F.lit(d))
    return orders.where(
        ((F.col("o_orderstatus") == "F") & within(ordered, date("1996-01-01"), date("1996-12-31")))
        | (
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
            & within(ordered, date("1998-01-01"), date("1999-01-01"), closed=False)
        )
        | ~any_present(["status_or_null", "priority_or_null"])
        | (~F.col("changed_status").eqNullSafe(F.col("o_orderstatus")) & (F.col("o_totalprice") > 400000))
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "scalar_pack",
    """SELECT o_orderkey, COALESCE(nullif(o_orderstatus, 'P'), 'none') AS status_text,
CAST(trunc(o_totalprice) AS BIGINT) AS price_whole, substring(o_orderpriority, 3) AS priority_name,
left(o_orderpriority, 1) AS priority_code, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS age_days,
CAST(year(o_orderdate) AS BIGINT) AS order_year, strftime(o_orderdate, '%m-%d-%Y') AS us_date,
CAST(strptime(strftime(o_orderdate, '%m-%d-%Y'), '%m-%d-%Y')::DATE AS VARCHAR) AS parsed_date,
upper(o_orderpriority) AS upper_text, lower(o_orderpriority) AS lower_text,
regexp_replace(o_orderpriority, '^[0-9]-', '') AS stripped,
split_part(o_orderpriority || '/' || o_orderstatus || '/x', '/', 1) AS first_part,
o_orderstatus || '/x' AS rest_part, '9999-12-31 00:00:00' AS open_end
FROM orders""",
)
def scalar_pack(spark: SparkSession, folder: str) -> DataFrame:
    ordered = F.col("o_orderdate").cast("date")
    us_date = F.date_format(ordered, "MM-dd-yyyy")
    label = F.concat_ws("/", "o_orderpriority", "o_orderstatus", F.lit("x"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("none")).alias("status_text"),
        F.col("o_totalprice").cast("bigint").alias("price_whole"),
        F.substring("o_orderpriority", 3, 100).alias("priority_name"),
        F.left("o_orderpriority", F.lit(1)).alias("priority_code"),
        F.date_diff(F.to_date(F.lit("2001-12-31")), ordered).cast("bigint").alias("age_days"),
        F.year(ordered).cast("bigint").alias("order_year"),
        us_date.alias("us_date"),
        F.to_date(us_date, "MM-dd-yyyy").cast("string").alias("parsed_date"),
        F.upper("o_orderpriority").alias("upper_text"),
        F.lower("o_orderpriority").alias("lower_text"),
        F.regexp_replace("o_orderpriority", "^[0-9]-", "").alias("stripped"),
        F.get(F.split(label, "/", 2), 0).alias("first_part"),
        F.get(F.split(label, "/", 2), 1).alias("rest_part"),
        F.lit(OPEN_END_DATE).cast("timestamp").cast("string").alias("open_end"),
    )


@query(
    "fill_blank",
    """SELECT c_custkey, COALESCE(nullif(c_mktsegment, 'BUILDING'), '') AS c_mktsegment, c_name,
CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer""",
)
def fill_blank(spark: SparkSession, folder: str) -> DataFrame:
    return blank_for_null(
        table(spark, folder, "customer").select(
            "c_custkey",
            F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
            "c_name",
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        )
    )


@query(
    "parse_dates",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_day,
CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS commit_day FROM orders""",
)
def parse_dates_query(spark: SparkSession, folder: str) -> DataFrame:
    iso, us = day("o_orderdate"), F.date_format(F.col("o_orderdate").cast("date"), "MM-dd-yyyy")
    landed = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("Policy Effective Date")).otherwise(iso).alias("order_day"),
        F.when(F.col("o_orderpriority") == "5-LOW", iso).otherwise(us).alias("commit_day"),
    )
    parsed = parse_dates(parse_dates(landed, ["order_day"]), ["commit_day"], "MM-dd-yyyy")
    return parsed.select("o_orderkey", text("order_day").alias("order_day"), text("commit_day").alias("commit_day"))


def mixed_dates(orders: DataFrame, priority: str = "o_orderpriority", date: str = "o_orderdate"):
    """Date text in the formats landing files use; one priority has none."""
    d = F.col(date).cast("date")
    return (
        F.when(F.col(priority) == "1-URGENT", d.cast("string"))
        .when(F.col(priority) == "2-HIGH", F.upper(F.date_format(d, "ddMMMyyyy")))
        .when(F.col(priority) == "3-MEDIUM", F.date_format(d, "MM/dd/yyyy"))
        .when(F.col(priority) == "4-NOT SPECIFIED", F.date_diff(d, F.to_date(F.lit("1899-12-30"))).cast("string"))
        .otherwise(F.lit("Policy Effective Date"))
    )


@query(
    "normalize_dates",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_day FROM orders""",
)
def normalize_dates_query(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    repaired = normalize_dates(orders.select("o_orderkey", mixed_dates(orders).alias("order_day")), ["order_day"])
    return repaired.withColumn("order_day", text("order_day"))


def landed_values(spark: SparkSession, folder: str) -> DataFrame:
    """Order days and prices as text in all the ways they arrive, some unreadable."""
    orders = table(spark, folder, "orders")
    way, date = F.pmod("o_orderkey", F.lit(8)), F.col("o_orderdate").cast("date")
    day_text = (
        F.when(way == 0, F.date_format(date, "M/d/yyyy h:mm a"))
        .when(way == 1, F.date_format(date, "MM/dd/yy"))
        .when(way == 2, F.date_format(date, "yyyy"))
        .when(way == 3, F.date_format(date, "MM/dd/yyyy HH:mm:ss"))
        .when(way == 4, F.lit(" "))
        .when(way == 5, F.lit("13/45/2024"))
        .when(way == 6, F.concat(F.date_diff(date, F.lit("1899-12-30")).cast("string"), F.lit(".0")))
    )
    price = F.when(way == 3, "n/a").when(way == 4, "").otherwise(F.col("o_totalprice").cast("string"))
    return orders.select("o_orderkey", day_text.alias("day"), price.alias("price"))


@query(
    "typed_values",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 1, 3, 6) THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day,
CASE WHEN o_orderkey % 8 NOT IN (3, 4) THEN o_totalprice END AS price,
CAST(CASE o_orderkey % 8 WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 5 THEN 1 ELSE 0 END AS BIGINT) AS lost FROM orders""",
)
def typed_values(spark: SparkSession, folder: str) -> DataFrame:
    found = typed(landed_values(spark, folder), ["day"], ["price"])
    return found.select("o_orderkey", text("day").alias("day"), "price", F.size("_rejects").cast("bigint").alias("lost"))


@query(
    "rejected_values",
    """SELECT 'day' AS "column", 'year' AS reason, year(o_orderdate)::VARCHAR AS raw, count(*) AS n FROM orders WHERE o_orderkey % 8 = 2 GROUP BY ALL
UNION ALL SELECT 'day', 'unreadable', '13/45/2024', count(*) FROM orders WHERE o_orderkey % 8 = 5 HAVING count(*) > 0
UNION ALL SELECT 'price', 'unreadable', 'n/a', count(*) FROM orders WHERE o_orderkey % 8 = 3 HAVING count(*) > 0""",
)
def rejected_values(spark: SparkSession, folder: str) -> DataFrame:
    """What could not be read, with its raw text, counted."""
    lost = rejects(typed(landed_values(spark, folder), ["day"], ["price"]), ["o_orderkey"])
    return lost.groupBy("column", "reason", "raw").agg(F.count(F.lit(1)).alias("n"))


MESSY_HEADERS = {
    "l_orderkey": "Policy #",
    "l_linenumber": "EndorsementNumber",
    "l_shipdate": "InceptionDate",
    "l_returnflag": "Fire & Theft",
    "l_linestatus": "Limit / Deductible",
    "l_quantity": "#RatEmp",
    "l_discount": "Commission %",
    "l_tax": "State.1",
    "l_extendedprice": "Limit (see tab)",
    "l_partkey": "Policy",
    "l_suppkey": " - ",
}


@query(
    "canonical_headers",
    """SELECT l_orderkey AS policy_number, CAST(l_linenumber AS BIGINT) AS endorsement_number,
CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS policy_effective_date, l_returnflag AS "fire_AND_theft",
l_linestatus AS "limit_OR_deductible", l_quantity AS num_rat_emp, l_discount AS commission_perc, l_tax AS state_1,
l_extendedprice AS "limit", l_partkey AS policy_number_, l_suppkey AS "-" FROM lineitem""".replace('AS "-"', "AS _"),
)
def canonical_headers_query(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").withColumns(
        {"l_shipdate": day("l_shipdate"), "l_linenumber": F.col("l_linenumber").cast("bigint")}
    )
    return canonical_headers(items.select(*MESSY_HEADERS).toDF(*MESSY_HEADERS.values()))


@query(
    "drop_embedded_headers",
    "SELECT CAST(l_orderkey AS VARCHAR) AS policy_number, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS policy_effective_date FROM lineitem",
)
def drop_embedded_headers_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        text("l_orderkey").alias("policy_number"), day("l_shipdate").alias("policy_effective_date")
    )
    orders = table(spark, folder, "orders")
    labels = orders.select(F.lit("Policy #").alias("policy_number"), F.lit("Policy Effective Date").alias("policy_effective_date"))
    names = orders.select(F.lit("policy_number").alias("policy_number"), F.lit("policy_effective_date").alias("policy_effective_date"))
    landed = rows.unionByName(labels).unionByName(names)
    return drop_embedded_headers(drop_embedded_headers(landed, {"policy_effective_date": "Policy Effective Date"}))


@query(
    "clean_rows",
    """SELECT nullif(lang, 'en') AS lang, doc_id, replace(text, chr(10), ', ') AS text
FROM documents WHERE nullif(lang, 'en') IS NOT NULL""",
)
def clean_rows_query(spark: SparkSession, folder: str) -> DataFrame:
    return clean_rows(table(spark, folder, "documents").select(F.nullif("lang", F.lit("en")).alias("lang"), "doc_id", "text"))


@query(
    "as_of_stamp",
    """SELECT o_orderkey, '2024-12-31' AS as_of,
CAST(last_day(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH) AS VARCHAR) AS month_before,
CAST(last_day(CAST(o_orderdate AS DATE) - INTERVAL 14 MONTH) AS VARCHAR) AS year_before FROM orders""",
)
def as_of_stamp(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        text(month_end("2025-01-15")).alias("as_of"),
        text(month_end(F.col("o_orderdate"))).alias("month_before"),
        text(month_end(F.col("o_orderdate"), 14)).alias("year_before"),
    )


TARGET = "as_of string, o_orderkey string, O_TOTALPRICE bigint, o_orderstatus string, region string, rating double"
ALIGN_SQL = """SELECT CAST(NULL AS VARCHAR) AS as_of, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
CAST(trunc(o_totalprice) AS BIGINT) AS "O_TOTALPRICE", o_orderstatus, CAST(NULL AS VARCHAR) AS region,
CAST(NULL AS DOUBLE) AS rating FROM orders"""


@query("align_schema", ALIGN_SQL)
def align_schema_query(spark: SparkSession, folder: str) -> DataFrame:
    return align_schema(table(spark, folder, "orders"), T.StructType.fromDDL(TARGET))


@query("schema_gate", ALIGN_SQL)
def schema_gate_query(spark: SparkSession, folder: str) -> DataFrame:
    target = T.StructType.fromDDL(TARGET)
    return schema_gate(align_schema(table(spark, folder, "orders"), target), target)


@query(
    "empty_from_schema",
    "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS carrier FROM customer",
)
def empty_from_schema(spark: SparkSession, folder: str) -> DataFrame:
    """A table is created empty from a schema, then takes rows aligned to it."""
    path = scratch_path(spark, "created")
    empty_frame(spark, "c_custkey bigint, c_name string, carrier string").write.parquet(path)
    created = spark.read.parquet(path)
    align_schema(table(spark, folder, "customer"), created).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query(
    "stringify",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
CAST(o_totalprice AS VARCHAR) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate,
o_orderpriority FROM orders""",
)
def stringify(spark: SparkSession, folder: str) -> DataFrame:
    return stringified(table(spark, folder, "orders"))


@query(
    "stringify_events",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS VARCHAR) AS value, props FROM events""",
)
def stringify_events(spark: SparkSession, folder: str) -> DataFrame:
    return stringified(table(spark, folder, "events"))


@query(
    "case_override",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
CASE WHEN l_linestatus = 'O' THEN 'Open Pro' ELSE s_name END AS specialty_program,
CASE WHEN l_returnflag = 'N' THEN l_returnflag ELSE s_name END AS lob
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def case_override_query(spark: SparkSession, folder: str) -> DataFrame:
    looked_up = lookup(
        table(spark, folder, "lineitem"), table(spark, folder, "supplier"), {"l_suppkey": "s_suppkey"}, ["s_name"]
    )
    return looked_up.select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        case_override(F.col("s_name"), F.col("l_linestatus"), {"O": "Open Pro"}).alias("specialty_program"),
        case_override(F.col("s_name"), F.col("l_returnflag"), {"N": F.col("l_returnflag")}).alias("lob"),
    )


@query(
    "exposure_base",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
round(CASE WHEN l_returnflag = 'A' THEN 1.0 * date_diff('day', CAST(l_shipdate AS DATE), DATE '2002-01-01') / 365
     WHEN l_returnflag = 'R' THEN COALESCE(l_extendedprice, 0) + COALESCE(nullif(l_quantity, 1), 0) + COALESCE(l_tax, 0)
     ELSE COALESCE(nullif(l_discount, 0), 0) END, 6) AS exposures FROM lineitem""",
)
def exposure_base_query(spark: SparkSession, folder: str) -> DataFrame:
    nothing = F.lit(None).cast("double")
    lob = F.when(F.col("l_returnflag") == "A", "AL").when(F.col("l_returnflag") == "R", "Property").otherwise("GL")
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        lob.alias("lob"),
        F.col("l_shipdate").cast("date").alias("expos_eff_dt"),
        F.to_date(F.lit("2002-01-01")).alias("expos_exp_dt"),
        F.col("l_extendedprice").alias("building_limit"),
        F.nullif("l_quantity", F.lit(1.0)).alias("contents_limit"),
        F.col("l_tax").alias("time_element_limit"),
        *[nothing.alias(c) for c in ("stock", "personal_stock", "eq_limit", "flood_limit")],
        F.nullif("l_discount", F.lit(0.0)).alias("value"),
    )
    return rows.select("l_orderkey", "l_linenumber", F.round(exposure_base(F.col("lob")), 6).alias("exposures"))


@query(
    "parse_numbers",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_totalprice END AS amount,
CASE o_orderstatus WHEN 'F' THEN round(o_totalprice / 100, 6) END AS fraction FROM orders""",
)
def parse_numbers(spark: SparkSession, folder: str) -> DataFrame:
    landed = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), F.col("o_totalprice").cast("string")))
        .when(F.col("o_orderstatus") == "O", F.lit("n/a"))
        .otherwise(F.lit(""))
    )
    return table(spark, folder, "orders").select(
        "o_orderkey", parsed_number(landed).alias("amount"), F.round(percent_as_fraction(landed), 6).alias("fraction")
    )


@query(
    "nfc_text",
    "SELECT doc_id, nfc_normalize(replace(replace(text, chr(233), 'e' || chr(769)), chr(252), 'u' || chr(776))) AS text FROM documents",
)
def nfc_text(spark: SparkSession, folder: str) -> DataFrame:
    acute = F.replace(F.col("text"), F.lit("\u00e9"), F.lit("e\u0301"))
    decomposed = F.replace(acute, F.lit("\u00fc"), F.lit("u\u0308"))
    return table(spark, folder, "documents").select("doc_id", nfc(decomposed).alias("text"))


@query(
    "rows_to_json",
    """SELECT '{"c_custkey":"' || c_custkey || '","c_mktsegment":"' || COALESCE(nullif(c_mktsegment, 'BUILDING'), '')
|| '","c_name":"' || c_name || '"}' AS json FROM customer""",
)
def rows_to_json_query(spark: SparkSession, folder: str) -> DataFrame:
    return rows_to_json(
        table(spark, folder, "customer").select(
            "c_name", text("c_custkey").alias("c_custkey"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment")
        )
    )


@query(
    "describe_columns",
    """SELECT CAST(position AS BIGINT) AS position, name, type, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS rowcount, 'OK' AS status
FROM (VALUES (0, 'O_ORDERKEY', 'bigint'), (1, 'O_ORDERDATE', 'timestamp_ntz'), (2, 'PRICE', 'double')) AS v(position, name, type)""",
)
def describe_columns_query(spark: SparkSession, folder: str) -> DataFrame:
    """What a user sees of a new selection set: its columns, its row count and status."""
    rows = full_query(
        table(spark, folder, "orders"),
        "SELECT o_orderkey, o_orderdate, o_totalprice AS price FROM dataset WHERE o_orderstatus = 'F'",
    )
    counted = rowcount_status(rows)
    return describe_columns(rows).select(
        F.col("position").cast("bigint").alias("position"),
        "name",
        "type",
        counted.select("rowcount").scalar().alias("rowcount"),
        counted.select("status").scalar().alias("status"),
    )
