"""Composed jobs end to end."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import rules as R
from ledgerloom.operators.sizing import broadcast_if_small
from ledgerloom.plans import rule_jobs as J
from ledgerloom.plans.bordereaux import bordereaux_load
from ledgerloom.plans.ingest import Ingested, References, append_stored, ingest_month, ingest_subject
from ledgerloom.plans.selection import (
    create_definition,
    publish_selection_set,
    refresh_definition,
    refresh_selection_set,
)
from ledgerloom.queries import mapping as M
from ledgerloom.queries.cleaning import mixed_dates
from ledgerloom.queries.files import RUNS_SQL, file_name, write_named, write_runs
from ledgerloom.queries.registry import day, query, table
from ledgerloom.session import scratch_path
from ledgerloom.sinks import tables as sink
from ledgerloom.plans.status import JobResult
from ledgerloom.sinks.versions import read_current, read_snapshots
from ledgerloom.sources.files import csv_robust, landing_file_name

LATEST_SQL = f"""WITH {RUNS_SQL}, latest AS (SELECT * FROM runs
  WHERE (priority, process_run_key) IN (SELECT priority, max(process_run_key) FROM runs GROUP BY priority))"""


# --- selection sets and mapping definitions ---------------------------------------


@query(
    "selection_set",
    f"""{LATEST_SQL} SELECT CAST(o_orderkey AS VARCHAR) AS "O_ORDERKEY", CAST(o_totalprice AS VARCHAR) AS "O_TOTALPRICE",
priority AS "PRIORITY", CAST(process_run_key AS VARCHAR) AS "PROCESS_RUN_KEY" FROM latest WHERE o_totalprice > 1000""",
)
def selection_set(spark: SparkSession, folder: str) -> DataFrame:
    result = publish_selection_set(
        spark,
        write_runs(spark, folder),
        scratch_path(spark, "selection"),
        columns="O_ORDERKEY,O_TOTALPRICE,PRIORITY,PROCESS_RUN_KEY",
        conditions="O_TOTALPRICE > 1000",
        key=["O_ORDERKEY"],
    )
    return result.data


@query(
    "selection_refresh",
    f"""{LATEST_SQL} SELECT priority AS "PRIORITY", CAST(count(*) AS VARCHAR) AS "ORDERS" FROM latest GROUP BY priority""",
)
def selection_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """A full-query selection set is published, then refreshed in place."""
    dataset, output = write_runs(spark, folder), scratch_path(spark, "selection")
    arguments = {"query_type": "FULL_QUERY", "key": ["PRIORITY"]}
    publish_selection_set(
        spark, dataset, output, conditions="SELECT PRIORITY, max(O_ORDERKEY) AS ORDERS FROM dataset GROUP BY PRIORITY", **arguments
    )
    result = refresh_selection_set(
        spark, dataset, output, conditions="SELECT PRIORITY, count(*) AS ORDERS FROM dataset GROUP BY PRIORITY", **arguments
    )
    return result.data


def part_selection(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "parts")
    sink.overwrite(
        table(spark, folder, "part").select(
            F.col("p_brand").alias("P_BRAND"),
            F.nullif("p_type", F.lit("PROMO")).alias("P_TYPE"),
            F.col("p_size").cast("string").alias("P_SIZE"),
        ),
        path,
    )
    return path


@query(
    "mapdef_create",
    """SELECT DISTINCT p_brand AS "P_BRAND", COALESCE(nullif(p_type, 'PROMO'), '') AS "P_TYPE" FROM part
WHERE nullif(p_type, 'PROMO') IS NULL OR p_type LIKE 'S%'""",
)
def mapdef_create(spark: SparkSession, folder: str) -> DataFrame:
    output = scratch_path(spark, "target")
    conditions = "P_TYPE IS NULL OR P_TYPE LIKE 'S%'"
    return create_definition(spark, part_selection(spark, folder), output, "P_BRAND,P_TYPE", conditions).data


@query(
    "mapdef_refresh",
    """SELECT p_brand AS "P_BRAND", COALESCE(nullif(p_type, 'PROMO'), '') AS "P_TYPE" FROM part WHERE p_type = 'PROMO' OR p_type LIKE 'S%'""",
)
def mapdef_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Refreshing keeps repeated rows, and blanks are filled before the filter."""
    selection, output = part_selection(spark, folder), scratch_path(spark, "target")
    create_definition(spark, selection, output, "P_BRAND,P_TYPE")
    conditions = "P_TYPE IS NULL OR P_TYPE = '' OR P_TYPE LIKE 'S%'"
    return refresh_definition(spark, selection, output, "P_BRAND,P_TYPE", conditions).data


@query(
    "job_status",
    """SELECT 'VALID KEY' AS job, 'OK' AS status, '' AS status_desc, count(*) AS row_cnt FROM nation
UNION ALL SELECT 'REPEATED KEY', 'ERROR', 'Provided Primary Key: [''N_REGIONKEY''] is not unique in this dataset.', NULL
UNION ALL SELECT 'OTHER COLUMNS', 'ERROR', 'Mismatched columns', NULL
UNION ALL SELECT 'DEFINITION', 'VALID', '', count(DISTINCT n_regionkey) FROM nation
UNION ALL SELECT 'OTHER DEFINITION', 'INVALID', 'columns in both source data do not match.', NULL
UNION ALL SELECT 'KEPT', 'OK', '', count(*) FROM nation""",
)
def job_status(spark: SparkSession, folder: str) -> DataFrame:
    """What jobs report: rows published, a key that repeats, columns that differ; a refused set leaves the former one."""
    path, output, definition = (scratch_path(spark, n) for n in ("nations", "selection", "definition"))
    sink.overwrite(table(spark, folder, "nation").select("n_name", "n_regionkey"), path)
    results = {
        "VALID KEY": publish_selection_set(spark, path, output, key=["N_NAME"]),
        "REPEATED KEY": publish_selection_set(spark, path, output, key=["N_REGIONKEY"]),
        "OTHER COLUMNS": refresh_selection_set(spark, path, output, columns="N_NAME"),
        "DEFINITION": create_definition(spark, output, definition, "N_REGIONKEY"),
        "OTHER DEFINITION": refresh_definition(spark, output, definition, "N_NAME"),
        "KEPT": JobResult("OK", row_cnt=read_current(spark, output).count()),
    }
    rows = [(job, r.status, r.status_desc, r.row_cnt) for job, r in results.items()]
    return spark.createDataFrame(rows, "job string, status string, status_desc string, row_cnt bigint")


# --- rules --------------------------------------------------------------------------


def nation_view(spark: SparkSession, folder: str) -> DataFrame:
    source = M.source_rows(spark, folder).where("c_nationkey < 20").select("C_NAME", "C_MKTSEGMENT")
    rules = M.nation_wide(spark, folder).join(
        M.source_rows(spark, folder).where("c_nationkey > 2").select("C_NAME"), "C_NAME", "left_semi"
    )
    return J.rule_view(
        source, rules, ["C_NAME"], "Key to Key", {"21": M.nation_rows(spark, folder)}, "C_NAME <> 'Customer#000000007'"
    )


VIEW_SQL = f"""WITH {M.NATION_SQL}, src AS (SELECT c_name, COALESCE(nullif(c_mktsegment, 'BUILDING'), '') AS segment FROM customer WHERE c_nationkey < 20),
rules AS (SELECT r.* FROM nation_rules r JOIN customer ON c_custkey = {M.G} WHERE c_nationkey > 2),
view AS (SELECT COALESCE(s.c_name, r."C_NAME") AS name, segment, {M.G}, r.n_name AS rule_nation FROM src s FULL JOIN rules r ON s.c_name = r."C_NAME"),
full_view AS (SELECT name, segment, {M.G}, rule_nation, r_name FROM view LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) t ON t.n_name = rule_nation
  WHERE name <> 'Customer#000000007')"""


@query(
    "rule_page",
    f"""{VIEW_SQL} SELECT name AS "C_NAME", segment AS "C_MKTSEGMENT", {M.G}, rule_nation AS "trg#21_N_NAME", r_name AS "trg#21_N_REGION", "RowNum"
FROM (SELECT *, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS "RowNum" FROM full_view) WHERE "RowNum" BETWEEN 51 AND 100""",
)
def rule_page(spark: SparkSession, folder: str) -> DataFrame:
    return J.rule_page(nation_view(spark, folder), 51, 50, "C_NAME asc")


@query(
    "rule_view",
    f"""{VIEW_SQL} SELECT name AS "C_NAME", segment AS "C_MKTSEGMENT", {M.G}, rule_nation AS "trg#21_N_NAME", r_name AS "trg#21_N_REGION" FROM full_view""",
)
def rule_view(spark: SparkSession, folder: str) -> DataFrame:
    return nation_view(spark, folder)


EXPORT_HEADERS = [
    J.ExportHeader("C_NAME", "SOURCES", "CUSTOMERS", "C_NAME"),
    J.ExportHeader("C_MKTSEGMENT", "SOURCES", "CUSTOMERS", "C_MKTSEGMENT"),
    J.ExportHeader("trg#11_SEGMENT", "TARGETS", "SEGMENTS", "SEGMENT"),
    J.ExportHeader("trg#11_GRADE", "TARGETS", "SEGMENTS", "GRADE"),
]


@query(
    "export_rules",
    f"""WITH {M.WIDE_SQL} SELECT COALESCE(s.name, r."C_NAME") AS "SOURCES#CUSTOMERS#C_NAME",
nullif(COALESCE(s.segment, r."C_MKTSEGMENT"), '') AS "SOURCES#CUSTOMERS#C_MKTSEGMENT", r.segment AS "TARGETS#SEGMENTS#SEGMENT", r.grade AS "TARGETS#SEGMENTS#GRADE"
FROM (SELECT "C_NAME" AS name, "C_MKTSEGMENT" AS segment FROM wide WHERE c_nationkey < 20) s
FULL JOIN (SELECT * FROM wide WHERE c_nationkey > 2) r ON s.name = r."C_NAME" AND s.segment = r."C_MKTSEGMENT" """,
)
def export_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Exported as CSV and read back, where blank and NULL are one."""
    rules = M.segment_wide(spark, folder).join(
        M.source_rows(spark, folder).where("c_nationkey > 2").select("C_NAME"), "C_NAME", "left_semi"
    )
    source = M.source_rows(spark, folder).where("c_nationkey < 20").select("C_NAME", "C_MKTSEGMENT")
    exported = J.export_rules(
        source, rules, ["C_NAME", "C_MKTSEGMENT"], "Attribute to Attribute", {}, EXPORT_HEADERS, sort_order="C_NAME"
    )
    path = scratch_path(spark, "export")
    sink.export_csv(exported, path)
    read = csv_robust(spark, path)
    return read.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in read.columns])


@query(
    "export_targets",
    """SELECT * FROM (SELECT DISTINCT 'PARTS' AS target, p_name || '|' || p_brand || '|' || p_size AS row_text FROM part)
UNION ALL SELECT DISTINCT 'NATION NAMES', n_name FROM nation""",
)
def export_targets(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(F.concat_ws("|", "p_name", "p_brand", "p_size").alias("row_text"))
    nations = table(spark, folder, "nation").select(F.col("n_name").alias("row_text"))
    paths = J.export_targets({"PARTS": parts, "NATION NAMES": nations}, scratch_path(spark, "sheets"))
    frames = [csv_robust(spark, path).select(F.lit(name).alias("target"), "row_text") for name, path in paths.items()]
    return frames[0].unionByName(frames[1])


def write_import(spark: SparkSession, folder: str) -> str:
    """An import sheet with three header rows above one row per customer."""
    path = scratch_path(spark, "import")
    head = spark.sql(
        """SELECT * FROM VALUES (-3L, 'Sources', '', 'Targets', '', ''), (-2L, 'Customers', '', 'Segments', '', 'Nations'),
        (-1L, 'c_name', 'c_mktsegment', 'trg#11_SEGMENT', 'grade', 'unknown') AS h(place, a, b, c, d, e)"""
    )
    body = M.segment_wide(spark, folder).select(
        F.col(R.GROUP).alias("place"), "C_NAME", "C_MKTSEGMENT", "`trg#11_SEGMENT`", "`trg#11_GRADE`", F.lit("NA")
    )
    sheet = head.union(body).orderBy("place").drop("place")
    sheet.write.option("header", False).option("escape", '"').option("emptyValue", "").csv(path)
    return path


@query(
    "import_rules",
    f"""WITH {M.LONG_SQL} SELECT {M.G}, {M.SI}, {M.SV}, {M.TI}, {M.TV} FROM long WHERE COALESCE({M.TV}, '') <> ''""",
)
def import_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Blank targets and columns the rule set does not know drop out; NA is a value."""
    sheet = J.read_import(spark, write_import(spark, folder))
    meta = M.metadata(spark)
    rows = J.import_rows(sheet, R.role_columns(meta, 1, True), R.role_columns(meta, 1, False))
    return M.as_long(rows)


@query(
    "import_layout",
    """SELECT CAST(c_custkey AS BIGINT) AS mapping_rule_column_group_id, c_name AS "CUSTOMERS/C_NAME",
nullif(nullif(c_mktsegment, 'BUILDING'), '') AS "CUSTOMERS/C_MKTSEGMENT", left(nullif(c_mktsegment, 'BUILDING'), 4) AS "SEGMENTS/TRG#11_SEGMENT",
CASE WHEN c_acctbal > 5000 THEN 'HIGH' WHEN c_acctbal > 0 THEN 'LOW' END AS "SEGMENTS/GRADE", 'NA' AS "NATIONS/UNKNOWN" FROM customer""",
)
def import_layout(spark: SparkSession, folder: str) -> DataFrame:
    sheet = J.read_import(spark, write_import(spark, folder)).data
    return sheet.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) if t == "string" else c for c, t in sheet.dtypes])


@query(
    "import_replace",
    f"""WITH {M.BOTH_SQL} SELECT {', '.join(M.LONG)} FROM both_sets WHERE {M.SI} = 511
UNION ALL SELECT {', '.join(M.LONG)} FROM long WHERE COALESCE({M.TV}, '') <> ''""",
)
def import_replace(spark: SparkSession, folder: str) -> DataFrame:
    """An import replaces its own rule set and leaves the others alone."""
    sheet = J.read_import(spark, write_import(spark, folder))
    meta, stored = M.metadata(spark), M.both_sets(spark, folder)
    in_set = F.col(R.SOURCE_ID).isin(501, 502)
    return J.import_rules(
        stored, sheet, R.role_columns(meta, 1, True), R.role_columns(meta, 1, False), in_set, "importer"
    )


@query(
    "publish_rules",
    f"""WITH {M.BOTH_SQL} SELECT 'SEGMENT_RULES' AS part_mapping_rule_set_name, {M.G}, {M.SV}, {M.TV} FROM long
UNION ALL SELECT 'NATION_KEYS', {M.G}, "C_NAME", n_name FROM nation_rules""",
)
def publish_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Two rule sets are published, one of them again: each replaces only itself."""
    path, rules, meta = scratch_path(spark, "published"), M.both_sets(spark, folder), M.metadata(spark)
    for rule_set in (1, 2, 1):
        J.publish_rules(J.published_rules(rules, meta, rule_set), path)
    return spark.read.parquet(path).select("part_mapping_rule_set_name", R.GROUP, R.SOURCE_VALUE, R.TARGET_VALUE)


# --- monthly snapshots ----------------------------------------------------------------


def references(spark: SparkSession, folder: str, coverage: DataFrame, cov_desc: DataFrame | None = None) -> References:
    """Nations are organizations of region books; coverages carry their line."""
    organization = (
        table(spark, folder, "nation")
        .where("n_name <> 'NATION_3'")
        .join(broadcast_if_small(table(spark, folder, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("organization"),
            F.col("r_name").alias("book"),
            F.concat(F.lit("Account "), "n_name").alias("account_name"),
            F.concat(F.lit("Program "), "r_name").alias("specialty_program"),
            F.when(F.col("n_regionkey") > 2, "Carrier B").otherwise("Carrier A").alias("carrier"),
        )
    )
    stored = {}
    for name, df in {"organization": organization, "lob": coverage, "cov_desc": cov_desc}.items():
        if df is not None:
            path = scratch_path(spark, f"ref-{name}")
            sink.overwrite(df, path)
            stored[name] = spark.read.parquet(path)
    return References(**stored, program_by_billing_code={"900001": "Orchard"})


ORGANIZATION_SQL = """org AS (SELECT n_name AS organization, r_name AS book, 'Account ' || n_name AS account_name,
  'Program ' || r_name AS specialty_program, CASE WHEN n_regionkey > 2 THEN 'Carrier B' ELSE 'Carrier A' END AS carrier
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name <> 'NATION_3')"""
ORG_COLUMNS_SQL = "book, account_name, specialty_program, carrier"


def described(spark: SparkSession, columns: dict[str, str]) -> DataFrame:
    """Metadata rows of a file's columns."""
    rows = ", ".join(f"({i}, '{n}', '{t}', NULL, NULL, NULL, 'YES')" for i, (n, t) in enumerate(columns.items()))
    return spark.sql(
        f"""SELECT * FROM VALUES {rows} AS m(ORDINAL_POSITION, COLUMN_NAME, DATA_TYPE,
        CHARACTER_MAXIMUM_LENGTH, NUMERIC_PRECISION, NUMERIC_SCALE, IS_NULLABLE)"""
    )


def run_ingest(
    spark: SparkSession, subject: str, raw: DataFrame, columns: dict[str, str], refs: References | None, prefix: str = ""
) -> DataFrame:
    """Land a subject as CSV, describe it by metadata rows, ingest it."""
    drop = scratch_path(spark, "landing")
    sink.export_csv(raw.select(*columns), f"{drop}/{landing_file_name(subject, '20241231', prefix)}")
    snapshot = ingest_subject(
        spark, subject, drop, described(spark, columns), refs, scratch_path(spark, f"{subject}-table"), dt.date(2025, 1, 15)
    )
    return snapshot.select(*[day(c).alias(c) if t == "date" else F.col(c) for c, t in snapshot.dtypes])


def two_months(spark: SparkSession, folder: str) -> list[Ingested]:
    """Suppliers as organizations of two months: a wider number, a new column and a lost one in the second."""
    drop, stored = scratch_path(spark, "landing"), scratch_path(spark, "organization-table")
    dates = {"org_last_updated_date_char": "varchar", "organization_created_date_char": "varchar"}
    rows = table(spark, folder, "supplier").select(
        F.col("s_name").alias("organization"),
        F.lit("01/31/2024").alias("org_last_updated_date_char"),
        F.lit("45292").alias("organization_created_date_char"),
        F.col("s_suppkey").alias("size"),
        F.col("s_nationkey").alias("region"),
        F.col("s_acctbal").alias("balance"),
    )
    months = (
        ("20241130", dt.date(2024, 12, 10), {"organization": "varchar", **dates, "size": "int", "region": "int"}),
        ("20241231", dt.date(2025, 1, 10), {"balance": "float", "size": "bigint", "organization": "varchar", **dates}),
    )
    done = []
    for suffix, reference, columns in months:
        sink.export_csv(rows.select(*columns), f"{drop}/{landing_file_name('organization', suffix)}")
        metadata = described(spark, columns)
        done.append(ingest_month(spark, "organization", drop, metadata, None, stored, reference, evolve=True))
    return done


@query(
    "append_stored",
    """SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal <= 0
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 0""",
)
def append_stored_query(spark: SparkSession, folder: str) -> DataFrame:
    """A file with its columns in another order, in the schema of the stored table."""
    path, landed = scratch_path(spark, "triangles"), scratch_path(spark, "triangles-csv")
    rows = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    sink.overwrite(rows.where("s_acctbal <= 0"), path)
    sink.export_csv(rows.where("s_acctbal > 0").select("s_acctbal", "s_suppkey", "s_name"), landed)
    return append_stored(spark, landed, path)


@query(
    "ingest_evolving",
    """SELECT '2024-11-30' AS as_of, s_name AS organization, CAST(s_suppkey AS BIGINT) AS size, CAST(s_nationkey AS BIGINT) AS region,
CAST(NULL AS DOUBLE) AS balance, '2024-01-31' AS organization_last_updated_date, '2024-01-01' AS organization_created_date FROM supplier
UNION ALL SELECT '2024-12-31', s_name, s_suppkey, NULL, s_acctbal, '2024-01-31', '2024-01-01' FROM supplier""",
)
def ingest_evolving(spark: SparkSession, folder: str) -> DataFrame:
    """Both months in the shape that the table has after the second."""
    whole = read_snapshots(spark, two_months(spark, folder)[-1].table)
    return whole.select(
        day("as_of").alias("as_of"),
        "organization",
        "size",
        F.col("region").cast("bigint").alias("region"),
        "balance",
        day("organization_last_updated_date").alias("organization_last_updated_date"),
        day("organization_created_date").alias("organization_created_date"),
    )


@query(
    "ingest_report",
    """SELECT as_of, name, action, new_type, stored_type FROM (VALUES
('2024-11-30', 'as_of', 'added', 'date', NULL), ('2024-11-30', 'organization', 'added', 'string', NULL),
('2024-11-30', 'org_last_updated_date_char', 'added', 'string', NULL), ('2024-11-30', 'organization_created_date_char', 'added', 'string', NULL),
('2024-11-30', 'size', 'added', 'int', NULL), ('2024-11-30', 'region', 'added', 'int', NULL),
('2024-11-30', 'organization_last_updated_date', 'added', 'date', NULL), ('2024-11-30', 'organization_created_date', 'added', 'date', NULL),
('2024-12-31', 'as_of', 'kept', 'date', 'date'), ('2024-12-31', 'organization', 'kept', 'string', 'string'),
('2024-12-31', 'org_last_updated_date_char', 'kept', 'string', 'string'), ('2024-12-31', 'organization_created_date_char', 'kept', 'string', 'string'),
('2024-12-31', 'size', 'widened', 'bigint', 'int'), ('2024-12-31', 'region', 'filled', NULL, 'int'),
('2024-12-31', 'organization_last_updated_date', 'kept', 'date', 'date'), ('2024-12-31', 'organization_created_date', 'kept', 'date', 'date'),
('2024-12-31', 'balance', 'added', 'double', NULL)) AS t(as_of, name, action, new_type, stored_type)""",
)
def ingest_report(spark: SparkSession, folder: str) -> DataFrame:
    """What became of every column of the two months."""
    first, second = two_months(spark, folder)
    return first.report().unionAll(second.report()).select(day("as_of").alias("as_of"), "name", "action", "new_type", "stored_type")


def orders_by_nation(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_mktsegment", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("organization")
    )
    return table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))


def priority_lines(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .where("o_orderpriority <> '3-MEDIUM'")
        .select(F.col("o_orderpriority").alias("coverage"))
        .distinct()
        .withColumn("LOB", F.when(F.col("coverage") == "1-URGENT", "AL").when(F.col("coverage") == "2-HIGH", "Property").otherwise("GL"))
    )


PRIORITY_SQL = """lob AS (SELECT DISTINCT o_orderpriority AS coverage,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'AL' WHEN '2-HIGH' THEN 'Property' ELSE 'GL' END AS lob FROM orders WHERE o_orderpriority <> '3-MEDIUM')"""
ORDERS_SQL = "o AS (SELECT orders.*, c_mktsegment, 'NATION_' || c_nationkey AS org_name FROM orders JOIN customer ON o_custkey = c_custkey)"


@query(
    "ingest_claims",
    f"""WITH {ORGANIZATION_SQL}, {PRIORITY_SQL}, {ORDERS_SQL}, cov AS (SELECT DISTINCT book, lob.lob, o_orderstatus AS tpa, c_mktsegment AS source
  FROM o JOIN org ON org_name = organization JOIN lob ON o_orderpriority = coverage WHERE o_totalprice > 300000 AND o_orderstatus <> 'P')
SELECT '2024-12-31' AS as_of, org.{ORG_COLUMNS_SQL.replace(', ', ', org.')}, lob.lob AS "LOB", CAST(o_orderkey AS VARCHAR) AS claim_number, org_name AS organization,
o_orderpriority AS coverage, o_orderstatus AS "TPA", c_mktsegment AS descriptors_source_coverage,
CASE o_orderpriority WHEN '1-URGENT' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) WHEN '2-HIGH' THEN upper(strftime(o_orderdate, '%d%b%Y'))
  WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%m/%d/%Y') WHEN '4-NOT SPECIFIED' THEN CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS VARCHAR)
  ELSE 'Policy Effective Date' END AS claim_last_updated_date_char,
CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS loss_date, o_totalprice AS gross_incurred_total,
CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS claim_last_updated_date,
cov.book || ' ' || cov.lob AS cov_desc, cov.source AS cov_desc_detail
FROM o LEFT JOIN org ON org_name = org.organization LEFT JOIN lob ON o_orderpriority = coverage
LEFT JOIN cov ON org.book = cov.book AND lob.lob = cov.lob AND o_orderstatus = cov.tpa AND c_mktsegment = cov.source""",
)
def ingest_claims(spark: SparkSession, folder: str) -> DataFrame:
    orders = orders_by_nation(spark, folder)
    raw = orders.select(
        F.col("o_orderkey").alias("claim_number"),
        "organization",
        F.col("o_orderpriority").alias("coverage"),
        F.col("o_orderstatus").alias("TPA"),
        F.col("c_mktsegment").alias("descriptors_source_coverage"),
        mixed_dates(orders).alias("claim_last_updated_date_char"),
        day("o_orderdate").alias("loss_date"),
        F.col("o_totalprice").alias("gross_incurred_total"),
    )
    refs = references(spark, folder, priority_lines(spark, folder))
    described = (
        raw.where("gross_incurred_total > 300000 AND TPA <> 'P'")
        .join(refs.organization, "organization")
        .join(refs.lob, "coverage")
        .select("book", "LOB", "TPA", "descriptors_source_coverage")
        .distinct()
        .select("*", F.concat_ws(" ", "book", "LOB").alias("cov_desc"), F.col("descriptors_source_coverage").alias("cov_desc_detail"))
    )
    path = scratch_path(spark, "ref-cov-desc")
    sink.overwrite(described, path)
    refs.cov_desc = spark.read.parquet(path)
    columns = {c: "nvarchar" for c in raw.columns} | {"loss_date": "date", "gross_incurred_total": "float"}
    return run_ingest(spark, "claims", raw, columns, refs)


@query(
    "ingest_exposures",
    f"""WITH {ORGANIZATION_SQL}, lob AS (SELECT * FROM (VALUES ('A', 'AL'), ('N', 'Property'), ('X', 'GL')) AS v(coverage, lob))
SELECT '2024-12-31' AS as_of, {ORG_COLUMNS_SQL}, lob AS "LOB", CAST(l_orderkey AS VARCHAR) AS policy_number, 'NATION_' || s_nationkey AS organization,
l_returnflag AS coverage, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS expos_eff_dt, CAST(CAST(l_shipdate + INTERVAL 6 MONTH AS DATE) AS VARCHAR) AS expos_exp_dt,
l_extendedprice AS building_limit, l_quantity AS contents_limit, CAST(NULL AS DOUBLE) AS time_element_limit, l_tax AS stock,
CAST(NULL AS DOUBLE) AS personal_stock, CAST(NULL AS DOUBLE) AS eq_limit, CAST(NULL AS DOUBLE) AS flood_limit,
nullif(l_discount, 0) AS value, CASE lob WHEN 'AL' THEN date_diff('day', CAST(l_shipdate AS DATE), CAST(l_shipdate + INTERVAL 6 MONTH AS DATE)) / 365.0
  WHEN 'Property' THEN l_extendedprice + l_quantity + l_tax ELSE COALESCE(nullif(l_discount, 0), 0) END AS exposures
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN org ON org.organization = 'NATION_' || s_nationkey LEFT JOIN lob ON l_returnflag = lob.coverage""",
)
def ingest_exposures(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").select(
        "s_suppkey", F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("organization")
    )
    shipped, nothing = F.col("l_shipdate").cast("date"), F.lit(None).cast("double")
    raw = (
        table(spark, folder, "lineitem")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_orderkey").alias("policy_number"),
            "organization",
            F.col("l_returnflag").alias("coverage"),
            shipped.alias("expos_eff_dt"),
            F.add_months(shipped, 6).alias("expos_exp_dt"),
            F.col("l_extendedprice").alias("building_limit"),
            F.col("l_quantity").alias("contents_limit"),
            nothing.alias("time_element_limit"),
            F.col("l_tax").alias("stock"),
            *[nothing.alias(c) for c in ("personal_stock", "eq_limit", "flood_limit")],
            F.nullif("l_discount", F.lit(0.0)).alias("value"),
        )
    )
    lines = spark.sql("SELECT * FROM VALUES ('A', 'AL'), ('N', 'Property'), ('X', 'GL') AS v(coverage, LOB)")
    columns = {c: "float" for c in raw.columns}
    columns |= {c: "nvarchar" for c in ("policy_number", "organization", "coverage")}
    columns |= {"expos_eff_dt": "date", "expos_exp_dt": "date"}
    return run_ingest(spark, "exposures", raw, columns, references(spark, folder, lines))


@query(
    "ingest_policy",
    f"""WITH {ORGANIZATION_SQL}, lob AS (SELECT DISTINCT c_mktsegment AS coverage, left(c_mktsegment, 2) AS lob FROM customer WHERE c_mktsegment <> 'FURNITURE')
SELECT '2024-12-31' AS as_of, book, account_name, CASE WHEN c_acctbal > 5000 THEN 'Orchard' ELSE specialty_program END AS specialty_program, carrier,
CASE WHEN c_acctbal < 0 THEN 'EPL/POL' ELSE lob END AS "LOB", CAST(c_custkey AS VARCHAR) AS policy_number, 'NATION_' || c_nationkey AS organization,
CASE WHEN c_acctbal > 5000 THEN '900001' ELSE '0' END AS billing_code, CASE WHEN c_acctbal < 0 THEN 'EPL/POL' ELSE c_mktsegment END AS primary_coverage,
CASE c_mktsegment WHEN 'BUILDING' THEN 'n/a' WHEN 'MACHINERY' THEN NULL ELSE '15' END AS sub_producer_commission_char,
CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN CAST(0.15 AS DOUBLE) END AS sub_producer_commission
FROM customer LEFT JOIN org ON org.organization = 'NATION_' || c_nationkey
LEFT JOIN lob ON CASE WHEN c_acctbal < 0 THEN 'EPL/POL' ELSE c_mktsegment END = lob.coverage""",
)
def ingest_policy(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    segment = F.col("c_mktsegment")
    raw = customers.select(
        F.col("c_custkey").alias("policy_number"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("organization"),
        F.when(F.col("c_acctbal") > 5000, "900001").otherwise("0").alias("billing_code"),
        F.when(F.col("c_acctbal") < 0, "EPL/POL").otherwise(segment).alias("primary_coverage"),
        F.when(segment == "BUILDING", "n/a").when(segment == "MACHINERY", None).otherwise("15").alias("sub_producer_commission_char"),
    )
    lines = (
        customers.where("c_mktsegment <> 'FURNITURE'")
        .select(segment.alias("coverage"))
        .distinct()
        .withColumn("LOB", F.left("coverage", F.lit(2)))
    )
    return run_ingest(
        spark, "policy", raw, {c: "nvarchar" for c in raw.columns}, references(spark, folder, lines), "Programs_"
    )


@query(
    "ingest_premium",
    f"""WITH {ORGANIZATION_SQL}, {PRIORITY_SQL}, {ORDERS_SQL}
SELECT '2024-12-31' AS as_of, {ORG_COLUMNS_SQL}, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'Not Selected' ELSE lob END AS "LOB",
CAST(o_orderkey AS VARCHAR) AS policy_number, org_name AS organization, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'Not Selected' ELSE o_orderpriority END AS coverage,
CAST(year(o_orderdate) AS VARCHAR) AS model_year_char, CASE o_orderstatus WHEN 'F' THEN 'n/a' ELSE '7' END AS unit_number_char,
CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS premium_created_date_char, o_totalprice AS premium_written_final,
CAST(year(o_orderdate) AS DOUBLE) AS model_year, CASE o_orderstatus WHEN 'F' THEN NULL ELSE CAST(7 AS DOUBLE) END AS unit_number,
CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS premium_created_date
FROM o LEFT JOIN org ON org_name = org.organization LEFT JOIN lob ON o_orderpriority = coverage""",
)
def ingest_premium(spark: SparkSession, folder: str) -> DataFrame:
    raw = orders_by_nation(spark, folder).select(
        F.col("o_orderkey").alias("policy_number"),
        "organization",
        F.when(F.col("o_orderpriority") == "3-MEDIUM", "Not Selected").otherwise(F.col("o_orderpriority")).alias("coverage"),
        F.year("o_orderdate").alias("model_year_char"),
        F.when(F.col("o_orderstatus") == "F", "n/a").otherwise("7").alias("unit_number_char"),
        day("o_orderdate").alias("premium_created_date_char"),
        F.col("o_totalprice").alias("premium_written_final"),
    )
    columns = {c: "nvarchar" for c in raw.columns} | {"premium_written_final": "float"}
    return run_ingest(spark, "premium", raw, columns, references(spark, folder, priority_lines(spark, folder)), "Partner_")


@query(
    "ingest_organization",
    """SELECT '2024-12-31' AS as_of, s_name AS organization, 'NATION_' || s_nationkey AS legal_name, '30SEP2024' AS org_last_updated_date_char,
CASE WHEN s_acctbal > 0 THEN '2024-09-30' ELSE '' END AS organization_created_date_char, '2024-09-30' AS organization_last_updated_date,
CASE WHEN s_acctbal > 0 THEN '2024-09-30' END AS organization_created_date FROM supplier""".replace("ELSE '' END AS org", "END AS org"),
)
def ingest_organization(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "supplier").select(
        F.col("s_name").alias("organization"),
        F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("legal_name"),
        F.lit("30SEP2024").alias("org_last_updated_date_char"),
        F.when(F.col("s_acctbal") > 0, "2024-09-30").alias("organization_created_date_char"),
    )
    return run_ingest(spark, "organization", raw, {c: "nvarchar" for c in raw.columns}, None)


# --- bordereaux -----------------------------------------------------------------------

BORDEREAUX_LINES = {"R": "agricultural", "A": "commercial_auto", "N": "crime"}
BORDEREAUX_YEARS = tuple(range(1995, 2002))


def write_bordereaux(spark: SparkSession, folder: str) -> str:
    """Messy yearly files: own headers, repeated rows, header rows as data, dates of several kinds."""
    root = scratch_path(spark, "bronze")
    shipped = F.col("l_shipdate").cast("date")
    text = (
        F.when(F.col("l_linenumber") < 3, shipped.cast("string"))
        .when(F.col("l_linenumber") < 5, F.date_format(shipped, "MM/dd/yyyy"))
        .otherwise(F.date_diff(shipped, F.to_date(F.lit("1899-12-30"))).cast("string"))
    )
    year = F.year(shipped)
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("Policy Number"),
        F.col("l_linenumber").cast("string").alias("EndorsementNumber"),
        text.alias("InceptionDate"),
        F.col("l_linestatus").alias("State.1"),
        year.alias("year"),
        file_name(F.col("l_returnflag"), BORDEREAUX_LINES, year),
    )
    headers = items.select(
        F.lit("Policy Number"), F.lit("Endorsement"), F.lit("Policy Effective Date"), F.lit("State"), "year", "file"
    ).distinct()
    rows = items.union(items).union(headers)
    write_named(rows.where("year > 1996").drop("year"), f"{root}/late")
    write_named(rows.where("year <= 1996").drop("year", "State.1"), f"{root}/early")
    return root


@query(
    "bordereaux_load",
    """SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS policy_number, CAST(l_linenumber AS VARCHAR) AS endorsement_number,
CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS policy_effective_date, CASE WHEN year(l_shipdate) > 1996 THEN l_linestatus END AS state_1,
CASE l_returnflag WHEN 'R' THEN 'agricultural' WHEN 'A' THEN 'commercial_auto' ELSE 'crime' END AS line, CAST(year(l_shipdate) AS BIGINT) AS year
FROM lineitem""",
)
def bordereaux_load_query(spark: SparkSession, folder: str) -> DataFrame:
    loaded = bordereaux_load(
        spark,
        write_bordereaux(spark, folder),
        scratch_path(spark, "bordereaux"),
        list(BORDEREAUX_LINES.values()),
        BORDEREAUX_YEARS,
    )
    return loaded.withColumns({"policy_effective_date": day("policy_effective_date"), "year": F.col("year").cast("bigint")})
