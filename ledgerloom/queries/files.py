"""Scans and writes: tables go out to files in the scratch folder and come back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.schemas import schema_from_metadata
from ledgerloom.functions.values import date_in_name
from ledgerloom.queries.registry import day, query, table
from ledgerloom.session import scratch_path
from ledgerloom.sinks import tables as sink
from ledgerloom.sources import files as source


def order_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", day("o_orderdate").alias("o_orderdate"), "o_orderpriority"
    )


ORDER_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders"""


@query(
    "scan_csv_inferred",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def scan_csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    sink.export_csv(order_text(spark, folder).drop("o_orderdate"), path)
    read = source.csv_inferred(spark, path)
    return read.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")})


@query("scan_csv_robust", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text, source FROM documents")
def scan_csv_robust(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with line breaks, quotes and commas survive the round trip."""
    path = scratch_path(spark, "documents-csv")
    sink.export_csv(table(spark, folder, "documents").select("doc_id", "lang", "text", "source"), path)
    return source.csv_robust(spark, path)


@query(
    "scan_csv_split",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, replace(text, chr(10), ' "" ') AS text FROM documents""",
)
def scan_csv_split(spark: SparkSession, folder: str) -> DataFrame:
    """Records that stay on their line: the check finds that the files can be split."""
    path = scratch_path(spark, "documents-csv")
    one_line = F.replace(F.col("text"), F.lit("\n"), F.lit(' "" '))
    sink.export_csv(table(spark, folder, "documents").select("doc_id", one_line.alias("text")), path)
    return source.csv_robust(spark, path, multi_line=source.records_span_lines(spark, path))


@query(
    "scan_csv_typed",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS o_orderdate FROM orders""",
)
def scan_csv_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Values that do not fit the schema are NULL; the rest of their row stays."""
    path = scratch_path(spark, "orders-csv")
    landed = order_text(spark, folder).select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") == "5-LOW", "soon").otherwise(F.col("o_orderdate")).alias("o_orderdate"),
    )
    sink.export_csv(landed, path)
    read = source.csv_typed(spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date")
    return read.withColumn("o_orderdate", day("o_orderdate"))


@query("scan_csv_positional", ORDER_SQL)
def scan_csv_positional(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    order_text(spark, folder).write.csv(path, header=False)
    target = T.StructType.fromDDL(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
    )
    return source.csv_positional(spark, path, target).withColumn("o_orderdate", day("o_orderdate"))


@query(
    "schema_from_metadata",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice, l_returnflag,
CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate FROM lineitem""",
)
def schema_from_metadata_query(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines read back with the schema that database metadata rows describe."""
    path = scratch_path(spark, "lineitem-csv")
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", day("l_shipdate").alias("l_shipdate")
    )
    sink.export_csv(rows, path)
    metadata = spark.sql(
        """SELECT * FROM VALUES (5, 'l_shipdate', 'date', NULL, NULL, NULL, 'YES'), (1, 'l_orderkey', 'bigint', NULL, 19, 0, 'NO'),
        (2, 'l_linenumber', 'smallint', NULL, 5, 0, 'NO'), (3, 'l_extendedprice', 'decimal', NULL, 12, 2, 'YES'),
        (4, 'l_returnflag', 'nvarchar', 1, NULL, NULL, 'YES')
        AS m(ORDINAL_POSITION, COLUMN_NAME, DATA_TYPE, CHARACTER_MAXIMUM_LENGTH, NUMERIC_PRECISION, NUMERIC_SCALE, IS_NULLABLE)"""
    )
    read = source.csv_typed(spark, path, schema_from_metadata(metadata))
    return read.select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.col("l_extendedprice").cast("double").alias("l_extendedprice"),
        "l_returnflag",
        day("l_shipdate").alias("l_shipdate"),
    )


@query("file_sql_scan", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 1000 GROUP BY o_orderstatus")
def file_sql_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = source.parquet_sql(spark, f"{folder}/orders.parquet", "o_orderstatus", "o_totalprice > 1000")
    return found.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("table_scan", ORDER_SQL)
def table_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders-table")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    sink.save_external(order_text(spark, folder), name, path)
    return spark.table(name)


RUNS_SQL = """runs AS (SELECT o_orderkey, o_totalprice, o_orderpriority AS priority, CAST(year(o_orderdate) - 1990 AS BIGINT) AS process_run_key
FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND year(o_orderdate) > 1999))"""


def write_runs(spark: SparkSession, folder: str) -> str:
    """Orders as a dataset with a run per year: keys 5 to 11, so text and number order differ."""
    path = scratch_path(spark, "runs")
    year = F.year("o_orderdate")
    (
        table(spark, folder, "orders")
        .where(~((F.col("o_orderpriority") == "5-LOW") & (year > 1999)))
        .select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("priority"), (year - 1990).alias("process_run_key"))
        .write.partitionBy("priority", "process_run_key")
        .parquet(path)
    )
    return path


@query(
    "latest_partition",
    f"""WITH {RUNS_SQL} SELECT o_orderkey, o_totalprice, priority, process_run_key FROM runs
WHERE (priority, process_run_key) IN (SELECT priority, max(process_run_key) FROM runs GROUP BY priority)""",
)
def latest_partition(spark: SparkSession, folder: str) -> DataFrame:
    newest = source.latest_runs(spark, write_runs(spark, folder))
    return newest.withColumn("process_run_key", F.col("process_run_key").cast("bigint"))


def write_xml(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "orders-xml")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("_id"),
        F.col("o_orderstatus").alias("Status"),
        F.struct(F.col("o_totalprice").alias("Amount"), F.col("o_orderpriority").alias("Priority")).alias("Bill"),
    )
    orders.write.format("xml").option("rootTag", "Root").option("rowTag", "Rec").save(path)
    return path


@query("scan_xml", "SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS amount FROM orders")
def scan_xml(spark: SparkSession, folder: str) -> DataFrame:
    schema = T.StructType.fromDDL("_id bigint, Status string, Bill struct<Amount: double, Priority: string>")
    rows = source.xml_rows(spark, write_xml(spark, folder), "Rec", schema)
    return rows.select(F.col("_id").alias("id"), F.col("Status").alias("status"), F.col("Bill.Amount").alias("amount"))


@query("scan_xml_inner", "SELECT o_totalprice AS amount, o_orderpriority AS priority FROM orders")
def scan_xml_inner(spark: SparkSession, folder: str) -> DataFrame:
    """The same documents by another row tag, with an inferred schema."""
    rows = source.xml_rows(spark, write_xml(spark, folder), "Bill")
    return rows.select(F.col("Amount").alias("amount"), F.col("Priority").alias("priority"))


@query(
    "landing_files",
    """SELECT 'FEED_Programs_CLAIM_LAND_20241231.CSV' AS name, '2024-12-31' AS as_of, CAST(o_orderkey AS VARCHAR) AS claim_number
FROM orders WHERE o_orderstatus = 'F'""",
)
def landing_files(spark: SparkSession, folder: str) -> DataFrame:
    """No default file for the month: the program file wins over the other book."""
    drop = scratch_path(spark, "landing")
    claims = table(spark, folder, "orders").select(F.col("o_orderkey").alias("claim_number"), "o_orderstatus")
    for subject, suffix, book, status in (
        ("claims", "20241130", "", "O"),
        ("claims", "20241231", "Partner_", "P"),
        ("claims", "20241231", "Programs_", "F"),
        ("policy", "20241231", "", "O"),
    ):
        name = source.landing_file_name(subject, suffix, book)
        sink.export_csv(claims.where(F.col("o_orderstatus") == status).select("claim_number"), f"{drop}/{name}")
    path = source.landing_file(spark, drop, "claims", "20241231")
    name = F.lit(path.rsplit("/", 1)[-1])
    return source.csv_robust(spark, path).select(
        name.alias("name"), day(date_in_name(name)).alias("as_of"), "claim_number"
    )


GRID_LINES = {"O": "agricultural", "F": "crime"}
GRID_YEARS = tuple(range(1995, 2002))


def write_grid(spark: SparkSession, folder: str) -> str:
    """One file per line and year from order lines; later files have one more column."""
    root = scratch_path(spark, "bronze")
    year = F.year("l_shipdate")
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("Policy #"),
        F.col("l_linenumber").alias("EndorsementNumber"),
        day("l_shipdate").alias("Policy Effective Date"),
        F.col("l_extendedprice").alias("CoveragePremium"),
        F.col("l_returnflag").alias("Fire & Theft"),
        year.alias("year"),
        file_name(F.col("l_linestatus"), GRID_LINES, year),
    )
    write_named(items.where("year >= 1998").drop("year"), f"{root}/late")
    write_named(items.where("year < 1998").drop("year", "Fire & Theft"), f"{root}/early")
    return root


def file_name(code: Column, lines: dict[str, str], year: Column) -> Column:
    """``<line>-bordereaux-<year>.csv`` of a row."""
    pairs = [F.lit(x) for item in lines.items() for x in item]
    line = F.element_at(F.create_map(*pairs), code)
    return F.concat(line, F.lit("-bordereaux-"), year.cast("string"), F.lit(".csv")).alias("file")


# CSV files that a task writes at once: text under way takes little memory.
NAMED_FILES = 64


def write_named(df: DataFrame, folder: str, *names: str) -> None:
    """CSV files named by columns, all in one write."""
    with sink.files_at_once(df.sparkSession, NAMED_FILES):
        df.write.option("header", True).option("escape", '"').partitionBy(*(names or ("file",))).csv(folder)


GRID_SQL = """SELECT CAST(l_orderkey AS VARCHAR) AS policy_number, CAST(l_linenumber AS VARCHAR) AS endorsement_number,
CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS policy_effective_date, CAST(l_extendedprice AS VARCHAR) AS coverage_premium,
CASE WHEN year(l_shipdate) >= 1998 THEN l_returnflag END AS "fire_AND_theft",
CASE l_linestatus WHEN 'O' THEN 'agricultural' ELSE 'crime' END AS line"""


@query("grid_load", GRID_SQL + ", CAST(year(l_shipdate) AS BIGINT) AS year FROM lineitem")
def grid_load(spark: SparkSession, folder: str) -> DataFrame:
    loaded = source.grid_load(spark, write_grid(spark, folder), list(GRID_LINES.values()), GRID_YEARS)
    return loaded.withColumn("year", F.col("year").cast("bigint"))


@query(
    "grid_report",
    """SELECT DISTINCT CASE l_linestatus WHEN 'O' THEN 'agricultural' ELSE 'crime' END AS line,
CASE l_returnflag WHEN 'A' THEN 'deduped' ELSE '' END AS variant, CAST(year(l_shipdate) AS BIGINT) AS year,
CASE WHEN l_linestatus = 'O' THEN 'line' WHEN l_returnflag = 'A' THEN 'variant' WHEN year(l_shipdate) > 1994 THEN 'year' END AS left_out
FROM lineitem""",
)
def grid_report(spark: SparkSession, folder: str) -> DataFrame:
    """The files that look like those of a grid, and why some of them are not loaded."""
    root = scratch_path(spark, "bronze")
    year = F.year("l_shipdate")
    variant = F.when(F.col("l_returnflag") == "A", "deduped-").otherwise("")
    name = F.replace(file_name(F.col("l_linestatus"), GRID_LINES, year), F.lit("bordereaux-"), F.concat(F.lit("bordereaux-"), variant))
    write_named(table(spark, folder, "lineitem").select("l_orderkey", name.alias("file")), root)
    found = source.grid_files(spark, root, ["crime"], range(1990, 1995))
    return found.select("line", "variant", F.col("year").cast("bigint").alias("year"), "left_out")


@query(
    "sheet_report",
    """SELECT DISTINCT 'book ' || l_linestatus AS workbook, CASE l_returnflag WHEN 'A' THEN 'property' WHEN 'N' THEN 'fee' END AS line,
CASE WHEN l_linestatus = 'O' THEN 'skipped' WHEN l_returnflag = 'R' THEN 'unknown' END AS left_out FROM lineitem""",
)
def sheet_report(spark: SparkSession, folder: str) -> DataFrame:
    """The sheets of workbooks, and why some of them are not routed to a line."""
    root = scratch_path(spark, "workbooks")
    sheet = F.element_at(F.create_map(*[F.lit(x) for x in ("A", "PROPERTY.csv", "N", "Fees.csv", "R", "Notes.csv")]), F.col("l_returnflag"))
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", F.concat(F.lit("book "), F.col("l_linestatus")).alias("book"), sheet.alias("file")
    )
    write_named(rows, root, "book", "file")
    return source.sheet_files(spark, root, skip_words=("Book O",)).select("workbook", "line", "left_out")


@query(
    "sheet_routing",
    """SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS policy_number, l_linestatus AS status,
CASE l_returnflag WHEN 'A' THEN 'property' WHEN 'N' THEN 'fee' ELSE 'umbrella' END AS line FROM lineitem""",
)
def sheet_routing(spark: SparkSession, folder: str) -> DataFrame:
    """Sheets of workbooks to lines; temporary, skipped and unknown ones stay out."""
    root = scratch_path(spark, "workbooks")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    sheets = {"A": ["Property"], "R": ["Umbrella", "Excess"], "N": ["Fees"]}
    book = F.when(status == "O", "north").otherwise("south")
    places = [F.when(flag == f, F.struct(book.alias("book"), F.lit(f"{s}.csv").alias("file"))) for f, names in sheets.items() for s in names]
    unwanted = [("~$north", "Property"), ("EPLI book", "Property"), ("west", "Notes")]
    places += [
        F.when(flag == "N", F.struct(F.lit(b).alias("book"), F.lit(f"{s}.csv").alias("file"))) for b, s in unwanted
    ]
    rows = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("Policy #"), status.alias("Status"), F.explode(F.array_compact(F.array(*places))).alias("place")
    )
    write_named(rows.select("Policy #", "Status", "place.*"), root, "book", "file")
    return source.consolidate_sheets(spark, root, skip_words=("epli",))


@query(
    "append_evolve",
    """SELECT o_orderkey AS key, o_orderstatus AS status, CAST(NULL AS DOUBLE) AS amount FROM orders
UNION ALL SELECT event_id, event_type, value FROM events""",
)
def append_evolve(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "evolving")
    sink.append_evolving(
        table(spark, folder, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status")), path
    )
    sink.append_evolving(
        table(spark, folder, "events").select(
            F.col("event_id").alias("key"), F.col("event_type").alias("status"), F.col("value").alias("amount")
        ),
        path,
    )
    return source.parquet_evolving(spark, path)


@query("overwrite_load", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def overwrite_load(spark: SparkSession, folder: str) -> DataFrame:
    """A table is replaced twice, the second time by rows it holds itself."""
    path, landed = scratch_path(spark, "replaced"), scratch_path(spark, "customer-csv")
    sink.export_csv(table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal"), landed)
    sink.overwrite(table(spark, folder, "nation"), path)
    loaded = sink.load_reference(spark, landed, "c_custkey bigint, c_name string, c_acctbal double", path)
    sink.overwrite_self(loaded.where("c_acctbal > 0"), path)
    return spark.read.parquet(path)


@query(
    "snapshot_append",
    """SELECT '2024-11-30' AS as_of, c_custkey, c_name FROM customer WHERE c_acctbal > 0
UNION ALL SELECT '2024-12-31', c_custkey, c_name FROM customer""",
)
def snapshot_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two months, the second stored twice: a repeated run replaces itself."""
    path = scratch_path(spark, "snapshots")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    target = T.StructType.fromDDL("c_custkey bigint, c_name string, as_of date")
    for as_of, rows in (
        (dt.date(2024, 11, 30), customers.where("c_acctbal > 0")),
        (dt.date(2024, 12, 31), customers.where("c_acctbal < 0")),
        (dt.date(2024, 12, 31), customers),
    ):
        sink.store_snapshot(rows.withColumn("as_of", F.lit(as_of)), path, target, ["c_name"])
    return spark.read.parquet(path).select(day("as_of").alias("as_of"), "c_custkey", "c_name")


@query(
    "dynamic_partition_overwrite",
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '1-URGENT'
UNION ALL SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 100000""",
)
def dynamic_partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "partitions")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    sink.overwrite_partitions(orders, path, ["o_orderpriority"])
    sink.overwrite_partitions(
        orders.where("o_orderpriority = '1-URGENT' AND o_totalprice > 100000"), path, ["o_orderpriority"]
    )
    return spark.read.parquet(path).select("o_orderkey", "o_orderpriority")


@query("export_csv", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, '  ' || lang || ' \"x\", ' AS lang FROM documents")
def export_csv(spark: SparkSession, folder: str) -> DataFrame:
    """One file for a result of sheet size; spaces, quotes and commas survive."""
    path = scratch_path(spark, "export")
    padded = F.concat(F.lit("  "), F.col("lang"), F.lit(' "x", '))
    sink.export_csv(table(spark, folder, "documents").select("doc_id", padded.alias("lang")), path, single_file=True)
    return source.csv_robust(spark, path)


@query(
    "export_tables",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_cnt FROM {t}" for t in ("orders", "customer", "documents", "nation")
    ),
)
def export_tables(spark: SparkSession, folder: str) -> DataFrame:
    tables = {t: table(spark, folder, t) for t in ("orders", "customer", "documents", "nation")}
    return sink.export_tables(spark, tables, scratch_path(spark, "exports"))
