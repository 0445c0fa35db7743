"""Monthly subject snapshots: typed scan, enrichment, alignment, storage."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.schemas import ColumnChange, align_schema, gated, schema_from_metadata, schema_gate
from ledgerloom.functions.values import filled, month_end_date, parsed_number, percent_as_fraction, repaired_date
from ledgerloom.operators.lookup import lookup
from ledgerloom.operators.project import case_override
from ledgerloom.sinks.tables import store_snapshot
from ledgerloom.sinks.versions import keep_schema, read_snapshots, stored_schema
from ledgerloom.sources.files import LANDING_PATTERN, csv_typed, landing_file

ORGANIZATION_TAKES = {
    "book": "book",
    "account_name": "account_name",
    "specialty_program": "specialty_program",
    "carrier": "carrier",
}
LEADING = ("as_of date", "book string", "account_name string", "specialty_program string", "carrier string", "LOB string")
# Subject -> derived columns that follow the raw ones.
TRAILING = {
    "claims": ("claim_last_updated_date date", "cov_desc string", "cov_desc_detail string"),
    "exposures": ("exposures double",),
    "organization": ("organization_last_updated_date date", "organization_created_date date"),
    "policy": ("sub_producer_commission double",),
    "premium": ("model_year double", "unit_number double", "premium_created_date date"),
}
# Codes that override a looked-up value.
COVERAGE_AS_LOB_POLICY = "EPL/POL"
COVERAGE_AS_LOB_PREMIUM = "Not Selected"
VEHICLE_LOBS = ("AL", "APD")
PROPERTY_LOB = "Property"
PROPERTY_LIMITS = (
    "building_limit",
    "contents_limit",
    "time_element_limit",
    "stock",
    "personal_stock",
    "eq_limit",
    "flood_limit",
)


@dataclass
class References:
    organization: DataFrame
    lob: DataFrame
    cov_desc: DataFrame | None = None
    #: Programs of billing codes that override the looked-up program.
    program_by_billing_code: dict[str, str] = field(default_factory=dict)


def exposure_base(lob: Column) -> Column:
    """Vehicle years for auto, insured limits for property, else the value."""
    days = F.date_diff(F.col("expos_exp_dt"), F.col("expos_eff_dt")).cast("double")
    limits = filled(F.col(PROPERTY_LIMITS[0]))
    for c in PROPERTY_LIMITS[1:]:
        limits = limits + filled(F.col(c))
    return (
        F.when(lob.isin(*VEHICLE_LOBS), days / F.lit(365.0))
        .when(lob == PROPERTY_LOB, limits)
        .otherwise(filled(F.col("value")))
    )


def _with_organization(raw: DataFrame, refs: References) -> DataFrame:
    return lookup(raw, refs.organization, ["organization"], ORGANIZATION_TAKES)


def _with_lob(df: DataFrame, refs: References, coverage: str) -> DataFrame:
    return lookup(df, refs.lob, {coverage: "coverage"}, {"LOB": "LOB"})


def enrich_claims(raw: DataFrame, refs: References) -> DataFrame:
    """Organization, then LOB, then the coverage description of book, LOB, TPA and source coverage."""
    df = _with_lob(_with_organization(raw, refs), refs, "coverage")
    df = lookup(
        df,
        refs.cov_desc,
        ["book", "LOB", "TPA", "descriptors_source_coverage"],
        ["cov_desc", "cov_desc_detail"],
    )
    return df.withColumn("claim_last_updated_date", repaired_date(F.col("claim_last_updated_date_char")))


def enrich_exposures(raw: DataFrame, refs: References) -> DataFrame:
    df = _with_lob(_with_organization(raw, refs), refs, "coverage")
    return df.withColumn("exposures", exposure_base(F.col("LOB")))


def enrich_organization(raw: DataFrame, refs: References | None = None) -> DataFrame:
    return raw.select(
        "*",
        repaired_date(F.col("org_last_updated_date_char")).alias("organization_last_updated_date"),
        repaired_date(F.col("organization_created_date_char")).alias("organization_created_date"),
    )


def enrich_policy(raw: DataFrame, refs: References) -> DataFrame:
    df = _with_lob(_with_organization(raw, refs), refs, "primary_coverage")
    return df.withColumns(
        {
            "specialty_program": case_override(
                F.col("specialty_program"), F.col("billing_code"), refs.program_by_billing_code
            ),
            "LOB": case_override(
                F.col("LOB"), F.col("primary_coverage"), {COVERAGE_AS_LOB_POLICY: F.col("primary_coverage")}
            ),
            "sub_producer_commission": percent_as_fraction(F.col("sub_producer_commission_char")),
        }
    )


def enrich_premium(raw: DataFrame, refs: References) -> DataFrame:
    df = _with_lob(_with_organization(raw, refs), refs, "coverage")
    return df.withColumns(
        {
            "LOB": case_override(F.col("LOB"), F.col("coverage"), {COVERAGE_AS_LOB_PREMIUM: F.col("coverage")}),
            "model_year": parsed_number(F.col("model_year_char")),
            "unit_number": parsed_number(F.col("unit_number_char")),
            "premium_created_date": repaired_date(F.col("premium_created_date_char")),
        }
    )


ENRICHMENTS = {
    "claims": enrich_claims,
    "exposures": enrich_exposures,
    "organization": enrich_organization,
    "policy": enrich_policy,
    "premium": enrich_premium,
}


def target_schema(subject: str, raw: T.StructType) -> T.StructType:
    """Snapshot schema of a subject: leading columns, the raw ones, derived ones."""
    leading = LEADING[:1] if subject == "organization" else LEADING
    ddl = lambda parts: T.StructType.fromDDL(", ".join(parts)).fields
    return T.StructType([*ddl(leading), *raw.fields, *ddl(TRAILING[subject])])


def subject_snapshot(
    subject: str, raw: DataFrame, refs: References | None, as_of: dt.date | Column, target: T.StructType | None = None
) -> DataFrame:
    """One month of a subject, enriched, stamped and in the target's shape."""
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    enriched = ENRICHMENTS[subject](raw, refs).withColumn("as_of", day.cast("date"))
    schema = target or target_schema(subject, raw.schema)
    return schema_gate(align_schema(enriched, schema), schema)


@dataclass
class Ingested:
    """A stored month, and what became of the columns of its file."""

    data: DataFrame
    table: str
    as_of: dt.date
    changes: list[ColumnChange]

    def report(self) -> DataFrame:
        """``as_of, position, name, action, new_type, stored_type`` per column."""
        rows = [(self.as_of, i, c.name, c.action, c.new_type, c.stored_type) for i, c in enumerate(self.changes)]
        return self.data.sparkSession.createDataFrame(
            rows, "as_of date, position int, name string, action string, new_type string, stored_type string"
        )


def ingest_month(
    spark: SparkSession,
    subject: str,
    folder: str,
    metadata: DataFrame,
    refs: References | None,
    table: str,
    reference_date: dt.date,
    months_back: int = 1,
    evolve: bool = False,
    pattern: str = LANDING_PATTERN,
) -> Ingested:
    """Load the landing file of a month into the stored table.

    The month takes the shape of the table (``gated``): its columns are kept, cast, filled
    or dropped, with ``evolve`` also added or widened, and a file that does not fit
    is an error before anything is written.  The first month gives the table its shape.
    """
    as_of = month_end_date(reference_date, months_back)
    path = landing_file(spark, folder, subject, as_of.strftime("%Y%m%d"), pattern=pattern)
    raw = csv_typed(spark, path, schema_from_metadata(metadata))
    target, changes = gated(target_schema(subject, raw.schema), stored_schema(spark, table), evolve)
    snapshot = subject_snapshot(subject, raw, refs, as_of, target)
    # A schema without its month only adds NULL columns to the months before.
    keep_schema(spark, table, target)
    cluster = [c for c in ("book", "carrier", "specialty_program", "organization") if c in snapshot.columns]
    store_snapshot(snapshot, table, cluster_by=cluster)
    return Ingested(read_snapshots(spark, table).where(F.col("as_of") == F.lit(as_of)), table, as_of, changes)


def ingest_subject(*arguments, **options) -> DataFrame:
    """The stored month that ``ingest_month`` loads."""
    return ingest_month(*arguments, **options).data


def append_stored(spark: SparkSession, csv_path: str, table: str) -> DataFrame:
    """Append a CSV file to a table in the schema that the table has; returns the whole table.

    For tables, such as premium triangles, whose columns are described nowhere else.
    Columns are found by name; an unknown or missing one is an error, and without a
    table there is no schema to go by.
    """
    schema = stored_schema(spark, table)
    if schema is None:
        raise FileNotFoundError(table)
    csv_typed(spark, csv_path, schema).write.mode("append").parquet(table)
    return spark.read.schema(schema).parquet(table)
