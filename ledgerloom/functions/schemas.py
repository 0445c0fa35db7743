"""Schemas from metadata rows or from a target table, and the checks around them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.headers import quoted

# A table definition is a handful to a few hundred rows; more is a wrong input.
MAX_METADATA_ROWS = 10_000

# Database type name -> Spark type.
SQL_TYPES: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "tinyint": T.ByteType(),
    "bit": T.BooleanType(),
    "money": T.DecimalType(19, 4),
    "smallmoney": T.DecimalType(10, 4),
    "float": T.DoubleType(),
    "real": T.FloatType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "datetime2": T.TimestampType(),
    "smalldatetime": T.TimestampType(),
    "binary": T.BinaryType(),
    "varbinary": T.BinaryType(),
    "image": T.BinaryType(),
    "rowversion": T.BinaryType(),
    "timestamp": T.BinaryType(),
}

# Columns of the reference tables every job looks up or loads.
REFERENCE_TABLES = {
    "ref_organization": "organization string, book string, account_name string, "
    "specialty_program string, carrier string",
    "ref_lob": "coverage string, LOB string",
    "ref_cov_desc": "book string, LOB string, TPA string, descriptors_source_coverage string, "
    "cov_desc string, cov_desc_detail string",
    "ref_marketing_plan": "marketing_plan_code string, marketing_plan string",
    "xref_marketing_plan_to_organization": "marketing_plan_code string, marketing_plan string, "
    "organization string",
    "ref_class_code": "LOB string, class_code string, class_code_desc string, auto_size_class string, "
    "auto_size_class_type string, auto_size_class_weight string, auto_business_use_class string, "
    "auto_radius_class string, auto_fleet string, auto_classification string, "
    "auto_subclassification string, auto_type string, auto_subtype string",
    "ref_claims_patch": "LOB string, Claim_Number bigint, Claimant_Sequence int, Party_Update string, "
    "Coverage_Code_Detail string, Claim_Type string, ref_claim_number string",
    "claims_dh": "as_of date, public_entity string, member_name string, claim_number string, "
    "case_type string, descriptors_source_policy_number string, "
    "descriptors_source_policy_period string, insured_name string, policy_year smallint, "
    "pol_eff_dt date, pol_exp_dt date, policy_number string",
    "claims_qualynx": "as_of date, public_entity string, member_name string, policy_number string, "
    "descriptors_source_policy_number string, insured_name string",
}


def spark_type(data_type: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """Spark type of a database column; unknown types are text."""
    name = data_type.strip().lower()
    if name in ("decimal", "numeric"):
        return T.DecimalType(38 if precision is None else int(precision), 0 if scale is None else int(scale))
    return SQL_TYPES.get(name, T.StringType())


def schema_from_metadata(metadata: DataFrame) -> T.StructType:
    """Schema from INFORMATION_SCHEMA-like rows, in ordinal order when it is given."""
    if "ORDINAL_POSITION" in metadata.columns:
        metadata = metadata.orderBy("ORDINAL_POSITION")
    rows = metadata.limit(MAX_METADATA_ROWS + 1).collect()
    if len(rows) > MAX_METADATA_ROWS:
        raise ValueError(f"more than {MAX_METADATA_ROWS} metadata rows: not one table definition")
    return T.StructType(
        [
            T.StructField(
                r["COLUMN_NAME"],
                spark_type(r["DATA_TYPE"], r["NUMERIC_PRECISION"], r["NUMERIC_SCALE"]),
                r["IS_NULLABLE"] == "YES",
            )
            for r in rows
        ]
    )


@dataclass
class Alignment:
    """What an alignment kept, left out and filled."""

    data: DataFrame
    dropped: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)


def align(df: DataFrame, target: T.StructType | DataFrame) -> Alignment:
    """Target columns in target order and type: cast shared ones, NULL for missing ones."""
    schema = target.schema if isinstance(target, DataFrame) else target
    present = {c.lower(): c for c in df.columns}
    out, missing = [], []
    for f in schema.fields:
        source = present.pop(f.name.lower(), None)
        if source is None:
            missing.append(f.name)
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            out.append(F.col(quoted(source)).try_cast(f.dataType).alias(f.name))
    return Alignment(df.select(*out), sorted(present.values()), missing)


def align_schema(df: DataFrame, target: T.StructType | DataFrame) -> DataFrame:
    return align(df, target).data


class SchemaMismatch(ValueError):
    """Columns or types differ from what the target needs."""


def schema_gate(df: DataFrame, target: T.StructType | DataFrame) -> DataFrame:
    """``df`` itself when names, order and types equal the target's, else an error."""
    schema = target.schema if isinstance(target, DataFrame) else target
    have = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    if have != want:
        raise SchemaMismatch(
            f"unexpected {[x for x in have if x not in want]}, lacking {[x for x in want if x not in have]}"
        )
    return df


_INTEGERS = ("tinyint", "smallint", "int", "bigint")
#: Digits of the integer types.
_DIGITS = dict(zip(_INTEGERS, (3, 5, 10, 19), strict=True))


def holds(wide: T.DataType, narrow: T.DataType) -> bool:
    """Whether every value of one type is one of the other, and files of the narrow type can be read as the wide one."""
    a, b = narrow.simpleString(), wide.simpleString()
    if a == b:
        return True
    if a in _DIGITS and b in _DIGITS:
        return _DIGITS[a] < _DIGITS[b]
    if isinstance(wide, T.DecimalType):
        whole = wide.precision - wide.scale
        if isinstance(narrow, T.DecimalType):
            return whole >= narrow.precision - narrow.scale and wide.scale >= narrow.scale
        return a in _DIGITS and whole >= _DIGITS[a]
    return b == "double" and a in ("float", "tinyint", "smallint", "int")


@dataclass(frozen=True)
class ColumnChange:
    """What happens to a column when rows of a new shape meet a stored table."""

    name: str
    #: kept, cast (to the stored type), widened (the stored type), filled (with NULL), added or dropped.
    action: str
    new_type: str | None
    stored_type: str | None


def gated(new: T.StructType, stored: T.StructType | None, evolve: bool = False) -> tuple[T.StructType, list[ColumnChange]]:
    """The shape in which rows enter a stored table, and what becomes of each column.

    Names compare without case; the stored ones and their order stay.  A type that the
    stored one holds, or any if that is text, is cast to it.  With ``evolve`` a wider type
    widens the stored one and a new column is added at the end; without, a new column is
    dropped.  A column whose type fits in neither way is an error.
    """
    if stored is None:
        return new, [ColumnChange(f.name, "added", f.dataType.simpleString(), None) for f in new.fields]
    fresh = {f.name.lower(): f for f in new.fields}
    target, changes, unfit = [], [], []
    for old in stored.fields:
        f = fresh.pop(old.name.lower(), None)
        have = old.dataType.simpleString()
        want = None if f is None else f.dataType.simpleString()
        kind, action = old.dataType, "kept"
        if f is None:
            action = "filled"
        elif want != have:
            if isinstance(old.dataType, T.StringType) or holds(old.dataType, f.dataType):
                action = "cast"
            elif evolve and holds(f.dataType, old.dataType):
                kind, action = f.dataType, "widened"
            else:
                unfit.append(f"{old.name}: {want} for {have}")
        target.append(T.StructField(old.name, kind))
        changes.append(ColumnChange(old.name, action, want, have))
    for f in new.fields:
        if f.name.lower() in fresh:
            changes.append(ColumnChange(f.name, "added" if evolve else "dropped", f.dataType.simpleString(), None))
            if evolve:
                target.append(T.StructField(f.name, f.dataType))
    if unfit:
        raise SchemaMismatch(f"columns that do not fit the stored table: {', '.join(unfit)}")
    return T.StructType(target), changes


def column_mismatch(data: Iterable[str], definition: Iterable[str], role: str) -> str | None:
    """Why the data columns do not fit the rule columns, or None.

    Attribute: both sets are the same.  Key: the rule columns occur in the data.
    """
    have, want = set(data), set(definition)
    if role == "Attribute":
        fits = have == want
    elif role == "Key":
        fits = want <= have
    else:
        return f"Unknown option: {role}"
    if fits:
        return None
    return f"columns don't match, data has: {sorted(have)}, mapping definition has: {sorted(want)}"


def describe_columns(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullable."""
    bad = [c for c in df.columns if "," in c]
    if bad:
        raise SchemaMismatch(f"Comma in column name not supported: {bad[0]}")
    rows = [(i, f.name.upper(), f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, type string, nullable boolean"
    )


def empty_frame(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)
