"""Mapping rules: customers are the source rows, segments and nations the targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import rules as R
from ledgerloom.operators.combine import split_labels
from ledgerloom.operators.sizing import broadcast_if_few, broadcast_if_small
from ledgerloom.plans import rule_jobs as J
from ledgerloom.queries.registry import query, table

# The metadata of two rule sets over the same source: attributes to attributes, keys to keys.
DIMENSIONS = {
    "rule_set": (
        "mapping_rule_set_key bigint, mapping_rule_set_name string, mapping_rule_set_type_id int, "
        "mapping_rule_data_comparison_type_id int, data_provider_key bigint",
        [(1, "SEGMENT_RULES", 1003, 1, 7), (2, "NATION_KEYS", 1001, 2, 8)],
    ),
    "set_assoc": (
        "mapping_rule_set_selection_set_assoc_key bigint, mapping_rule_set_key bigint, selection_set_key bigint, "
        "is_srce_selection_set_flag int",
        [(10, 1, 100, 1), (11, 1, 200, 0), (20, 2, 100, 1), (21, 2, 300, 0)],
    ),
    "selection_set": (
        "selection_set_key bigint, selection_set_name string",
        [(100, "CUSTOMERS"), (200, "SEGMENTS"), (300, "NATIONS")],
    ),
    "set_column": (
        "selection_set_column_key bigint, selection_set_key bigint, selection_set_srce_column_name string, "
        "selection_set_mapping_tool_column_name string, is_selection_set_column_primary_key_flag int",
        [
            (1000, 100, "C_NAME", "C_NAME", 1),
            (1001, 100, "C_MKTSEGMENT", "C_MKTSEGMENT", 0),
            (2000, 200, "SEGMENT", "SEGMENT", 1),
            (2001, 200, "GRADE", "GRADE", 0),
            (3000, 300, "N_NAME", "N_NAME", 1),
            (3001, 300, "N_REGION", "N_REGION", 0),
        ],
    ),
    "column_assoc": (
        "mapping_rule_set_selection_set_column_assoc_key bigint, mapping_rule_set_selection_set_assoc_key bigint, "
        "selection_set_column_key bigint",
        [
            (501, 10, 1000),
            (502, 10, 1001),
            (601, 11, 2000),
            (602, 11, 2001),
            (511, 20, 1000),
            (512, 20, 1001),
            (611, 21, 3000),
            (612, 21, 3001),
        ],
    ),
    "provider": ("data_provider_key bigint, data_provider_code string", [(7, "P7"), (8, "P8")]),
    "rule_set_type": (
        "mapping_rule_set_type_id int, mapping_rule_set_type_name string",
        [(1001, "Key to Key"), (1003, "Attribute to Attribute")],
    ),
    "comparison_type": (
        "mapping_rule_data_comparison_type_id int, mapping_rule_data_comparison_type_name string",
        [(1, "Exact"), (2, "Any case")],
    ),
}


def metadata(spark: SparkSession) -> R.RuleMetadata:
    def dimension(schema: str, rows: list[tuple]) -> DataFrame:
        fields = [f.split() for f in schema.split(",")]
        values = ", ".join(repr(r) for r in rows)
        columns = ", ".join(f"CAST(col{i} AS {kind}) AS {name}" for i, (name, kind) in enumerate(fields, 1))
        return spark.sql(f"SELECT {columns} FROM VALUES {values}")

    return R.RuleMetadata(**{name: dimension(*definition) for name, definition in DIMENSIONS.items()})


SEGMENT_COLUMNS = R.RuleColumns(
    {501: "C_NAME", 502: "C_MKTSEGMENT"}, {601: "trg#11_SEGMENT", 602: "trg#11_GRADE"}
)
NATION_COLUMNS = R.RuleColumns({511: "C_NAME"}, {611: "trg#21_N_NAME"})


def source_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Source selection set; one segment is missing."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey"),
        F.col("c_name").alias("C_NAME"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("C_MKTSEGMENT"),
        "c_acctbal",
        "c_nationkey",
    )


def segment_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Rule set 1 in wide form: one rule per customer, graded only with a positive balance."""
    return source_rows(spark, folder).select(
        F.col("c_custkey").alias(R.GROUP),
        "C_NAME",
        F.coalesce("C_MKTSEGMENT", F.lit("")).alias("C_MKTSEGMENT"),
        F.left("C_MKTSEGMENT", F.lit(4)).alias("trg#11_SEGMENT"),
        F.when(F.col("c_acctbal") > 5000, "HIGH").when(F.col("c_acctbal") > 0, "LOW").alias("trg#11_GRADE"),
    )


def segment_long(spark: SparkSession, folder: str) -> DataFrame:
    return R.unpivot_rules(
        segment_wide(spark, folder),
        {n: i for i, n in SEGMENT_COLUMNS.source.items()},
        {n: i for i, n in SEGMENT_COLUMNS.target.items()},
    ).select(R.GROUP, *[F.col(c).cast("bigint").alias(c) if c.endswith("_key") else F.col(c) for c in LONG[1:]])


LONG = (R.GROUP, R.SOURCE_ID, R.SOURCE_VALUE, R.TARGET_ID, R.TARGET_VALUE)


def nation_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Rule set 2 in wide form: customers to nation keys; nation 30 and up do not exist."""
    return source_rows(spark, folder).select(
        F.col("c_custkey").alias(R.GROUP),
        "C_NAME",
        F.concat(
            F.lit("NATION_"), F.when(F.col("c_acctbal") < 0, F.col("c_nationkey") + 30).otherwise(F.col("c_nationkey")).cast("string")
        ).alias("trg#21_N_NAME"),
    )


def nation_rows(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "region")
    return (
        table(spark, folder, "nation")
        .join(broadcast_if_small(regions), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("N_NAME"), F.col("r_name").alias("N_REGION"))
    )


G, SI, SV, TI, TV = LONG
WIDE_SQL = f"""wide AS (SELECT c_custkey AS {G}, c_name AS "C_NAME", COALESCE(nullif(c_mktsegment, 'BUILDING'), '') AS "C_MKTSEGMENT",
  left(nullif(c_mktsegment, 'BUILDING'), 4) AS segment,
  CASE WHEN c_acctbal > 5000 THEN 'HIGH' WHEN c_acctbal > 0 THEN 'LOW' END AS grade, c_acctbal, c_nationkey FROM customer)"""
LONG_SQL = f"""{WIDE_SQL}, long AS (
  SELECT {G}, CAST(501 AS BIGINT) AS {SI}, "C_NAME" AS {SV}, CAST(601 AS BIGINT) AS {TI}, segment AS {TV} FROM wide
  UNION ALL SELECT {G}, 501, "C_NAME", 602, grade FROM wide
  UNION ALL SELECT {G}, 502, "C_MKTSEGMENT", 601, segment FROM wide
  UNION ALL SELECT {G}, 502, "C_MKTSEGMENT", 602, grade FROM wide)"""
NATION_SQL = f"""nation_rules AS (SELECT c_custkey AS {G}, c_name AS "C_NAME",
  'NATION_' || CASE WHEN c_acctbal < 0 THEN c_nationkey + 30 ELSE c_nationkey END AS n_name FROM customer)"""


@query("unpivot_rules", f"WITH {LONG_SQL} SELECT {', '.join(LONG)} FROM long")
def unpivot_rules(spark: SparkSession, folder: str) -> DataFrame:
    return segment_long(spark, folder)


@query(
    "pivot_rules",
    f"""WITH {WIDE_SQL} SELECT {G}, "C_NAME", "C_MKTSEGMENT", segment AS "trg#11_SEGMENT", grade AS "trg#11_GRADE" FROM wide""",
)
def pivot_rules(spark: SparkSession, folder: str) -> DataFrame:
    columns = R.rule_columns(metadata(spark), 1)
    return R.pivot_rules(segment_long(spark, folder), columns.source, columns.target)


def both_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Long rows of both rule sets in one table."""
    keys = R.unpivot_rules(nation_wide(spark, folder), {"C_NAME": 511}, {"trg#21_N_NAME": 611})
    return segment_long(spark, folder).unionByName(keys.select(*segment_long(spark, folder).columns))


BOTH_SQL = f"""{LONG_SQL}, {NATION_SQL}, both_sets AS (SELECT * FROM long
  UNION ALL SELECT {G}, 511, "C_NAME", 611, n_name FROM nation_rules)"""


@query(
    "role_columns",
    f"""WITH {BOTH_SQL} SELECT 'CUSTOMERS' AS set_name, 'C_NAME' AS column_name, count(*) AS rule_rows FROM both_sets WHERE {SI} = 511
UNION ALL SELECT 'NATIONS', 'N_NAME', count(*) FROM both_sets WHERE {TI} = 611""",
)
def role_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Rule rows per column that takes part in the key-to-key set: key columns only."""
    meta, rules = metadata(spark), both_sets(spark, folder)
    key = "mapping_rule_set_selection_set_column_assoc_key"

    def used(is_source: bool, rule_id: str) -> DataFrame:
        columns = R.role_columns(meta, 2, is_source)
        return (
            rules.join(broadcast_if_few(columns.withColumnRenamed(key, rule_id), R.MAX_RULE_COLUMNS), rule_id)
            .groupBy(
                F.col("selection_set_name").alias("set_name"),
                F.col("selection_set_srce_column_name").alias("column_name"),
            )
            .agg(F.count(F.lit(1)).alias("rule_rows"))
        )

    return used(True, R.SOURCE_ID).unionByName(used(False, R.TARGET_ID))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Long rows with ``SET/COLUMN`` labels instead of ids."""
    return R.unpivot_rules(
        segment_wide(spark, folder),
        {"C_NAME": "CUSTOMERS/C_NAME", "C_MKTSEGMENT": "CUSTOMERS/C_MKTSEGMENT"},
        {"trg#11_SEGMENT": "SEGMENTS/SEGMENT", "trg#11_GRADE": "SEGMENTS/GRADE/NOTE"},
    )


@query(
    "split_labels",
    f"""WITH {LONG_SQL} SELECT {G}, 'CUSTOMERS' AS srce_set, CASE {SI} WHEN 501 THEN 'C_NAME' ELSE 'C_MKTSEGMENT' END AS srce_column,
'SEGMENTS' AS trgt_set, CASE {TI} WHEN 601 THEN 'SEGMENT' ELSE 'GRADE/NOTE' END AS trgt_column, {TV} FROM long""",
)
def split_labels_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = split_labels(labelled(spark, folder), R.SOURCE_ID, "srce_set", "srce_column")
    rows = split_labels(rows, R.TARGET_ID, "trgt_set", "trgt_column")
    return rows.select(R.GROUP, "srce_set", "srce_column", "trgt_set", "trgt_column", R.TARGET_VALUE)


@query(
    "resolve_ids",
    f"WITH {LONG_SQL} SELECT {G}, {SI}, {SV}, {TI}, {TV} FROM long WHERE {TI} = 601",
)
def resolve_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Names to ids for several targets; a column the metadata lacks drops out."""
    meta = metadata(spark)
    rows = split_labels(labelled(spark, folder), R.SOURCE_ID, "srce_set", "srce_column")
    rows = split_labels(rows, R.TARGET_ID, "trgt_set", "trgt_column").drop(R.SOURCE_ID, R.TARGET_ID, "srce_set")
    name, key = "selection_set_srce_column_name", "mapping_rule_set_selection_set_column_assoc_key"
    rows = R.resolve_ids(rows, R.role_columns(meta, 1, True), {"srce_column": name}, {key: R.SOURCE_ID})
    return R.resolve_ids(
        rows, R.role_columns(meta, 1, False), {"trgt_set": "selection_set_name", "trgt_column": name}, {key: R.TARGET_ID}
    )


@query("semi_scope", f"WITH {BOTH_SQL} SELECT {', '.join(LONG)} FROM both_sets WHERE {SI} = 511")
def semi_scope(spark: SparkSession, folder: str) -> DataFrame:
    return R.scoped_rules(both_sets(spark, folder), metadata(spark), 2)


@query(
    "star_publish",
    f"""WITH {LONG_SQL} SELECT {G}, {SV}, {TV},
CAST(CASE {SI} WHEN 501 THEN 1000 ELSE 1001 END AS BIGINT) AS srce_selection_set_column_key,
CAST(CASE {TI} WHEN 601 THEN 2000 ELSE 2001 END AS BIGINT) AS trgt_selection_set_column_key,
CAST(10 AS BIGINT) AS mapping_rule_set_srce_selection_set_key, CAST(11 AS BIGINT) AS mapping_rule_set_trgt_selection_set_key,
'CUSTOMERS' AS srce_selection_set_name, 'SEGMENTS' AS trgt_selection_set_name,
CASE {SI} WHEN 501 THEN 'C_NAME' ELSE 'C_MKTSEGMENT' END AS srce_selection_set_mapping_tool_column_name,
CASE {TI} WHEN 601 THEN 'SEGMENT' ELSE 'GRADE' END AS trgt_selection_set_mapping_tool_column_name,
CASE {SI} WHEN 501 THEN 'C_NAME' ELSE 'C_MKTSEGMENT' END AS srce_selection_set_srce_column_name,
CASE {TI} WHEN 601 THEN 'SEGMENT' ELSE 'GRADE' END AS trgt_selection_set_srce_column_name,
'SEGMENT_RULES' AS mapping_rule_set_name, CAST(1 AS BIGINT) AS mapping_rule_set_key,
'Attribute to Attribute' AS mapping_rule_set_type_name, 'Exact' AS mapping_rule_data_comparison_type_name,
CAST(7 AS BIGINT) AS data_provider_key, 'P7' AS data_provider_code FROM long""",
)
def star_publish(spark: SparkSession, folder: str) -> DataFrame:
    return J.published_rules(both_sets(spark, folder), metadata(spark), 1)


@query(
    "rules_full_outer",
    f"""WITH {WIDE_SQL}, data AS (SELECT "C_NAME", "C_MKTSEGMENT", c_acctbal FROM wide WHERE c_acctbal > 1000),
rules AS (SELECT {G}, "C_NAME", "C_MKTSEGMENT", COALESCE(segment, '') AS segment FROM wide WHERE c_nationkey < 15)
SELECT COALESCE(d."C_NAME", r."C_NAME") AS "C_NAME", COALESCE(d."C_MKTSEGMENT", r."C_MKTSEGMENT") AS "C_MKTSEGMENT",
c_acctbal, {G}, segment AS "trg#11_SEGMENT"
FROM data d FULL OUTER JOIN rules r ON d."C_NAME" = r."C_NAME" AND d."C_MKTSEGMENT" = r."C_MKTSEGMENT" """,
)
def rules_full_outer(spark: SparkSession, folder: str) -> DataFrame:
    data = source_rows(spark, folder).where("c_acctbal > 1000").select("C_NAME", "C_MKTSEGMENT", "c_acctbal")
    rules = source_rows(spark, folder).where("c_nationkey < 15").select(
        F.col("c_custkey").alias(R.GROUP), "C_NAME", "C_MKTSEGMENT", F.left("C_MKTSEGMENT", F.lit(4)).alias("trg#11_SEGMENT")
    )
    return R.rules_full_outer(data, rules, ["C_NAME", "C_MKTSEGMENT"])


@query(
    "target_attr_right_join",
    f"""WITH {NATION_SQL} SELECT {G}, "C_NAME", r.n_name AS "trg#21_N_NAME", r_name AS "trg#21_N_REGION"
FROM (nation JOIN region ON n_regionkey = r_regionkey) t RIGHT JOIN nation_rules r ON t.n_name = r.n_name""",
)
def target_attr_right_join(spark: SparkSession, folder: str) -> DataFrame:
    return R.with_target_attributes(nation_wide(spark, folder), 21, nation_rows(spark, folder))


@query(
    "missing_rules",
    f"""WITH {WIDE_SQL} SELECT {G}, "C_NAME", "C_MKTSEGMENT", COALESCE(segment, '') AS "trg#11_SEGMENT", COALESCE(grade, '') AS "trg#11_GRADE"
FROM wide r WHERE NOT EXISTS (SELECT 1 FROM customer d WHERE c_acctbal > 0
  AND d.c_name IS NOT DISTINCT FROM r."C_NAME" AND COALESCE(nullif(d.c_mktsegment, 'BUILDING'), '') IS NOT DISTINCT FROM r."C_MKTSEGMENT")""",
)
def missing_rules(spark: SparkSession, folder: str) -> DataFrame:
    data = source_rows(spark, folder).where("c_acctbal > 0")
    return R.missing_rules(segment_wide(spark, folder), data, ["C_NAME", "C_MKTSEGMENT"])


FLAGGED = (*LONG, R.MISSING_SOURCE, R.MISSING_TARGET)


def flagged_long(spark: SparkSession, folder: str) -> DataFrame:
    return segment_long(spark, folder).withColumns(
        {R.MISSING_SOURCE: F.lit(1).cast("bigint"), R.MISSING_TARGET: F.lit(0).cast("bigint")}
    )


@query(
    "flag_missing",
    f"""WITH {LONG_SQL} SELECT {', '.join(LONG)}, CASE WHEN c_acctbal > 0 THEN CAST(0 AS BIGINT) ELSE 1 END AS {R.MISSING_SOURCE},
CAST(0 AS BIGINT) AS {R.MISSING_TARGET} FROM long JOIN customer ON {G} = c_custkey""",
)
def flag_missing(spark: SparkSession, folder: str) -> DataFrame:
    data = source_rows(spark, folder).where("c_acctbal > 0")
    gone = R.missing_rules(segment_wide(spark, folder), data, ["C_NAME", "C_MKTSEGMENT"])
    flagged = R.flag_missing(flagged_long(spark, folder), R.MISSING_SOURCE, gone)
    return flagged.withColumn(R.MISSING_SOURCE, F.col(R.MISSING_SOURCE).cast("bigint"))


def segment_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Target rows that still exist: one segment has lost its ungraded row."""
    return (
        segment_wide(spark, folder)
        .select(F.col("trg#11_SEGMENT").alias("SEGMENT"), F.col("trg#11_GRADE").alias("GRADE"))
        .where("NOT (SEGMENT <=> 'MACH' AND GRADE IS NULL)")
        .distinct()
    )


VALIDATED_SQL = f"""{LONG_SQL}, checked AS (SELECT {G} AS id, CASE WHEN c_acctbal > 0 THEN 0 ELSE 1 END AS no_source,
  CASE WHEN segment = 'MACH' AND grade IS NULL THEN 1 ELSE 0 END AS no_target FROM wide)"""


@query(
    "validate_rules",
    f"""WITH {VALIDATED_SQL} SELECT {', '.join(LONG)}, CAST(no_source AS BIGINT) AS {R.MISSING_SOURCE},
CAST(no_target AS BIGINT) AS {R.MISSING_TARGET} FROM long JOIN checked ON {G} = id""",
)
def validate_rules(spark: SparkSession, folder: str) -> DataFrame:
    flagged = validation(spark, folder).rules
    return flagged.select(*LONG, *[F.col(c).cast("bigint").alias(c) for c in FLAGGED[5:]])


@query(
    "validation_findings",
    f"""WITH {VALIDATED_SQL} SELECT CAST(0 AS BIGINT) AS position, 'source' AS scope, CAST(sum(no_source) AS BIGINT) AS missing_rules FROM checked
UNION ALL SELECT 1, 'target 1', CAST(sum(no_target) AS BIGINT) FROM checked""",
)
def validation_findings(spark: SparkSession, folder: str) -> DataFrame:
    found = validation(spark, folder).findings
    return found.withColumn("position", F.col("position").cast("bigint"))


def validation(spark: SparkSession, folder: str) -> J.Validation:
    source = source_rows(spark, folder).where("c_acctbal > 0").select("C_NAME", "C_MKTSEGMENT")
    return J.validate_rules(
        flagged_long(spark, folder),
        SEGMENT_COLUMNS,
        source,
        {"11": segment_targets(spark, folder)},
        "Attribute to Attribute",
    )


# --- rules by expression: part rows get a size class --------------------------------

SIZE_EXPRESSION = "CASE WHEN P_SIZE > 25 THEN 'BIG' WHEN P_SIZE > 5 THEN 'MID' END"
SIZE_COLUMNS = R.RuleColumns({701: "P_NAME", 702: "P_SIZE", 703: "P_KEY"}, {801: "trg#31_SIZE_CLASS"})


def part_source(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_name").alias("P_NAME"), F.col("p_size").alias("P_SIZE"), F.col("p_partkey").cast("string").alias("P_KEY")
    )


def current_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Rules that exist: the cheaper parts, the cheapest of them with an outdated class."""
    return table(spark, folder, "part").where("p_retailprice < 1000 AND p_size > 5").select(
        F.col("p_partkey").alias(R.GROUP),
        F.col("p_name").alias("P_NAME"),
        F.col("p_size").cast("string").alias("P_SIZE"),
        F.col("p_partkey").cast("string").alias("P_KEY"),
        F.when(F.col("p_retailprice") < 950, F.lit("OLD"))
        .when(F.col("p_size") > 25, F.lit("BIG"))
        .otherwise(F.lit("MID"))
        .alias("trg#31_SIZE_CLASS"),
    )


SIZE_SQL = f"""source AS (SELECT p_name AS "P_NAME", CAST(p_size AS VARCHAR) AS "P_SIZE", CAST(p_partkey AS VARCHAR) AS "P_KEY",
    CASE WHEN p_size > 25 THEN 'BIG' ELSE 'MID' END AS new_class, p_partkey, p_retailprice FROM part WHERE p_size > 5),
current AS (SELECT p_partkey AS old_id, CASE WHEN p_retailprice < 950 THEN 'OLD' ELSE new_class END AS old_class
    FROM source WHERE p_retailprice < 1000),
changed AS (SELECT s.*, old_id FROM source s LEFT JOIN current ON p_partkey = old_id WHERE old_class IS DISTINCT FROM new_class),
numbered AS (SELECT "P_NAME", "P_SIZE", "P_KEY", new_class, CASE WHEN old_id IS NOT NULL THEN old_id
    ELSE (SELECT max(old_id) FROM current) + CAST(row_number() OVER (PARTITION BY old_id IS NULL ORDER BY "P_NAME", "P_SIZE", "P_KEY") AS BIGINT) END AS {G} FROM changed)"""


@query(
    "changed_rows",
    f"""WITH {SIZE_SQL} SELECT "P_NAME", "P_SIZE", "P_KEY", new_class AS "trg#31_SIZE_CLASS", old_id AS {G} FROM changed""",
)
def changed_rows(spark: SparkSession, folder: str) -> DataFrame:
    new = part_source(spark, folder).withColumn("trg#31_SIZE_CLASS", F.expr(SIZE_EXPRESSION)).where("`trg#31_SIZE_CLASS` IS NOT NULL")
    new = new.withColumn("P_SIZE", F.col("P_SIZE").cast("string"))
    return R.changed_rows(new, current_wide(spark, folder), ["P_NAME", "P_SIZE", "P_KEY"], "trg#31_SIZE_CLASS")


@query("assign_group_ids", f"""WITH {SIZE_SQL} SELECT "P_NAME", "P_SIZE", "P_KEY", new_class AS "trg#31_SIZE_CLASS", {G} FROM numbered""")
def assign_group_ids(spark: SparkSession, folder: str) -> DataFrame:
    largest = R.largest_group_id(current_wide(spark, folder))
    return R.assign_group_ids(changed_rows(spark, folder), ["P_NAME", "P_SIZE", "P_KEY"], largest)


EXPRESSION_LONG_SQL = " UNION ALL ".join(
    f'SELECT {G}, CAST({i} AS BIGINT) AS {SI}, "{c}" AS {SV}, CAST(801 AS BIGINT) AS {TI}, new_class AS {TV} FROM numbered'
    for i, c in SIZE_COLUMNS.source.items()
)


def as_long(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c).cast("bigint").alias(c) if c in (R.GROUP, R.SOURCE_ID, R.TARGET_ID) else F.col(c) for c in LONG])


def current_long(spark: SparkSession, folder: str) -> DataFrame:
    return as_long(
        R.unpivot_rules(
            current_wide(spark, folder), {n: i for i, n in SIZE_COLUMNS.source.items()}, {"trg#31_SIZE_CLASS": 801}
        )
    )


@query("expression_rules", f"WITH {SIZE_SQL} {EXPRESSION_LONG_SQL}")
def expression_rules(spark: SparkSession, folder: str) -> DataFrame:
    """EDIT: long rows of the rules the expression adds or changes."""
    return as_long(
        J.expression_changes(part_source(spark, folder), SIZE_EXPRESSION, SIZE_COLUMNS, current_long(spark, folder))
    )


RULE_TABLE = (*LONG, R.MISSING_SOURCE, R.MISSING_TARGET, "curr_ind", "end_date", "created_by", "updated_by")


def size_rule_table(spark: SparkSession, folder: str) -> DataFrame:
    return current_long(spark, folder).select(
        "*",
        F.lit(0).cast("bigint").alias(R.MISSING_SOURCE),
        F.lit(0).cast("bigint").alias(R.MISSING_TARGET),
        F.lit("Y").alias("curr_ind"),
        F.lit("9999-12-31 00:00:00").cast("timestamp_ntz").alias("end_date"),
        F.lit("first").alias("created_by"),
        F.lit("first").alias("updated_by"),
    )


def shown(rules: DataFrame) -> DataFrame:
    return rules.select(*[F.col(c).cast("string").alias(c) if c == "end_date" else F.col(c) for c in RULE_TABLE])


BOOK_SQL = f"""CAST(0 AS BIGINT) AS {R.MISSING_SOURCE}, CAST(0 AS BIGINT) AS {R.MISSING_TARGET}, 'Y' AS curr_ind, '9999-12-31 00:00:00' AS end_date"""
CURRENT_LONG_SQL = " UNION ALL ".join(
    f'SELECT old_id AS {G}, CAST({i} AS BIGINT) AS {SI}, "{c}" AS {SV}, CAST(801 AS BIGINT) AS {TI}, old_class AS {TV} FROM current JOIN source ON old_id = p_partkey'
    for i, c in SIZE_COLUMNS.source.items()
)


@query(
    "expression_edit",
    f"""WITH {SIZE_SQL}, new_rows AS ({EXPRESSION_LONG_SQL}), old_rows AS ({CURRENT_LONG_SQL})
SELECT COALESCE(o.{G}, n.{G}) AS {G}, COALESCE(o.{SI}, n.{SI}) AS {SI}, COALESCE(o.{SV}, n.{SV}) AS {SV}, COALESCE(o.{TI}, n.{TI}) AS {TI},
COALESCE(n.{TV}, o.{TV}) AS {TV}, {BOOK_SQL}, CASE WHEN o.{G} IS NULL THEN 'editor' ELSE 'first' END AS created_by,
CASE WHEN n.{G} IS NULL THEN 'first' ELSE 'editor' END AS updated_by
FROM old_rows o FULL JOIN new_rows n ON o.{G} = n.{G} AND o.{SI} = n.{SI} AND o.{TI} = n.{TI} AND o.{SV} = n.{SV}""",
)
def expression_edit(spark: SparkSession, folder: str) -> DataFrame:
    """The rule table after EDIT: changed rules updated, new ones inserted."""
    return shown(
        J.rules_by_expression(
            size_rule_table(spark, folder), part_source(spark, folder), SIZE_EXPRESSION, SIZE_COLUMNS, "editor", "EDIT"
        )
    )


@query(
    "expression_save",
    f"""WITH {SIZE_SQL.replace("numbered AS", "unused AS")}, numbered AS (SELECT "P_NAME", "P_SIZE", "P_KEY", new_class,
  CAST(row_number() OVER (ORDER BY "P_NAME", "P_SIZE", "P_KEY") AS BIGINT) - 1 AS {G} FROM source), new_rows AS ({EXPRESSION_LONG_SQL})
SELECT *, {BOOK_SQL}, 'editor' AS created_by, 'editor' AS updated_by FROM new_rows""",
)
def expression_save(spark: SparkSession, folder: str) -> DataFrame:
    """The rule table after SAVE: the set is replaced."""
    return shown(
        J.rules_by_expression(
            size_rule_table(spark, folder), part_source(spark, folder), SIZE_EXPRESSION, SIZE_COLUMNS, "editor", "SAVE"
        )
    )


@query(
    "expression_preview",
    """SELECT p_name AS "P_NAME", CAST(p_size AS VARCHAR) AS "P_SIZE", CAST(p_partkey AS VARCHAR) AS "P_KEY",
CASE WHEN p_size > 25 THEN 'BIG' WHEN p_size > 5 THEN 'MID' END AS "SIZE_CLASS" FROM part ORDER BY 1, 2, 3 LIMIT 5000""",
)
def expression_preview(spark: SparkSession, folder: str) -> DataFrame:
    return J.preview_expression(part_source(spark, folder), SIZE_EXPRESSION, "SIZE_CLASS")
