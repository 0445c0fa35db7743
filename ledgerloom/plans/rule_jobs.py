"""Jobs over mapping rules: page, validate, generate, import, export, publish."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.headers import quoted
from ledgerloom.functions.schemas import SchemaMismatch, column_mismatch
from ledgerloom.functions.values import OPEN_END_DATE, blank_for_null, stringified
from ledgerloom.operators import rules as R
from ledgerloom.operators.mutate import replace_group, upsert
from ledgerloom.operators.numbering import first_rows, order_columns, paginate
from ledgerloom.operators.pages import keep_order
from ledgerloom.operators.project import any_present, expression_column, filter_where, given
from ledgerloom.operators.sizing import broadcast_if_small
from ledgerloom.plans.status import JobResult
from ledgerloom.session import scratch_root
from ledgerloom.sinks.tables import export_csv, overwrite_partitions
from ledgerloom.sources.records import csv_lines, csv_records, parsed, plain_path, split_size

PREVIEW_ROWS = 5_000
BOOKKEEPING = (R.GROUP, R.MISSING_SOURCE, R.MISSING_TARGET, "updated_by")


# --- page and export ----------------------------------------------------------


def rule_view(
    source: DataFrame,
    rules: DataFrame,
    keys: Sequence[str],
    mapping_type: str,
    targets: Mapping[str, DataFrame],
    conditions: str | None = None,
) -> DataFrame:
    """Distinct source rows with their rules, filtered, with target attributes for key targets.

    Blanks stand for NULL, and both sides are then made distinct before the join, where copies cost least; the
    joined rows are then distinct too, because they hold both sides whole.
    """
    joined = filter_where(R.rules_full_outer(blank_for_null(source).distinct(), blank_for_null(rules).distinct(), keys), conditions)
    return _with_targets(joined, mapping_type, targets)


def _with_targets(df: DataFrame, mapping_type: str, targets: Mapping[str, DataFrame]) -> DataFrame:
    if R.mapping_roles(mapping_type)[1] == "Key":
        for target, data in targets.items():
            df = R.with_target_attributes(df, target, data)
    return df


def rule_page(view: DataFrame, start: int, size: int, sort_order: str | None = None) -> DataFrame:
    """One page; without a sort order the first column leads."""
    return paginate(view, start, size, sort_order if given(sort_order) else None)


def keep_rule_pages(view: DataFrame, path: str, sort_order: str | None = None) -> int:
    """Sort a view once for many pages (``pages.page``); its number of rows."""
    return keep_order(view, path, sort_order if given(sort_order) else None)


def rows_to_json(df: DataFrame) -> DataFrame:
    """Each row as JSON text with sorted keys: blank for NULL text, no entry for other NULLs."""
    filled = blank_for_null(df)
    return filled.select(F.to_json(F.struct(*[F.col(quoted(c)) for c in sorted(filled.columns)])).alias("json"))


@dataclass
class ExportHeader:
    """Role, set name and column name above each exported column."""

    column: str
    role: str
    set_name: str
    name: str

    @property
    def flat(self) -> str:
        return f"{self.role}#{self.set_name}#{self.name}"


def export_rules(
    source: DataFrame,
    rules: DataFrame,
    keys: Sequence[str],
    mapping_type: str,
    targets: Mapping[str, DataFrame],
    headers: Sequence[ExportHeader],
    conditions: str | None = None,
    sort_order: str | None = None,
) -> DataFrame:
    """Mapped and unmapped rows under flat ``role#set#column`` names, sources first."""
    joined = filter_where(R.rules_full_outer(source, rules, keys), conditions).drop(*BOOKKEEPING)
    full = _with_targets(joined, mapping_type, targets)
    if given(sort_order):
        full = full.orderBy(*order_columns(full, sort_order))
    return full.select(*[F.col(quoted(h.column)).alias(h.flat) for h in headers])


def export_targets(targets: Mapping[str, DataFrame], folder: str, rows: int | None = None) -> dict[str, str]:
    """The distinct rows of each target (the first ones, if a number is asked for), one CSV directory per target."""
    paths = {}
    for name, data in targets.items():
        paths[name] = f"{folder.rstrip('/')}/{name.replace(' ', '_')}"
        if rows is None:
            export_csv(data.distinct(), paths[name])
        else:
            export_csv(first_rows(data.distinct(), rows, data.columns), paths[name], single_file=True)
    return paths


# --- validation -----------------------------------------------------------------


@dataclass
class Validation:
    """Rules with fresh missing flags, and what was found."""

    rules: DataFrame
    findings: DataFrame
    problems: Sequence[str] = ()

    def status(self) -> JobResult:
        if self.problems:
            return JobResult("INVALID", self.problems[0])
        first = self.findings.where(F.col("missing_rules") > 0).orderBy("position").first()
        return JobResult("VALID") if first is None else JobResult("INVALID", f"Missing rows in {first['scope']}")


def validate_rules(
    long: DataFrame,
    columns: R.RuleColumns,
    source: DataFrame,
    targets: Mapping[str, DataFrame],
    mapping_type: str,
) -> Validation:
    """Check the rules of a set against source and targets and set their flags.

    All targets are checked, and flags go back to 0 where nothing is missing.
    Where the columns themselves do not fit, every rule counts as missing on
    that side and the values are not looked at.
    """
    source_role, target_role = R.mapping_roles(mapping_type)
    wide = R.pivot_rules(long, columns.source, columns.target)
    names = R.columns_by_target(wide.columns)
    checks = {("source", R.MISSING_SOURCE): column_mismatch(source.columns, names["src"], source_role)}
    for i, (target, data) in enumerate(targets.items(), 1):
        mismatch = column_mismatch(data.columns, names.get(str(target), []), target_role)
        checks[(f"target {i}", R.MISSING_TARGET)] = mismatch
    unfit = {place: text for place, text in checks.items() if text}
    if unfit:
        return _unfit(long, unfit)

    # One pass: the pivoted rules meet source and targets in turn, each reduced to distinct keys.
    found = R.with_presence(wide, source, names["src"], "__in_source")
    gone = {"source": ~F.col("__in_source")}
    for i, (target, data) in enumerate(targets.items(), 1):
        keys = [c for c in wide.columns if (R.target_of(c) or ("", ""))[0] == str(target)]
        found = R.with_presence(found, R.with_target_prefix(data, target), keys, f"__in_target{i}")
        gone[f"target {i}"] = any_present(keys) & ~F.col(f"__in_target{i}")
    target_gone = reduce(Column.__or__, [c for scope, c in gone.items() if scope != "source"], F.lit(False))
    flags = found.select(
        R.GROUP,
        gone["source"].cast("int").alias(R.MISSING_SOURCE),
        target_gone.cast("int").alias(R.MISSING_TARGET),
        *[c.cast("int").alias(f"__gone{i}") for i, c in enumerate(gone.values())],
    )
    missing = flags.where((F.col(R.MISSING_SOURCE) == 1) | (F.col(R.MISSING_TARGET) == 1)).select(
        R.GROUP, F.col(R.MISSING_SOURCE).alias("__source"), F.col(R.MISSING_TARGET).alias("__target")
    )
    flagged = long.join(missing, R.GROUP, "left").withColumns(
        {
            R.MISSING_SOURCE: F.coalesce("__source", F.lit(0)),
            R.MISSING_TARGET: F.coalesce("__target", F.lit(0)),
        }
    )
    sums = flags.agg(*[F.coalesce(F.sum(f"__gone{i}"), F.lit(0)).alias(f"__gone{i}") for i in range(len(gone))])
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(scope).alias("scope"), F.col(f"__gone{i}").cast("bigint").alias("missing_rules"))
        for i, scope in enumerate(gone)
    ]
    findings = sums.select(F.inline(F.array(*rows)))
    return Validation(flagged.select(*long.columns), findings)


def _unfit(long: DataFrame, unfit: Mapping[tuple[str, str], str]) -> Validation:
    flagged = long.withColumns({flag: F.lit(1) for _, flag in unfit})
    rules = long.agg(F.count_distinct(R.GROUP).alias("missing_rules"))
    scopes = [F.struct(F.lit(i).alias("position"), F.lit(scope).alias("scope")) for i, (scope, _) in enumerate(unfit)]
    findings = rules.select(F.explode(F.array(*scopes)).alias("at"), "missing_rules").select("at.*", "missing_rules")
    return Validation(flagged.select(*long.columns), findings, [f"{s.capitalize()} {text}" for (s, _), text in unfit.items()])


# --- new rule rows ----------------------------------------------------------------


def new_rule_values(user: str, now: Column | None = None) -> dict[str, Column]:
    """Bookkeeping of a rule row that is inserted: valid from now, open ended, active."""
    stamp = F.current_timestamp() if now is None else now
    return {
        R.MISSING_SOURCE: F.lit(0),
        R.MISSING_TARGET: F.lit(0),
        "begin_date": stamp,
        "end_date": F.lit(OPEN_END_DATE).cast("timestamp"),
        "curr_ind": F.lit("Y"),
        "active_ind": F.lit("Y"),
        "create_date": stamp,
        "update_date": stamp,
        "secure_group_key": F.lit(0),
        "process_run_key": F.lit(0),
        "created_by": F.lit(user),
        "updated_by": F.lit(user),
    }


RULE_KEYS = (R.SOURCE_ID, R.TARGET_ID, R.SOURCE_VALUE, R.GROUP)


def merge_rules(table: DataFrame, changes: DataFrame, scope: Column, user: str, now: Column | None = None) -> DataFrame:
    """Update the target values of known rule rows of a set, insert the others."""
    stamp = F.current_timestamp() if now is None else now
    insert = {c: F.col(c) for c in (*RULE_KEYS, R.TARGET_VALUE)}
    insert |= {c: v for c, v in new_rule_values(user, now).items() if c in table.columns}
    update = {
        R.TARGET_VALUE: F.col(f"change.{R.TARGET_VALUE}"),
        "update_date": stamp,
        "updated_by": F.lit(user),
    }
    return upsert(table, changes, RULE_KEYS, {c: v for c, v in update.items() if c in table.columns}, insert, scope)


def as_rule_rows(table: DataFrame, rows: DataFrame, user: str, now: Column | None = None) -> DataFrame:
    """Long rule rows in the shape of the rule table."""
    values = {c: F.col(c) for c in rows.columns} | new_rule_values(user, now)
    return rows.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema.fields]
    )


# --- rules by expression ------------------------------------------------------------


def preview_expression(source: DataFrame, expression: str, target: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows with the expression's value, mapped or not, all as text."""
    return first_rows(stringified(expression_column(source, expression, target)), rows)


def expression_changes(
    source: DataFrame,
    expression: str,
    columns: R.RuleColumns,
    current: DataFrame | None = None,
    largest: int | None = None,
) -> DataFrame:
    """Long rule rows that an expression adds or changes.

    ``current`` holds the set's long rows (EDIT) or is None (SAVE).  A changed
    rule keeps its group id; new ones follow the highest.  Rules whose source
    row vanished or whose value turned NULL stay as they are.  There is no row
    limit: every mapped source row gets its rule.  ``largest`` is the highest group
    id of ``current``, if known.  Source and current rules are read once: what changed
    is stored, and known and new rules are both taken from there.
    """
    if len(columns.target) != 1:
        raise SchemaMismatch("Target selection set has more than 1 column.")
    target_id, target = next(iter(columns.target.items()))
    keys = list(columns.source.values())
    mapped = stringified(expression_column(source, expression, target)).where(F.col(quoted(target)).isNotNull())
    if current is None:
        changed = mapped.withColumn(R.GROUP, F.lit(None).cast("bigint"))
        largest = -1
    else:
        wide = R.pivot_rules(current, columns.source, columns.target)
        scratch_root(source.sparkSession)
        changed = R.changed_rows(mapped, wide, keys, target).checkpoint()
        largest = R.largest_group_id(current) if largest is None else largest
    numbered = R.assign_group_ids(changed, [F.col(quoted(k)).asc_nulls_first() for k in keys], largest)
    return R.unpivot_rules(
        numbered, {name: i for i, name in columns.source.items()}, {target: target_id}
    )


def rules_by_expression(
    table: DataFrame,
    source: DataFrame,
    expression: str,
    columns: R.RuleColumns,
    user: str,
    mode: str = "EDIT",
    now: Column | None = None,
) -> DataFrame:
    """The rule table after SAVE (replace the set) or EDIT (merge into it)."""
    in_set = F.col(R.SOURCE_ID).isin(*columns.source)
    if mode.upper() == "SAVE":
        rows = expression_changes(source, expression, columns)
        return replace_group(table, as_rule_rows(table, rows, user, now), in_set)
    current = table.where(in_set)
    known = current.agg(F.count(F.lit(1)).alias("rows"), F.max(R.GROUP).alias("largest")).first()
    rows = expression_changes(source, expression, columns, current if known.rows else None, int(known.largest or 0))
    return merge_rules(table, rows, in_set, user, now)


# --- import ---------------------------------------------------------------------


@dataclass
class ImportSheet:
    """Rows of an import file under ``SET/COLUMN`` labels, numbered from 0 in sheet order."""

    data: DataFrame
    layout: int
    source_columns: list[str]

    @property
    def target_columns(self) -> list[str]:
        return [c for c in self.data.columns if c not in self.source_columns and c != R.GROUP]


def _forward_filled(cells: Sequence[str | None]) -> list[str]:
    out: list[str] = []
    for c in cells:
        out.append(c if c is not None and c != "" else (out[-1] if out else ""))
    return out


def _in_sheet_order(raw: DataFrame) -> DataFrame:
    """Number the rows from 0: files by name, rows by their place in the file.

    A multi-line file is never split, so row ids are consecutive within a file
    and only one row per file (its first id and its size) is needed to place it.
    """
    placed = raw.select("*", F.col("_metadata.file_name").alias("__file"), F.monotonically_increasing_id().alias("__at"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        placed.groupBy("__file")
        .agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__size"))
        .select("__file", "__first", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    )
    return placed.join(F.broadcast(files), "__file").select(
        *raw.columns, (F.col("__before") + F.col("__at") - F.col("__first")).alias(R.GROUP)
    )


def _sheet_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a sheet as text, numbered from 0.

    Files larger than a split are joined to records by many tasks.
    """
    options = {"emptyValue": "", "nullValue": "\\N"}
    lines = csv_lines(spark, path)
    if lines.where(F.col("size") > split_size(spark)).isEmpty():
        return _in_sheet_order(spark.read.csv(path, header=False, multiLine=True, quote='"', escape='"', **options))
    records = csv_records(lines)
    first = records.orderBy(_name("file"), "number").limit(1).first()
    cells = next(csv.reader(io.StringIO(first.record, newline=""))) if first else []
    columns = [f"_c{i}" for i in range(len(cells))]
    before = Window.orderBy("__name").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        records.groupBy("file", _name("file").alias("__name"))
        .agg(F.count(F.lit(1)).alias("__size"))
        .select("file", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    )
    rows = parsed(records, columns, **options)
    # One row per file of the sheet.
    return rows.join(F.broadcast(files), "file").select(*columns, (F.col("__before") + F.col("number")).alias(R.GROUP))


def _name(file: str) -> Column:
    return F.element_at(F.split(plain_path(file), "/"), -1)


def read_import(spark: SparkSession, path: str) -> ImportSheet:
    """Read a CSV export of an import sheet with two or three header rows.

    ``Sources`` in the first cell: role, set name and column name rows.
    ``Source``: role and column name rows.  Merged cells count for the columns
    to their right, and all values are text: ``NA`` stays ``NA``.  A folder of
    part files counts as one sheet in the order of their names.
    """
    raw = _sheet_rows(spark, path)
    head = [list(r)[:-1] for r in raw.where(F.col(R.GROUP) < 3).orderBy(R.GROUP).collect()]
    first = (head[0][0] or "").strip().lower() if head else ""
    if first == "sources" and len(head) == 3:
        layout, upper, lower = 1, _forward_filled(head[1]), head[2]
    elif first == "source" and len(head) >= 2:
        layout, upper, lower = 2, _forward_filled(head[0]), head[1]
    else:
        raise SchemaMismatch("file does not contain Source(s) in its first cell")
    labels = [f"{u}/{name}".upper() for u, name in zip(upper, lower)]
    depth = 3 if layout == 1 else 2
    data = raw.where(F.col(R.GROUP) >= depth).withColumn(R.GROUP, F.col(R.GROUP) - F.lit(depth)).toDF(*labels, R.GROUP)
    prefix = labels[0].split("/", 1)[0] + "/"
    return ImportSheet(data, layout, [c for c in labels if c.startswith(prefix)])


def import_rows(sheet: ImportSheet, source: DataFrame, target: DataFrame) -> DataFrame:
    """Long rule rows of an import sheet with association ids.

    ``source`` and ``target`` are role columns of the rule set.  Blank targets
    are unmapped.  With several targets a column is found by set and column
    name, with one by column name alone.
    """
    name, key = "selection_set_mapping_tool_column_name", "mapping_rule_set_selection_set_column_assoc_key"

    def label(c: str) -> str:
        set_name, column = c.split("/", 1)
        return f"{set_name}/{re.sub(r'^TRG#[0-9]*_', '', column)}"

    long = R.mapped_only(
        R.unpivot_rules(
            sheet.data, {c: label(c) for c in sheet.source_columns}, {c: label(c) for c in sheet.target_columns}
        )
    )
    cut = lambda c, i: F.get(F.split(F.col(c), "/", 2), i)
    long = long.select(
        R.GROUP,
        cut(R.SOURCE_ID, 1).alias("source_name"),
        F.coalesce(F.col(R.SOURCE_VALUE), F.lit("")).alias(R.SOURCE_VALUE),
        cut(R.TARGET_ID, 0).alias("target_set"),
        cut(R.TARGET_ID, 1).alias("target_name"),
        R.TARGET_VALUE,
    )
    upper = lambda df: df.select(
        F.upper("selection_set_name").alias("selection_set_name"), F.upper(name).alias(name), key
    )
    out = R.resolve_ids(long, upper(source), {"source_name": name}, {key: R.SOURCE_ID})
    several = len({c.split("/", 1)[0] for c in sheet.target_columns}) > 1
    if several:
        by = {"target_set": "selection_set_name", "target_name": name}
    else:
        by = {"target_name": name}
    return R.resolve_ids(out, upper(target), by, {key: R.TARGET_ID}).drop("target_set")


def import_rules(
    table: DataFrame, sheet: ImportSheet, source: DataFrame, target: DataFrame, in_set: Column, user: str, now: Column | None = None
) -> DataFrame:
    """The rule table with one rule set replaced by an import sheet."""
    rows = import_rows(sheet, source, target)
    return replace_group(table, as_rule_rows(table, rows, user, now), in_set)


# --- publish --------------------------------------------------------------------

RULE_FACTS = (
    "mapping_rule_key",
    R.GROUP,
    R.SOURCE_VALUE,
    R.TARGET_VALUE,
    R.MISSING_SOURCE,
    R.MISSING_TARGET,
    "begin_date",
    "end_date",
    "curr_ind",
    "active_ind",
    "created_by_party_key",
    "updated_by_party_key",
    "data_owner_key",
    "create_date",
    "update_date",
    "secure_group_key",
    "created_by",
    "updated_by",
)
# Columns a published rule takes once, from its source side.
SET_FACTS = (
    "mapping_rule_set_name",
    "mapping_rule_set_key",
    "mapping_rule_set_type_name",
    "mapping_rule_data_comparison_type_name",
    "data_provider_key",
    "data_provider_code",
)


# Columns a published rule takes from each side, and their names there.
SIDE_COLUMNS = {
    "selection_set_column_key": "{}_selection_set_column_key",
    "mapping_rule_set_selection_set_assoc_key": "mapping_rule_set_{}_selection_set_key",
    "selection_set_name": "{}_selection_set_name",
    "selection_set_mapping_tool_column_name": "{}_selection_set_mapping_tool_column_name",
    "selection_set_srce_column_name": "{}_selection_set_srce_column_name",
}


def published_rules(rules: DataFrame, meta: R.RuleMetadata, rule_set_key: int) -> DataFrame:
    """Rules of a set with the names of both sides: the column graph joined twice.

    A graph of at most ``MAX_RULE_COLUMNS`` columns is read once.  A larger one is reduced
    first, to the columns of the set and then to the target columns that its rules name.
    What is within the bound is sent to all tasks, so that rules stay where they are,
    however many share a column; sides beyond it are joined as they are.
    """
    small = broadcast_if_small
    graph = (
        R.column_graph(meta)
        .join(small(meta.provider), "data_provider_key")
        .join(small(meta.rule_set_type), "mapping_rule_set_type_id")
        .join(small(meta.comparison_type), "mapping_rule_data_comparison_type_id")
    )
    key = "mapping_rule_set_selection_set_column_assoc_key"

    def side(columns: DataFrame, role: str, extra: Sequence[str] = ()) -> DataFrame:
        return columns.select(
            F.col(key).alias(R.SOURCE_ID if role == "srce" else R.TARGET_ID),
            *[F.col(c).alias(name.format(role)) for c, name in SIDE_COLUMNS.items()],
            *extra,
        )

    def few(df: DataFrame) -> tuple[DataFrame, list | None]:
        """The frame from its rows, read once, and its first column; as it is, and None, if it has too many."""
        rows = df.limit(R.MAX_RULE_COLUMNS + 1).collect()
        if len(rows) > R.MAX_RULE_COLUMNS:
            return df, None
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), [r[0] for r in rows]

    in_set = F.col("mapping_rule_set_key") == rule_set_key
    whole, ids = few(graph.select(key, *SIDE_COLUMNS, *SET_FACTS))
    if ids is not None:
        source, target = (F.broadcast(x) for x in (side(whole.where(in_set), "srce", SET_FACTS), side(whole, "trgt")))
        joined = rules.join(source, R.SOURCE_ID).join(target, R.TARGET_ID)
    else:
        source, ids = few(side(graph.where(in_set), "srce", SET_FACTS))
        joined = (rules if ids is None else rules.where(F.col(R.SOURCE_ID).isin(ids))).join(source, R.SOURCE_ID)
        _, ids = few(joined.select(R.TARGET_ID).distinct())
        target, _ = few(side(graph if ids is None else graph.where(F.col(key).isin(ids)), "trgt"))
        joined = joined.join(target, R.TARGET_ID)
    facts = [c for c in RULE_FACTS if c in rules.columns]
    return joined.select(
        *facts, *[c for c in source.columns if c != R.SOURCE_ID], *[c for c in target.columns if c != R.TARGET_ID]
    )


def publish_rules(published: DataFrame, path: str) -> None:
    """Replace the published partition of each rule set that occurs."""
    part = published.withColumn("part_mapping_rule_set_name", F.col("mapping_rule_set_name"))
    overwrite_partitions(part, path, ["part_mapping_rule_set_name"])
