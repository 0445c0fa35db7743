"""Value-mapping rules: long and wide forms, comparison with data, identifiers.

A rule is one ``mapping_rule_column_group_id``.  The long table holds one row
per (source column, target column) of a rule; the wide form holds one row per
rule with the source columns by name and the target columns as
``trg#<target id>_<name>``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.headers import quoted
from ledgerloom.functions.values import blank_for_null
from ledgerloom.operators.combine import grouped_rows
from ledgerloom.operators.numbering import number_rows
from ledgerloom.operators.sizing import broadcast_if_few, broadcast_if_small

# Column names of the rule table.
GROUP = "mapping_rule_column_group_id"
SOURCE_ID = "mapping_rule_set_srce_selection_set_column_assoc_key"
TARGET_ID = "mapping_rule_set_trgt_selection_set_column_assoc_key"
SOURCE_VALUE = "mapping_rule_srce_column_val"
TARGET_VALUE = "mapping_rule_trgt_column_val"
MISSING_SOURCE = "is_missing_srce_flag"
MISSING_TARGET = "is_missing_trgt_flag"
# Rule set types.
KEY_TO_KEY, ATTRIBUTE_TO_KEY, ATTRIBUTE_TO_ATTRIBUTE, EXPRESSION, KEY_TO_ATTRIBUTE = 1001, 1002, 1003, 1004, 1005
_ALL_COLUMNS = {
    1: (ATTRIBUTE_TO_ATTRIBUTE, ATTRIBUTE_TO_KEY, EXPRESSION),
    0: (ATTRIBUTE_TO_ATTRIBUTE, KEY_TO_ATTRIBUTE, EXPRESSION),
}
# Rule sets describe table columns; far more than a table can have is a wrong input.
MAX_RULE_COLUMNS = 10_000


def mapping_roles(mapping_type: str) -> tuple[str, str]:
    """(source role, target role) of a text such as ``Key to Attribute``."""
    if mapping_type.strip().lower() == "expression mapping":
        return "Attribute", "Attribute"
    words = mapping_type.split()
    return words[0], words[2]


def target_column(target: object, name: str) -> str:
    return f"trg#{target}_{name}"


def target_of(column: str) -> tuple[str, str] | None:
    """(target id, column name) of a target column of the wide form, else None."""
    found = re.fullmatch(r"trg#(\d+)_(.*)", column, re.DOTALL)
    return (found.group(1), found.group(2)) if found else None


def with_target_prefix(df: DataFrame, target: object) -> DataFrame:
    return df.toDF(*[target_column(target, c) for c in df.columns])


def columns_by_target(columns: Sequence[str], not_rule_columns: Sequence[str] = (GROUP,)) -> dict[str, list[str]]:
    """Rule columns grouped by ``src`` and target id, without their prefixes."""
    out: dict[str, list[str]] = {}
    for c in columns:
        if c in not_rule_columns:
            continue
        target, name = target_of(c) or ("src", c)
        out.setdefault(target, []).append(name)
    return out


# --- metadata ---------------------------------------------------------------


@dataclass
class RuleMetadata:
    """The dimension tables that describe rule sets."""

    rule_set: DataFrame
    set_assoc: DataFrame
    selection_set: DataFrame
    set_column: DataFrame
    column_assoc: DataFrame
    provider: DataFrame | None = None
    rule_set_type: DataFrame | None = None
    comparison_type: DataFrame | None = None


def column_graph(meta: RuleMetadata) -> DataFrame:
    """Rule set, selection set and column of every column association."""
    small = broadcast_if_small
    return (
        meta.column_assoc.join(small(meta.set_column), "selection_set_column_key")
        .join(small(meta.set_assoc.withColumnRenamed("selection_set_key", "__set")), "mapping_rule_set_selection_set_assoc_key")
        .where(F.col("selection_set_key") == F.col("__set"))
        .drop("__set")
        .join(small(meta.rule_set), "mapping_rule_set_key")
        .join(small(meta.selection_set), "selection_set_key")
    )


def role_columns(meta: RuleMetadata, rule_set_key: int, is_source: bool) -> DataFrame:
    """Columns that take part in a role: all for Attribute, key columns for Key."""
    flag = 1 if is_source else 0
    return (
        column_graph(meta)
        .where((F.col("mapping_rule_set_key") == rule_set_key) & (F.col("is_srce_selection_set_flag") == flag))
        .where(
            F.col("mapping_rule_set_type_id").isin(*_ALL_COLUMNS[flag])
            | (F.col("is_selection_set_column_primary_key_flag") == 1)
        )
        .select(
            "mapping_rule_set_selection_set_assoc_key",
            "selection_set_name",
            "selection_set_srce_column_name",
            "selection_set_mapping_tool_column_name",
            "mapping_rule_set_selection_set_column_assoc_key",
        )
    )


@dataclass
class RuleColumns:
    """Association id -> wide column name for both roles of one rule set."""

    source: dict[int, str]
    target: dict[int, str]

    @property
    def names(self) -> list[str]:
        return [*self.source.values(), *self.target.values()]


def rule_columns(meta: RuleMetadata, rule_set_key: int) -> RuleColumns:
    """The column lists of a rule set; metadata rows, one per table column."""

    def rows(is_source: bool):
        found = (
            role_columns(meta, rule_set_key, is_source)
            .orderBy("mapping_rule_set_selection_set_assoc_key", "mapping_rule_set_selection_set_column_assoc_key")
            .limit(MAX_RULE_COLUMNS + 1)
            .collect()
        )
        if len(found) > MAX_RULE_COLUMNS:
            raise ValueError(f"more than {MAX_RULE_COLUMNS} columns in rule set {rule_set_key}")
        return found

    key = "mapping_rule_set_selection_set_column_assoc_key"
    name = "selection_set_srce_column_name"
    return RuleColumns(
        {r[key]: r[name] for r in rows(True)},
        {r[key]: target_column(r["mapping_rule_set_selection_set_assoc_key"], r[name]) for r in rows(False)},
    )


def resolve_ids(long: DataFrame, columns: DataFrame, by: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Replace names by ids through an inner join; unknown names drop out."""
    keys = [f"__key{i}" for i in range(len(by))]
    side = columns.select(
        *[F.col(quoted(c)).alias(k) for k, c in zip(keys, by.values())],
        *[F.col(quoted(c)).alias(name) for c, name in take.items()],
    )
    condition = F.lit(True)
    for k, c in zip(keys, by):
        condition = condition & (long[quoted(c)] == F.col(k))
    # Few names label very many rows: shuffling on them would fill a handful of tasks.
    return long.join(broadcast_if_few(side, MAX_RULE_COLUMNS), condition, "inner").drop(*keys, *by)


def scoped_rules(rules: DataFrame, meta: RuleMetadata, rule_set_key: int) -> DataFrame:
    """Rules whose source column belongs to a rule set."""
    scope = (
        meta.column_assoc.join(
            broadcast_if_small(
                meta.set_assoc.where(
                    (F.col("mapping_rule_set_key") == rule_set_key) & (F.col("is_srce_selection_set_flag") == 1)
                )
            ),
            "mapping_rule_set_selection_set_assoc_key",
            "left_semi",
        )
        .select(F.col("mapping_rule_set_selection_set_column_assoc_key").alias(SOURCE_ID))
        .distinct()
    )
    return rules.join(broadcast_if_small(scope), SOURCE_ID, "left_semi").select(*rules.columns)


# --- shape ------------------------------------------------------------------


def unpivot_rules(
    wide: DataFrame, source: Mapping[str, object], target: Mapping[str, object], group: str = GROUP
) -> DataFrame:
    """Wide rules to one row per (source column, target column); no shuffle.

    ``source`` and ``target`` map wide column names to the label (an id or a
    name) that stands for them in the long form.
    """
    labelled = wide.select(
        group,
        *[F.col(quoted(c)).cast("string").alias(f"s{i}") for i, c in enumerate(source)],
        *[F.col(quoted(c)).cast("string").alias(f"t{i}") for i, c in enumerate(target)],
    )
    source_vars = [f"s{i}" for i in range(len(source))]
    target_vars = [f"t{i}" for i in range(len(target))]
    long = labelled.unpivot([group, *source_vars], target_vars, "__target", TARGET_VALUE).unpivot(
        [group, "__target", TARGET_VALUE], source_vars, "__source", SOURCE_VALUE
    )
    return long.select(
        group,
        _label("__source", source_vars, list(source.values())).alias(SOURCE_ID),
        SOURCE_VALUE,
        _label("__target", target_vars, list(target.values())).alias(TARGET_ID),
        TARGET_VALUE,
    )


def _label(variable: str, names: Sequence[str], labels: Sequence[object]) -> Column:
    out = F.when(F.lit(False), F.lit(labels[0]))
    for n, label in zip(names, labels):
        out = out.when(F.col(variable) == n, F.lit(label))
    return out if isinstance(labels[0], str) else out.cast("bigint")


def pivot_rules(
    long: DataFrame,
    source: Mapping[object, str],
    target: Mapping[object, str],
    keep: Sequence[str] = (),
    group: str = GROUP,
) -> DataFrame:
    """Long rules to one row per rule (and kept columns) in a single aggregation."""

    def values(id_column: str, value: str, names: Mapping[object, str]) -> list[Column]:
        return [F.max(F.when(F.col(id_column) == F.lit(k), F.col(value))).alias(n) for k, n in names.items()]

    return (
        long.where(F.col(SOURCE_ID).isin(*source))
        .groupBy(group, *keep)
        .agg(*values(SOURCE_ID, SOURCE_VALUE, source), *values(TARGET_ID, TARGET_VALUE, target))
    )


def mapped_only(df: DataFrame, value: str = TARGET_VALUE) -> DataFrame:
    """Rows with a target: neither NULL nor blank."""
    return df.where(F.nullif(F.col(quoted(value)), F.lit("")).isNotNull())


# --- rules against data -------------------------------------------------------


def _met(data: DataFrame, rules: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Data with a key of the rules, so that what is made distinct afterwards is no larger than the rules ask for."""
    return data.join(broadcast_if_small(rules.select(*keys).distinct()), list(keys), "left_semi")


def rules_full_outer(data: DataFrame, rules: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Data with its rules, unmapped data, and rules without data.

    Blank stands for NULL on both sides, so NULL keys meet.  The full outer
    join is a left join plus the rules that match nothing: a left join can
    broadcast the rules or split a hot data key, a full join can do neither.
    """
    left, right = blank_for_null(data), blank_for_null(rules)
    keys = list(keys)
    mapped = left.join(broadcast_if_small(right), keys, "left")
    orphans = right.join(grouped_rows(_met(left, right, keys), {k: k for k in keys}), keys, "left_anti")
    return mapped.unionByName(orphans, allowMissingColumns=True)


def with_target_attributes(rules: DataFrame, target: object, target_data: DataFrame) -> DataFrame:
    """Add the other columns of a target to rules that hold only its key.

    Every rule stays, found or not.
    """
    prefixed = with_target_prefix(target_data, target)
    keys = [c for c in prefixed.columns if c in rules.columns]
    return rules.join(broadcast_if_small(prefixed), keys, "left")


def missing_rules(rules: DataFrame, data: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rules whose values no longer occur in the data; NULL equals NULL.

    The data side is reduced to distinct keys before it is shuffled.
    """
    keys = list(keys)
    filled = blank_for_null(rules)
    present = grouped_rows(_met(blank_for_null(data), filled, keys), {k: k for k in keys})
    return filled.join(present, keys, "left_anti")


def with_presence(rules: DataFrame, data: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """All rules with a flag: their key values occur in the data; NULL equals NULL."""
    names = {k: f"__key{i}" for i, k in enumerate(keys)}
    present = grouped_rows(blank_for_null(data), names).withColumn("__present", F.lit(True))
    condition = F.lit(True)
    for k, n in names.items():
        condition = condition & (F.coalesce(rules[quoted(k)], F.lit("")) == F.col(n))
    joined = rules.join(present, condition, "left").drop(*names.values())
    return joined.withColumn(flag, F.col("__present").isNotNull()).drop("__present")


def flag_missing(rules: DataFrame, flag: str, missing: DataFrame, group: str = GROUP) -> DataFrame:
    """Set a flag to 1 on every row of the missing rules and to 0 elsewhere."""
    ids = missing.select(group).distinct().withColumn("__missing", F.lit(1))
    return (
        rules.drop(flag)
        .join(broadcast_if_small(ids), group, "left")
        .withColumn(flag, F.coalesce(F.col("__missing"), F.lit(0)))
        .drop("__missing")
    )


def changed_rows(new: DataFrame, current: DataFrame, keys: Sequence[str], value: str, group: str = GROUP) -> DataFrame:
    """New rules whose target differs from the current one, with the current group id.

    A rule without a current one counts as changed and has a NULL group id.
    """
    names = {k: f"__cur{i}" for i, k in enumerate(keys)}
    side = current.select(
        *[F.col(quoted(k)).alias(n) for k, n in names.items()],
        F.col(quoted(value)).alias("__current"),
        F.col(group),
    )
    condition = F.lit(True)
    for k, n in names.items():
        condition = condition & new[quoted(k)].eqNullSafe(F.col(n))
    joined = new.drop(group).join(broadcast_if_small(side), condition, "left")
    return joined.where(~F.col(quoted(value)).eqNullSafe(F.col("__current"))).drop("__current", *names.values())


def assign_group_ids(
    df: DataFrame, order: Sequence[str], largest: int | None, group: str = GROUP
) -> DataFrame:
    """Give rows without a group id the next numbers after the largest one."""
    known = df.where(F.col(group).isNotNull())
    new = number_rows(df.where(F.col(group).isNull()).drop(group), list(order), group, (largest or 0) + 1)
    return known.unionByName(new)


def largest_group_id(rules: DataFrame, group: str = GROUP) -> int:
    """The highest group id; 0 when there is none."""
    return int(rules.agg(F.coalesce(F.max(group), F.lit(0)).alias("m")).first()["m"])
