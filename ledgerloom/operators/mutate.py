"""Row-level changes on plain files: every change is a recomputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.headers import quoted
from ledgerloom.operators.combine import grouped_rows
from ledgerloom.operators.sizing import broadcast_if_small


def _match(left: DataFrame, names: Mapping[str, str]) -> Column:
    condition = F.lit(True)
    for key, name in names.items():
        condition = condition & (left[quoted(key)] == F.col(name))
    return condition


def upsert(
    table: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, Column],
    insert: Mapping[str, Column],
    in_scope: Column | None = None,
) -> DataFrame:
    """MERGE: matched rows take the updates, unmatched changes are inserted.

    ``update`` and ``insert`` map table columns to expressions; in ``update``
    a change column ``c`` is ``change.c``.  Columns an insert does not name are
    NULL.  Keys compare with ``=``: a NULL key never matches.  Two changes for
    one row are an error, as in MERGE.  Rows outside ``in_scope`` never match.

    The table keeps its place as the preserved side of left and semi joins, so
    it is not shuffled when the changes are small, and a hot key in it can be
    split when they are not.
    """
    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    scope = F.lit(True) if in_scope is None else F.coalesce(in_scope, F.lit(False))
    per_key = grouped_rows(
        changes,
        names,
        F.count(F.lit(1)).alias("__n"),
        F.first(F.struct(*[F.col(quoted(c)) for c in changes.columns])).alias("change"),
    )
    side = broadcast_if_small(per_key)
    hit = F.when(F.col("__n") == 1, F.lit(True)).when(
        F.col("__n") > 1, F.raise_error(F.lit("several changes match one row")).cast("boolean")
    )
    scoped = table.withColumn("__scope", scope)
    joined = scoped.join(side, _match(scoped, names) & F.col("__scope"), "left").withColumn("__hit", hit)
    updated = joined.select(
        *[
            F.when(F.col("__hit"), update[c]).otherwise(F.col(quoted(c))).cast(table.schema[c].dataType).alias(c)
            if c in update
            else F.col(quoted(c))
            for c in table.columns
        ]
    )
    hits = scoped.where("__scope").join(
        broadcast_if_small(per_key.select(*names.values())), _match(scoped, names), "left_semi"
    )
    matched = grouped_rows(hits, names)
    fresh = changes.join(broadcast_if_small(matched), _match(changes, names), "left_anti")
    inserted = fresh.select(
        *[
            (insert[c] if c in insert else F.lit(None)).cast(table.schema[c].dataType).alias(c)
            for c in table.columns
        ]
    )
    return updated.unionByName(inserted)


def replace_group(table: DataFrame, replacement: DataFrame, old_rows: Column) -> DataFrame:
    """Delete the old rows and insert the replacement as one new table."""
    return delete_where(table, old_rows).unionByName(replacement)


def delete_where(table: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true; unknown (NULL) keeps the row."""
    return table.where(~F.coalesce(condition, F.lit(False)))


def patch(table: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """UPDATE: new values where the condition is true, same columns and order."""
    hit = F.coalesce(condition, F.lit(False))
    return table.select(
        *[
            F.when(hit, values[c]).otherwise(F.col(quoted(c))).alias(c) if c in values else F.col(quoted(c))
            for c in table.columns
        ]
    )
