"""Set operations over frames of one or of evolving shape."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.headers import quoted
from ledgerloom.operators.sizing import broadcast_if_small

# A group of equal rows is written out again in pieces of at most this many copies.
COPIES_PER_PIECE = 10_000


def grouped_rows(df: DataFrame, columns: Mapping[str, str], *aggregates: Column) -> DataFrame:
    """Groups of equal rows under new names (NULL equals NULL), with aggregates.

    The grouping key is one struct, so neither input nor output counts as
    partitioned by the columns themselves: copies collapse before the shuffle
    even when the input comes out of a join on these columns, and a join that
    follows gets an exchange of its own, which the adaptive engine can split
    when the other side has a hot key.
    """
    row = F.struct(*[F.col(quoted(c)).alias(name) for c, name in columns.items()]).alias("__row")
    keyed = df.select(row, *[F.col(quoted(c)) for c in df.columns]) if aggregates else df.select(row)
    groups = keyed.groupBy("__row").agg(*aggregates) if aggregates else keyed.distinct()
    return groups.select("__row.*", *[c for c in groups.columns if c != "__row"])


def union_evolving(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of frames whose columns differ; a column a frame lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(frames))


def union_distinct(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, list(frames)).distinct()


def dedup_rows(df: DataFrame) -> DataFrame:
    """Whole-row duplicates collapse before the shuffle, so copies are cheap."""
    return df.dropDuplicates()


def dedup_counts(df: DataFrame) -> DataFrame:
    """Rows before and after dropping duplicates, in one aggregation."""
    groups = df.groupBy(*[F.col(quoted(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    )


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Each row as often as its count column says, spread over tasks.

    A count is first cut into pieces that are shuffled apart; a group that
    holds a third of all rows is therefore not written by one task.
    """
    pieces = df.where(F.col(copies) > 0).select(
        "*", F.explode(F.expr(f"sequence(0, ({copies} - 1) div {COPIES_PER_PIECE})")).alias("__piece")
    )
    spread = pieces.repartition(*[F.col(quoted(c)) for c in df.columns], F.col("__piece"))
    return spread.select(
        *[F.col(quoted(c)) for c in df.columns if c != copies],
        F.explode(
            F.expr(f"sequence(1, least({COPIES_PER_PIECE}, {copies} - __piece * {COPIES_PER_PIECE}))")
        ).alias("__copy"),
    ).drop("__copy")


def except_rows(df: DataFrame, removed: DataFrame) -> DataFrame:
    """Multiset difference: each removed row takes one equal row away.

    Rows without an equal one on the other side pass straight through; only
    the values that occur on both sides are counted.
    """
    names = list(df.columns)
    aliases = [f"__r{i}" for i in range(len(names))]
    gone = grouped_rows(removed, dict(zip(removed.columns, aliases)), F.count(F.lit(1)).alias("__gone"))
    side = broadcast_if_small(gone)
    equal = F.lit(True)
    for c, a in zip(names, aliases):
        equal = equal & df[quoted(c)].eqNullSafe(F.col(a))
    untouched = df.join(side, equal, "left_anti")
    touched = df.join(side, equal, "inner").select(*[df[quoted(c)] for c in names], "__gone")
    counted = grouped_rows(touched, {c: c for c in touched.columns}, F.count(F.lit(1)).alias("__have"))
    left_over = counted.withColumn("__left", F.col("__have") - F.col("__gone")).drop("__gone", "__have")
    return untouched.unionByName(repeat_rows(left_over, "__left"))


def split_labels(df: DataFrame, label: str, set_name: str, column_name: str) -> DataFrame:
    """``set/column`` labels as two columns, cut at the first slash."""
    parts = F.split(F.col(quoted(label)), "/", 2)
    return df.withColumn(set_name, F.get(parts, 0)).withColumn(column_name, F.get(parts, 1))
