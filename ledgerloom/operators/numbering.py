"""Row numbers and pages without pulling a table through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.headers import quoted
from ledgerloom.operators.project import given
from ledgerloom.session import scratch_root

# Pages that end within this many rows come from a top-k; deeper ones are numbered.
TOP_K_ROWS = 10_000
_LOCAL_BITS = (1 << 33) - 1


def order_columns(df: DataFrame, order: str | Sequence[str | Column] | None) -> list[Column]:
    """Sort keys from text such as ``A desc, B``; every other column breaks ties.

    Without an order the first column leads.
    """
    if isinstance(order, str) or order is None:
        keys = [_sort_key(part) for part in order.split(",")] if given(order) else []
    else:
        keys = [_sort_key(o) if isinstance(o, str) else o for o in order]
    return keys + [F.col(quoted(c)).asc_nulls_first() for c in df.columns]


def _sort_key(text: str) -> Column:
    name, descending = text.strip(), False
    for suffix, flag in ((" asc", False), (" desc", True)):
        if name.lower().endswith(suffix):
            name, descending = name[: -len(suffix)].strip(), flag
    column = F.col(name if name.startswith("`") else quoted(name))
    return column.desc_nulls_last() if descending else column.asc_nulls_first()


def number_rows(
    df: DataFrame, order: str | Sequence[str | Column] | None, name: str, start: int = 1
) -> DataFrame:
    """Consecutive numbers in a total order, computed in parallel.

    Rows are range-sorted and stored once; the number is the row's place in its
    stored partition plus the sizes of the partitions before it.  Only those
    sizes (one per partition) meet in one place.  Copies of a row are told apart
    by the input partition they come from, so they can fall in different ranges,
    and a repeated task sends each row to the same range again.
    """
    scratch_root(df.sparkSession)
    stored = (
        df.withColumn("__tie", F.spark_partition_id())
        .orderBy(*order_columns(df, order), F.col("__tie"))
        .drop("__tie")
        .checkpoint()
    )
    placed = stored.select(
        "*",
        F.spark_partition_id().alias("__part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS)).alias("__place"),
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__size"))
        .select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    )
    # One row per partition of the sorted data: bounded by the partition count.
    return placed.join(F.broadcast(starts), "__part").select(
        *[F.col(quoted(c)) for c in df.columns],
        (F.col("__before") + F.col("__place") + F.lit(start)).cast("bigint").alias(name),
    )


def paginate(
    df: DataFrame,
    start: int,
    size: int,
    order: str | Sequence[str | Column] | None = None,
    number: str = "RowNum",
) -> DataFrame:
    """Rows ``start`` to ``start + size - 1`` (1-based) of the ordered frame, with their numbers."""
    last = start + size - 1
    if last > TOP_K_ROWS:
        numbered = number_rows(df, order, number)
    else:
        top = df.orderBy(*order_columns(df, order)).limit(last)
        numbered = top.withColumn(
            number, F.row_number().over(Window.orderBy(*order_columns(df, order))).cast("bigint")
        )
    return numbered.where(F.col(number).between(start, last))


def first_rows(df: DataFrame, rows: int, order: str | Sequence[str | Column] | None = None) -> DataFrame:
    """The first rows of a total order (a top-k, never an arbitrary subset)."""
    return df.orderBy(*order_columns(df, order)).limit(rows)
