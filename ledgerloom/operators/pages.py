"""Pages over an order that is kept: sorted and numbered once, then read by place.

``paginate`` sorts again for every page.  Here the numbered rows are stored in
blocks of a fixed number of rows, so that the blocks of a page follow from its row
numbers, and a page reads these alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.headers import quoted
from ledgerloom.operators.numbering import number_rows
from ledgerloom.sinks.versions import commit, current, keep_schema, stage, stored_schema

BLOCK = "page_block"
#: Rows of a block: some megabytes in a file.
BLOCK_ROWS = 100_000


def keep_order(
    df: DataFrame,
    path: str,
    order: str | Sequence[str | Column] | None = None,
    number: str = "RowNum",
    block_rows: int = BLOCK_ROWS,
) -> int:
    """Store the rows in a total order (see ``order_columns``) for ``page``; their number.

    The sort is one parallel range sort.  The pages before stay readable until the
    new ones are complete.
    """
    numbered = number_rows(df, order, number)
    block = F.floor((F.col(quoted(number)) - 1) / block_rows).cast("bigint")
    # Files of a task hold whole stretches of the order: a block is in one file, or in two where a range ends.
    kept = numbered.select("*", block.alias(BLOCK, metadata={"rows": block_rows}))
    spark = df.sparkSession
    name, rows = stage(kept, path, [BLOCK])
    keep_schema(spark, f"{path.rstrip('/')}/{name}", kept.schema)
    commit(spark, path, name)
    return rows


def page(spark: SparkSession, path: str, start: int, size: int, number: str = "RowNum") -> DataFrame:
    """Rows ``start`` to ``start + size - 1`` (from 1) of the kept order, with their numbers."""
    version = current(spark, path)
    schema = stored_schema(spark, version)
    block_rows = schema[BLOCK].metadata["rows"]
    last = start + size - 1
    wanted = F.col(BLOCK).between((start - 1) // block_rows, (last - 1) // block_rows)
    rows = spark.read.schema(schema).parquet(version)
    return rows.where(wanted & F.col(quoted(number)).between(start, last)).drop(BLOCK)
