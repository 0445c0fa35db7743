"""When a join side may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound of the optimizer's size estimate for a side that is sent to every executor.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's own size estimate of a plan; no job is run.

    Filters and projections never raise it above the size of the scanned files
    and joins multiply it, so an unknown size counts as a large one.
    """
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only below the limit.

    Above it the plan stays a shuffled join, where the adaptive engine splits
    hot keys of the preserved side.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def broadcast_if_few(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast after counting at most ``rows + 1`` rows.

    For joins of small tables, whose estimate is far above their true size.
    """
    if estimated_bytes(df) <= BROADCAST_LIMIT_BYTES or df.limit(rows + 1).count() <= rows:
        return F.broadcast(df)
    return df
