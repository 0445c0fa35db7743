"""Selection sets and mapping definitions: text snapshots of datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.headers import upper_headers
from ledgerloom.functions.values import blank_for_null, stringified
from ledgerloom.operators.profile import key_check, rowcount_status
from ledgerloom.operators.project import filter_where, full_query, project
from ledgerloom.plans.status import JobResult
from ledgerloom.sinks.versions import publish, read_current
from ledgerloom.sources.files import latest_runs

FULL_QUERY = "FULL_QUERY"


def select_rows(
    dataset: DataFrame, columns: Sequence[str] | str | None, conditions: str | None, query_type: str = "FILTER"
) -> DataFrame:
    """Upper-case names, then a whole query or a column list and a filter."""
    df = upper_headers(dataset)
    if query_type == FULL_QUERY:
        return full_query(df, conditions)
    return filter_where(project(df, columns), conditions)


def publish_selection_set(
    spark: SparkSession,
    dataset: str,
    output: str,
    columns: Sequence[str] | str | None = None,
    conditions: str | None = None,
    query_type: str = "FILTER",
    key: Sequence[str] = (),
    earlier: Sequence[str] | None = None,
) -> JobResult:
    """Snapshot the newest runs of a dataset as text.

    With the columns of an earlier snapshot (a refresh) they must be the same.  The
    rows are computed once: keys are checked as written, before the snapshot counts.
    Readers use ``read_current``.
    """
    rows = select_rows(latest_runs(spark, dataset), columns, conditions, query_type)
    if earlier is not None and set(earlier) != set(rows.columns):
        return JobResult("ERROR", "Mismatched columns")

    def not_unique(written: DataFrame) -> str | None:
        if key and not key_check(written, key).first()["is_unique"]:
            return f"Provided Primary Key: {list(key)} is not unique in this dataset."
        return None

    reason, n = publish(stringified(rows), output, check=not_unique)
    if reason is not None:
        return JobResult("ERROR", reason)
    return JobResult("OK", row_cnt=n, data=read_current(spark, output))


def refresh_selection_set(spark: SparkSession, dataset: str, output: str, **arguments) -> JobResult:
    return publish_selection_set(spark, dataset, output, earlier=read_current(spark, output).columns, **arguments)


def create_definition(
    spark: SparkSession,
    selection_set: str,
    output: str,
    columns: Sequence[str] | str | None = None,
    conditions: str | None = None,
) -> JobResult:
    """Distinct rows of a selection set, blank for NULL (a source takes no conditions)."""
    rows = filter_where(project(read_current(spark, selection_set), columns), conditions)
    return _published(blank_for_null(rows.distinct()), output)


def refresh_definition(
    spark: SparkSession,
    selection_set: str,
    output: str,
    columns: Sequence[str] | str | None = None,
    conditions: str | None = None,
) -> JobResult:
    """Store a definition again; blanks are filled before the filter sees the rows."""
    rows = filter_where(blank_for_null(project(read_current(spark, selection_set), columns)), conditions)
    if set(rows.columns) != set(read_current(spark, output).columns):
        return JobResult("INVALID", "columns in both source data do not match.")
    return _published(rows, output)


def _published(rows: DataFrame, output: str) -> JobResult:
    _, n = publish(rows, output)
    return JobResult("VALID", "", n, read_current(rows.sparkSession, output))


def target_values(definition: DataFrame, columns: Sequence[str] | str | None, conditions: str | None, rows: int = 100) -> DataFrame:
    """The first distinct target rows for a picker, in a fixed order."""
    picked = filter_where(project(definition, columns), conditions).distinct()
    return picked.orderBy(*picked.columns).limit(rows)


def coverage(definition: DataFrame) -> DataFrame:
    """Number of distinct source rows a mapping has to cover."""
    return definition.distinct().agg(F.count(F.lit(1)).alias("row_cnt"))


def exposed_rowcount(dataset: DataFrame, conditions: str | None = None) -> DataFrame:
    return rowcount_status(filter_where(dataset, conditions))
