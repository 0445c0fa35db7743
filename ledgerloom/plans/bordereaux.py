"""Bordereaux load: files of many lines and years to one clean, growing table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions.headers import HEADER_ALIASES
from ledgerloom.functions.values import normalize_dates, parse_dates, typed
from ledgerloom.operators.combine import dedup_rows
from ledgerloom.operators.project import drop_embedded_headers
from ledgerloom.sinks.tables import append_evolving
from ledgerloom.sources.files import LINES, grid_load, parquet_evolving

# The date columns of every line.
DATE_COLUMNS = ("policy_effective_date", "policy_expiration_date", "transaction_effective_date", "commit_date")
# Header text found inside the data.
EMBEDDED_HEADERS = {"policy_effective_date": "Policy Effective Date"}


def clean_bordereaux(
    raw: DataFrame,
    dates: Sequence[str] = DATE_COLUMNS,
    headers: Mapping[str, str] = EMBEDDED_HEADERS,
    repair: bool = True,
    keep_rejects: bool = False,
) -> DataFrame:
    """No header rows, no duplicate rows, dates as DATE (repaired or strictly ISO).

    With ``keep_rejects`` dates are repaired and what could not be read is in ``_rejects``.
    """
    known = [c for c in dates if c in raw.columns]
    labels = {c: t for c, t in headers.items() if c in raw.columns}
    rows = dedup_rows(drop_embedded_headers(raw, labels) if labels else raw)
    if keep_rejects:
        return typed(rows, known)
    return normalize_dates(rows, known) if repair else parse_dates(rows, known)


def bordereaux_load(
    spark: SparkSession,
    root: str,
    table: str,
    lines: Sequence[str] = LINES,
    years: Sequence[int] | None = None,
    repair: bool = True,
    variant: str = "",
    aliases: Mapping[str, str] = HEADER_ALIASES,
) -> DataFrame:
    """Append the cleaned grid (one variant of its files) to a table partitioned by line; returns the whole table."""
    grid = grid_load(spark, root, lines, years, variant=variant, aliases=aliases)
    cleaned = clean_bordereaux(grid, repair=repair)
    append_evolving(cleaned, table, ["line"])
    return parquet_evolving(spark, table)
