"""Premium reports over lines of business, each with its own premium columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.headers import quoted
from ledgerloom.operators.lookup import period_of, restrict_to_keys
from ledgerloom.operators.project import within

KEYS = (
    "policy_number",
    "endorsement_number",
    "policy_effective_date",
    "policy_expiration_date",
    "transaction_effective_date",
    "commit_date",
)

# Line -> columns whose sum is the gross premium.
PREMIUM_COLUMNS = {
    "agricultural": ("coverage_premium", "terrorism_premium"),
    "commercial_auto": ("prorated_prem",),
    "inland_marine": ("prorate_premium",),
    "property": ("coverage_premium",),
    "crime": ("pro_rate",),
    "liability": ("premium",),
}


@dataclass
class Line:
    """One line of business: its transactions and its premium columns."""

    name: str
    data: DataFrame
    premium: Sequence[str]

    def gross_premium(self) -> Column:
        """Sum of the premium columns; NULL and unreadable text count as 0."""
        types = dict(self.data.dtypes)
        parts = [f"trim({quoted(c)})" if types[c] == "string" else quoted(c) for c in self.premium]
        return F.expr(" + ".join(f"coalesce(try_cast({p} AS DOUBLE), 0D)" for p in parts))


def lines_of(tables: Mapping[str, DataFrame], premium: Mapping[str, Sequence[str]] = PREMIUM_COLUMNS) -> list[Line]:
    return [Line(name, tables[name], columns) for name, columns in premium.items() if name in tables]


def transactions(lines: Sequence[Line], start: str, end: str, closed: bool = True) -> DataFrame:
    """Transactions of all lines in one shape, committed in the period."""
    last = "<=" if closed else "<"
    committed = f"policy_number IS NOT NULL AND commit_date >= DATE'{start}' AND commit_date {last} DATE'{end}'"
    parts = [
        line.data.where(committed).select(
            F.lit(line.name).alias("source_table"), *KEYS, line.gross_premium().alias("gross_premium")
        )
        for line in lines
    ]
    return reduce(DataFrame.unionByName, parts)


def premium_report(
    lines: Sequence[Line], start: str, end: str, closed: bool = True, reference_compat: bool = False
) -> DataFrame:
    """Gross premium per transaction.

    ``reference_compat`` leaves the expiration date out of the output and then
    drops equal rows, as the original report does; by default it stays, so no
    two transactions collapse.
    """
    totals = (
        transactions(lines, start, end, closed)
        .groupBy(*KEYS)
        .agg(F.sum("gross_premium").alias("total_gross_premium"))
    )
    day = lambda c: F.date_format(c, "MM-dd-yyyy")
    shown = totals.select(
        "policy_number",
        "endorsement_number",
        day("policy_effective_date").alias("policy_effective_date"),
        day("policy_expiration_date").alias("policy_expiration_date"),
        day("transaction_effective_date").alias("transaction_effective_date"),
        day("commit_date").alias("commit_datetime"),
        "total_gross_premium",
    )
    return shown.drop("policy_expiration_date").distinct() if reference_compat else shown


def premium_by_line(lines: Sequence[Line], policies: DataFrame, parameters: DataFrame, closed: bool = True) -> DataFrame:
    """Premium per line, policy, endorsement and day for a policy list and a period.

    ``policies`` holds policy_number and endorsement_number, ``parameters`` one
    row with start_date and end_date.
    """
    start, end = (F.lit(d) for d in period_of(parameters, "start_date", "end_date"))
    keys = {"policy_number": "policy_number", "endorsement_number": "endorsement_number"}
    committed = [
        line.data.where(within(F.col("commit_date"), start, end, closed)).select(
            F.lit(line.name).alias("source_table"),
            "policy_number",
            "endorsement_number",
            "commit_date",
            line.gross_premium().alias("gross_premium"),
        )
        for line in lines
    ]
    # The period is filtered in each line's scan; the policy list meets all lines in one join.
    return (
        restrict_to_keys(reduce(DataFrame.unionByName, committed), policies, keys)
        .groupBy("source_table", "policy_number", "endorsement_number", "commit_date")
        .agg(F.sum("gross_premium").alias("total_gross_premium"))
        .orderBy("source_table", "commit_date")
    )
