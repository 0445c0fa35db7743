"""Enrichment by lookup tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.headers import quoted
from ledgerloom.operators.project import within
from ledgerloom.operators.sizing import broadcast_if_small


def lookup(
    facts: DataFrame,
    table: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    take: Mapping[str, str] | Sequence[str],
    case_insensitive: bool = False,
    how: str = "left",
) -> DataFrame:
    """Fact rows with columns of a lookup table; a NULL key never matches.

    ``on`` maps fact column to lookup column, ``take`` maps lookup column to
    output name.  The table is broadcast after a size check; a larger one is
    joined by shuffle, keeping fact rows as the side that can be split.
    """
    pairs = on if isinstance(on, Mapping) else {c: c for c in on}
    taken = take if isinstance(take, Mapping) else {c: c for c in take}

    def key(column: Column) -> Column:
        return F.lower(column) if case_insensitive else column

    keys = [f"__key{i}" for i in range(len(pairs))]
    side = table.select(
        *[key(F.col(quoted(c))).alias(k) for k, c in zip(keys, pairs.values())],
        *[F.col(quoted(c)).alias(name) for c, name in taken.items()],
    )
    condition = F.lit(True)
    for k, c in zip(keys, pairs):
        condition = condition & (key(facts[quoted(c)]) == F.col(k))
    return facts.join(broadcast_if_small(side), condition, how).drop(*keys)


def fallback_lookup(
    facts: DataFrame,
    key: str,
    unknown: str,
    code: str,
    code_length: int,
    cross_reference: DataFrame,
    cross_code: str,
    cross_value: str,
    table: DataFrame,
    table_key: str,
    take: str,
    key_out: str,
    take_out: str,
) -> DataFrame:
    """Look a key up; for the unknown key find one through a code prefix first.

    ``cross_reference`` turns the first ``code_length`` characters of ``code``
    into a key, ``table`` turns a key into ``take``.
    """
    prefixed = facts.withColumn("__prefix", F.left(F.col(quoted(code)), F.lit(code_length)))
    crossed = lookup(prefixed, cross_reference, {"__prefix": cross_code}, {cross_value: "__found"})
    is_unknown = F.col(quoted(key)) == F.lit(unknown)
    named = crossed.withColumn("__key", F.when(is_unknown, F.col("__found")).otherwise(F.col(quoted(key))))
    taken = lookup(named, table, {"__key": table_key}, {take: "__taken"})
    return taken.select(
        *[F.col(quoted(c)) for c in facts.columns],
        F.col("__key").alias(key_out),
        F.col("__taken").alias(take_out),
    )


def restrict_to_keys(df: DataFrame, keys: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key columns occur in a key list; unlike types compare as text.

    A key listed twice keeps its rows twice, as a join does.
    """
    have, listed_types = dict(df.dtypes), dict(keys.dtypes)
    names = [f"__key{i}" for i in range(len(on))]
    condition, listed = F.lit(True), []
    for n, (c, k) in zip(names, on.items()):
        key, value = F.col(quoted(k)), df[quoted(c)]
        if have[c] != listed_types[k]:
            key, value = key.cast("string"), value.cast("string")
        listed.append(key.alias(n))
        condition = condition & (value == F.col(n))
    return df.join(broadcast_if_small(keys.select(*listed)), condition, "inner").drop(*names)


def period_of(parameters: DataFrame, start: str, end: str) -> tuple:
    """Both bounds of a one-row parameter relation; another number of rows is an error."""
    rows = parameters.select(start, end).limit(2).collect()
    if len(rows) != 1:
        raise ValueError("the parameter relation must hold exactly one row")
    return rows[0][0], rows[0][1]


def within_parameters(
    df: DataFrame, day: str, parameters: DataFrame, start: str, end: str, closed: bool = False
) -> DataFrame:
    """Rows inside the period of a one-row parameter relation.

    The one row is read first, so its values are literals of the filter and
    reach the file scan; no pairs are formed.
    """
    first, last = period_of(parameters, start, end)
    return df.where(within(F.col(quoted(day)), F.lit(first), F.lit(last), closed))
