"""Projections, filters and user-supplied SQL text."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.headers import quoted


def given(text: str | None) -> bool:
    """True when an optional text argument holds something (``null`` is nothing)."""
    return text is not None and text.strip() not in ("", "null")


def project(df: DataFrame, columns: Sequence[str] | str | None = None) -> DataFrame:
    """The listed columns; everything when the list is empty, ``*`` or ``null``."""
    if isinstance(columns, str):
        columns = columns.split(",")
    names = [c.strip() for c in columns or []]
    if not names or names[0] in ("", "null", "*"):
        return df
    return df.select(*[c if c.startswith("`") else quoted(c) for c in names])


def filter_where(df: DataFrame, condition: str | None) -> DataFrame:
    """Rows that satisfy a SQL predicate text; no text, no filter."""
    return df.where(condition) if given(condition) else df


def full_query(df: DataFrame, query: str, name: str = "dataset") -> DataFrame:
    """A whole SQL query over the frame, which it calls ``dataset``.

    The name is bound inside the text alone: a view of that name that the user has
    is neither read nor replaced, and calls at once don't meet.  ``dataset`` has to be
    free as a name of the query's own common table expressions.
    """
    spark = df.sparkSession
    text = query.strip().rstrip(";")
    # A frame given to a query is bound by a name that nobody else knows, while its text is analyzed.
    parts = text.replace("{", "{{").replace("}", "}}")
    bound = f"WITH {quoted(name)} AS (SELECT * FROM {{{name}}}) "
    start = re.match(r"(?is)((?:\s|--[^\n]*\n|/\*.*?\*/)*)with\s+", parts)
    if start is None:
        return spark.sql(bound + parts, **{name: df})
    return spark.sql(parts[: start.end()] + bound.removeprefix("WITH ").rstrip() + ", " + parts[start.end() :], **{name: df})


def expression_column(df: DataFrame, expression: str, name: str) -> DataFrame:
    """All columns plus one computed from SQL text."""
    return df.select("*", F.expr(expression).alias(name))


def case_override(looked_up: Column, code: Column, replacements: Mapping[str, str | Column]) -> Column:
    """The looked-up value unless the code has a value of its own."""
    out = looked_up
    for value, replacement in replacements.items():
        out = F.when(code == F.lit(value), replacement if isinstance(replacement, Column) else F.lit(replacement)).otherwise(out)
    return out


def any_present(columns: Iterable[str]) -> Column:
    """True when at least one of the columns is not NULL."""
    return F.coalesce(*[F.col(quoted(c)).cast("string") for c in columns]).isNotNull()


def within(day: Column, start: Column, end: Column, closed: bool = True) -> Column:
    """Period test, closed on both ends or half open."""
    return (day >= start) & ((day <= end) if closed else (day < end))


def drop_embedded_headers(df: DataFrame, labels: Mapping[str, str] | None = None) -> DataFrame:
    """Rows whose values repeat the header are not data.

    With labels (column -> header text) a row goes when any labelled column
    holds its header text; without, when every column holds its own name.
    """
    if labels:
        tests = [F.coalesce(F.col(quoted(c)) == F.lit(text), F.lit(False)) for c, text in labels.items()]
        is_header = tests[0]
        for t in tests[1:]:
            is_header = is_header | t
    else:
        is_header = F.lit(True)
        for c in df.columns:
            is_header = is_header & F.coalesce(F.col(quoted(c)) == F.lit(c), F.lit(False))
    return df.where(~is_header)
