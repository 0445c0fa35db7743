"""Dates, numbers and text values as they arrive in landing files.

ANSI mode stays on: every parse is a ``try_`` expression, so a bad value turns
into NULL instead of stopping the job.
"""

from __future__ import annotations

import datetime as dt
import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.headers import quoted

ISO_DATE = "yyyy-MM-dd"
# Day zero of the serial dates that spreadsheets write.
SERIAL_EPOCH = "1899-12-30"
OPEN_END_DATE = "9999-12-31 00:00:00"


def parse_dates(df: DataFrame, columns: Iterable[str], fmt: str = ISO_DATE) -> DataFrame:
    """Turn the named text columns into DATE; the others keep type and place."""
    wanted = set(columns)
    return df.select(
        *[
            F.try_to_date(F.col(quoted(c)), fmt).alias(c) if c in wanted else F.col(quoted(c))
            for c in df.columns
        ]
    )


# A year without a day, as text or as a number.
_BARE_YEAR = r"^(?:19|20)\d{2}(\.0+)?$"
_TIME = r"(?:\s+\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:\s*[AaPp][Mm])?)?$"
# Two-digit years from here on are of the last century.
LAST_CENTURY_FROM = 70


def repaired_date(text: Column) -> Column:
    """DATE from ISO, US, ``ddMMMyyyy`` or spreadsheet-serial text, else NULL.

    A US date may have a time, which is left out, and a year of two digits: 70 to 99
    are of the last century.  A year alone is no date, nor is it a serial number, and
    serial numbers begin at 1; ``date_reject`` tells what such text is.
    """
    value = F.trim(text)
    serial = F.when(
        value.rlike(r"^[0-9]{1,6}(\.0+)?$") & ~value.rlike(_BARE_YEAR), F.nullif(value.try_cast("double").cast("int"), F.lit(0))
    )
    # Month, day and year in the order that a cast reads.
    long = F.regexp_replace(value, r"^(\d{1,2})/(\d{1,2})/(\d{4})" + _TIME, "$3-$1-$2")
    day = F.regexp_extract(value, r"^(\d{1,2}/\d{1,2}/)\d{2}" + _TIME, 1)
    short = F.regexp_extract(value, r"^\d{1,2}/\d{1,2}/(\d{2})" + _TIME, 1)
    century = F.when(short.try_cast("int") >= LAST_CENTURY_FROM, "19").otherwise("20")
    slashed = F.coalesce(
        F.when(long != value, long.try_cast("date")),
        F.when(short != "", F.try_to_date(F.concat(day, century, short), "M/d/yyyy")),
    )
    # Text without the mark of a form is not matched with its expression.
    return F.coalesce(
        F.when(value.contains("-") & value.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(value, 1, 10).try_cast("date")),
        F.when(value.contains("/"), slashed),
        F.when(value.rlike(r"^(?i)\d{2}[a-z]{3}\d{4}$"), F.try_to_date(F.initcap(value), "ddMMMyyyy")),
        F.date_add(F.lit(SERIAL_EPOCH).cast("date"), serial),
    )


def date_reject(text: Column) -> Column:
    """Why text gives no date: ``year`` for a year alone, else ``unreadable``; NULL for a date, and for no text."""
    value = F.trim(text)
    return F.when((F.length(value) > 0) & repaired_date(text).isNull(), F.when(value.rlike(_BARE_YEAR), "year").otherwise("unreadable"))


def number_reject(text: Column) -> Column:
    """``unreadable`` for text that is no number; NULL for a number, and for no text."""
    return F.when((F.length(F.trim(text)) > 0) & parsed_number(text).isNull(), "unreadable")


REJECTS = "_rejects"


def typed(df: DataFrame, dates: Iterable[str] = (), numbers: Iterable[str] = ()) -> DataFrame:
    """The named text columns as DATE or DOUBLE, and what they lost: ``_rejects``, an array of column, raw text and reason.

    Rows are read once; ``rejects`` gives the array as rows, ``drop("_rejects")`` the typed rows alone.
    """
    dates, numbers = list(dates), list(numbers)
    lost = [
        F.when(reason.isNotNull(), F.struct(F.lit(c).alias("column"), F.col(quoted(c)).alias("raw"), reason.alias("reason")))
        for c, reason in [(c, date_reject(F.col(quoted(c)))) for c in dates]
        + [(c, number_reject(F.col(quoted(c)))) for c in numbers]
    ]
    values = {c: repaired_date(F.col(quoted(c))) for c in dates} | {c: parsed_number(F.col(quoted(c))) for c in numbers}
    none = F.from_json(F.lit("[]"), "array<struct<column: string, raw: string, reason: string>>")
    return df.select(
        *[values[c].alias(c) if c in values else F.col(quoted(c)) for c in df.columns],
        (F.array_compact(F.array(*lost)) if lost else none).alias(REJECTS),
    )


def rejects(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """``column, raw, reason`` of every value that ``typed`` could not read, with the kept columns of its row."""
    return df.select(*[F.col(quoted(c)) for c in keep], F.explode(REJECTS).alias("__lost")).select(*keep, "__lost.*")


def normalize_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    wanted = set(columns)
    return df.select(
        *[
            repaired_date(F.col(quoted(c))).alias(c) if c in wanted else F.col(quoted(c))
            for c in df.columns
        ]
    )


def month_end(reference: Column | dt.date | str, months_back: int = 1) -> Column:
    """Last day of the month ``months_back`` months before the reference date."""
    day = reference if isinstance(reference, Column) else F.lit(str(reference))
    return F.last_day(F.add_months(day.cast("date"), -months_back))


def month_end_date(reference: dt.date, months_back: int = 1) -> dt.date:
    """The same rule for a driver-side value, used in file names."""
    months = reference.year * 12 + reference.month - 1 - months_back
    first_of_next = dt.date((months + 1) // 12, (months + 1) % 12 + 1, 1)
    return first_of_next - dt.timedelta(days=1)


def date_in_name(name: Column) -> Column:
    """DATE from the first eight-digit run of a file name."""
    return F.try_to_date(F.regexp_extract(name, r"(\d{8})", 1), "yyyyMMdd")


def parsed_number(text: Column) -> Column:
    """DOUBLE from text; blank or unreadable text is NULL."""
    return F.trim(text).try_cast("double")


def percent_as_fraction(text: Column) -> Column:
    return parsed_number(text) / F.lit(100.0)


def filled(column: Column) -> Column:
    return F.coalesce(column.cast("double"), F.lit(0.0))


def stringified(df: DataFrame) -> DataFrame:
    """Every column as STRING; dates and times as ``yyyy-MM-dd HH:mm:ss.SSSSSS``."""
    out = []
    for field in df.schema.fields:
        column = F.col(quoted(field.name))
        if isinstance(field.dataType, T.TimestampNTZType):
            # Text of the wall clock itself: no session time zone is involved.
            text = column.cast("string")
            column = F.concat(
                F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0")
            )
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DateType):
            column = F.concat(column.cast("string"), F.lit(" 00:00:00.000000"))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            column = F.to_json(column)
        elif not isinstance(field.dataType, T.StringType):
            column = column.cast("string")
        out.append(column.alias(field.name))
    return df.select(*out)


def blank_for_null(df: DataFrame) -> DataFrame:
    """NULL text becomes ``""``; other types are left alone."""
    return df.fillna("")


def clean_rows(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL first column; put line breaks of text columns on one line."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    kept = df.where(F.col(quoted(df.columns[0])).isNotNull())
    return kept.select(
        *[
            F.replace(F.col(quoted(c)), F.lit("\n"), F.lit(", ")).alias(c) if c in text else F.col(quoted(c))
            for c in df.columns
        ]
    )


@F.pandas_udf(T.StringType())
def _normalized(text: pd.Series) -> pd.Series:
    return text.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


def nfc(text: str | Column) -> Column:
    """Unicode NFC; Spark has no built-in for it.

    ASCII text is already normal and stays in the JVM; only the rest goes to
    Python, in Arrow batches.
    """
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(_normalized(F.when(column.rlike(r"[^\x00-\x7F]"), column)), column)
