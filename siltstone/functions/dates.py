"""Parsing text dates under ANSI mode."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_MONTH_YEAR = "d/M/yyyy"


def text_to_date(column: str, fmt: str = DAY_MONTH_YEAR, strict: bool = False) -> Column:
    """``strict`` fails the query on the first bad value; otherwise it becomes NULL."""
    if strict:
        return F.to_date(F.col(column), fmt)
    # an empty text is spared the parser, which is slow to fail
    return F.try_to_date(F.nullif(F.col(column), F.lit("")), fmt)


def parse_dates(
    df: DataFrame, columns: Iterable[str], fmt: str = DAY_MONTH_YEAR, strict: bool = False
) -> DataFrame:
    """Replace text columns by dates, in place."""
    return df.withColumns({c: text_to_date(c, fmt, strict) for c in columns})


def unreadable_dates(columns: Iterable[str], fmt: str = DAY_MONTH_YEAR) -> list[Column]:
    """Aggregates, named like the columns: texts that are present but not a date."""
    return [
        F.count_if(F.col(c).isNotNull() & text_to_date(c, fmt).isNull()).alias(c) for c in columns
    ]


def date_parse_failures(
    df: DataFrame, columns: Iterable[str], fmt: str = DAY_MONTH_YEAR
) -> DataFrame:
    """Rows ``(column_name, failures)``, in one pass."""
    columns = list(columns)
    totals = df.agg(*unreadable_dates(columns, fmt))
    return totals.unpivot([], columns, "column_name", "failures")
