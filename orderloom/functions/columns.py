"""Small column expressions shared by the operators.

Ratios are taken in double precision after exact decimal sums, so a plan gives the same digits
whatever the partitioning was.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels shown in place of a missing name.
UNCLASSIFIED = "Chưa phân loại"
UNKNOWN_PLACE = "Không xác định"
UNKNOWN_COLOR = "Không rõ"
NOT_AVAILABLE = "N/A"


def labelled(name: str, text: str) -> Column:
    return F.coalesce(F.col(name), F.lit(text)).alias(name)


def first_rows(df: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows of an ordered report, ``None`` for all."""
    return df if n is None else df.limit(n)


def code_order(code) -> Column:
    """Order of generated codes: by what stands before the last digits, then by their number, then as text."""
    text = (F.col(code) if isinstance(code, str) else code).cast("string")
    digits = F.regexp_extract(text, r"(\d{1,18})$", 1)
    number = F.coalesce(F.nullif(digits, F.lit("")).cast("long"), F.lit(-1))
    return F.when(text.isNotNull(), F.struct(F.regexp_replace(text, r"\d{1,18}$", ""), number, text))


def as_double(value) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def ratio(part, whole) -> Column:
    """``part / whole`` as double, NULL on a zero base."""
    return as_double(part) / F.nullif(as_double(whole), F.lit(0.0))


def pct(part, whole, scale: int = 1) -> Column:
    """Percentage, half away from zero (SQL ROUND)."""
    return F.round(ratio(part, whole) * 100.0, scale)


def pct_even(part, whole, scale: int = 1) -> Column:
    """Percentage, half to even (data-frame rounding)."""
    return F.bround(ratio(part, whole) * 100.0, scale)


def pct_change(new, old, scale: int = 1) -> Column:
    return F.round(100.0 * (as_double(new) - as_double(old)) / F.nullif(as_double(old), F.lit(0.0)), scale)


def nearest(value) -> Column:
    """Nearest integer, halves towards plus infinity (what a browser shows)."""
    return F.floor(as_double(value) + 0.5).cast("bigint")


def sum_when(condition: Column, value: str) -> Column:
    """Conditional sum; NULL when no row qualifies."""
    return F.sum(F.when(condition, F.col(value)))


def in_month(year: int, month: int) -> Column:
    return (F.col("fiscal_year") == year) & (F.col("fiscal_month") == month)


def in_quarter(year: int, quarter: int) -> Column:
    return (F.col("fiscal_year") == year) & (F.col("fiscal_quarter") == quarter)


def of_month(df: DataFrame, year: int, month: int, date: str = "order_date") -> DataFrame:
    """Rows of a month: by the calendar columns where the table is stored by them, else by a range of dates,
    which a scan can use too."""
    if {"fiscal_year", "fiscal_month"} <= set(df.columns):
        return df.where(in_month(year, month))
    first, after = dt.date(year, month, 1), dt.date(year + month // 12, month % 12 + 1, 1)
    return df.where((F.col(date) >= F.lit(first)) & (F.col(date) < F.lit(after)))


def month_label(date: Column) -> Column:
    return F.date_format(F.trunc(date, "month"), "MM/yyyy")


def total_of(df: DataFrame, column: str) -> Column:
    """The grand total of a column as a scalar subquery: one row, no join, no global window."""
    return df.agg(F.sum(column).alias("total")).scalar()
