"""Dates, periods and durations. Instants are UTC; the session time zone is expected to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_text(at: Column) -> Column:
    return F.year(at).cast("string")


def month_text(at: Column) -> Column:
    return F.lpad(F.month(at).cast("string"), 2, "0")


def year_month(year: Column, month: Column) -> Column:
    return F.concat(year, F.lit("-"), F.lpad(month, 2, "0"))


def leading_year_month(period: Column) -> Column:
    """``yyyy-MM`` at the start of the text, NULL if the text does not start that way."""
    return F.nullif(F.regexp_extract(period, r"^(\d{4}-\d{2})", 1), F.lit(""))


def period_key(period: Column | None, captured: Column | None) -> Column:
    """Reporting month: given text as ``yyyy-MM…`` or ``October 1, 2023``, else the capture month."""
    options = []
    if period is not None:
        options.append(leading_year_month(period))
        spelled = F.when(period.rlike(r"^[A-Za-z]+ \d{1,2}, \d{4}$"), period)
        options.append(F.date_format(F.try_to_timestamp(spelled, F.lit("MMMM d, yyyy")), "yyyy-MM"))
    if captured is not None:
        options.append(F.date_format(captured, "yyyy-MM"))
    return F.coalesce(*options, F.lit("unknown"))


def hour_boundaries(start: Column, end: Column) -> Column:
    """Number of full-hour marks between two instants, negative if ``end`` comes first."""
    marks = [F.unix_seconds(F.date_trunc("HOUR", at)) for at in (start, end)]
    return ((marks[1] - marks[0]) / 3600).cast("bigint")


def day_boundaries(start: Column, end: Column) -> Column:
    return F.datediff(end.cast("date"), start.cast("date"))


def lag_micros(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def lag_hours(start: Column, end: Column) -> Column:
    return lag_micros(start, end) / F.lit(3.6e9)


def date_key(at: Column) -> Column:
    return F.date_format(at, "yyyyMMdd").try_cast("int")


def calendar_parts(day: Column) -> dict[str, Column]:
    """Columns of a calendar dimension for a date column."""
    weekday = F.dayofweek(day) - 1
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day).cast("smallint"),
        "quarter": F.quarter(day).cast("smallint"),
        "month": F.month(day).cast("smallint"),
        "month_name": F.date_format(day, "MMMM"),
        "day_of_month": F.dayofmonth(day).cast("smallint"),
        "day_of_week": weekday.cast("smallint"),
        "day_name": F.date_format(day, "EEEE"),
        "week_of_year": F.weekofyear(day).cast("smallint"),
        "is_weekend": weekday.isin(0, 6),
        "is_month_start": F.dayofmonth(day) == 1,
        "is_month_end": day == F.last_day(day),
    }
