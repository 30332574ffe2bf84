"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def date_key(day: Column) -> Column:
    """``YYYYMMDD`` as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def monday_week(day: Column) -> Column:
    """Week 0-53 inside the calendar year; week 1 is the first with 4 days of it."""
    return F.floor((F.dayofyear(day) - (F.weekday(day) + 1) + 10) / 7).cast("int")


def sunday_week(day: Column) -> Column:
    """Week of the year, weeks from Sunday, 1 January always in week 1."""
    first_weekday = F.dayofweek(F.trunc(day, "year"))
    return F.floor((F.dayofyear(day) + first_weekday - 2) / 7).cast("int") + 1


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def month_label(day: Column) -> Column:
    """``YYYY-MM``."""
    return F.date_format(day, "yyyy-MM")


def week_label(day: Column) -> Column:
    """Monday and Sunday of the week as ``start/end``."""
    monday = F.trunc(day, "week")
    return F.concat_ws("/", monday.cast("string"), F.date_add(monday, 6).cast("string"))


def weekday_position(day_name: Column) -> Column:
    """1 for Monday to 7 for Sunday, to sort by weekday name."""
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), day_name)


def with_calendar(df: DataFrame, day: str = "order_date") -> DataFrame:
    """Add the calendar columns that the queries group by."""
    d = F.col(day)
    return df.withColumns(
        {
            "year": F.year(d),
            "month": F.month(d),
            "month_name": F.date_format(d, "MMM"),
            "quarter": F.quarter(d),
            "week_number": F.weekofyear(d),
            "day_name": F.date_format(d, "EEEE"),
        }
    )
