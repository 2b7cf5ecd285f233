"""Column expressions over dates and hours."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wickwork import constants as C


def day_name(day: Column) -> Column:
    """English weekday name."""
    return F.date_format(day, "EEEE")


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(C.WEEKEND_DAYS)


def hour_period(hour: Column) -> Column:
    """Part of the day an hour belongs to."""
    *parts, (_, rest) = C.HOUR_PERIODS
    (last_hour, label), *more = parts
    chain = reduce(lambda acc, p: acc.when(hour <= p[0], p[1]), more, F.when(hour <= last_hour, label))
    return chain.otherwise(rest)


def calendar_parts(moment: Column) -> dict[str, Column]:
    """Attributes shared by the day and the hour calendar."""
    return {
        "year": F.year(moment),
        "quarter": F.quarter(moment),
        "month": F.month(moment),
        "day": F.day(moment),
        "year_month": F.date_format(moment, C.MONTH_LABEL),
        "day_of_week": F.dayofweek(moment),
        "day_of_week_name": day_name(moment),
        "is_weekend": is_weekend(moment),
    }


def month_flags(day: Column) -> dict[str, Column]:
    """Planned day attributes: month edges, month name, ISO week."""
    return {
        "is_month_start": F.day(day) == 1,
        "is_month_end": F.last_day(day) == day,
        "month_name": F.date_format(day, "MMMM"),
        "week_of_year": F.weekofyear(day),
    }


def is_business_hour(hour: Column) -> Column:
    return hour.between(*C.BUSINESS_HOURS)
