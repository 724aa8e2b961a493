"""Order times, launch months and calendar expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names, Monday = 0.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


# 0001-01-01 00:00:00 and 9999-12-31 23:59:59 in epoch seconds.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def order_time(c: Column) -> Column:
    """Epoch seconds (as number or text) or timestamp text; anything else is NULL.

    Numbers outside the years 1 to 9999, such as epochs in microseconds, are NULL too.
    """
    seconds = c.try_cast("bigint")
    in_range = F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds)
    text = F.when(seconds.isNull(), c.cast("string"))
    return F.coalesce(F.timestamp_seconds(in_range), F.try_to_timestamp(text))


def launch_month(order_date: Column, launch_date: Column) -> Column:
    """1 in the first calendar month after the launch, 2 in the second, ..."""
    return F.floor(F.months_between(order_date, launch_date)).cast("int") + F.lit(1)


def day_number(c: Column) -> Column:
    """Days since 1970-01-01, for integer range frames."""
    return F.unix_date(c.cast("date"))


def month_sin(d: Column) -> Column:
    return F.sin(F.month(d) * F.lit(2 * math.pi) / F.lit(12))


def month_cos(d: Column) -> Column:
    return F.cos(F.month(d) * F.lit(2 * math.pi) / F.lit(12))


def weekday_name(day: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in WEEKDAYS]), day)


def part_of_day(hour: Column) -> Column:
    return (
        F.when((hour < 5) | (hour >= 22), "late night")
        .when(hour.between(8, 19), "daytime")
        .when(hour.isNotNull(), "evening")
    )
