"""Weekday calendar (Monday to Friday, no holidays)."""

from pyspark.sql import Column, functions as F


def next_trading_day(day: Column) -> Column:
    """The first Monday-to-Friday date after ``day``."""
    weekday = F.weekday(day)  # Monday is 0
    step = F.when(weekday == 4, 3).when(weekday == 5, 2).otherwise(1)
    return F.date_add(day, step)


def business_days(first: Column, last: Column) -> Column:
    """Weekdays from ``first`` to ``last``, both included; 0 for an empty range.

    Closed form, so a long range does not build an array: whole weeks hold
    five, and the rest is the weekday position, cut off at five, at both ends.
    """
    monday_of_first = F.date_sub(first, F.weekday(first))
    monday_of_last = F.date_sub(last, F.weekday(last))
    weeks = F.datediff(monday_of_last, monday_of_first) / F.lit(7)
    before_first = F.least(F.weekday(first), F.lit(5))
    upto_last = F.least(F.weekday(last) + 1, F.lit(5))
    days = (weeks * 5 - before_first + upto_last).cast("bigint")
    return F.when(first <= last, days).when(first > last, F.lit(0).cast("bigint"))


def business_day_sequence(first: Column, last: Column) -> Column:
    """Array of the weekdays in the range (empty when it is)."""
    days = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))
    return F.filter(days, lambda d: F.weekday(d) < 5)


def version_string(ticker: Column, at: Column) -> Column:
    """``<ticker>_v<yyyyMMdd>T<HHmmss>``."""
    return F.concat(ticker, F.lit("_v"), F.date_format(at, "yyyyMMdd'T'HHmmss"))
