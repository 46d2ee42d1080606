"""Date parsing and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_mixed_date(text: Column) -> Column:
    """`yyyy-MM-dd` or `dd-MM-yyyy`, told apart by the width of the first part; anything else NULL."""
    clean = F.trim(text.cast("string"))
    width = F.length(F.split(clean, "-", 2)[0])
    return (
        F.when(width == 4, F.try_to_date(clean, "yyyy-M-d"))
        .when(width == 2, F.try_to_date(clean, "d-M-yyyy"))
    )


def parse_us_date(text: Column) -> Column:
    """Month/day/year text, NULL where it does not parse."""
    return F.try_to_date(text, "M/d/yyyy")


def month_key(day: Column) -> Column:
    """`yyyy-MM`."""
    return F.date_format(day, "yyyy-MM")


def month_number(day: Column) -> Column:
    """Months since year 0, so that the distance of two months is a subtraction."""
    return F.year(day) * 12 + F.month(day)


def week_key(day: Column) -> Column:
    """`yyyy-WW`: weeks start on Monday and days before the first Monday are week 00 (not ISO)."""
    week = F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7)
    return F.concat_ws("-", F.lpad(F.year(day).cast("string"), 4, "0"), F.lpad(week.cast("string"), 2, "0"))


def age_in_years(born: Column, as_of: Column) -> Column:
    """Whole years between two dates."""
    return F.floor(F.months_between(as_of, born) / 12).cast("int")
