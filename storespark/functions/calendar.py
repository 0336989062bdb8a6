"""Calendar keys of a movement date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def year_key(day: Column) -> Column:
    return F.year(day)


def iso_week(day: Column) -> Column:
    """ISO week number; shown beside the calendar year, so 2027-01-01 is year 2027, week 53."""
    return F.weekofyear(day)


def with_calendar(df: DataFrame, day: str = "movement_date") -> DataFrame:
    return df.withColumns(
        {"month": month_key(F.col(day)), "year": year_key(F.col(day)), "week": iso_week(F.col(day))}
    )


def calendar_columns(day: str = "movement_date") -> list[Column]:
    d = F.col(day)
    return [month_key(d).alias("month"), year_key(d).alias("year"), iso_week(d).alias("week")]


def date_spine(bounds: DataFrame, start: str, end: str, name: str = "movement_date") -> DataFrame:
    """One row per day of each inclusive range in ``bounds``; other columns are kept."""
    keep = [c for c in bounds.columns if c not in (start, end)]
    days = F.explode(F.expr(f"sequence({start}, {end}, interval 1 day)"))
    return bounds.filter(F.col(start) <= F.col(end)).select(*keep, days.alias(name))
