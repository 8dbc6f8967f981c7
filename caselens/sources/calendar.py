"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens.functions import month_start, week_start, weekday_name


def days_between(first: Column, last: Column) -> Column:
    """Array of all days from ``first`` to ``last``, both included."""
    return F.sequence(first, last, F.expr("interval 1 day"))


def with_calendar_columns(days: DataFrame) -> DataFrame:
    day = F.col("date")
    return days.select(
        "date",
        week_start(day).alias("week_start"),
        month_start(day).alias("month_start"),
        weekday_name(day).alias("weekday"),
    )


def dim_date(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day in ``[start, end)``."""
    if start >= end:
        raise ValueError(f"empty calendar: {start} .. {end}")
    last = F.date_sub(F.lit(end), 1)
    return with_calendar_columns(
        spark.range(1).select(F.explode(days_between(F.lit(start), last)).alias("date"))
    )


def dim_date_covering(requests: DataFrame) -> DataFrame:
    """Calendar from the first to the last created day found in ``requests``."""
    day = F.to_date("created_date")
    span = requests.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return with_calendar_columns(
        span.select(F.explode(days_between(F.col("first"), F.col("last"))).alias("date"))
    )


def attach_calendar(enriched: DataFrame, calendar: DataFrame) -> DataFrame:
    """Join each request to its calendar row (n:1, requests without a created day are kept).

    The month is part of the join, so that a filter on calendar columns prunes the month folders of a
    written fact: what the filter leaves of the calendar names the months to read.
    """
    fact = enriched.withColumn("created_date_only", F.to_date("created_date"))
    same = (fact["created_date_only"] == calendar["date"]) & (
        fact["created_month"] == calendar["month_start"]
    )
    return fact.join(calendar, same, "left")


def in_calendar(fact: DataFrame, calendar: DataFrame, chosen: Column) -> DataFrame:
    """The requests created on the days that a condition on the calendar's columns chooses, with
    these columns."""
    days = calendar.filter(chosen)
    return attach_calendar(fact, days).filter(F.col("date").isNotNull())


def requests_per_day(fact: DataFrame) -> DataFrame:
    """Requests of all slices per calendar date; ``fact`` carries the calendar columns."""
    return fact.filter(F.col("date").isNotNull()).groupBy("date").agg(
        F.count(F.lit(1)).alias("requests")
    )
