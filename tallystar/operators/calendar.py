"""Month calendars and limiting facts to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.scalars import month_key_of_date


def describe_months(months: DataFrame, date: str = "date") -> DataFrame:
    """Calendar columns for a DataFrame holding the first day of each month."""
    d = F.col(date)
    year, quarter = F.year(d), F.quarter(d)
    return months.select(
        month_key_of_date(d).alias("date_key"),
        d.alias("date"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        year.alias("year"),
        quarter.alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.concat(year.cast("string"), F.lit(" Q"), quarter.cast("string")).alias("quarter_name"),
    )


def month_calendar(spark: SparkSession, start_month: str, end_month: str) -> DataFrame:
    """One row per month from ``start_month`` to ``end_month``, both ``'yyyy-MM'``."""
    bounds = spark.range(1).select(
        F.to_date(F.lit(f"{start_month}-01")).alias("lo"),
        F.to_date(F.lit(f"{end_month}-01")).alias("hi"),
    )
    return describe_months(expand_months(bounds, "lo", "hi"))


def expand_months(bounds: DataFrame, lo: str, hi: str) -> DataFrame:
    """Every month between two date columns, as column ``date``."""
    return bounds.select(
        F.explode(F.sequence(lo, hi, F.expr("interval 1 month"))).alias("date")
    )


def within_calendar(fact: DataFrame, calendar: DataFrame, key: str = "date_key") -> DataFrame:
    """Keep rows whose month is in the calendar.

    A calendar has one row per month, so its size is bounded and it is broadcast;
    the fact is filtered where it lies.
    """
    return fact.join(F.broadcast(calendar.select(key)), key, "left_semi")
