"""Six questions asked of the warehouse.  Ties in a ranking are broken by name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.functions.scalars import month_of_key, percent, ratio, rounded
from tallystar.operators.aggregates import top_k
from tallystar.operators.timeseries import last_period_with_data, latest_only
from tallystar.plans.views import with_dates

Star = Mapping[str, DataFrame]
TOTAL_UNITS = "Total units"
JUNE = 6


def top_movers(what_changed: DataFrame, level: str = "Province",
               coverage: str = vocab.TOWNS, k: int = 10) -> DataFrame:
    """Places that moved housing starts most in the latest month."""
    rows = latest_only(what_changed).filter(
        (F.col("geo_level") == level) & (F.col("coverage_name") == coverage)
    )
    best = top_k(rows, k, F.abs("change_vs_last_year").desc_nulls_last(), F.col("geo_name").asc())
    return best.select(
        "year_month", "geo_name", "units", "units_last_year", "change_vs_last_year",
        rounded("percent_change", 1).alias("percent_change"),
        rounded("share_of_national_change", 1).alias("share_of_change"),
    )


def biggest_backlogs(pipeline_health: DataFrame, coverage: str = vocab.METROS,
                     k: int = 10) -> DataFrame:
    """Metro areas that would need longest to finish what is under construction.

    The month is the last one with a backlog to compare: the newest may still be open.
    """
    rows = latest_only(pipeline_health.filter(
        (F.col("coverage_name") == coverage)
        & (F.col("dwelling_type_name") == TOTAL_UNITS)
        & F.col("backlog_months").isNotNull()
    ))
    best = top_k(rows, k, F.col("backlog_months").desc(), F.col("geo_name").asc())
    return best.select(
        "year_month", "geo_name", "starts_last_12_months", "completions_last_12_months",
        rounded("completion_ratio", 2).alias("completion_ratio"), "under_construction",
        rounded("backlog_months", 1).alias("backlog_months"),
    )


def june_backlog(pipeline_health: DataFrame, from_year: int = 2015,
                 coverage: str = vocab.METROS) -> DataFrame:
    """One reading each June over all metro areas; the backlog is a ratio of sums."""
    june = pipeline_health.filter(
        (F.col("coverage_name") == coverage)
        & (F.col("dwelling_type_name") == TOTAL_UNITS)
        & (month_of_key("date_key") == JUNE)
        & (F.col("year") >= from_year)
    )
    sums = june.groupBy("year_month").agg(
        F.sum("starts_last_12_months").alias("started_last_12_months"),
        F.sum("completions_last_12_months").alias("finished_last_12_months"),
        F.sum("under_construction").alias("still_under_construction"),
    )
    pace = F.col("finished_last_12_months").cast("double") / 12
    backlog = rounded(ratio("still_under_construction", pace), 1)
    return sums.withColumn("backlog_months", backlog).orderBy("year_month")


def latest_arrears(arrears_trend: DataFrame) -> DataFrame:
    """Arrears by region in the latest month and the change on a year ago."""
    return latest_only(arrears_trend).orderBy(
        F.col("arrears_rate").desc_nulls_last(), "region_name"
    ).select(
        "year_month", "region_name", "covers_provinces", "total_mortgages",
        "mortgages_in_arrears", "arrears_rate",
        rounded("arrears_rate_last_year", 2).alias("rate_a_year_ago"),
        rounded("change_vs_last_year", 3).alias("change"),
    )


def june_arrears_and_rates(arrears_trend: DataFrame, from_year: int = 2016) -> DataFrame:
    """National arrears each June next to the rate now and 18 months before."""
    june = arrears_trend.filter(
        F.col("is_national") & (month_of_key("date_key") == JUNE) & (F.col("year") >= from_year)
    )
    return june.orderBy("year_month").select(
        "year_month", "arrears_rate",
        rounded("mortgage_rate_now", 2).alias("rate_now"),
        rounded("mortgage_rate_18_months_ago", 2).alias("rate_18_months_ago"),
    )


def unsold_homes(star: Star, k: int = 10) -> DataFrame:
    """Places with the most finished, unsold homes in the latest month."""
    fact = star["fact_market_absorption"]
    places = star["dim_geography"].filter(~F.col("is_aggregate"))
    rows = (
        fact.filter(F.col("date_key") == last_period_with_data(fact))
        .filter(F.col("unabsorbed_inventory").isNotNull())
        .join(star["dim_dwelling_type"].filter("is_total"), "dwelling_type_key", "left_semi")
        .join(places.select("geography_key", "geo_name"), "geography_key")
    )
    best = top_k(rows, k, F.col("unabsorbed_inventory").desc(), F.col("geo_name").asc())
    finished = F.col("absorptions") + F.col("unabsorbed_inventory")
    return with_dates(best, star, "year_month").select(
        "year_month", "geo_name", "absorptions", "unabsorbed_inventory",
        rounded(percent("unabsorbed_inventory", finished), 1).alias("percent_unsold"),
    )
