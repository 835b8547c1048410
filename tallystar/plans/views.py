"""The three analytical views over the star.

Filters on series keys come first and each fact is aggregated before any window, so
windows run over one row per series and month.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.functions.scalars import percent, ratio
from tallystar.operators.aggregates import exclude_aggregates, sums_by_label
from tallystar.operators.timeseries import (
    moved_months,
    rolling_sum,
    share_of_movement,
    value_months_ago,
)

Star = Mapping[str, DataFrame]

STAGE_COLUMNS = {short.lower().replace(" ", "_"): short for _, short, _ in vocab.STAGES}


def with_dates(frame: DataFrame, star: Star, *columns: str) -> DataFrame:
    """Calendar columns by month key; a calendar is bounded, so it is broadcast."""
    return frame.join(F.broadcast(star["dim_date"].select("date_key", *columns)), "date_key")


def rolling_health(
    stages: DataFrame, keys: list[str], mode: str = "calendar", month: str = "date_key"
) -> DataFrame:
    """Rolling year of starts and completions, their ratio, and the backlog in months."""
    rolled = stages.withColumns({
        "starts_last_12_months": rolling_sum("starts", keys, month, 12, mode),
        "completions_last_12_months": rolling_sum("completions", keys, month, 12, mode),
    })
    monthly_pace = F.col("completions_last_12_months").cast("double") / 12
    return rolled.withColumns({
        "completion_ratio": ratio("completions_last_12_months", "starts_last_12_months"),
        "backlog_months": ratio("under_construction", monthly_pace),
    })


def pipeline_health(star: Star, mode: str = "calendar") -> DataFrame:
    """Where building stalls: the three stages side by side with their rolling year."""
    series = ["geography_key", "coverage_key", "dwelling_type_key"]
    places = exclude_aggregates(star["dim_geography"]).select(
        "geography_key", "geo_name", "geo_level", "province_name", "arrears_region"
    )
    staged = (
        star["fact_housing_activity"]
        .join(star["dim_construction_stage"].select("stage_key", "stage_short"), "stage_key")
        .join(places.select("geography_key"), "geography_key", "left_semi")
    )
    stages = sums_by_label(staged, ["date_key", *series], "stage_short", "units", STAGE_COLUMNS)
    measured = rolling_health(stages, series, mode)
    named = (
        measured.join(places, "geography_key")
        .join(star["dim_coverage"].select("coverage_key", "coverage_name"), "coverage_key")
        .join(
            star["dim_dwelling_type"].select(
                "dwelling_type_key", "dwelling_type_name", "dwelling_category"
            ),
            "dwelling_type_key",
        )
    )
    return with_dates(named, star, "date", "year_month", "year").select(
        "date_key", "date", "year_month", "year", "geo_name", "geo_level", "province_name",
        "arrears_region", "coverage_name", "dwelling_type_name", "dwelling_category",
        "starts", "under_construction", "completions", "starts_last_12_months",
        "completions_last_12_months", "completion_ratio", "backlog_months",
    )


def what_changed(star: Star, mode: str = "calendar") -> DataFrame:
    """Starts against the same month last year, and each place's share of the movement."""
    series = ["geography_key", "coverage_key"]
    places = exclude_aggregates(star["dim_geography"]).select(
        "geography_key", "geo_name", "geo_level", "province_name"
    )
    starts = star["dim_construction_stage"].filter(F.col("stage_short") == "Starts")
    totals = star["dim_dwelling_type"].filter("is_total")
    monthly = (
        star["fact_housing_activity"]
        .join(starts, "stage_key", "left_semi")
        .join(totals, "dwelling_type_key", "left_semi")
        .join(places, "geography_key", "left_semi")
        .groupBy("date_key", *series)
        .agg(F.sum("units").alias("units"))
    )
    compared = monthly.withColumn(
        "units_last_year", value_months_ago("units", series, "date_key", 12, mode)
    ).filter(F.col("units_last_year").isNotNull())
    change = F.col("units") - F.col("units_last_year")
    named = (
        compared.withColumn("change_vs_last_year", change)
        .withColumn("percent_change", percent("change_vs_last_year", "units_last_year"))
        .join(places, "geography_key")
        .join(star["dim_coverage"].select("coverage_key", "coverage_name"), "coverage_key")
    )
    shared = share_of_movement(
        named, "change_vs_last_year", ["date_key", "coverage_key", "geo_level"],
        "share_of_national_change",
    )
    return with_dates(shared, star, "year_month", "year").select(
        "date_key", "year_month", "year", "geo_name", "geo_level", "province_name",
        "coverage_name", "units", "units_last_year", "change_vs_last_year", "percent_change",
        "share_of_national_change",
    )


def arrears_trend(star: Star, mode: str = "calendar") -> DataFrame:
    """Arrears against a year ago, with the mortgage rate now and 18 months before.

    Last year's value comes from one row per region and month, so that rows piled up on
    the Unknown region are not drawn into one window.  The rate of 18 months ago is
    looked up by calendar month in the rate table; a row lag over region rows would reach
    back two months, not eighteen.
    """
    rates = star["fact_mortgage_rate"]
    then = moved_months(rates, {"rate_5year": "mortgage_rate_18_months_ago"}, 18)
    now = rates.withColumnRenamed("rate_5year", "mortgage_rate_now")
    region_month = ["arrears_region_key", "date_key"]
    fact = star["fact_mortgage_arrears"]
    last_year = (
        fact.groupBy(*region_month)
        # Rows piled up on the Unknown region have no rate in common.
        .agg(F.when(F.count(F.lit(1)) == 1, F.max("arrears_rate")).alias("_rate"))
        .select(
            *region_month,
            value_months_ago("_rate", region_month[:1], "date_key", 12, mode).alias(
                "arrears_rate_last_year"
            ),
        )
    )
    trend = (
        fact.join(last_year, region_month)
        .withColumn("change_vs_last_year",
                    F.col("arrears_rate") - F.col("arrears_rate_last_year"))
        .join(
            star["dim_arrears_region"].select(
                "arrears_region_key", "region_name", "covers_provinces", "is_national"
            ),
            "arrears_region_key",
        )
        .join(F.broadcast(now), "date_key", "left")
        .join(F.broadcast(then), "date_key", "left")
    )
    return with_dates(trend, star, "date", "year_month", "year").select(
        "date_key", "date", "year_month", "year", "region_name", "covers_provinces",
        "is_national", "total_mortgages", "mortgages_in_arrears", "arrears_rate", "is_hidden",
        "arrears_rate_last_year", "change_vs_last_year", "mortgage_rate_now",
        "mortgage_rate_18_months_ago",
    )


def all_views(star: Star) -> dict[str, DataFrame]:
    return {
        "pipeline_health": pipeline_health(star),
        "what_changed": what_changed(star),
        "arrears_trend": arrears_trend(star),
    }
