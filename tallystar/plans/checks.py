"""The six reconciliation checks of the star, and their verdict."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.functions.scalars import detail, percent
from tallystar.operators.aggregates import stack
from tallystar.operators.reconcile import (
    comparison,
    completeness,
    score,
    totals_side_by_side,
    verdict,
)
from tallystar.plans.views import with_dates
from tallystar.schemas import CHECK_RESULTS
from tallystar.sources.tables import conform

Star = Mapping[str, DataFrame]

EXPECTED = (
    vocab.CHECK_ARREARS_TOTAL, vocab.CHECK_ARREARS_RATE, vocab.CHECK_PROVINCES,
    vocab.CHECK_DWELLINGS, vocab.CHECK_LENDING, vocab.CHECK_COMPLETE,
)


def arrears_add_up(star: Star) -> DataFrame:
    """The regions of the report against its national row."""
    rows = star["fact_mortgage_arrears"].join(
        star["dim_arrears_region"].select("arrears_region_key", "is_national"),
        "arrears_region_key",
    )
    national = F.col("is_national")
    paired = totals_side_by_side(rows, ["date_key"], "total_mortgages", ~national, national)
    paired = with_dates(paired, star, "year_month")
    return comparison(paired, vocab.CHECK_ARREARS_TOTAL, F.col("year_month"))


def arrears_rate_matches(star: Star) -> DataFrame:
    """Our rate against the printed one, row by row; catches swapped columns."""
    rows = (
        star["fact_mortgage_arrears"]
        .filter(F.col("arrears_rate").isNotNull() & F.col("mortgages_in_arrears").isNotNull())
        .join(
            star["dim_arrears_region"].select("arrears_region_key", "region_name"),
            "arrears_region_key",
        )
        .withColumn("our_value", percent("mortgages_in_arrears", "total_mortgages"))
        .withColumnRenamed("arrears_rate", "published_value")
    )
    dated = with_dates(rows, star, "year_month")
    return comparison(dated, vocab.CHECK_ARREARS_RATE, detail("year_month", "region_name"))


def provinces_add_up(star: Star) -> DataFrame:
    """Provinces against the country row of the same release."""
    starts = star["dim_construction_stage"].filter(F.col("stage_short") == "Starts")
    rows = (
        star["fact_housing_activity"]
        .join(starts, "stage_key", "left_semi")
        .join(star["dim_dwelling_type"].filter("is_total"), "dwelling_type_key", "left_semi")
        .join(
            star["dim_geography"].select("geography_key", "geo_name", "geo_level", "is_aggregate"),
            "geography_key",
        )
    )
    keys = ["date_key", "coverage_key"]
    province = (F.col("geo_level") == "Province") & ~F.col("is_aggregate")
    country = F.col("geo_name") == vocab.COUNTRY
    paired = totals_side_by_side(rows, keys, "units", province, country)
    paired = with_dates(paired, star, "year_month").join(
        star["dim_coverage"].select("coverage_key", "coverage_name"), "coverage_key"
    )
    return comparison(paired, vocab.CHECK_PROVINCES, detail("year_month", "coverage_name"))


def dwellings_add_up(star: Star, from_year: int = 2015) -> DataFrame:
    """The four dwelling categories against "All types", on all four other keys."""
    keys = ["date_key", "geography_key", "coverage_key", "stage_key"]
    rows = (
        star["fact_housing_activity"]
        .filter(F.col("date_key") >= from_year * 10000)
        .join(
            star["dim_dwelling_type"].select("dwelling_type_key", "dwelling_category", "is_total"),
            "dwelling_type_key",
        )
    )
    parts = F.col("dwelling_category").isin(*vocab.DWELLING_PARTS)
    paired = totals_side_by_side(rows, keys, "units", parts, F.col("is_total"))
    paired = (
        with_dates(paired, star, "year_month")
        .join(star["dim_geography"].select("geography_key", "geo_name"), "geography_key")
        .join(star["dim_construction_stage"].select("stage_key", "stage_short"), "stage_key")
    )
    return comparison(
        paired, vocab.CHECK_DWELLINGS, detail("year_month", "geo_name", "stage_short")
    )


def lending_adds_up(star: Star) -> DataFrame:
    """Detailed residential lending against the published subtotals."""
    residential = star["dim_credit_product"].filter(F.col("product_family") == vocab.RESIDENTIAL)
    rows = star["fact_mortgage_originations"].join(
        residential.select("credit_product_key", "is_total"), "credit_product_key"
    )
    total = F.col("is_total")
    paired = totals_side_by_side(rows, ["date_key"], "funds_advanced_millions", ~total, total)
    paired = with_dates(paired, star, "year_month")
    return comparison(paired, vocab.CHECK_LENDING, F.col("year_month"))


def nothing_lost(star: Star) -> DataFrame:
    """Rows of the main fact that found all their labels, against all its rows."""
    return completeness(
        star["fact_housing_activity"],
        ["geography_key", "dwelling_type_key", "stage_key", "coverage_key"],
        vocab.CHECK_COMPLETE, "fact_housing_activity",
    )


def all_checks(
    star: Star,
    known: Iterable[tuple[str, str]] = vocab.KNOWN_SOURCE_PROBLEMS,
    from_year: int = 2015,
) -> DataFrame:
    """Every comparison, scored.  Completeness allows no gap at all."""
    scored = stack([
        score(arrears_add_up(star), "percent"),
        score(arrears_rate_matches(star), "points"),
        score(provinces_add_up(star), "percent"),
        score(dwellings_add_up(star, from_year), "percent"),
        score(lending_adds_up(star), "percent"),
        score(nothing_lost(star), "percent", allowed=0.0),
    ])
    return verdict(scored, known)


def to_stored(results: DataFrame) -> DataFrame:
    """Results in the shape they are kept, stamped with the time of the run."""
    return conform(results.withColumn("checked_at", F.current_timestamp()), CHECK_RESULTS)
