"""The eight dimensions.  Each carries an Unknown member with key -1."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.functions import labels
from tallystar.operators.calendar import month_calendar
from tallystar.operators.lookup import (
    distinct_labels,
    literal_frame,
    pick,
    surrogate_key,
    with_unknown,
)
from tallystar.schemas import DIMENSIONS
from tallystar.sources.releases import with_column, with_prefix
from tallystar.sources.tables import conform

Releases = Mapping[str, DataFrame]


def dim_date(
    spark: SparkSession, end_month: str, start_month: str = vocab.START_MONTH
) -> DataFrame:
    """Months up to an explicit end, so that a rerun gives the same table."""
    return month_calendar(spark, start_month, end_month)


def dim_geography(releases: Releases) -> DataFrame:
    names = distinct_labels(with_column(releases, "GEO"), "geo_name")
    return number_places(names)


def number_places(names: DataFrame) -> DataFrame:
    """Classify and number place labels held in column ``geo_name``."""
    described = labels.with_place(names, "geo_name")
    keyed = surrogate_key(described, "geography_key", ["sort_order", "geo_name"])
    return with_unknown(
        conform(keyed, DIMENSIONS["dim_geography"]),
        {"geography_key": vocab.UNKNOWN_KEY, "geo_name": "Unknown", "geo_level": "Unknown",
         "is_aggregate": False, "sort_order": 9999},
    )


def _literal(spark: SparkSession, table: str, rows: list[tuple], unknown: dict) -> DataFrame:
    keyed = [(i, *row) for i, row in enumerate(rows, start=1)]
    return with_unknown(literal_frame(spark, keyed, DIMENSIONS[table]), unknown)


def dim_arrears_region(spark: SparkSession) -> DataFrame:
    return _literal(
        spark, "dim_arrears_region", list(vocab.ARREARS_REGIONS),
        {"arrears_region_key": vocab.UNKNOWN_KEY, "region_name": "Unknown",
         "region_code": "UNKNOWN", "is_national": False, "sort_order": 999},
    )


def dim_coverage(spark: SparkSession) -> DataFrame:
    return _literal(
        spark, "dim_coverage", list(vocab.COVERAGES),
        {"coverage_key": vocab.UNKNOWN_KEY, "coverage_name": "Unknown", "is_default": False},
    )


def dim_construction_stage(spark: SparkSession) -> DataFrame:
    return _literal(
        spark, "dim_construction_stage", list(vocab.STAGES),
        {"stage_key": vocab.UNKNOWN_KEY, "stage_name": "Unknown", "stage_short": "Unknown",
         "stage_order": 9},
    )


def dim_dwelling_type(releases: Releases) -> DataFrame:
    names = distinct_labels(with_prefix(releases, "Type of"), "dwelling_type_name")
    return number_dwellings(names)


def number_dwellings(names: DataFrame) -> DataFrame:
    """Harmonise and number dwelling labels held in column ``dwelling_type_name``."""
    described = names.withColumn("_type", labels.dwelling("dwelling_type_name")).select(
        "dwelling_type_name",
        *pick(F.col("_type"), "dwelling_category", "is_total", "sort_order"),
    )
    keyed = surrogate_key(described, "dwelling_type_key", ["sort_order", "dwelling_type_name"])
    return with_unknown(
        conform(keyed, DIMENSIONS["dim_dwelling_type"]),
        {"dwelling_type_key": vocab.UNKNOWN_KEY, "dwelling_type_name": "Unknown",
         "dwelling_category": "Unknown", "is_total": False, "sort_order": 999},
    )


def dim_price_component(releases: Releases) -> DataFrame:
    names = distinct_labels(
        [(releases["price_index"], "New housing price indexes")], "component_name"
    )
    keyed = surrogate_key(names, "price_component_key", ["component_name"])
    return with_unknown(
        conform(keyed, DIMENSIONS["dim_price_component"]),
        {"price_component_key": vocab.UNKNOWN_KEY, "component_name": "Unknown"},
    )


def dim_credit_product(releases: Releases) -> DataFrame:
    names = distinct_labels([(releases["originations"], "Components")], "product_name")
    return number_products(names)


def number_products(names: DataFrame) -> DataFrame:
    """Classify and number product sentences held in column ``product_name``."""
    described = names.withColumn("_product", labels.credit_product("product_name")).select(
        "product_name",
        *pick(F.col("_product"), "product_family", "rate_type", "insurance_status", "is_total"),
    )
    keyed = surrogate_key(described, "credit_product_key", ["product_name"])
    return with_unknown(
        conform(keyed, DIMENSIONS["dim_credit_product"]),
        {"credit_product_key": vocab.UNKNOWN_KEY, "product_name": "Unknown", "is_total": False},
    )


def all_dims(
    spark: SparkSession,
    releases: Releases,
    end_month: str,
    start_month: str = vocab.START_MONTH,
) -> dict:
    """Builders per dimension, called when the caller is ready to store the result."""
    return {
        "dim_date": lambda: dim_date(spark, end_month, start_month),
        "dim_geography": lambda: dim_geography(releases),
        "dim_arrears_region": lambda: dim_arrears_region(spark),
        "dim_coverage": lambda: dim_coverage(spark),
        "dim_dwelling_type": lambda: dim_dwelling_type(releases),
        "dim_construction_stage": lambda: dim_construction_stage(spark),
        "dim_credit_product": lambda: dim_credit_product(releases),
        "dim_price_component": lambda: dim_price_component(releases),
    }
