"""The seven facts.

Labels are resolved with a left lookup, so an unknown one lands on key -1 instead
of losing the row.  Months outside the calendar are dropped on purpose.  Where a fact
aggregates, rows are summed per label first and looked up afterwards: the join then
sees one row per group instead of one per cell.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.functions.scalars import count_cell, decimal_cell, month_key_of_text
from tallystar.operators.aggregates import mean, stack, sums_by_label
from tallystar.operators.calendar import within_calendar
from tallystar.operators.lookup import constant_key, lookup_key
from tallystar.schemas import FACTS, KEY, LABEL
from tallystar.sources.tables import conform

Tables = Mapping[str, DataFrame]


def _cells(release: DataFrame, dims: Tables, month: str = "REF_DATE", **columns: Column):
    """The wanted columns of a release, with its month key, inside the calendar."""
    cells = release.select(
        month_key_of_text(month).alias("date_key"),
        *[column.alias(name) for name, column in columns.items()],
    )
    return within_calendar(cells, dims["dim_date"])


def _keyed(frame: DataFrame, dims: Tables, **labels: str) -> DataFrame:
    """Resolve ``label column`` per dimension (named without its ``dim_``)."""
    for short, label in labels.items():
        dim = f"dim_{short}"
        frame = lookup_key(frame, dims[dim], label, LABEL[dim], KEY[dim])
    return frame


HOUSING_RELEASES = (("housing_activity", vocab.TOWNS), ("housing_cma", vocab.METROS))


def housing_activity(releases: Tables, dims: Tables) -> DataFrame:
    def cells(name: str, coverage: str) -> DataFrame:
        found = _cells(
            releases[name], dims,
            geo=F.col("GEO"), dwelling=F.col("Type of unit"), stage=F.col("Housing estimates"),
            units=decimal_cell("VALUE"),
        )
        key = constant_key(dims["dim_coverage"], coverage, "coverage_name", "coverage_key")
        return found.withColumn("coverage_key", key)

    both = stack([cells(name, coverage) for name, coverage in HOUSING_RELEASES])
    keyed = _keyed(both, dims, geography="geo", dwelling_type="dwelling",
                   construction_stage="stage")
    return conform(keyed, FACTS["fact_housing_activity"])


def market_absorption(releases: Tables, dims: Tables) -> DataFrame:
    cells = _cells(
        releases["absorptions"], dims,
        geo=F.col("GEO"), dwelling=F.col("Type of dwelling unit"),
        measure=F.col("Completed dwelling units"), value=decimal_cell("VALUE"),
    )
    measures = {"absorptions": "Absorptions", "unabsorbed_inventory": "Unabsorbed inventory"}
    per_label = sums_by_label(cells, ["date_key", "geo", "dwelling"], "measure", "value", measures)
    keyed = _keyed(per_label, dims, geography="geo", dwelling_type="dwelling")
    per_key = keyed.groupBy("date_key", "geography_key", "dwelling_type_key").agg(
        *[F.sum(name).alias(name) for name in measures]
    )
    return conform(per_key, FACTS["fact_market_absorption"])


def unoccupied_housing(releases: Tables, dims: Tables) -> DataFrame:
    cells = _cells(
        releases["unoccupied"], dims,
        geo=F.col("GEO"), dwelling=F.col("Type of unit"), unoccupied_units=decimal_cell("VALUE"),
    )
    keyed = _keyed(cells, dims, geography="geo", dwelling_type="dwelling")
    return conform(keyed, FACTS["fact_unoccupied_housing"])


def mortgage_arrears(arrears: DataFrame, dims: Tables) -> DataFrame:
    """A missing count means the publisher hid it: NULL and a flag, never zero."""
    cells = _cells(
        arrears, dims, month="month",
        region=F.col("region"),
        total_mortgages=count_cell("total_mortgages"),
        mortgages_in_arrears=count_cell("mortgages_in_arrears"),
        arrears_rate=decimal_cell("arrears_rate", "decimal(9,4)"),
        is_hidden=F.col("mortgages_in_arrears").isNull(),
    )
    keyed = _keyed(cells, dims, arrears_region="region")
    return conform(keyed, FACTS["fact_mortgage_arrears"])


def mortgage_originations(releases: Tables, dims: Tables) -> DataFrame:
    """One value column, three measures: a flow, a snapshot and a rate."""
    cells = _cells(
        releases["originations"], dims,
        product=F.col("Components"), unit=F.col("Unit of measure"), value=F.col("VALUE"),
    )
    sentence = F.lower("product")
    money = decimal_cell("value", "decimal(20,2)")
    rate = F.when(F.col("unit") == "Interest rate", decimal_cell("value", "decimal(9,4)"))
    dollars = F.col("unit") == "Dollars"
    per_label = cells.groupBy("date_key", "product").agg(
        F.sum(F.when(dollars & sentence.contains("funds advanced"), money)).alias("flow"),
        F.sum(F.when(dollars & sentence.contains("outstanding"), money)).alias("snapshot"),
        F.sum(rate).alias("rate_sum"),
        F.count(rate).alias("rate_rows"),
    )
    keyed = _keyed(per_label, dims, credit_product="product")
    per_key = keyed.groupBy("date_key", "credit_product_key").agg(
        F.sum("flow").alias("funds_advanced_millions"),
        F.sum("snapshot").alias("outstanding_balance_millions"),
        F.try_divide(
            F.sum("rate_sum").cast("double"), F.sum("rate_rows").cast("double")
        ).alias("interest_rate"),
    )
    return conform(per_key, FACTS["fact_mortgage_originations"])


def price_index(releases: Tables, dims: Tables) -> DataFrame:
    cells = _cells(
        releases["price_index"], dims,
        geo=F.col("GEO"), component=F.col("New housing price indexes"),
        index_value=decimal_cell("VALUE", "decimal(12,4)"),
    )
    keyed = _keyed(cells, dims, geography="geo", price_component="component")
    return conform(keyed, FACTS["fact_price_index"])


def mortgage_rate(releases: Tables, dims: Tables) -> DataFrame:
    cells = _cells(
        releases["mortgage_rate"], dims, value=decimal_cell("VALUE", "decimal(9,4)")
    )
    monthly = cells.groupBy("date_key").agg(mean("value").alias("rate_5year"))
    return conform(monthly, FACTS["fact_mortgage_rate"])


def all_facts(releases: Tables, dims: Tables) -> dict[str, DataFrame]:
    return {
        "fact_housing_activity": housing_activity(releases, dims),
        "fact_market_absorption": market_absorption(releases, dims),
        "fact_unoccupied_housing": unoccupied_housing(releases, dims),
        "fact_mortgage_arrears": mortgage_arrears(releases["arrears"], dims),
        "fact_mortgage_originations": mortgage_originations(releases, dims),
        "fact_price_index": price_index(releases, dims),
        "fact_mortgage_rate": mortgage_rate(releases, dims),
    }
