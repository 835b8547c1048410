"""The star: one StructType per stored table, its key, and the edges between tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

INT, LONG, TEXT, FLAG = IntegerType(), LongType(), StringType(), BooleanType()
UNITS, MONEY = DecimalType(18, 2), DecimalType(20, 2)
RATE, INDEX, CHECKED = DecimalType(9, 4), DecimalType(12, 4), DecimalType(20, 4)


def _table(required: dict, optional: dict | None = None) -> StructType:
    fields = [StructField(name, kind, False) for name, kind in required.items()]
    fields += [StructField(name, kind, True) for name, kind in (optional or {}).items()]
    return StructType(fields)


def _ordered(order: tuple[str, ...], struct: StructType) -> StructType:
    return StructType([struct[name] for name in order])


DIMENSIONS = {
    "dim_date": _table({
        "date_key": INT, "date": DateType(), "year_month": TEXT, "year": INT,
        "quarter": INT, "month": INT, "month_name": TEXT, "quarter_name": TEXT,
    }),
    "dim_geography": _ordered(
        ("geography_key", "geo_name", "geo_level", "province_name", "province_code",
         "arrears_region", "is_aggregate", "sort_order"),
        _table(
            {"geography_key": INT, "geo_name": TEXT, "geo_level": TEXT,
             "is_aggregate": FLAG, "sort_order": INT},
            {"province_name": TEXT, "province_code": TEXT, "arrears_region": TEXT},
        ),
    ),
    "dim_arrears_region": _ordered(
        ("arrears_region_key", "region_name", "region_code", "covers_provinces",
         "is_national", "sort_order"),
        _table(
            {"arrears_region_key": INT, "region_name": TEXT, "region_code": TEXT,
             "is_national": FLAG, "sort_order": INT},
            {"covers_provinces": TEXT},
        ),
    ),
    "dim_coverage": _ordered(
        ("coverage_key", "coverage_name", "description", "is_default"),
        _table({"coverage_key": INT, "coverage_name": TEXT, "is_default": FLAG},
               {"description": TEXT}),
    ),
    "dim_dwelling_type": _table({
        "dwelling_type_key": INT, "dwelling_type_name": TEXT, "dwelling_category": TEXT,
        "is_total": FLAG, "sort_order": INT,
    }),
    "dim_construction_stage": _table({
        "stage_key": INT, "stage_name": TEXT, "stage_short": TEXT, "stage_order": INT,
    }),
    "dim_credit_product": _ordered(
        ("credit_product_key", "product_name", "product_family", "rate_type",
         "insurance_status", "is_total"),
        _table({"credit_product_key": INT, "product_name": TEXT, "is_total": FLAG},
               {"product_family": TEXT, "rate_type": TEXT, "insurance_status": TEXT}),
    ),
    "dim_price_component": _table({"price_component_key": INT, "component_name": TEXT}),
}

FACTS = {
    "fact_housing_activity": _table(
        {"date_key": INT, "geography_key": INT, "dwelling_type_key": INT,
         "stage_key": INT, "coverage_key": INT},
        {"units": UNITS},
    ),
    "fact_market_absorption": _table(
        {"date_key": INT, "geography_key": INT, "dwelling_type_key": INT},
        {"absorptions": UNITS, "unabsorbed_inventory": UNITS},
    ),
    "fact_unoccupied_housing": _table(
        {"date_key": INT, "geography_key": INT, "dwelling_type_key": INT},
        {"unoccupied_units": UNITS},
    ),
    "fact_mortgage_arrears": _ordered(
        ("date_key", "arrears_region_key", "total_mortgages", "mortgages_in_arrears",
         "arrears_rate", "is_hidden"),
        _table({"date_key": INT, "arrears_region_key": INT, "is_hidden": FLAG},
               {"total_mortgages": LONG, "mortgages_in_arrears": LONG, "arrears_rate": RATE}),
    ),
    "fact_mortgage_originations": _table(
        {"date_key": INT, "credit_product_key": INT},
        {"funds_advanced_millions": MONEY, "outstanding_balance_millions": MONEY,
         "interest_rate": RATE},
    ),
    "fact_price_index": _table(
        {"date_key": INT, "geography_key": INT, "price_component_key": INT},
        {"index_value": INDEX},
    ),
    "fact_mortgage_rate": _table({"date_key": INT}, {"rate_5year": RATE}),
}

CHECK_RESULTS = _table({}, {
    "check_name": TEXT, "detail": TEXT, "our_value": CHECKED, "published_value": CHECKED,
    "difference": CHECKED, "passed": FLAG, "checked_at": TimestampType(),
})

VIEWS = ("pipeline_health", "what_changed", "arrears_trend")

# Everything an export contains.
EXPORTED = (*DIMENSIONS, *FACTS, *VIEWS, "check_results")

# Rows of a fact must be unique on these.
GRAIN = {
    "fact_housing_activity": ("date_key", "geography_key", "dwelling_type_key", "stage_key",
                              "coverage_key"),
    "fact_market_absorption": ("date_key", "geography_key", "dwelling_type_key"),
    "fact_unoccupied_housing": ("date_key", "geography_key", "dwelling_type_key"),
    "fact_mortgage_arrears": ("date_key", "arrears_region_key"),
    "fact_mortgage_originations": ("date_key", "credit_product_key"),
    "fact_price_index": ("date_key", "geography_key", "price_component_key"),
    "fact_mortgage_rate": ("date_key",),
}

# Natural label of each dimension, the column lookups join on.
LABEL = {
    "dim_geography": "geo_name",
    "dim_arrears_region": "region_code",
    "dim_coverage": "coverage_name",
    "dim_dwelling_type": "dwelling_type_name",
    "dim_construction_stage": "stage_name",
    "dim_credit_product": "product_name",
    "dim_price_component": "component_name",
}

# Key column of each dimension: always its first column.
KEY = {name: struct.fieldNames()[0] for name, struct in DIMENSIONS.items()}

# (dimension, fact) edges, one-to-many on the dimension's key.  An edge exists
# where a fact carries the key, so places and arrears regions stay unrelated.
RELATIONSHIPS = tuple(
    (dim, fact)
    for fact, struct in FACTS.items()
    for dim in DIMENSIONS
    if KEY[dim] in struct.fieldNames()
)
