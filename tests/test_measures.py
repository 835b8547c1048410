"""Measures on a star small enough to work out by hand."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.operators.calendar import month_calendar
from tallystar.plans import measures as m
from tallystar.schemas import CHECK_RESULTS, DIMENSIONS, FACTS
from tests.conftest import tuples

ON, QC, CANADA, TORONTO = 1, 2, 3, 4
SINGLE, ROW, TOTAL = 1, 2, 3
STARTS, OPEN, BUILT = 1, 2, 3
TOWNS, METROS = 1, 2


def frame(spark, table, rows):
    schema = {**DIMENSIONS, **FACTS, "check_results": CHECK_RESULTS}[table]
    return spark.createDataFrame(rows, schema)


def d(x):
    return None if x is None else Decimal(x)


@pytest.fixture(scope="module")
def star(spark):
    housing = []
    for i in range(24):
        key = (2019 + i // 12) * 10000 + (i % 12 + 1) * 100 + 1
        for place, scale in ((ON, 1), (QC, 2)):
            for kind, part in ((SINGLE, 1), (ROW, 2), (TOTAL, 3)):
                for stage, base in ((STARTS, 10 + i), (OPEN, 100), (BUILT, 5)):
                    housing.append((key, place, kind, stage, TOWNS, d(base * scale * part)))
        housing.append((key, CANADA, TOTAL, STARTS, TOWNS, d((10 + i) * 9)))
        housing.append((key, TORONTO, TOTAL, STARTS, METROS, d(4)))
    arrears = []
    for i, late in enumerate((1, 2, 3, 6)):
        key = 20200101 + i * 100
        arrears += [(key, 1, 1000, 10 * late, None, False), (key, 2, 100, None, None, True),
                    (key, 3, 1100, 10 * late, None, False)]
    lending = []
    for i in range(2):
        key = 20200101 + i * 100
        lending += [(key, 1, d(60), d(600), d(4)), (key, 2, d(40), d(400), d(6)),
                    (key, 3, d(100), d(1000), None), (key, 4, d(999), None, d(9))]
    return {
        "dim_date": month_calendar(spark, "2018-01", "2021-12"),
        "dim_geography": frame(spark, "dim_geography", [
            (ON, "Ontario", "Province", "Ontario", "ON", "ONTARIO", False, 20),
            (QC, "Quebec", "Province", "Quebec", "QC", "QUEBEC", False, 20),
            (CANADA, "Canada", "Country", None, None, None, True, 0),
            (TORONTO, "Toronto, Ontario", "CMA", "Ontario", "ON", "ONTARIO", False, 40)]),
        "dim_dwelling_type": frame(spark, "dim_dwelling_type", [
            (SINGLE, "single", "Single-detached", False, 1), (ROW, "row", "Row houses", False, 3),
            (TOTAL, "Total units", "All types", True, 9)]),
        "dim_construction_stage": frame(spark, "dim_construction_stage", [
            (i, name, short, order) for i, (name, short, order) in enumerate(vocab.STAGES, 1)]),
        "dim_coverage": frame(spark, "dim_coverage", [
            (TOWNS, vocab.TOWNS, None, True), (METROS, vocab.METROS, None, False)]),
        "dim_arrears_region": frame(spark, "dim_arrears_region", [
            (1, "Ontario", "ONTARIO", None, False, 3),
            (2, "Territories", "TERRITORIES", None, False, 8),
            (3, "Canada", "CANADA", None, True, 0)]),
        "dim_credit_product": frame(spark, "dim_credit_product", [
            (1, "fixed", vocab.RESIDENTIAL, "Fixed", "Insured", False),
            (2, "variable", vocab.RESIDENTIAL, "Variable", "Insured", False),
            (3, "total", vocab.RESIDENTIAL, "All", "Insured", True),
            (4, "business", "Business loan", "All", "All", False)]),
        "dim_price_component": frame(spark, "dim_price_component", [(1, "House only")]),
        "fact_housing_activity": frame(spark, "fact_housing_activity", housing),
        "fact_market_absorption": frame(spark, "fact_market_absorption", [
            (20200101, TORONTO, TOTAL, d(30), d(20)), (20200201, TORONTO, TOTAL, d(10), d(40)),
            (20200301, TORONTO, TOTAL, d(20), None), (20200201, TORONTO, ROW, d(7), d(7))]),
        "fact_mortgage_arrears": frame(spark, "fact_mortgage_arrears", arrears),
        "fact_mortgage_originations": frame(spark, "fact_mortgage_originations", lending),
        "fact_mortgage_rate": frame(spark, "fact_mortgage_rate", [
            (20180701, d("3.5")), (20200101, d("5.0")), (20200201, d("5.5"))]),
        "fact_price_index": frame(spark, "fact_price_index", [
            (20190101, ON, 1, d(100)), (20200101, ON, 1, d(110)), (20200101, QC, 1, d(112))]),
        "check_results": frame(spark, "check_results", [
            ("a", "x", d(1), d(1), d(0), True, datetime(2020, 1, 1)),
            ("a", "y", d(1), d(2), d(50), False, datetime(2020, 1, 1)),
            ("b", "x", d(1), d(1), d(0), True, datetime(2020, 1, 1))]),
    }


PROVINCES = {"level": "Province", "dwelling": "total"}
TOWNS_ONLY = {"dim_coverage": f"coverage_name = '{vocab.TOWNS}'"}


def one(result, column=-1):
    rows = result.collect()
    assert len(rows) == 1
    return rows[0][column]


def test_all_measures_are_listed():
    assert len(m.MEASURES) == 39
    assert set(vocab.DISPLAY) <= set(m.MEASURES)


def test_flows_leave_out_totals_of_places(star):
    key = {"dim_date": "date_key = 20190101"}
    assert one(m.housing_starts(star, (), key, **PROVINCES)) == 10 * 3 * 3
    assert one(m.housing_completions(star, (), key, **PROVINCES)) == 5 * 3 * 3
    parts = m.housing_starts(star, (), key, level="Province", dwelling="parts")
    assert one(parts) == 10 * 3 * 3


def test_two_coverages_are_never_added(star):
    both = m.in_context(star, "fact_housing_activity", ["coverage_name"]).select(
        "coverage_name").distinct()
    assert both.count() == 2
    assert one(m.one_coverage_selected(star)) is False
    assert one(m.coverage_warning(star)) == vocab.COVERAGE_WARNING
    assert one(m.one_coverage_selected(star, (), TOWNS_ONLY)) is True
    assert one(m.coverage_warning(star, (), TOWNS_ONLY)) is None
    mixed = {**star, "fact_housing_activity": star["fact_housing_activity"].withColumn(
        "coverage_key", F.when(F.col("geography_key") == QC, METROS).otherwise(TOWNS))}
    assert one(m.housing_starts(mixed, **PROVINCES)) is None
    assert one(m.under_construction(mixed, **PROVINCES)) is None
    assert dict(tuples(m.housing_completions(mixed, ("geo_name",), **PROVINCES))) == {
        "Ontario": 24 * 15, "Quebec": 24 * 30}


def test_place_measures_demand_a_level_and_a_dwelling(star):
    with pytest.raises(TypeError):
        m.housing_starts(star)
    with pytest.raises(ValueError, match="dwelling"):
        m.housing_starts(star, level="Province", dwelling="everything")


def test_unrelated_dimensions_are_refused(star):
    with pytest.raises(ValueError, match="no relationship"):
        m.arrears_rate(star, (), {"dim_geography": "true"})
    with pytest.raises(ValueError, match="geo_name"):
        m.arrears_rate(star, ("geo_name",))


def test_time_shifted_measures_by_longer_periods(star):
    starts = {2019: sum((10 + i) * 9 for i in range(12)), 2020: sum((22 + i) * 9 for i in range(12))}
    last_year = tuples(m.housing_starts_last_year(star, ("year",), **PROVINCES))
    assert last_year == [(2020, starts[2019]), (2021, starts[2020])]
    change = tuples(m.housing_starts_change(star, ("year",), **PROVINCES))
    assert change == [(2019, None), (2020, starts[2020] - starts[2019])]
    trailing = dict(tuples(m.housing_starts_12_months(star, ("year",), **PROVINCES)))
    assert trailing == starts
    by_name = dict(tuples(m.housing_starts_last_year(star, ("year_month",), **PROVINCES)))
    by_key = dict(tuples(m.housing_starts_last_year(star, ("date_key",), **PROVINCES)))
    assert {k.replace("-", ""): v for k, v in by_name.items()} == {
        str(k)[:6]: v for k, v in by_key.items()}


def test_months_a_series_skips_still_look_back(star):
    gaps = {**star, "fact_housing_activity": star["fact_housing_activity"].filter(
        "date_key NOT IN (20200301, 20200401)")}
    by = ("date_key",)
    last_year = dict(tuples(m.housing_starts_last_year(gaps, by, **PROVINCES)))
    assert last_year[20200301] == 12 * 9 and 20210301 not in last_year
    trailing = dict(tuples(m.housing_starts_12_months(gaps, by, **PROVINCES)))
    assert trailing[20200401] == sum((10 + i) * 9 for i in range(4, 14))
    panel = {r["date_key"]: r for r in m.housing_panel(gaps, by, **PROVINCES).collect()}
    assert panel[20200301]["housing_starts"] is None
    assert panel[20200301]["housing_starts_last_year"] == 12 * 9
    assert panel[20200301]["housing_starts_12_months"] == trailing[20200301]


def test_a_place_filter_keeps_the_national_movement(star):
    by, one_place = ("geo_name", "date_key"), {"dim_geography": "geo_name = 'Ontario'"}
    everywhere = dict(((g, k), v) for g, k, v in tuples(m.share_of_national_change(star, by, **PROVINCES)))
    sliced = tuples(m.share_of_national_change(star, by, one_place, **PROVINCES))
    assert sliced == [(g, k, everywhere[g, k]) for g, k, _ in sliced] and len(sliced) == 24
    assert sliced[-1][2] == pytest.approx(1 / 3)
    assert one(m.headline(star, (), one_place, **PROVINCES)).startswith("Ontario: housing starts up")
    assert one(m.headline(star, (), **PROVINCES)).startswith("Canada: housing starts up")


def test_snapshots_take_the_last_month(star):
    assert one(m.under_construction(star, **PROVINCES)) == 900
    by_year = m.under_construction(star, ("year",), **PROVINCES)
    assert tuples(by_year) == [(2019, 900), (2020, 900)]
    metros = {"level": "CMA", "dwelling": "total"}
    # The last month has no inventory published, so the month before counts.
    assert one(m.unsold_inventory(star, **metros)) == 40
    assert one(m.homes_sold_or_rented(star, **metros)) == 60
    assert one(m.percent_unsold(star, **metros)) == 0.4
    assert one(m.mortgage_debt_outstanding(star)) == 1000 * 1_000_000


def test_year_over_year(star):
    at = {"dim_date": "date_key = 20200301"}
    ask = dict(by=("geo_name",), where=at, **PROVINCES)
    assert tuples(m.housing_starts_last_year(star, **ask)) == [("Ontario", 36), ("Quebec", 72)]
    assert tuples(m.housing_starts_change(star, **ask)) == [("Ontario", 36), ("Quebec", 72)]
    assert tuples(m.housing_starts_change_pct(star, **ask)) == [("Ontario", 1.0), ("Quebec", 1.0)]
    assert tuples(m.share_of_national_change(star, ("geo_name", "date_key"), at, **PROVINCES)) == [
        ("Ontario", 20200301, pytest.approx(1 / 3)), ("Quebec", 20200301, pytest.approx(2 / 3))]
    assert tuples(m.headline(star, **ask)) == [
        ("Ontario", "Ontario: housing starts up 36 homes (100.0%) vs the same month last year"),
        ("Quebec", "Quebec: housing starts up 72 homes (100.0%) vs the same month last year")]
    early = {"dim_date": "date_key = 20190301"}
    assert one(m.headline(star, (), early, **PROVINCES)) == vocab.NO_COMPARABLE_MONTH


def test_trailing_year_and_backlog(star):
    at = {"dim_date": "date_key = 20201201"}
    starts = sum(10 + i for i in range(12, 24)) * 9
    assert one(m.housing_starts_12_months(star, (), at, **PROVINCES)) == starts
    assert one(m.housing_completions_12_months(star, (), at, **PROVINCES)) == 12 * 45
    assert one(m.completion_ratio(star, (), at, **PROVINCES)) == pytest.approx(540 / starts)
    assert one(m.backlog_months(star, (), at, **PROVINCES)) == 900 / 45
    assert one(m.backlog_months_last_year(star, (), at, **PROVINCES)) == 900 / 45
    assert one(m.backlog_months_change(star, (), at, **PROVINCES)) == 0
    # Without a month in the context: as of the last month with data.
    assert one(m.backlog_months(star, **PROVINCES)) == 20


def test_arrears(star):
    assert one(m.total_mortgages(star)) == 4 * 1100
    assert one(m.mortgages_in_arrears(star)) == 120
    assert one(m.arrears_rate(star)) == pytest.approx(120 / 4400)
    national = {"dim_arrears_region": "is_national"}
    assert one(m.total_mortgages(star, (), national)) == 4 * 1100
    assert dict(tuples(m.arrears_rate(star, ("region_name",))))["Territories"] is None
    smooth = dict(tuples(m.arrears_rate_3_month_average(star, ("date_key",))))
    assert smooth[20200401] == pytest.approx((20 + 30 + 60) / 3 / 1100)
    assert smooth[20200101] == pytest.approx(10 / 1100)
    assert one(m.arrears_rate_last_year(star)) is None
    assert one(m.arrears_rate_change_points(star)) is None


def test_rates_and_prices(star):
    assert one(m.mortgage_rate(star)) == pytest.approx(14 / 3)
    then = dict(tuples(m.mortgage_rate_18_months_ago(star, ("date_key",))))
    assert then == {20200101: 3.5, 20210701: 5.0, 20210801: 5.5}
    assert one(m.price_index(star, (), {"dim_date": "date_key = 20200101"})) == 111
    change = dict(tuples(m.price_index_change_pct(star, ("date_key",))))
    assert change == {20190101: None, 20200101: pytest.approx(0.11)}


def test_lending(star):
    assert one(m.new_mortgage_lending(star)) == 200 * 1_000_000
    assert one(m.new_mortgage_lending_12_months(star)) == 200 * 1_000_000
    assert one(m.average_rate_on_new_lending(star)) == pytest.approx(4.8)
    assert one(m.variable_rate_share(star)) == pytest.approx(0.4)


def test_quality(star):
    assert one(m.checks_run(star)) == 3
    assert one(m.checks_passed(star)) == 2
    assert one(m.check_pass_rate(star)) == pytest.approx(2 / 3)
    assert dict(tuples(m.data_quality_status(star, ("check_name",)))) == {
        "a": "1 numbers need review", "b": vocab.ALL_NUMBERS_MATCH}
    assert one(m.data_through(star)) == "Data up to December 2020"
    assert one(m.data_through(star, fact="fact_mortgage_rate")) == "Data up to February 2020"


@pytest.mark.parametrize("name, value, text", [
    ("arrears_rate", 0.00345, "0.35%"), ("housing_starts", 1234.5, "1,235"),
    ("new_mortgage_lending", 2_500_000_000.0, "$2,500 M"),
    ("mortgage_debt_outstanding", 1_250_406_000_000.0, "$1,250 B"),
    ("backlog_months_change", 0.26, "+0.3"), ("backlog_months_change", -1.0, "-1.0"),
    ("backlog_months_change", 0.0, "0.0"), ("completion_ratio", None, None),
])
def test_display(spark, name, value, text):
    shown = m.displayed(spark.createDataFrame([(value,)], f"{name} double"), name)
    assert shown.first()[0] == text
