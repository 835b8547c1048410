"""Fused measures against each measure by itself, and how often facts are scanned."""

import contextlib
import io
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystar.functions.scalars import month_index
from tallystar.plans import fusion
from tallystar.plans import measures as m
from tallystar.schemas import FACTS
from tests.test_measures import star  # noqa: F401  (fixture)

PLACE = {*m.HOUSING_PANEL, "share_of_national_change", "headline", "unsold_inventory",
         "homes_sold_or_rented", "percent_unsold"}
READING = {"level": "Province", "dwelling": "total"}
HOUSING = (*m.HOUSING_PANEL, "share_of_national_change", "headline", "one_coverage_selected",
           "coverage_warning", "data_through")


def plain(value):
    if isinstance(value, (Decimal, float)) and not isinstance(value, bool):
        return round(float(value), 9)
    return value


def by_themselves(star, names, by, where):
    out = {}
    for name in names:
        reading = READING if name in PLACE else {}
        for row in m.MEASURES[name](star, by, where, **reading).collect():
            out.setdefault(tuple(row[c] for c in by), {})[name] = plain(row[name])
    if not by:
        out.setdefault((), {})
    return {key: {name: found.get(name) for name in names} for key, found in out.items()}


def fused(star, names, by, where):
    rows = fusion.together(star, names, by, where, **READING).collect()
    return {tuple(r[c] for c in by): {name: plain(r[name]) for name in names} for r in rows}


@pytest.fixture(scope="module")
def gappy(star):  # noqa: F811
    """The star with every fifth month taken from its largest fact."""
    fact = star["fact_housing_activity"]
    return {**star, "fact_housing_activity": fact.filter(month_index("date_key") % 5 != 0)}


@pytest.mark.parametrize("by, where", [
    (("geo_name", "date_key"), {}),
    (("geo_name", "year"), {"dim_date": "year >= 2020"}),
    (("geo_name",), {"dim_geography": "geo_name = 'Ontario'"}),
])
def test_each_measure_as_by_itself(gappy, by, where):
    assert fused(gappy, HOUSING, by, where) == by_themselves(gappy, HOUSING, by, where)


def test_one_row_without_groups(star):  # noqa: F811
    names = (*m.HOUSING_PANEL, "headline", "data_through")
    where = {"dim_date": "year = 2020"}
    assert fused(star, names, (), where) == by_themselves(star, names, (), where)


ARREARS = ("total_mortgages", "arrears_rate", "arrears_rate_last_year", "arrears_rate_change_points",
           "arrears_rate_3_month_average")
LENDING = ("new_mortgage_lending", "new_mortgage_lending_12_months", "mortgage_debt_outstanding",
           "average_rate_on_new_lending", "variable_rate_share")


@pytest.mark.parametrize("by", [("date_key",), ("year",), ()])
def test_several_facts_side_by_side(star, by):  # noqa: F811
    names = (*ARREARS, *LENDING, "housing_starts")
    assert fused(star, names, by, None) == by_themselves(star, names, by, None)


def test_checks_ride_along(star):  # noqa: F811
    names = ("checks_run", "checks_passed", "check_pass_rate", "data_quality_status")
    row = fusion.together(star, (*names, "housing_starts"), (), None, **READING).first()
    for name in names:
        assert row[name] == m.MEASURES[name](star).first()[name]
    by_name = fusion.together(star, names, ("check_name",), checks_where=F.col("passed"))
    want = m.checks_run(star, ("check_name",), F.col("passed"))
    assert sorted(map(tuple, by_name.select("check_name", "checks_run").collect())) == sorted(map(tuple, want.collect()))


def test_listed_gives_the_rows_of_each(star):  # noqa: F811
    by = ("geo_name", "date_key")
    rows = fusion.listed(star, m.HOUSING_PANEL, by, **READING).collect()
    want = []
    for name in m.HOUSING_PANEL:
        for r in m.MEASURES[name](star, by, **READING).collect():
            want.append((name, r["geo_name"], r["date_key"], plain(r[name])))
    found = [(r["measure"], r["geo_name"], r["date_key"], plain(r["value"])) for r in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def scans(frame, path):
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        frame.explain("formatted")
    return len(re.findall(rf"Location: [^\n]*{path}\b", printed.getvalue()))


def test_one_scan_per_fact(spark, star, tmp_path):  # noqa: F811
    stored = dict(star)
    for name in FACTS:
        if name in star:
            star[name].write.parquet(f"{tmp_path}/{name}")
            stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    by = ("geo_name", "date_key")
    for names in (("housing_starts",), m.HOUSING_PANEL, (*m.HOUSING_PANEL, "headline", "one_coverage_selected")):
        frame = fusion.together(stored, names, by, **READING)
        assert scans(frame, "fact_housing_activity") == 1
    both = fusion.together(stored, (*ARREARS, *LENDING), ("date_key",))
    assert scans(both, "fact_mortgage_arrears") == scans(both, "fact_mortgage_originations") == 1


def test_what_cannot_be_asked(star):  # noqa: F811
    for names, by, where, reading in [
        (("no_such",), (), None, READING), (("housing_starts",), (), None, {}),
        (("mortgage_rate",), ("geo_name",), None, READING),
        (("mortgage_rate",), (), {"dim_geography": "is_aggregate"}, READING),
        (("share_of_national_change",), ("date_key",), None, READING),
        (("checks_run",), ("geo_name",), None, READING),
    ]:
        with pytest.raises(ValueError):
            fusion.together(star, names, by, where, **reading)


def test_every_measure_is_defined():
    assert set(fusion.DEFINITIONS) | set(fusion.OF_CHECKS) == set(m.MEASURES)
