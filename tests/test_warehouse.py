"""The whole run on hand-written raw files."""

import csv
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.operators import quality
from tallystar.plans import checks, warehouse
from tallystar.schemas import CHECK_RESULTS, EXPORTED, FACTS, GRAIN, KEY, RELATIONSHIPS
from tallystar.sources.releases import REGISTRY
from tests.conftest import tuples

MONTHS = [f"{y}-{m:02d}" for y in (2019, 2020) for m in range(1, 13)]
TYPES = {"Single-detached units": 1, "Semi-detached units": 2, "Row units": 3,
         "Apartment and other units": 4}
STAGES = [stage for stage, _, _ in vocab.STAGES]


def write(raw, name, header, rows):
    folder = raw / name
    folder.mkdir(parents=True)
    file = "arrears" if name == "arrears" else REGISTRY[name].pid
    with open(folder / f"{file}.csv", "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(rows)


def housing_rows(places):
    for n, month in enumerate(MONTHS):
        for place, scale in places:
            for stage in STAGES:
                for kind, units in TYPES.items():
                    yield month, place, kind, stage, units * scale * (n + 1)
                yield month, place, "Total units", stage, sum(TYPES.values()) * scale * (n + 1)


def write_raw(raw, canada_scale=30):
    header = ["REF_DATE", "GEO", "Type of unit", "Housing estimates", "VALUE"]
    towns = [("Canada", canada_scale), ("Ontario", 10), ("Quebec", 20), ("Atlantic provinces", 5)]
    early = [("1989-12", "Ontario", "Total units", STAGES[0], "7")]
    odd = [("2020-12", "Atlantis, Underwater", "Total units", STAGES[0], "F")]
    write(raw, "housing_activity", header, [*housing_rows(towns), *early, *odd])
    write(raw, "housing_cma", header, housing_rows([("Toronto, Ontario", 7)]))
    write(raw, "absorptions",
          ["REF_DATE", "GEO", "Type of dwelling unit", "Completed dwelling units", "VALUE"],
          [(m, "Toronto, Ontario", "Total units", measure, value) for m in MONTHS
           for measure, value in (("Absorptions", 30), ("Unabsorbed inventory", 10))])
    write(raw, "unoccupied", ["REF_DATE", "GEO", "Type of unit", "VALUE"],
          [(m, "Toronto, Ontario", "Total units", "..") for m in MONTHS])
    write(raw, "price_index", ["REF_DATE", "GEO", "New housing price indexes", "VALUE"],
          [(m, "Canada", c, f"{100 + i}.5") for i, m in enumerate(MONTHS)
           for c in ("House only", "Land only")])
    write(raw, "mortgage_rate", ["REF_DATE", "VALUE"],
          [(m, v) for i, m in enumerate(MONTHS) for v in (f"{i}", f"{i + 1}", "")])
    lending = []
    for m in MONTHS:
        for kind, funds, rate in (("Fixed", 60, 4), ("Variable", 40, 6)):
            name = f"{kind} rate, {{}}, residential mortgages, insured"
            lending += [
                (m, name.format("funds advanced"), "Dollars", funds),
                (m, name.format("funds advanced"), "Interest rate", rate),
                (m, name.format("outstanding balances"), "Dollars", funds * 100),
            ]
        lending += [
            (m, "Total, funds advanced, residential mortgages, insured", "Dollars", 100),
            (m, "Funds advanced, business loans", "Dollars", 999),
        ]
    write(raw, "originations", ["REF_DATE", "Components", "Unit of measure", "VALUE"], lending)
    arrears = []
    for m in MONTHS:
        arrears += [(code, m, "1000", "5", "0.5") for code in ("ONTARIO", "QUEBEC")]
        arrears += [("TERRITORIES", m, "100", "", ""), ("CANADA", m, "2100", "10", "0.48")]
    write(raw, "arrears",
          ["region", "month", "total_mortgages", "mortgages_in_arrears", "arrears_rate"], arrears)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    write_raw(base / "raw")
    manifest, reasons = warehouse.run(
        spark, str(base / "raw"), str(base / "work"), str(base / "out"), "v1", "2020-12", known=()
    )
    assert reasons == []
    return base, manifest


@pytest.fixture(scope="module")
def export(spark, run):
    return warehouse.read_export(spark, str(run[0] / "out"))


def test_manifest(run):
    rows = {r["table_name"]: r["n_rows"] for r in run[1].collect()}
    assert set(rows) == set(EXPORTED)
    assert rows["dim_date"] == 31 * 12
    assert rows["fact_housing_activity"] == len(MONTHS) * 5 * 3 * 5 + 1
    assert rows["fact_mortgage_arrears"] == len(MONTHS) * 4


def test_dimensions(export):
    assert tuples(export["dim_geography"], "geo_name", "geo_level", "is_aggregate") == sorted([
        ("Canada", "Country", True), ("Ontario", "Province", False),
        ("Quebec", "Province", False), ("Atlantic provinces", "Region", True),
        ("Toronto, Ontario", "CMA", False), ("Atlantis, Underwater", "Unknown", False),
        ("Unknown", "Unknown", False),
    ])
    places = warehouse.unclassified_places(export)
    assert tuples(places, "geo_name") == [("Atlantis, Underwater",)]
    shown = warehouse.in_display_order(export["dim_dwelling_type"], "dim_dwelling_type",
                                       "dwelling_type_name")
    assert [r["dwelling_category"] for r in shown.collect()] == [
        "Single-detached", "Semi-detached", "Row houses", "Apartments & other", "All types",
        "Unknown",
    ]
    first = export["dim_date"].orderBy("date_key").first()
    assert (first["date_key"], first["date"]) == (19900101, date(1990, 1, 1))


def test_every_dimension_has_its_unknown_member(export):
    for dim, key in KEY.items():
        if dim != "dim_date":
            assert export[dim].filter(F.col(key) == -1).count() == 1, dim


def test_facts(export):
    rate = tuples(export["fact_mortgage_rate"].filter("date_key = 20190101"))
    assert rate == [(20190101, Decimal("0.5000"))]
    unoccupied = export["fact_unoccupied_housing"]
    assert unoccupied.count() == 24
    assert unoccupied.filter("unoccupied_units is not null").count() == 0
    absorbed = export["fact_market_absorption"].filter("date_key = 20200101").first()
    assert (absorbed["absorptions"], absorbed["unabsorbed_inventory"]) == (30, 10)
    hidden = export["fact_mortgage_arrears"].filter("is_hidden")
    assert hidden.count() == 24
    assert hidden.filter("mortgages_in_arrears is not null").count() == 0
    lending = export["fact_mortgage_originations"].join(
        export["dim_credit_product"], "credit_product_key"
    ).filter("date_key = 20200101")
    assert tuples(lending, "rate_type", "funds_advanced_millions",
                  "outstanding_balance_millions", "interest_rate") == sorted([
        ("Fixed", Decimal("60.00"), None, Decimal("4.0000")),
        ("Fixed", None, Decimal("6000.00"), None),
        ("Variable", Decimal("40.00"), None, Decimal("6.0000")),
        ("Variable", None, Decimal("4000.00"), None),
        ("All", Decimal("100.00"), None, None), ("All", Decimal("999.00"), None, None),
    ], key=repr)


def test_keys_and_references(export):
    for fact, keys in GRAIN.items():
        assert quality.duplicate_keys(export[fact], keys).count() == 0, fact
    edges = [(dim, KEY[dim], fact, KEY[dim]) for dim, fact in RELATIONSHIPS]
    counted = quality.referential_integrity(export, edges)
    assert counted.filter("orphan_rows > 0").count() == 0
    assert counted.count() == 19


def test_stored_schemas(export):
    for fact, schema in FACTS.items():
        found = [(f.name, f.dataType) for f in export[fact].schema.fields]
        assert found == [(f.name, f.dataType) for f in schema.fields]
    assert export["check_results"].columns == CHECK_RESULTS.fieldNames()


def test_views(export):
    june = export["what_changed"].filter("geo_name = 'Quebec' and date_key = 20200601").first()
    assert (june["units"], june["units_last_year"]) == (20 * 10 * 18, 20 * 10 * 6)
    assert june["percent_change"] == 200.0
    assert june["share_of_national_change"] == pytest.approx(100 * 20 / 30)
    december = export["pipeline_health"].filter(
        "geo_name = 'Toronto, Ontario' and date_key = 20201201 "
        "and dwelling_type_name = 'Total units'"
    ).first()
    year = sum(range(13, 25)) * 70
    assert december["completions_last_12_months"] == year
    assert december["completion_ratio"] == 1.0
    assert december["backlog_months"] == pytest.approx(24 * 70 / (year / 12))
    trend = export["arrears_trend"].filter("is_national and date_key = 20200801").first()
    # Eighteen calendar months before 2020-08 is 2019-02, whatever the rows in between.
    assert trend["mortgage_rate_18_months_ago"] == Decimal("1.5000")
    assert trend["change_vs_last_year"] == 0


def test_views_answer_to_sql(spark, export):
    star = {k: v for k, v in export.items() if k.startswith(("dim_", "fact_"))}
    warehouse.register_views(star)
    assert spark.sql("SELECT count(*) AS n FROM what_changed").first()["n"] > 0
    assert warehouse.fact_rows(star).first()["n_rows"] == sum(
        export[f].count() for f in FACTS
    )


def test_checks_pass_and_are_stored(export):
    per_check = tuples(export["check_results"].groupBy("check_name").agg(
        F.count("*"), F.count_if("passed")
    ))
    assert [(name, n == ok) for name, n, ok in per_check] == [
        (name, True) for name in sorted(checks.EXPECTED)
    ]
    assert dict((n, c) for n, c, _ in per_check)[vocab.CHECK_ARREARS_TOTAL] == 24


def test_a_failed_check_keeps_the_last_export(spark, run):
    base, _ = run
    write_raw(base / "raw2", canada_scale=31)
    manifest, reasons = warehouse.run(
        spark, str(base / "raw2"), str(base / "work2"), str(base / "out"), "v2", "2020-12"
    )
    assert manifest is None
    assert reasons == [f"{vocab.CHECK_PROVINCES}: 24 of 24 failed"]
    assert warehouse.tables.current_version(spark, str(base / "out")) == "v1"


def test_arrears_from_report_text(spark, run, tmp_path):
    base, _ = run
    lines = {"ONTARIO": "1,000  5  0.50%", "QUEBEC": "1,000  5  0.50%", "TERRITORIES": "100",
             "CANADA": "2,100  10  0.48%"}
    pages = ["Summary"]
    for region, figures in lines.items():
        body = "\n".join(
            f"{a}  {figures}    {b}  {figures}" for a, b in zip(MONTHS[::2], MONTHS[1::2], strict=True)
        )
        pages.append(f"REGION: {region}*\nAs at: Total Arrears %\n{body}")
    (tmp_path / "reports").mkdir()
    (tmp_path / "reports" / "2020-12.txt").write_text("\f".join(pages))
    manifest, reasons = warehouse.run(
        spark, str(base / "raw"), str(tmp_path / "work"), str(tmp_path / "out"), "v1", "2020-12",
        known=(), reports=str(tmp_path / "reports"),
    )
    assert reasons == [] and manifest is not None
    told = warehouse.read_export(spark, str(tmp_path / "out"))["fact_mortgage_arrears"]
    before = warehouse.read_export(spark, str(base / "out"))["fact_mortgage_arrears"]
    assert tuples(told) == tuples(before)
