import pytest
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.functions import labels
from tallystar.operators.lookup import pick

# label -> level, province, code, arrears region, is total, display order
PLACES = {
    "Canada": ("Country", None, None, None, True, 0),
    "Ontario": ("Province", "Ontario", "ON", "ONTARIO", False, 20),
    "Quebec": ("Province", "Quebec", "QC", "QUEBEC", False, 20),
    " British Columbia\t": ("Province", "British Columbia", "BC", "BRITISH COLUMBIA", False, 20),
    "Prince Edward Island": ("Province", "Prince Edward Island", "PE", "ATLANTIC", False, 20),
    "Nova Scotia": ("Province", "Nova Scotia", "NS", "ATLANTIC", False, 20),
    "New Brunswick": ("Province", "New Brunswick", "NB", "ATLANTIC", False, 20),
    "Toronto, Ontario": ("CMA", "Ontario", "ON", "ONTARIO", False, 40),
    "Vancouver, British Columbia": (
        "CMA", "British Columbia", "BC", "BRITISH COLUMBIA", False, 40),
    "Calgary, Alberta": ("CMA", "Alberta", "AB", "ALBERTA", False, 40),
    "St. John's, Newfoundland and Labrador": (
        "CMA", "Newfoundland and Labrador", "NL", "ATLANTIC", False, 40),
    "Trois-Rivières, Quebec": ("CMA", "Quebec", "QC", "QUEBEC", False, 40),
    "Kitchener-Cambridge-Waterloo, Ontario": ("CMA", "Ontario", "ON", "ONTARIO", False, 40),
    # A place split by a border: two halves are places, the combined row is a total,
    # and its province is the first one listed that the label mentions.
    "Ottawa-Gatineau, Ontario part, Ontario/Quebec": (
        "CMA", "Ontario", "ON", "ONTARIO", False, 40),
    "Ottawa-Gatineau, Quebec part, Ontario/Quebec": ("CMA", "Quebec", "QC", "QUEBEC", False, 40),
    "Ottawa-Gatineau, Ontario/Quebec": ("CMA", "Quebec", "QC", "QUEBEC", True, 40),
    "Atlantic provinces": ("Region", None, None, None, True, 10),
    "Prairie provinces": ("Region", None, None, None, True, 10),
    "Census metropolitan areas": ("Region", None, None, None, True, 10),
    "British Columbia excluding Vancouver": (
        "Region", "British Columbia", "BC", "BRITISH COLUMBIA", True, 30),
    "Ontario excluding Toronto": ("Region", "Ontario", "ON", "ONTARIO", True, 30),
    "Montreal excluding Saint-Jerome, Quebec": ("Region", "Quebec", "QC", "QUEBEC", True, 30),
    "Saint John, Fredericton, and Moncton, New Brunswick": (
        "Region", "New Brunswick", "NB", "ATLANTIC", True, 35),
    "Atlantis, Underwater": ("Unknown", None, None, None, False, 999),
    "Greater Ontario": ("Unknown", None, None, None, False, 999),
}


@pytest.fixture(scope="module")
def placed(spark):
    frame = spark.createDataFrame([(name,) for name in PLACES], "geo_name string")
    return {row["geo_name"]: row for row in labels.with_place(frame, "geo_name").collect()}


@pytest.mark.parametrize("name", PLACES)
def test_place(placed, name):
    row = placed[name]
    found = tuple(row[c] for c in ("geo_level", "province_name", "province_code",
                                   "arrears_region", "is_aggregate", "sort_order"))
    assert found == PLACES[name]


def test_every_known_total_is_a_total(spark):
    frame = spark.createDataFrame([(t,) for t in vocab.KNOWN_TOTALS], "geo_name string")
    assert all(row["is_aggregate"] for row in labels.with_place(frame, "geo_name").collect())


def test_dwellings_are_harmonised_without_regard_to_case(spark):
    names = [(n,) for n in ("Single detached units", "APARTMENT AND OTHER UNITS", "Total units",
                            "Multiples", "Houseboats")]
    frame = spark.createDataFrame(names, "name string").withColumn("d", labels.dwelling("name"))
    rows = {r["name"]: tuple(r["d"]) for r in frame.collect()}
    assert rows == {
        "Single detached units": ("Single-detached", False, 1),
        "APARTMENT AND OTHER UNITS": ("Apartments & other", False, 4),
        "Total units": ("All types", True, 9),
        "Multiples": ("Multiples", False, 7),
        "Houseboats": ("Houseboats", False, 50),
    }


def test_credit_products(spark):
    expected = {
        "Total, funds advanced, residential mortgages, insured":
            ("Residential mortgage", "All", "Insured", True),
        "Fixed rate, funds advanced, residential mortgages, uninsured, 5 years and more":
            ("Residential mortgage", "Fixed", "Uninsured", False),
        "Funds advanced, non-residential mortgages":
            ("Commercial mortgage", "All", "All", False),
        "Variable rate mortgages, funds advanced, open":
            ("Variable rate mortgage (alternative split)", "Variable", "All", False),
        "Business loans, total": ("Business loan", "All", "All", False),
        "Non-mortgage loans": ("Consumer credit", "All", "All", False),
        "Leases": ("Other", "All", "All", False),
    }
    frame = spark.createDataFrame([(n,) for n in expected], "name string")
    fields = ("product_family", "rate_type", "insurance_status", "is_total")
    rows = frame.withColumn("p", labels.credit_product("name")).select(
        "name", *pick(F.col("p"), *fields)
    )
    assert {r["name"]: tuple(r[f] for f in fields) for r in rows.collect()} == expected
