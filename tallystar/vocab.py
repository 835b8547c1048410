"""Fixed values.

Everything in this file is a published spelling, code, tolerance or pattern that
must stay exactly as it is for results to be right.  Logic lives elsewhere.
"""

# The key every dimension reserves for a label it does not know.
UNKNOWN_KEY = -1

# Provinces and their codes.  The order matters: the substring fallback of
# ``functions.labels.province_of`` takes the first one found.
PROVINCES = {
    "Newfoundland and Labrador": "NL",
    "Prince Edward Island": "PE",
    "Nova Scotia": "NS",
    "New Brunswick": "NB",
    "Quebec": "QC",
    "Ontario": "ON",
    "Manitoba": "MB",
    "Saskatchewan": "SK",
    "Alberta": "AB",
    "British Columbia": "BC",
}

# Province code -> region code of the arrears report.
ARREARS_REGION_OF_PROVINCE = {
    "NL": "ATLANTIC",
    "PE": "ATLANTIC",
    "NS": "ATLANTIC",
    "NB": "ATLANTIC",
    "QC": "QUEBEC",
    "ON": "ONTARIO",
    "MB": "MANITOBA",
    "SK": "SASKATCHEWAN",
    "AB": "ALBERTA",
    "BC": "BRITISH COLUMBIA",
}

COUNTRY = "Canada"

# Labels that are totals of other labels in the same list.
KNOWN_TOTALS = (
    "Canada",
    "Atlantic provinces",
    "Atlantic Region",
    "Prairie provinces",
    "Prairie Region",
    "Census metropolitan areas",
    "Census agglomerations 50,000 and over",
    "Census metropolitan areas and census agglomerations of 50,000 and over",
)

# Display order per classification outcome.
SORT_COUNTRY = 0
SORT_KNOWN_TOTAL = 10
SORT_PROVINCE = 20
SORT_EXCLUDING = 30
SORT_COMBINED = 35
SORT_METRO = 40
SORT_UNKNOWN = 999

# name, code in the report, provinces covered, is national, display order
ARREARS_REGIONS = (
    ("Canada", "CANADA", "everywhere", True, 0),
    ("Atlantic", "ATLANTIC", "NL, PE, NS, NB", False, 1),
    ("Quebec", "QUEBEC", "QC", False, 2),
    ("Ontario", "ONTARIO", "ON", False, 3),
    ("Manitoba", "MANITOBA", "MB", False, 4),
    ("Saskatchewan", "SASKATCHEWAN", "SK", False, 5),
    ("Alberta", "ALBERTA", "AB (plus NT, NU)", False, 6),
    ("British Columbia", "BRITISH COLUMBIA", "BC (plus YT)", False, 7),
    ("Territories", "TERRITORIES", "YT, NT, NU", False, 8),
)

TOWNS = "Towns of 10,000 and over"
METROS = "Big metro areas only"

# stage as published, short name, order
STAGES = (
    ("Housing starts", "Starts", 1),
    ("Housing under construction", "Under construction", 2),
    ("Housing completions", "Completions", 3),
)

# published spelling (lower case) -> category, is total, display order
DWELLING_SPELLINGS = {
    "single-detached units": ("Single-detached", False, 1),
    "single detached units": ("Single-detached", False, 1),
    "semi-detached units": ("Semi-detached", False, 2),
    "row units": ("Row houses", False, 3),
    "apartment and other units": ("Apartments & other", False, 4),
    "apartment and other unit types": ("Apartments & other", False, 4),
    "row, apartment and other units": ("Row + apartments", False, 5),
    "single-detached and semi-detached units": ("Single + semi", False, 6),
    "multiples": ("Multiples", False, 7),
    "total units": ("All types", True, 9),
}
DWELLING_UNLISTED_SORT = 50

# The four categories that add up to "All types".
DWELLING_PARTS = ("Single-detached", "Semi-detached", "Row houses", "Apartments & other")

# phrase in the lower-cased product sentence -> family, tried in this order
PRODUCT_FAMILIES = (
    (("non-residential mortgage",), "Commercial mortgage"),
    (("residential mortgage",), "Residential mortgage"),
    (("variable rate mortgage",), "Variable rate mortgage (alternative split)"),
    (("business loan",), "Business loan"),
    (("consumer credit", "non-mortgage loan"), "Consumer credit"),
)
PRODUCT_FAMILY_OTHER = "Other"
RESIDENTIAL = "Residential mortgage"

# Release registry: table number and folder name.
RELEASES = (
    ("34100143", "housing_activity",
     "Housing starts, under construction, completions - towns of 10,000+"),
    ("34100154", "housing_cma", "Same three measures, but for 37 big metro areas"),
    ("34100149", "absorptions", "Finished homes: how many sold, how many still empty"),
    ("34100162", "unoccupied", "Newly built homes that are finished but nobody lives in yet"),
    ("18100205", "price_index", "New housing price index"),
    ("34100145", "mortgage_rate", "5-year conventional mortgage rate"),
    ("10100006", "originations", "Bank of Canada: new mortgage money lent out each month"),
)

# What is said of each coverage, and which one is the default.
COVERAGES = (
    (TOWNS, "Every town of 10,000+ people, by province. The default view.", True),
    (METROS, "Just the 37 largest metro areas. These are INSIDE the figure above, "
     "so never add the two together.", False),
)

# First month loaded when the caller names none.
START_MONTH = "1990-01"

# Report text: a section header, and one record (month, total, count, percent).
# The look-ahead keeps the optional count from taking the start of the next
# record's month or of a percent when the count itself is hidden.
REPORT_HEADER = r"(?m)REGION:\s*([A-Z ']+?)\*{0,2}\s*$"
REPORT_RECORD = (
    r"(\d{4}-\d{2})\s+([\d,]+)(?:\s+([\d,]+)(?![\d,.-]))?(?:\s+([\d.]+)%)?"
)

# How far a computed number may lie from the published one.
MAX_PERCENT_GAP = 1.0
MAX_POINT_GAP = 0.02

# Check names, as they appear in stored results.
CHECK_ARREARS_TOTAL = "arrears add up to Canada"
CHECK_ARREARS_RATE = "arrears rate matches published"
CHECK_PROVINCES = "provinces add up to Canada"
CHECK_DWELLINGS = "house types add up to total"
CHECK_LENDING = "mortgage lending adds up to total"
CHECK_COMPLETE = "every row matched a real place"

# Published figures known to be wrong at the source: (check, detail).
KNOWN_SOURCE_PROBLEMS = (
    (CHECK_ARREARS_TOTAL, "1999-04"),
    (CHECK_ARREARS_RATE, "1999-07 / Atlantic"),
    (CHECK_ARREARS_RATE, "2013-03 / Quebec"),
)

# Texts shown by the measures.
COVERAGE_WARNING = (
    "Pick ONE coverage. The metro areas are already inside the towns figure, "
    "so adding both counts houses twice."
)
NO_COMPARABLE_MONTH = "No comparable month last year"
ALL_NUMBERS_MATCH = "All numbers match the published figures"

# Display order: (table, column) -> the column that orders it.
SORT_BY = {
    ("dim_date", "month_name"): "month",
    ("dim_geography", "geo_name"): "sort_order",
    ("dim_dwelling_type", "dwelling_type_name"): "sort_order",
    ("dim_construction_stage", "stage_short"): "stage_order",
    ("dim_arrears_region", "region_name"): "sort_order",
}

# How a measure is shown: (style, decimal places).
DISPLAY = {
    "housing_starts": ("number", 0),
    "housing_completions": ("number", 0),
    "under_construction": ("number", 0),
    "housing_starts_change_pct": ("percent", 1),
    "housing_starts_12_months": ("number", 0),
    "housing_completions_12_months": ("number", 0),
    "completion_ratio": ("number", 2),
    "backlog_months": ("number", 1),
    "backlog_months_last_year": ("number", 1),
    "backlog_months_change": ("signed", 1),
    "percent_unsold": ("percent", 1),
    "total_mortgages": ("number", 0),
    "mortgages_in_arrears": ("number", 0),
    "arrears_rate": ("percent", 2),
    "arrears_rate_last_year": ("percent", 2),
    "arrears_rate_3_month_average": ("percent", 2),
    "mortgage_rate": ("number", 2),
    "mortgage_rate_18_months_ago": ("number", 2),
    "share_of_national_change": ("percent", 1),
    "new_mortgage_lending": ("millions", 0),
    "new_mortgage_lending_12_months": ("millions", 0),
    "mortgage_debt_outstanding": ("billions", 0),
    "average_rate_on_new_lending": ("number", 2),
    "variable_rate_share": ("percent", 1),
    "price_index": ("number", 1),
    "price_index_change_pct": ("percent", 1),
    "check_pass_rate": ("percent", 2),
}
