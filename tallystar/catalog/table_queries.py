"""Single operators applied straight to the base tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.catalog import query
from tallystar.functions import labels
from tallystar.functions.scalars import (
    count_cell,
    decimal_cell,
    month_key_of_date,
    month_key_of_text,
    month_start,
    ratio,
    rounded,
)
from tallystar.operators import gazetteer, quality, reconcile
from tallystar.operators.aggregates import row_totals, stack, sum_of_amounts
from tallystar.operators.calendar import describe_months, expand_months, month_calendar, within_calendar
from tallystar.operators.distinct import distinct_count, distinct_states
from tallystar.operators.lookup import (
    constant_key,
    distinct_labels,
    duplicate_keys,
    lookup_key,
    pick,
    surrogate_key,
    with_unknown,
)
from tallystar.operators.report_text import extract_records
from tallystar.operators.timeseries import (
    first_per_key,
    forward_fill,
    rolling_sum,
    semi_additive_last,
    year_over_year,
)
from tallystar.plans import dims
from tallystar.plans.roles import table
from tallystar.session import shared_dir

PROVINCES = list(vocab.PROVINCES)
_PROVINCE_LIST = ", ".join(f"'{p}'" for p in PROVINCES)
_TOTALS_LIST = ", ".join(f"'{t}'" for t in vocab.KNOWN_TOTALS)


# Time series: orders per nation, status and month ------------------------------------


def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value per (nation, status, month).

    Orders meet customers before the sum; a customer with a large share of all orders
    is split by AQE, and the sum itself combines map-side to at most one row per
    group and task.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.col("o_orderstatus").alias("status"),
        month_key_of_date("o_orderdate").alias("date_key"),
        "o_totalprice",
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("nation"), "status", "date_key")
        .agg(sum_of_amounts("o_totalprice").alias("units"))
    )


SERIES = ["nation", "status"]

_MONTHLY = """
WITH monthly AS (
  SELECT c_nationkey AS nation, o_orderstatus AS status,
         CAST(strftime(o_orderdate, '%Y%m01') AS INTEGER) AS date_key,
         CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS mi,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS units
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL
)
"""


@query("rolling12_rows", _MONTHLY + """
SELECT nation, status, date_key, CAST(units AS DOUBLE) AS units,
       CAST(SUM(units) OVER (PARTITION BY nation, status ORDER BY date_key
            ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS DOUBLE) AS last_12_rows
FROM monthly""")
def rolling12_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = rolling_sum("units", SERIES, mode="rows")
    return monthly_orders(spark, sf_dir).withColumn("last_12_rows", total)


@query("rolling12_calendar", _MONTHLY + """
SELECT nation, status, date_key, CAST(units AS DOUBLE) AS units,
       CAST(SUM(units) OVER w AS DOUBLE) AS last_12_months,
       CAST(CASE WHEN COUNT(*) OVER w = 12 THEN SUM(units) OVER w END AS DOUBLE)
         AS full_12_months
FROM monthly
WINDOW w AS (PARTITION BY nation, status ORDER BY mi RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)""")
def rolling12_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_orders(spark, sf_dir).withColumns({
        "last_12_months": rolling_sum("units", SERIES),
        "full_12_months": rolling_sum("units", SERIES, require_full=True),
    })


def _yoy_sql(before: str) -> str:
    return _MONTHLY + f""",
paired AS (SELECT *, {before} AS before FROM monthly m)
SELECT nation, status, date_key, CAST(units AS DOUBLE) AS units,
       CAST(before AS DOUBLE) AS units_last_year, CAST(units - before AS DOUBLE) AS change,
       100.0::DOUBLE * CAST(units - before AS DOUBLE) / NULLIF(CAST(before AS DOUBLE), 0)
         AS change_pct
FROM paired"""


def _yoy(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    return year_over_year(
        monthly_orders(spark, sf_dir), "units", SERIES, "units_last_year", "change",
        "change_pct", mode=mode,
    )


@query("yoy_calendar", _yoy_sql(
    "(SELECT x.units FROM monthly x WHERE x.nation = m.nation AND x.status = m.status "
    "AND x.mi = m.mi - 12)"))
def yoy_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _yoy(spark, sf_dir, "calendar")


@query("yoy_rows", _yoy_sql(
    "lag(units, 12) OVER (PARTITION BY nation, status ORDER BY date_key)"))
def yoy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _yoy(spark, sf_dir, "rows")


@query("semi_additive_last", _MONTHLY + """,
lasts AS (SELECT year, MAX(date_key) AS k FROM monthly WHERE status = 'P' GROUP BY year),
latest AS (SELECT MAX(date_key) AS k FROM monthly WHERE status = 'P')
SELECT year, nation, CAST(SUM(CASE WHEN date_key = k THEN units END) AS DOUBLE) AS open_units
FROM monthly JOIN lasts USING (year) WHERE status = 'P' GROUP BY year, nation
UNION ALL
SELECT 0, nation, CAST(SUM(CASE WHEN date_key = k THEN units END) AS DOUBLE)
FROM monthly, latest WHERE status = 'P' GROUP BY nation""")
def semi_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders at the last month of each year, and (year 0) at the last month of all."""
    year = F.floor(F.col("date_key") / 10000).cast("int")
    open_orders = monthly_orders(spark, sf_dir).filter("status = 'P'").withColumn("year", year)
    shared_dir(spark)
    open_orders = open_orders.checkpoint()  # read three times, made once
    yearly = semi_additive_last(open_orders, "units", ["nation"], "open_units", periods=["year"])
    latest = semi_additive_last(open_orders, "units", ["nation"], "open_units")
    return stack([yearly, latest.withColumn("year", F.lit(0))])


# Calendar ---------------------------------------------------------------------------


@query("month_calendar", """
WITH bounds AS (SELECT date_trunc('month', MIN(o_orderdate)) AS lo,
                       date_trunc('month', MAX(o_orderdate)) AS hi FROM orders),
months AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS d FROM bounds)
SELECT CAST(strftime(d, '%Y%m01') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS date,
       strftime(d, '%Y-%m') AS year_month, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       strftime(d, '%B') AS month_name,
       CAST(year(d) AS VARCHAR) || ' Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name
FROM months""")
def calendar_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    bounds = orders.agg(
        month_start(F.min("o_orderdate")).alias("lo"), month_start(F.max("o_orderdate")).alias("hi")
    )
    return describe_months(expand_months(bounds, "lo", "hi"))


@query("calendar_semi_filter", """
SELECT CAST(strftime(o_orderdate, '%Y%m01') AS INTEGER) AS date_key, COUNT(*) AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS units
FROM orders WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1999-11-01'
GROUP BY 1""")
def calendar_semi_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        month_key_of_date("o_orderdate").alias("date_key"), "o_totalprice"
    )
    calendar = month_calendar(spark, "1996-03", "1999-10")
    return within_calendar(orders, calendar).groupBy("date_key").agg(
        F.count(F.lit(1)).alias("n_orders"), sum_of_amounts("o_totalprice").alias("units")
    )


# Casts and lookups ------------------------------------------------------------------


@query("tolerant_cast", r"""
WITH cells AS (
  SELECT event_type, strftime(ts, '%Y-%m') AS ref_date,
         CASE event_type WHEN 'error' THEN k || 'F' WHEN 'view' THEN ''
              WHEN 'signup' THEN k || '.7' WHEN 'purchase' THEN '..' ELSE k END AS cell
  FROM (SELECT *, regexp_extract(props, '(\d+)', 1) AS k FROM events)
)
SELECT event_type, CAST(replace(ref_date, '-', '') || '01' AS INTEGER) AS date_key,
       COUNT(*) AS n_cells, COUNT(TRY_CAST(cell AS DECIMAL(18,2))) AS n_numbers,
       CAST(SUM(TRY_CAST(cell AS DECIMAL(18,2))) AS DOUBLE) AS total,
       CAST(SUM(CAST(ROUND(TRY_CAST(cell AS DECIMAL(38,6)), 0) AS BIGINT)) AS DOUBLE)
         AS total_count
FROM cells GROUP BY ALL""")
def tolerant_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = F.regexp_extract("props", r"(\d+)", 1)
    kind = F.col("event_type")
    cell = (
        F.when(kind == "error", F.concat(digits, F.lit("F")))
        .when(kind == "view", "")
        .when(kind == "signup", F.concat(digits, F.lit(".7")))
        .when(kind == "purchase", "..")
        .otherwise(digits)
    )
    cells = table(spark, sf_dir, "events").select(
        "event_type", F.date_format("ts", "yyyy-MM").alias("ref_date"), cell.alias("cell")
    )
    return cells.groupBy("event_type", month_key_of_text("ref_date").alias("date_key")).agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.count(decimal_cell("cell")).alias("n_numbers"),
        F.sum(decimal_cell("cell")).alias("total"),
        F.sum(count_cell("cell")).cast("double").alias("total_count"),
    )


def customers_with_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers looked up by nation label in a dimension that lacks some labels."""
    nation = table(spark, sf_dir, "nation")
    dim = with_unknown(
        nation.filter("n_nationkey % 7 <> 0").select(
            (F.col("n_nationkey") + 1).cast("int").alias("nation_key"), "n_name"
        ),
        {"nation_key": vocab.UNKNOWN_KEY, "n_name": "Unknown"},
    )
    labelled = table(spark, sf_dir, "customer").join(
        nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("label")),
        "c_nationkey",
    )
    keyed = lookup_key(labelled, dim, "label", "n_name", "nation_key")
    coverage = constant_key(
        dims.dim_coverage(spark), vocab.TOWNS, "coverage_name", "coverage_key"
    )
    return keyed.withColumn("coverage_key", coverage)


_KEYED = """
WITH keyed AS (
  SELECT c_acctbal, CASE WHEN n_nationkey % 7 <> 0 THEN n_nationkey + 1 ELSE -1 END AS nation_key,
         1 AS coverage_key
  FROM customer JOIN nation ON n_nationkey = c_nationkey
)
"""


@query("lookup_unknown_member", _KEYED + """
SELECT CAST(nation_key AS INTEGER) AS nation_key, CAST(coverage_key AS INTEGER) AS coverage_key,
       COUNT(*) AS n_customers, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM keyed GROUP BY ALL""")
def lookup_unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers_with_keys(spark, sf_dir).groupBy("nation_key", "coverage_key").agg(
        F.count(F.lit(1)).alias("n_customers"),
        sum_of_amounts("c_acctbal").alias("balance"),
    )


@query("unknown_rows", _KEYED + """
SELECT 'nation_key' AS key, COUNT(*) AS total_rows, COUNT(*) FILTER (nation_key = -1)
       AS unknown_rows FROM keyed
UNION ALL SELECT 'coverage_key', COUNT(*), COUNT(*) FILTER (coverage_key = -1) FROM keyed""")
def unknown_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unknown_rows(customers_with_keys(spark, sf_dir), ["nation_key", "coverage_key"])


# (dimension, its key, fact, the fact's key)
EDGES = (
    ("closed_orders", "o_orderkey", "lineitem", "l_orderkey"),
    ("part", "p_partkey", "lineitem", "l_partkey"),
    ("supplier", "s_suppkey", "lineitem", "l_suppkey"),
    ("customer", "c_custkey", "orders", "o_custkey"),
    ("nation", "n_nationkey", "customer", "c_nationkey"),
    ("region", "r_regionkey", "nation", "n_regionkey"),
)


@query("orphan_rows", "WITH closed_orders AS (SELECT * FROM orders WHERE o_orderstatus <> 'P')\n"
       + "\nUNION ALL ".join(
           f"SELECT '{dim}' AS dim, '{fact}' AS fact, '{key}' AS key, COUNT(*) AS orphan_rows "
           f"FROM {fact} WHERE {key} NOT IN (SELECT {dim_key} FROM {dim})"
           for dim, dim_key, fact, key in EDGES))
def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a dimension row per edge; open orders are left out to seed some."""
    names = ("part", "supplier", "customer", "nation", "region", "orders", "lineitem")
    tables = {name: table(spark, sf_dir, name) for name in names}
    tables["closed_orders"] = tables["orders"].filter("o_orderstatus <> 'P'")
    return quality.referential_integrity(tables, EDGES)


@query("union_coverages", f"""
WITH base AS (
  SELECT CAST(strftime(o_orderdate, '%Y%m01') AS INTEGER) AS date_key, c_mktsegment AS segment,
         CAST(o_totalprice AS DECIMAL(18,2)) AS units
  FROM orders JOIN customer ON c_custkey = o_custkey
)
SELECT coverage_name, date_key, CAST(SUM(units) AS DOUBLE) AS units FROM (
  SELECT '{vocab.TOWNS}' AS coverage_name, date_key, units FROM base
  UNION ALL SELECT '{vocab.METROS}', date_key, units FROM base WHERE segment = 'BUILDING')
GROUP BY ALL""")
def union_coverages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping coverages, tagged; summed per segment first, so only once scanned."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", month_key_of_date("o_orderdate").alias("date_key"), "o_totalprice"
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment"
    )
    per_segment = (
        orders.join(customers, "o_custkey")
        .groupBy("date_key", "c_mktsegment")
        .agg(sum_of_amounts("o_totalprice").alias("units"))
    )
    tags = F.array_compact(F.array(
        F.lit(vocab.TOWNS), F.when(F.col("c_mktsegment") == "BUILDING", F.lit(vocab.METROS))
    ))
    tagged = per_segment.select(F.explode(tags).alias("coverage_name"), "date_key", "units")
    return tagged.groupBy("coverage_name", "date_key").agg(F.sum("units").alias("units"))


# Labels -----------------------------------------------------------------------------


@query("label_union", """
SELECT n_name AS label FROM nation UNION SELECT r_name FROM region
UNION SELECT c_mktsegment FROM customer UNION SELECT p_type FROM part
UNION SELECT p_brand FROM part UNION SELECT o_orderpriority FROM orders""")
def label_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = (("nation", "n_name"), ("region", "r_name"), ("customer", "c_mktsegment"),
               ("part", "p_type"), ("part", "p_brand"), ("orders", "o_orderpriority"))
    return distinct_labels([(table(spark, sf_dir, t), c) for t, c in sources], "label")


def _pick_literal(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def place_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place labels of every shape, one per customer."""
    p = _pick_literal(PROVINCES, F.col("c_nationkey") % 10)
    q = _pick_literal(PROVINCES, (F.col("c_nationkey") + 3) % 10)
    total = _pick_literal(list(vocab.KNOWN_TOTALS), F.floor(F.col("c_custkey") / 8) % 8)
    name, shape = F.col("c_name"), F.col("c_custkey") % 8

    def text(*parts) -> Column:
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    label = (
        F.when(shape == 0, text("  ", p, " "))
        .when(shape == 1, text(name, ", ", p))
        .when(shape == 2, text(p, " excluding ", name))
        .when(shape == 3, text(name, ", Port, and Bay, ", p))
        .when(shape == 4, text(name, ", ", p, " part, ", p, "/", q))
        .when(shape == 5, text(name, ", ", p, "/", q))
        .when(shape == 6, text(name, ", Underwater"))
        .otherwise(total)
    )
    customers = table(spark, sf_dir, "customer").select(label.alias("label"))
    return distinct_labels([(customers, "label")], "geo_name")


def _contains_case(text: str) -> str:
    whens = " ".join(f"WHEN contains({text}, '{p}') THEN '{p}'" for p in PROVINCES)
    return f"CASE {whens} END"


_CODES = " ".join(f"WHEN '{p}' THEN '{c}'" for p, c in vocab.PROVINCES.items())
_REGION_OF = " ".join(
    f"WHEN '{c}' THEN '{r}'" for c, r in vocab.ARREARS_REGION_OF_PROVINCE.items()
)
_PARTS = " ".join(f"WHEN contains(name, '{p} part,') THEN '{p}'" for p in PROVINCES)

_PLACES = f"""
WITH raw AS (
  SELECT c_name AS n, c_custkey % 8 AS shape,
         list_extract([{_PROVINCE_LIST}], c_nationkey % 10 + 1) AS p,
         list_extract([{_PROVINCE_LIST}], (c_nationkey + 3) % 10 + 1) AS q,
         list_extract([{_TOTALS_LIST}], c_custkey // 8 % 8 + 1) AS t
  FROM customer
),
labels AS (
  SELECT DISTINCT CASE shape WHEN 0 THEN '  ' || p || ' ' WHEN 1 THEN n || ', ' || p
         WHEN 2 THEN p || ' excluding ' || n WHEN 3 THEN n || ', Port, and Bay, ' || p
         WHEN 4 THEN n || ', ' || p || ' part, ' || p || '/' || q
         WHEN 5 THEN n || ', ' || p || '/' || q WHEN 6 THEN n || ', Underwater' ELSE t END
         AS geo_name FROM raw
),
named AS (SELECT geo_name, trim(geo_name) AS name FROM labels),
tailed AS (SELECT *, trim(list_extract(string_split(name, ','), -1)) AS tail FROM named),
found AS (
  SELECT *, COALESCE(CASE {_PARTS} END, CASE WHEN tail IN ({_PROVINCE_LIST}) THEN tail END,
                     {_contains_case('name')}) AS mentioned FROM tailed
),
ruled AS (
  SELECT *, CASE WHEN name = 'Canada' THEN 0 WHEN name IN ({_TOTALS_LIST}) THEN 10
         WHEN name IN ({_PROVINCE_LIST}) THEN 20 WHEN contains(name, ' excluding ') THEN 30
         WHEN contains(name, ', and ') THEN 35
         WHEN contains(name, ',') AND mentioned IS NOT NULL THEN 40 ELSE 999 END AS sort_order
  FROM found
),
placed AS (
  SELECT geo_name, CASE sort_order WHEN 0 THEN 'Country' WHEN 20 THEN 'Province'
         WHEN 40 THEN 'CMA' WHEN 999 THEN 'Unknown' ELSE 'Region' END AS geo_level,
         CASE WHEN sort_order IN (20, 30, 35, 40) THEN mentioned END AS province_name,
         sort_order IN (0, 10, 30, 35)
           OR (sort_order = 40 AND contains(tail, '/') AND NOT contains(name, ' part,'))
           AS is_aggregate,
         CAST(sort_order AS INTEGER) AS sort_order FROM ruled
),
coded AS (SELECT *, CASE province_name {_CODES} END AS province_code FROM placed),
places AS (SELECT *, CASE province_code {_REGION_OF} END AS arrears_region FROM coded)
"""


@query("classify_labels", _PLACES + "SELECT * FROM places")
def classify_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.with_place(place_labels(spark, sf_dir), "geo_name")


@query("province_lookup", _PLACES + f"""
SELECT province_code, r.code AS region_code, CAST(COALESCE(r.k, -1) AS INTEGER)
       AS arrears_region_key, COUNT(*) AS n_labels
FROM places LEFT JOIN (SELECT unnest([{", ".join(f"'{r[1]}'" for r in vocab.ARREARS_REGIONS)}])
  AS code, unnest(range(1, {len(vocab.ARREARS_REGIONS) + 1})) AS k) r
  ON r.code = arrears_region GROUP BY ALL""")
def province_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Province codes bridged to the regions of the arrears report."""
    placed = labels.with_place(place_labels(spark, sf_dir), "geo_name")
    keyed = lookup_key(
        placed, dims.dim_arrears_region(spark), "arrears_region", "region_code",
        "arrears_region_key",
    )
    return keyed.groupBy(
        "province_code", F.col("arrears_region").alias("region_code"), "arrears_region_key"
    ).agg(F.count(F.lit(1)).alias("n_labels"))


@query("surrogate_keys", _PLACES + """
SELECT CAST(row_number() OVER (ORDER BY sort_order, geo_name) AS INTEGER) AS geography_key,
       geo_name, geo_level, province_name, province_code, arrears_region, is_aggregate, sort_order
FROM places
UNION ALL SELECT -1, 'Unknown', 'Unknown', NULL, NULL, NULL, FALSE, 9999""")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.number_places(place_labels(spark, sf_dir))


@query("unclassified_labels", _PLACES + """
SELECT geo_name FROM places WHERE geo_level = 'Unknown'""")
def unclassified_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels no rule claims, for someone to look at."""
    places = labels.with_place(place_labels(spark, sf_dir), "geo_name")
    # Unnested first: a filter on the rules themselves would repeat them in the plan.
    levels = places.select("geo_name", F.explode(F.array("geo_level")).alias("level"))
    return levels.filter("level = 'Unknown'").select("geo_name")


_SPELLING = """
WITH spelled AS (
  SELECT CASE p_type WHEN 'STANDARD' THEN 'Single-Detached Units' WHEN 'SMALL'
         THEN 'Semi-detached units' WHEN 'MEDIUM' THEN 'ROW UNITS' WHEN 'LARGE'
         THEN 'Apartment and other unit types' WHEN 'PROMO' THEN 'Total units'
         ELSE p_brand || ' homes' END AS label FROM part
),
typed AS (
  SELECT label, CASE lower(label) WHEN 'single-detached units' THEN 'Single-detached'
         WHEN 'semi-detached units' THEN 'Semi-detached' WHEN 'row units' THEN 'Row houses'
         WHEN 'apartment and other unit types' THEN 'Apartments & other'
         WHEN 'total units' THEN 'All types' ELSE label END AS dwelling_category,
         lower(label) = 'total units' AS is_total,
         CAST(CASE lower(label) WHEN 'single-detached units' THEN 1
              WHEN 'semi-detached units' THEN 2 WHEN 'row units' THEN 3
              WHEN 'apartment and other unit types' THEN 4 WHEN 'total units' THEN 9
              ELSE 50 END AS INTEGER) AS sort_order
  FROM spelled
)
"""


def spelled_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types under dwelling spellings, some of them unlisted."""
    spelling = (
        F.when(F.col("p_type") == "STANDARD", "Single-Detached Units")
        .when(F.col("p_type") == "SMALL", "Semi-detached units")
        .when(F.col("p_type") == "MEDIUM", "ROW UNITS")
        .when(F.col("p_type") == "LARGE", "Apartment and other unit types")
        .when(F.col("p_type") == "PROMO", "Total units")
        .otherwise(F.concat("p_brand", F.lit(" homes")))
    )
    counted = (
        table(spark, sf_dir, "part")
        .groupBy(spelling.alias("label"))
        .agg(F.count(F.lit(1)).alias("n_parts"))
    )
    return counted.withColumn("_type", labels.dwelling("label")).select(
        "label", "n_parts", *pick(F.col("_type"), "dwelling_category", "is_total", "sort_order")
    )


@query("type_harmonise", _SPELLING + """
SELECT label, COUNT(*) AS n_parts, dwelling_category, is_total, sort_order
FROM typed GROUP BY ALL""")
def type_harmonise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelled_types(spark, sf_dir)


@query("sorted_members", _SPELLING + """
SELECT CAST(row_number() OVER (ORDER BY sort_order, label) AS INTEGER) AS position, label,
       sort_order FROM (SELECT DISTINCT label, sort_order FROM typed)""")
def sorted_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members numbered in display order, which is not the alphabet's."""
    members = spelled_types(spark, sf_dir).select("label", "sort_order")
    return surrogate_key(members, "position", ["sort_order", "label"])


PRODUCT_SHAPES = (
    "Total, funds advanced, residential mortgages, insured",
    "Variable rate, funds advanced, residential mortgages, uninsured, ",
    "Fixed rate, outstanding balances, non-residential mortgages, ",
    "Variable rate mortgages, open, ",
    "Business loans, ",
    "Consumer credit, non-mortgage loans, ",
    "Leasing receivables, ",
)
_SHAPES = ", ".join(f"'{s}'" for s in PRODUCT_SHAPES)


@query("product_family", f"""
WITH products AS (
  SELECT p_size % 7 AS k, list_extract([{_SHAPES}], p_size % 7 + 1)
         || CASE WHEN p_size % 7 = 0 THEN '' ELSE p_brand END AS product_name FROM part
)
SELECT product_name, COUNT(*) AS n_parts,
       list_extract(['Residential mortgage', 'Residential mortgage', 'Commercial mortgage',
         'Variable rate mortgage (alternative split)', 'Business loan', 'Consumer credit',
         'Other'], k + 1) AS product_family,
       list_extract(['All', 'Variable', 'Fixed', 'Variable', 'All', 'All', 'All'], k + 1)
         AS rate_type,
       list_extract(['Insured', 'Uninsured', 'All', 'All', 'All', 'All', 'All'], k + 1)
         AS insurance_status,
       k = 0 AS is_total
FROM products GROUP BY ALL""")
def product_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = F.col("p_size") % 7
    sentence = F.concat(
        _pick_literal(list(PRODUCT_SHAPES), shape),
        F.when(shape == 0, F.lit("")).otherwise(F.col("p_brand")),
    )
    counted = (
        table(spark, sf_dir, "part")
        .groupBy(sentence.alias("product_name"))
        .agg(F.count(F.lit(1)).alias("n_parts"))
    )
    fields = ("product_family", "rate_type", "insurance_status", "is_total")
    return counted.withColumn("_product", labels.credit_product("product_name")).select(
        "product_name", "n_parts", *pick(F.col("_product"), *fields)
    )


# Quality ----------------------------------------------------------------------------


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS rows FROM lineitem
GROUP BY ALL HAVING COUNT(*) > 1""")
def duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("label_unique", """
SELECT 'p_name' AS label_column, p_name AS label, COUNT(*) AS rows FROM part
GROUP BY p_name HAVING COUNT(*) > 1
UNION ALL SELECT 'n_name', n_name, COUNT(*) FROM nation GROUP BY n_name HAVING COUNT(*) > 1
UNION ALL SELECT 'c_name', c_name, COUNT(*) FROM customer GROUP BY c_name HAVING COUNT(*) > 1""")
def label_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stack([
        duplicate_keys(table(spark, sf_dir, name), [column]).select(
            F.lit(column).alias("label_column"), F.col(column).alias("label"), "rows"
        )
        for name, column in (("part", "p_name"), ("nation", "n_name"), ("customer", "c_name"))
    ])


@query("table_totals", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}"
    for t in ("orders", "lineitem", "events", "customer", "part")))
def table_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("orders", "lineitem", "events", "customer", "part")
    return row_totals({name: table(spark, sf_dir, name) for name in names})


@query("reconcile_joined_totals", """
WITH ours AS (
  SELECT CAST(strftime(l_shipdate, '%Y%m01') AS INTEGER) AS date_key,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem GROUP BY 1
),
theirs AS (
  SELECT CAST(strftime(o_orderdate, '%Y%m01') AS INTEGER) AS date_key,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1
),
paired AS (
  SELECT CAST(date_key AS VARCHAR) AS detail, CAST(o.total AS DOUBLE) AS our_value,
         CAST(t.total AS DOUBLE) AS published_value
  FROM ours o JOIN theirs t USING (date_key) WHERE t.total > 0
),
gap AS (SELECT *, 100.0::DOUBLE * abs(our_value - published_value)
        / NULLIF(abs(published_value), 0) AS difference FROM paired)
SELECT 'lines add up to orders' AS check_name, detail, our_value, published_value, difference,
       1.0::DOUBLE AS allowed, '%' AS units, COALESCE(difference <= 1.0, FALSE) AS close_enough
FROM gap""")
def reconcile_joined_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals kept in two tables: each summed to the month first, then joined."""

    def monthly(name: str, date: str, amount: str) -> DataFrame:
        return table(spark, sf_dir, name).groupBy(month_key_of_date(date).alias("date_key")).agg(
            sum_of_amounts(amount).alias("total")
        )

    paired = reconcile.pair_totals(
        monthly("lineitem", "l_shipdate", "l_extendedprice"),
        monthly("orders", "o_orderdate", "o_totalprice"),
        ["date_key"],
    )
    detail = F.col("date_key").cast("string")
    return reconcile.score(
        reconcile.comparison(paired, "lines add up to orders", detail), "percent"
    )


# Report text ------------------------------------------------------------------------

REPORT_REGIONS = {"A": "ATLANTIC", "N": "BRITISH COLUMBIA", "R": "TERRITORIES"}
RECORDS_PER_PAGE = 40

_REPORT = """
WITH recs AS (
  SELECT l_suppkey AS doc_id, CASE l_returnflag WHEN 'A' THEN 'ATLANTIC'
         WHEN 'N' THEN 'BRITISH COLUMBIA' ELSE 'TERRITORIES' END AS region,
         strftime(l_shipdate, '%Y-%m') AS month, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT)
           AS total, COUNT(*) FILTER (l_linestatus = 'F') AS late
  FROM lineitem GROUP BY ALL
)
"""


def report_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One printed record per supplier, region and month; one region hides its counts."""
    region = F.coalesce(*[
        F.when(F.col("l_returnflag") == flag, F.lit(name)) for flag, name in REPORT_REGIONS.items()
    ])
    counted = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("doc_id"), region.alias("region"),
        F.date_format("l_shipdate", "yyyy-MM").alias("month"),
    ).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total"),
        F.count_if(F.col("l_linestatus") == "F").alias("late"),
    )
    hundredths = F.expr("(20000 * late + total) div (2 * total)")
    rate = (hundredths.cast("decimal(12,2)") / 100).cast("decimal(12,2)").cast("string")
    open_record = F.concat(
        "month", F.lit("  "), F.format_number("total", 0), F.lit("  "),
        F.format_number("late", 0), F.lit("  "), rate, F.lit("%"),
    )
    hidden_record = F.concat("month", F.lit("  "), F.format_number("total", 0))
    record = F.when(F.col("region") == "TERRITORIES", hidden_record).otherwise(open_record)
    return counted.withColumn("record", record)


def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records laid out as text: two per line, a header on each region's first page.

    Each page repeats the last record of the page before, as reports do at page breaks,
    and page 0 is a summary without a section.  A supplier's region has one record per
    calendar month, so its list of records is short.
    """
    listed = report_records(spark, sf_dir).groupBy("doc_id", "region").agg(
        F.array_sort(F.collect_list(F.struct("month", "record")))["record"].alias("records")
    )
    last_page = F.floor((F.size("records") - 1) / RECORDS_PER_PAGE).cast("int")
    paged = listed.select(
        "doc_id", "region", "records", F.explode(F.sequence(F.lit(0), last_page)).alias("page")
    )
    repeated = F.when(F.col("page") > 0, 1).otherwise(0)
    start = F.col("page") * RECORDS_PER_PAGE + 1 - repeated
    printed = paged.withColumn("shown", F.slice("records", start, RECORDS_PER_PAGE + repeated))
    lines = F.transform(
        F.sequence(F.lit(0), F.size("shown") - 1, F.lit(2)),
        lambda i: F.concat_ws("    ", F.get("shown", i), F.get("shown", i + 1)),
    )
    section = F.array_position(
        F.array(*[F.lit(name) for name in REPORT_REGIONS.values()]), F.col("region")
    )
    header = F.when(
        F.col("page") == 0, F.concat(F.lit("REGION: "), "region", F.lit("**\n"))
    ).otherwise(F.lit(""))
    pages = printed.select(
        "doc_id",
        (section.cast("long") * 2**32 + F.col("page")).alias("page_no"),
        F.concat(
            header, F.lit("As at   Total   Arrears\n"), F.array_join(lines, "\n")
        ).alias("text"),
    )
    summaries = listed.select("doc_id").distinct().select(
        "doc_id", F.lit(0).cast("long").alias("page_no"),
        F.lit("All sections\n1999-01  1,234,567  8,901  0.72%").alias("text"),
    )
    return stack([summaries, pages])


def stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as a stored table, which is how report text arrives."""
    folder = sf_dir.strip("/").replace("/", "_")
    path = f"{shared_dir(spark)}/pages-{spark.sparkContext.applicationId}-{folder}"
    report_pages(spark, sf_dir).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("extract_report_rows", _REPORT + """
SELECT doc_id, region, month, CAST(total AS DOUBLE) AS total_mortgages,
       CASE WHEN region <> 'TERRITORIES' THEN CAST(late AS DOUBLE) END AS mortgages_in_arrears,
       CASE WHEN region <> 'TERRITORIES'
            THEN CAST(CAST((20000 * late + total) // (2 * total) AS DECIMAL(12,2)) / 100
                 AS DOUBLE) END AS arrears_rate,
       region = 'TERRITORIES' AS suppressed, FALSE AS parse_failed
FROM recs""")
def extract_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extract_records(stored_pages(spark, sf_dir))
    counts = ("total_mortgages", "mortgages_in_arrears")
    return rows.withColumns({c: F.col(c).cast("double") for c in counts})


@query("ffill_header", """
SELECT user_id, event_id, event_type, last_value(CASE WHEN event_type = 'signup' THEN value END
         IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
         ROWS UNBOUNDED PRECEDING) AS last_signup_value
FROM events""")
def ffill_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of each user's latest signup, carried over the events that follow."""
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type",
        F.when(F.col("event_type") == "signup", F.col("value")).alias("header"),
    )
    filled = forward_fill(events, "header", ["user_id"], "event_id", "last_signup_value")
    return filled.drop("header")


@query("dedupe_first", """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn = 1""")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", "ts", "event_id", "value"
    )
    return first_per_key(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


# Weighted price by part type, over the large join ----------------------------------------


@query("price_by_type", """
SELECT p_type, CAST(strftime(l_shipdate, '%Y%m01') AS INTEGER) AS date_key,
       CAST(ROUND(CAST(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
         / CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE)
         AS unit_price
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL""")
def price_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price per unit as a ratio of sums.

    One shuffle of the lines at most: none while the part table is small enough to
    broadcast, and beyond that a sort-merge join whose hot parts AQE splits.  The sums
    combine map-side to one row per type and month.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        month_key_of_date("l_shipdate").alias("date_key"), "l_extendedprice", "l_quantity",
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    unit_price = ratio(sum_of_amounts("l_extendedprice"), sum_of_amounts("l_quantity"))
    return (
        lines.join(parts, "p_partkey")
        .groupBy("p_type", "date_key")
        .agg(rounded(unit_price, 6).alias("unit_price"))
    )


# Gazetteer ----------------------------------------------------------------------------


@query("gazetteer_names", r"""
WITH labels AS (SELECT DISTINCT p_name || ', ' || p_type || ' of ' || p_brand AS label FROM part),
names AS (
  SELECT p_brand AS name, 0 AS place FROM part WHERE p_size < 10
  UNION SELECT split_part(p_name, ' ', 2), 1 FROM part
  UNION SELECT p_name, 2 FROM part
  UNION SELECT p_name || ' ' || p_type, 3 FROM part WHERE p_size > 40
),
entries AS (
  SELECT array_to_string(regexp_extract_all(name, '[\p{L}\p{N}]+'), ' ') AS run, name, place FROM names
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY place, name) = 1
),
starts AS (
  SELECT label, w, unnest(range(len(w))) AS s
  FROM (SELECT label, regexp_extract_all(label, '[\p{L}\p{N}]+') AS w FROM labels)
),
hits AS (
  SELECT label, s, n, name, place
  FROM (SELECT label, s, n, array_to_string(w[s + 1 : s + n], ' ') AS run
        FROM starts, (SELECT unnest([1, 2, 3, 4]) AS n) WHERE s + n <= len(w)) JOIN entries USING (run)
  QUALIFY row_number() OVER (PARTITION BY label, s ORDER BY n DESC) = 1
),
best AS (
  SELECT label, name, COUNT(*) OVER (PARTITION BY label) AS mentions FROM hits
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY n DESC, place, s) = 1
)
SELECT label, name, COALESCE(mentions, 0) AS mentions FROM labels LEFT JOIN best USING (label)""")
def gazetteer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part's label with the entry it means, of a list as long as the table has names."""
    part = table(spark, sf_dir, "part")
    labels = part.select(F.concat("p_name", F.lit(", "), "p_type", F.lit(" of "), "p_brand").alias("label"))
    listed = [
        (part.filter("p_size < 10"), F.col("p_brand")),
        (part, F.split_part("p_name", F.lit(" "), F.lit(2))),
        (part, F.col("p_name")),
        (part.filter("p_size > 40"), F.concat("p_name", F.lit(" "), "p_type")),
    ]
    names = stack([rows.select(name.alias("name"), F.lit(n).alias("place")).distinct()
                   for n, (rows, name) in enumerate(listed)])
    return gazetteer.named_in(labels, "label", names, "name", "place")


# Distinct counts ------------------------------------------------------------------------


@query("distinct_rollup", """
WITH seen AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, user_id FROM events)
SELECT day, event_type, COUNT(DISTINCT user_id) AS users FROM seen GROUP BY day, event_type
UNION ALL SELECT day, NULL, COUNT(DISTINCT user_id) FROM seen GROUP BY day
UNION ALL SELECT NULL, event_type, COUNT(DISTINCT user_id) FROM seen GROUP BY event_type
UNION ALL SELECT NULL, NULL, COUNT(DISTINCT user_id) FROM seen""")
def distinct_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by day and type, by either, and in all, from one pass over the events."""
    seen = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", F.col("user_id"))
    shared_dir(spark)
    states = distinct_states(seen, "user_id", ["day", "event_type"]).checkpoint()
    shown = [F.lit(None).cast("string").alias("day"), F.lit(None).cast("string").alias("event_type")]
    levels = []
    for by in (["day", "event_type"], ["day"], ["event_type"], []):
        counted = distinct_count(states, by, "users")
        levels.append(counted.select(
            *[F.col(c) if c in by else none for c, none in zip(("day", "event_type"), shown, strict=True)],
            "users"))
    return stack(levels)
