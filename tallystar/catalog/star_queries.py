"""Queries answered by the star: views, questions, measures, checks, builders."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.catalog import query
from tallystar.catalog.star_sql import ARREARS, EVERYTHING, HOUSING, LINES, month_key
from tallystar.functions.scalars import decimal_cell, rounded
from tallystar.operators import quality, reconcile
from tallystar.operators.aggregates import exclude_aggregates, row_totals, stack, sum_of_amounts
from tallystar.operators.timeseries import last_period_with_data, latest_only
from tallystar.plans import (
    checks, dims, facts, fusion, measures, questions, roles, views, warehouse,
)
from tallystar.schemas import CHECK_RESULTS, FACTS, GRAIN
from tallystar.session import shared_dir
from tallystar.sources import releases
from tallystar.sources.tables import FOLDER

#: The published questions start in a year of their own data; here every year counts.
EVERY_YEAR = 0


def towns() -> dict[str, Column]:
    return {"dim_coverage": F.col("coverage_name") == vocab.TOWNS}


PROVINCES = {"level": "Province", "dwelling": "total"}


# Views and questions --------------------------------------------------------------

_CHANGED = HOUSING + """,
starts AS (
  SELECT date_key, year_month, year, mi, coverage, geo, level, province, units
  FROM housing WHERE stage = 'Starts' AND is_total AND (NOT agg OR level = 'Country')
),
compared AS (
  SELECT s.*, l.units AS before, s.units - l.units AS change
  FROM starts s JOIN starts l ON l.coverage = s.coverage AND l.geo = s.geo AND l.mi = s.mi - 12
),
changed AS (
  SELECT date_key, year_month, year, geo AS geo_name, level AS geo_level,
         province AS province_name, coverage AS coverage_name, CAST(units AS DOUBLE) AS units,
         CAST(before AS DOUBLE) AS units_last_year, CAST(change AS DOUBLE) AS change_vs_last_year,
         100.0::DOUBLE * CAST(change AS DOUBLE) / NULLIF(CAST(before AS DOUBLE), 0) AS percent_change,
         100.0::DOUBLE * CAST(change AS DOUBLE) / NULLIF(CAST(SUM(abs(change)) OVER (
           PARTITION BY date_key, coverage, level) AS DOUBLE), 0) AS share_of_national_change
  FROM compared
)
"""


@query("what_changed", _CHANGED + "SELECT * FROM changed")
def what_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.what_changed(roles.star(spark, sf_dir))


@query("top_movers", _CHANGED + f"""
SELECT year_month, geo_name, units, units_last_year, change_vs_last_year,
       CAST(ROUND(CAST(percent_change AS DECIMAL(38,10)), 1) AS DOUBLE) AS percent_change,
       CAST(ROUND(CAST(share_of_national_change AS DECIMAL(38,10)), 1) AS DOUBLE) AS share_of_change
FROM changed WHERE geo_level = 'Province' AND coverage_name = '{vocab.TOWNS}'
  AND date_key = (SELECT MAX(date_key) FROM changed)
ORDER BY abs(change_vs_last_year) DESC NULLS LAST, geo_name LIMIT 10""")
def top_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.top_movers(views.what_changed(roles.star(spark, sf_dir)))


def _health_sql(mode: str) -> str:
    frame = "RANGE" if mode == "calendar" else "ROWS"
    return HOUSING + f""",
stages AS (
  SELECT date_key, m, year_month, year, mi, coverage, geo, level, province, dwelling,
         SUM(CASE WHEN stage = 'Starts' THEN units END) AS starts,
         SUM(CASE WHEN stage = 'Under construction' THEN units END) AS open,
         SUM(CASE WHEN stage = 'Completions' THEN units END) AS built
  FROM housing WHERE NOT agg OR level = 'Country' GROUP BY ALL
),
rolled AS (
  SELECT *, SUM(starts) OVER w AS starts12, SUM(built) OVER w AS built12 FROM stages
  WINDOW w AS (PARTITION BY coverage, geo, dwelling ORDER BY mi
               {frame} BETWEEN 11 PRECEDING AND CURRENT ROW)
),
health AS (
  SELECT date_key, strftime(m, '%Y-%m-%d') AS date, year_month, year, geo AS geo_name,
         level AS geo_level, province AS province_name,
         CASE WHEN province IN ('Newfoundland and Labrador', 'Prince Edward Island',
                                'Nova Scotia', 'New Brunswick') THEN 'ATLANTIC'
              ELSE upper(province) END AS arrears_region,
         coverage AS coverage_name, dwelling AS dwelling_type_name,
         CASE dwelling WHEN 'Single-detached units' THEN 'Single-detached'
              WHEN 'Semi-detached units' THEN 'Semi-detached' WHEN 'Row units' THEN 'Row houses'
              WHEN 'Apartment and other units' THEN 'Apartments & other'
              ELSE 'All types' END AS dwelling_category,
         CAST(starts AS DOUBLE) AS starts, CAST(open AS DOUBLE) AS under_construction,
         CAST(built AS DOUBLE) AS completions,
         CAST(starts12 AS DOUBLE) AS starts_last_12_months,
         CAST(built12 AS DOUBLE) AS completions_last_12_months,
         CAST(built12 AS DOUBLE) / NULLIF(CAST(starts12 AS DOUBLE), 0) AS completion_ratio,
         CAST(open AS DOUBLE) / NULLIF(CAST(built12 AS DOUBLE) / 12, 0) AS backlog_months
  FROM rolled
)
"""


@query("stage_health", _health_sql("calendar") + "SELECT * FROM health")
def stage_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.pipeline_health(roles.star(spark, sf_dir))


@query("stage_health_rows", _health_sql("rows") + "SELECT * FROM health")
def stage_health_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.pipeline_health(roles.star(spark, sf_dir), mode="rows")


@query("backlog_topk", _health_sql("calendar") + f"""
SELECT year_month, geo_name, starts_last_12_months, completions_last_12_months,
       CAST(ROUND(CAST(completion_ratio AS DECIMAL(38,10)), 2) AS DOUBLE) AS completion_ratio,
       under_construction,
       CAST(ROUND(CAST(backlog_months AS DECIMAL(38,10)), 1) AS DOUBLE) AS backlog_months
FROM health WHERE coverage_name = '{vocab.METROS}' AND dwelling_type_name = 'Total units'
  AND backlog_months IS NOT NULL AND date_key = (
    SELECT MAX(date_key) FROM health WHERE backlog_months IS NOT NULL AND coverage_name = '{vocab.METROS}'
      AND dwelling_type_name = 'Total units')
ORDER BY health.backlog_months DESC, geo_name LIMIT 10""")
def backlog_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.biggest_backlogs(views.pipeline_health(roles.star(spark, sf_dir)))


@query("backlog_ratio_of_sums", _health_sql("calendar") + f"""
SELECT year_month, SUM(starts_last_12_months::DECIMAL(38,2))::DOUBLE AS started_last_12_months,
       SUM(completions_last_12_months::DECIMAL(38,2))::DOUBLE AS finished_last_12_months,
       SUM(under_construction::DECIMAL(38,2))::DOUBLE AS still_under_construction,
       CAST(ROUND(CAST(SUM(under_construction::DECIMAL(38,2))::DOUBLE / NULLIF(
         SUM(completions_last_12_months::DECIMAL(38,2))::DOUBLE / 12, 0)
         AS DECIMAL(38,10)), 1) AS DOUBLE) AS backlog_months
FROM health WHERE coverage_name = '{vocab.METROS}' AND dwelling_type_name = 'Total units'
  AND date_key % 10000 = 601 GROUP BY year_month""")
def backlog_ratio_of_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    health = views.pipeline_health(roles.star(spark, sf_dir))
    return questions.june_backlog(health, from_year=EVERY_YEAR)


_TREND = ARREARS + """,
trend AS (
  SELECT a.date_key, strftime(a.m, '%Y-%m-%d') AS date, a.year_month, a.year,
         a.region AS region_name, a.covers AS covers_provinces, a.nat AS is_national,
         CAST(a.total AS DOUBLE) AS total_mortgages, CAST(a.late AS DOUBLE) AS mortgages_in_arrears,
         CAST(a.rate AS DOUBLE) AS arrears_rate, a.hidden AS is_hidden,
         CAST(b.rate AS DOUBLE) AS arrears_rate_last_year,
         CAST(a.rate - b.rate AS DOUBLE) AS change_vs_last_year,
         CAST(n.rate AS DOUBLE) AS mortgage_rate_now,
         CAST(t.rate AS DOUBLE) AS mortgage_rate_18_months_ago
  FROM arrears_typed a
  LEFT JOIN arrears_typed b ON b.region = a.region AND b.mi = a.mi - 12
  LEFT JOIN mortgage_rate n ON n.mi = a.mi
  LEFT JOIN mortgage_rate t ON t.mi = a.mi - 18
)
"""


def _counts_as_double(frame: DataFrame, *names: str) -> DataFrame:
    """Counts that may be missing, as double: engines differ on nullable integers."""
    return frame.withColumns({n: F.col(n).cast("double") for n in names})


@query("arrears_trend", _TREND + "SELECT * FROM trend")
def arrears_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = views.arrears_trend(roles.star(spark, sf_dir))
    return _counts_as_double(trend, "total_mortgages", "mortgages_in_arrears")


@query("arrears_latest", _TREND + """
SELECT year_month, region_name, covers_provinces, total_mortgages, mortgages_in_arrears,
       arrears_rate,
       CAST(ROUND(CAST(arrears_rate_last_year AS DECIMAL(38,10)), 2) AS DOUBLE) AS rate_a_year_ago,
       CAST(ROUND(CAST(change_vs_last_year AS DECIMAL(38,10)), 3) AS DOUBLE) AS change
FROM trend WHERE date_key = (SELECT MAX(date_key) FROM trend)""")
def arrears_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = questions.latest_arrears(views.arrears_trend(roles.star(spark, sf_dir)))
    return _counts_as_double(latest, "total_mortgages", "mortgages_in_arrears")


@query("rate_lag_calendar", _TREND + """
SELECT year_month, arrears_rate,
       CAST(ROUND(CAST(mortgage_rate_now AS DECIMAL(38,10)), 2) AS DOUBLE) AS rate_now,
       CAST(ROUND(CAST(mortgage_rate_18_months_ago AS DECIMAL(38,10)), 2) AS DOUBLE)
         AS rate_18_months_ago
FROM trend WHERE is_national AND date_key % 10000 = 601""")
def rate_lag_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = views.arrears_trend(roles.star(spark, sf_dir))
    return questions.june_arrears_and_rates(trend, from_year=EVERY_YEAR)


@query("unsold_topk", LINES + """
SELECT year_month, geo AS geo_name, CAST(absorptions AS DOUBLE) AS absorptions,
       CAST(unabsorbed AS DOUBLE) AS unabsorbed_inventory,
       CAST(ROUND(CAST(100.0::DOUBLE * CAST(unabsorbed AS DOUBLE)
         / NULLIF(CAST(absorptions + unabsorbed AS DOUBLE), 0) AS DECIMAL(38,10)), 1) AS DOUBLE)
         AS percent_unsold
FROM absorption WHERE is_total AND NOT agg AND unabsorbed IS NOT NULL
  AND date_key = (SELECT MAX(date_key) FROM absorption)
ORDER BY unabsorbed DESC, geo LIMIT 10""")
def unsold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.unsold_homes(roles.star(spark, sf_dir))


# Measures ---------------------------------------------------------------------------


def _long(frames: dict[str, DataFrame], *by: str) -> DataFrame:
    """Measures with the same groups, stacked as (measure, groups, value)."""
    return stack([
        frame.select(F.lit(name).alias("measure"), *by, F.col(name).cast("double").alias("value"))
        for name, frame in frames.items()
    ])


_PACE_SQL = HOUSING + f""",
picked AS (
  SELECT date_key, mi, geo AS geo_name, stage, units FROM housing
  WHERE level = 'Province' AND is_total AND coverage = '{vocab.TOWNS}'
),
wide AS (
  SELECT geo_name, date_key, mi, SUM(CASE WHEN stage = 'Starts' THEN units END) AS s,
         SUM(CASE WHEN stage = 'Completions' THEN units END) AS c,
         SUM(CASE WHEN stage = 'Under construction' THEN units END) AS o
  FROM picked GROUP BY ALL
),
grid AS (
  SELECT g.geo_name, m.mi, {month_key("m.mi")} AS date_key, s, c, o, w.mi IS NOT NULL AS own
  FROM (SELECT DISTINCT geo_name FROM wide) g CROSS JOIN months m
  LEFT JOIN wide w ON w.geo_name = g.geo_name AND w.mi = m.mi
),
pace AS (
  SELECT geo_name, date_key, mi, own, s, c, o, SUM(s) OVER w AS sy, SUM(c) OVER w AS cy,
         COUNT(*) FILTER (own) OVER w AS seen,
         CAST(SUM(c) OVER w AS DOUBLE) / NULLIF(CAST(SUM(s) OVER w AS DOUBLE), 0) AS done,
         CAST(o AS DOUBLE) / NULLIF(CAST(SUM(c) OVER w AS DOUBLE) / 12, 0) AS backlog
  FROM grid WINDOW w AS (PARTITION BY geo_name ORDER BY mi
    RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)
)"""


@query("housing_panel", _PACE_SQL + """
SELECT a.geo_name, a.date_key, CAST(a.s AS DOUBLE) AS housing_starts,
       CAST(a.c AS DOUBLE) AS housing_completions, CAST(a.o AS DOUBLE) AS under_construction,
       CAST(b.s AS DOUBLE) AS housing_starts_last_year,
       CAST(a.s - b.s AS DOUBLE) AS housing_starts_change,
       CAST(a.s - b.s AS DOUBLE) / NULLIF(CAST(b.s AS DOUBLE), 0) AS housing_starts_change_pct,
       CAST(a.sy AS DOUBLE) AS housing_starts_12_months,
       CAST(a.cy AS DOUBLE) AS housing_completions_12_months, a.done AS completion_ratio,
       a.backlog AS backlog_months, b.backlog AS backlog_months_last_year,
       a.backlog - b.backlog AS backlog_months_change
FROM pace a LEFT JOIN pace b ON b.geo_name = a.geo_name AND b.mi = a.mi - 12
WHERE a.own OR b.s IS NOT NULL OR a.sy IS NOT NULL OR a.cy IS NOT NULL OR b.backlog IS NOT NULL""")
def housing_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.star(spark, sf_dir)
    return measures.housing_panel(star, ("geo_name", "date_key"), towns(), **PROVINCES)


def _trailing_sql(name: str, stage: str) -> str:
    """Every month of a stage's series with the sum of its last twelve."""
    return f"""
{name} AS (SELECT geo_name, date_key, mi, units AS v FROM picked WHERE stage = '{stage}'),
{name}_grid AS (
  SELECT g.geo_name, m.mi, {month_key("m.mi")} AS date_key, v, p.mi IS NOT NULL AS own
  FROM (SELECT DISTINCT geo_name FROM {name}) g CROSS JOIN months m
  LEFT JOIN {name} p ON p.geo_name = g.geo_name AND p.mi = m.mi),
{name}_year AS (
  SELECT geo_name, date_key, SUM(v) OVER w AS y, COUNT(*) FILTER (own) OVER w AS seen
  FROM {name}_grid WINDOW w AS (PARTITION BY geo_name ORDER BY mi
    RANGE BETWEEN 11 PRECEDING AND CURRENT ROW))"""


@query("housing_measures", _PACE_SQL + "," + _trailing_sql("starts", "Starts") + ","
       + _trailing_sql("built", "Completions") + f""",
yoy AS (SELECT a.geo_name, a.date_key, a.v, b.v AS ly FROM starts a
  LEFT JOIN starts b ON b.geo_name = a.geo_name AND b.mi = a.mi - 12),
slow AS (SELECT a.geo_name, a.date_key, a.backlog, b.backlog AS ly FROM pace a
  LEFT JOIN pace b ON b.geo_name = a.geo_name AND b.mi = a.mi - 12 AND b.seen > 0
  WHERE a.seen > 0)
SELECT 'housing_starts' AS measure, geo_name, date_key, CAST(v AS DOUBLE) AS value FROM starts
UNION ALL SELECT 'housing_completions', geo_name, date_key, CAST(v AS DOUBLE) FROM built
UNION ALL SELECT 'under_construction', geo_name, date_key, CAST(units AS DOUBLE) FROM picked
  WHERE stage = 'Under construction'
UNION ALL SELECT 'housing_starts_last_year', geo_name, {month_key("mi + 12")},
  CAST(v AS DOUBLE) FROM starts, calendar WHERE mi + 12 <= hi
UNION ALL SELECT 'housing_starts_change', geo_name, date_key, CAST(v - ly AS DOUBLE) FROM yoy
UNION ALL SELECT 'housing_starts_change_pct', geo_name, date_key,
  CAST(v - ly AS DOUBLE) / NULLIF(CAST(ly AS DOUBLE), 0) FROM yoy
UNION ALL SELECT 'housing_starts_12_months', geo_name, date_key, CAST(y AS DOUBLE)
  FROM starts_year WHERE seen > 0
UNION ALL SELECT 'housing_completions_12_months', geo_name, date_key, CAST(y AS DOUBLE)
  FROM built_year WHERE seen > 0
UNION ALL SELECT 'completion_ratio', geo_name, date_key, done FROM pace WHERE seen > 0
UNION ALL SELECT 'backlog_months', geo_name, date_key, backlog FROM pace WHERE seen > 0
UNION ALL SELECT 'backlog_months_last_year', geo_name, {month_key("mi + 12")}, backlog
  FROM pace, calendar WHERE seen > 0 AND mi + 12 <= hi
UNION ALL SELECT 'backlog_months_change', geo_name, date_key, backlog - ly FROM slow""")
def housing_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve measures by name, from one pass over their fact."""
    return fusion.listed(
        roles.star(spark, sf_dir), measures.HOUSING_PANEL, ("geo_name", "date_key"), towns(),
        **PROVINCES)


_PLACE_CHANGE = HOUSING + f""",
starts AS (
  SELECT geo, date_key, mi, units FROM housing
  WHERE stage = 'Starts' AND is_total AND level = 'Province' AND coverage = '{vocab.TOWNS}'
),
moved AS (
  SELECT a.geo, a.date_key, a.units - b.units AS change, b.units AS before
  FROM starts a LEFT JOIN starts b ON b.geo = a.geo AND b.mi = a.mi - 12
),
shared AS (
  SELECT geo AS geo_name, date_key, CAST(change AS DOUBLE)
           / NULLIF(CAST(SUM(abs(change)) OVER (PARTITION BY date_key) AS DOUBLE), 0)
           AS share_of_national_change
  FROM moved
)
"""


@query("share_of_change", _PLACE_CHANGE + "SELECT * FROM shared")
def share_of_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.star(spark, sf_dir)
    return measures.share_of_national_change(star, ("geo_name", "date_key"), towns(), **PROVINCES)


ONE_PLACE = "Ontario"


def _one_place() -> dict[str, Column]:
    return {**towns(), "dim_geography": F.col("geo_name") == ONE_PLACE}


@query("share_of_change_sliced", _PLACE_CHANGE + f"SELECT * FROM shared WHERE geo_name = '{ONE_PLACE}'")
def share_of_change_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place filter narrows the rows shown, not the movement they are a share of."""
    star = roles.star(spark, sf_dir)
    return measures.share_of_national_change(
        star, ("geo_name", "date_key"), _one_place(), **PROVINCES
    )


@query("headline_sliced", _PLACE_CHANGE + f"""
SELECT date_key, CASE WHEN change IS NULL THEN '{vocab.NO_COMPARABLE_MONTH}' ELSE
  geo || ': housing starts ' || CASE WHEN change >= 0 THEN 'up' ELSE 'down' END END AS opening
FROM moved WHERE geo = '{ONE_PLACE}'""")
def headline_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one selected place is named, without being asked for as a column."""
    star = roles.star(spark, sf_dir)
    text = measures.headline(star, ("date_key",), _one_place(), **PROVINCES)
    opening = F.regexp_extract("headline", r"^(.*: housing starts (?:up|down)) ", 1)
    return text.select("date_key", F.when(opening != "", opening).otherwise(F.col("headline")).alias("opening"))


@query("measures_by_year", HOUSING + f""",
starts AS (
  SELECT geo AS geo_name, mi, units FROM housing
  WHERE stage = 'Starts' AND is_total AND level = 'Province' AND coverage = '{vocab.TOWNS}'
),
ends AS (SELECT CAST(mi // 12 AS INTEGER) AS year, MAX(mi) AS last FROM months GROUP BY ALL),
now AS (SELECT geo_name, CAST(mi // 12 AS INTEGER) AS year, SUM(units) AS v FROM starts GROUP BY ALL),
ago AS (
  SELECT geo_name, CAST(mi // 12 + 1 AS INTEGER) AS year, SUM(units) AS v
  FROM starts, calendar WHERE mi + 12 <= hi GROUP BY ALL)
SELECT 'housing_starts_last_year' AS measure, geo_name, year, CAST(v AS DOUBLE) AS value FROM ago
UNION ALL SELECT 'housing_starts_change', geo_name, year, CAST(n.v - a.v AS DOUBLE)
  FROM now n LEFT JOIN ago a USING (geo_name, year)
UNION ALL SELECT 'housing_starts_12_months', geo_name, year, CAST(SUM(units) AS DOUBLE)
  FROM starts JOIN ends ON mi BETWEEN last - 11 AND last GROUP BY geo_name, year""")
def measures_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-shifted measures of whole years: a year against the one before, and the
    twelve months up to its last month in the calendar."""
    names = ("housing_starts_last_year", "housing_starts_change", "housing_starts_12_months")
    return fusion.listed(
        roles.star(spark, sf_dir), names, ("geo_name", "year"), towns(), **PROVINCES)


@query("measures_with_gaps", HOUSING + f""",
starts AS (
  SELECT geo AS geo_name, mi, units FROM housing
  WHERE stage = 'Starts' AND is_total AND level = 'Province' AND coverage = '{vocab.TOWNS}'
),
spread AS (
  SELECT g.geo_name, m.mi, SUM(units) OVER w AS y, COUNT(units) OVER w AS seen
  FROM (SELECT DISTINCT geo_name FROM starts) g CROSS JOIN months m
  LEFT JOIN starts s ON s.geo_name = g.geo_name AND s.mi = m.mi
  WINDOW w AS (PARTITION BY g.geo_name ORDER BY m.mi RANGE BETWEEN 11 PRECEDING AND CURRENT ROW))
SELECT 'housing_starts_last_year' AS measure, geo_name, strftime(make_date(CAST((mi + 12) // 12 AS INTEGER), CAST((mi + 12) % 12 + 1 AS INTEGER), 1), '%Y-%m') AS year_month,
       CAST(units AS DOUBLE) AS value FROM starts, calendar WHERE mi + 12 <= hi
UNION ALL SELECT 'housing_starts_12_months', geo_name, strftime(make_date(CAST(mi // 12 AS INTEGER), CAST(mi % 12 + 1 AS INTEGER), 1), '%Y-%m'),
       CAST(y AS DOUBLE) FROM spread WHERE seen > 0""")
def measures_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last year's value and a trailing sum in every month of the calendar, also in those
    that a series skips: the first and last months of many places, and a few between."""
    star, by = roles.star(spark, sf_dir), ("geo_name", "year_month")
    names = ("housing_starts_last_year", "housing_starts_12_months")
    return _long(
        {n: measures.MEASURES[n](star, by, towns(), **PROVINCES) for n in names}, *by)


#: Several facts by month: what a report's first page shows.
FRONT_PAGE = ("unsold_inventory", "homes_sold_or_rented", "percent_unsold", "new_mortgage_lending",
              "mortgage_debt_outstanding", "variable_rate_share", "mortgage_rate", "arrears_rate")


@query("measures_together", EVERYTHING + """,
sold AS (
  SELECT date_key, SUM(unabsorbed) AS unsold, SUM(absorptions) AS sold FROM absorption
  WHERE level = 'Province' AND is_total GROUP BY date_key),
lent AS (
  SELECT date_key, SUM(funds) AS funds, SUM(balance) AS owed,
         SUM(CASE WHEN lead = 'Variable rate' THEN funds END) AS variable
  FROM residential GROUP BY date_key),
late AS (
  SELECT date_key, CAST(SUM(late) AS DOUBLE) / NULLIF(CAST(SUM(total) AS DOUBLE), 0) AS rate
  FROM arrears WHERE NOT nat GROUP BY date_key),
every AS (
  SELECT date_key FROM sold UNION SELECT date_key FROM lent UNION SELECT date_key FROM late
  UNION SELECT date_key FROM mortgage_rate)
SELECT date_key, CAST(unsold AS DOUBLE) AS unsold_inventory,
       CAST(sold AS DOUBLE) AS homes_sold_or_rented,
       CAST(unsold AS DOUBLE) / NULLIF(CAST(unsold + sold AS DOUBLE), 0) AS percent_unsold,
       CAST(funds * 1000000 AS DOUBLE) AS new_mortgage_lending,
       CAST(owed * 1000000 AS DOUBLE) AS mortgage_debt_outstanding,
       CAST(variable AS DOUBLE) / NULLIF(CAST(funds AS DOUBLE), 0) AS variable_rate_share,
       CAST(m.rate AS DOUBLE) AS mortgage_rate, l.rate AS arrears_rate
FROM every LEFT JOIN sold USING (date_key) LEFT JOIN lent USING (date_key)
LEFT JOIN mortgage_rate m USING (date_key) LEFT JOIN late l USING (date_key)""")
def measures_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight measures of four facts side by side, each fact read once."""
    return fusion.together(roles.star(spark, sf_dir), FRONT_PAGE, ("date_key",), **PROVINCES)


@query("snapshot_measures", LINES + """,
last_a AS (SELECT MAX(date_key) AS k FROM absorption WHERE level = 'Province' AND is_total
           AND unabsorbed IS NOT NULL),
last_r AS (SELECT MAX(date_key) AS k FROM residential WHERE balance IS NOT NULL),
a AS (SELECT geo, SUM(CASE WHEN date_key = k THEN unabsorbed END) AS unsold,
             SUM(absorptions) AS sold
      FROM absorption, last_a WHERE level = 'Province' AND is_total GROUP BY geo)
SELECT 'unsold_inventory' AS measure, geo AS member, CAST(unsold AS DOUBLE) AS value FROM a
UNION ALL SELECT 'homes_sold_or_rented', geo, CAST(sold AS DOUBLE) FROM a
UNION ALL SELECT 'percent_unsold', geo,
  CAST(unsold AS DOUBLE) / NULLIF(CAST(unsold + sold AS DOUBLE), 0) FROM a
UNION ALL SELECT 'mortgage_debt_outstanding', CASE lead WHEN 'Fixed rate' THEN 'Fixed'
    ELSE 'Variable' END,
  CAST(SUM(CASE WHEN date_key = k THEN balance END) * 1000000 AS DOUBLE)
  FROM residential, last_r GROUP BY lead""")
def snapshot_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.star(spark, sf_dir)
    frames = {
        name: measures.MEASURES[name](star, ("geo_name",), **PROVINCES).withColumnRenamed(
            "geo_name", "member"
        )
        for name in ("unsold_inventory", "homes_sold_or_rented", "percent_unsold")
    }
    debt = measures.mortgage_debt_outstanding(star, ("rate_type",))
    frames["mortgage_debt_outstanding"] = debt.withColumnRenamed("rate_type", "member")
    return _long(frames, "member")


_MEASURED_ARREARS = ARREARS + """,
monthly AS (
  SELECT date_key, mi, CAST(SUM(total) AS DOUBLE) AS total, CAST(SUM(late) AS DOUBLE) AS late,
         CAST(SUM(late) AS DOUBLE) / NULLIF(CAST(SUM(total) AS DOUBLE), 0) AS rate
  FROM arrears_typed WHERE NOT nat GROUP BY date_key, mi
)
"""


@query("ratio_of_sums", ARREARS + """
SELECT region AS region_name, CAST(SUM(total) AS DOUBLE) AS total_mortgages,
       CAST(SUM(late) AS DOUBLE) AS mortgages_in_arrears,
       CAST(SUM(late) AS DOUBLE) / NULLIF(CAST(SUM(total) AS DOUBLE), 0) AS arrears_rate
FROM arrears_typed GROUP BY region""")
def ratio_of_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, by = roles.star(spark, sf_dir), ("region_name",)
    parts = [
        measures.total_mortgages(star, by),
        measures.mortgages_in_arrears(star, by),
        measures.arrears_rate(star, by),
    ]
    joined = reduce(lambda left, right: left.join(right, "region_name"), parts)
    return _counts_as_double(joined, "total_mortgages", "mortgages_in_arrears")


@query("mean_of_ratios_3m", _MEASURED_ARREARS + f""",
spread AS (
  SELECT m.mi, AVG(rate) OVER w AS smooth, COUNT(a.mi) OVER w AS seen
  FROM months m LEFT JOIN monthly a ON a.mi = m.mi
  WINDOW w AS (ORDER BY m.mi RANGE BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT {month_key("mi")} AS date_key, CAST(ROUND(CAST(smooth AS DECIMAL(38,10)), 8) AS DOUBLE)
       AS arrears_rate_3_month_average FROM spread WHERE seen > 0""")
def mean_of_ratios_3m(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "arrears_rate_3_month_average"
    smooth = measures.arrears_rate_3_month_average(roles.star(spark, sf_dir), ("date_key",))
    return smooth.withColumn(name, rounded(name, 8))


@query("arrears_measures", _MEASURED_ARREARS + f"""
SELECT 'total_mortgages' AS measure, date_key, total AS value FROM monthly
UNION ALL SELECT 'mortgages_in_arrears', date_key, late FROM monthly
UNION ALL SELECT 'arrears_rate', date_key, rate FROM monthly
UNION ALL SELECT 'arrears_rate_last_year', {month_key("mi + 12")}, rate
  FROM monthly, calendar WHERE mi + 12 <= hi
UNION ALL SELECT 'arrears_rate_change_points', a.date_key, (a.rate - b.rate) * 100
  FROM monthly a LEFT JOIN monthly b ON b.mi = a.mi - 12
UNION ALL SELECT 'mortgage_rate', date_key, CAST(rate AS DOUBLE) FROM mortgage_rate
UNION ALL SELECT 'mortgage_rate_18_months_ago', {month_key("mi + 18")}, CAST(rate AS DOUBLE)
  FROM mortgage_rate, calendar WHERE mi + 18 <= hi""")
def arrears_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of two facts, each read once."""
    names = ("total_mortgages", "mortgages_in_arrears", "arrears_rate", "arrears_rate_last_year",
             "arrears_rate_change_points", "mortgage_rate", "mortgage_rate_18_months_ago")
    return fusion.listed(roles.star(spark, sf_dir), names, ("date_key",))


@query("rates_of_late_years", _MEASURED_ARREARS + f""",
ends AS (SELECT MAX(date_key) // 10000 AS last FROM mortgage_rate),
sides AS (
  SELECT date_key, CAST(rate AS DOUBLE) AS now, CAST(NULL AS DOUBLE) AS earlier FROM mortgage_rate
  UNION ALL SELECT {month_key("mi + 18")}, NULL, CAST(rate AS DOUBLE) FROM mortgage_rate, calendar
  WHERE mi + 18 <= hi)
SELECT date_key, MAX(now) AS mortgage_rate, MAX(earlier) AS mortgage_rate_18_months_ago
FROM sides, ends WHERE date_key // 10000 BETWEEN last - 2 AND last GROUP BY date_key""")
def rates_of_late_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of the last three years that have one, beside those of eighteen months before:
    the scan reads the year folders of these months alone."""
    star = roles.star(spark, sf_dir)
    last = star["fact_mortgage_rate"].agg(F.max("date_key")).first()[0] or 0
    years = F.col("year").between(last // 10000 - 2, last // 10000)
    names = ("mortgage_rate", "mortgage_rate_18_months_ago")
    rates = fusion.together(star, names, ("date_key",), {"dim_date": years})
    return rates.select("date_key", *[F.col(n).cast("double").alias(n) for n in names])


@query("suppressed_null", ARREARS + """
SELECT region AS region_name, COUNT(*) AS months, COUNT(*) FILTER (hidden) AS hidden_months,
       COUNT(*) FILTER (late IS NULL) AS missing_counts, COUNT(*) FILTER (late = 0) AS zero_counts,
       COUNT(*) FILTER (hidden AND late IS NOT NULL) AS contradictions
FROM arrears_typed GROUP BY region""")
def suppressed_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.star(spark, sf_dir)
    fact = star["fact_mortgage_arrears"].join(
        star["dim_arrears_region"].select("arrears_region_key", "region_name"),
        "arrears_region_key",
    )
    per_region = fact.groupBy("region_name").agg(
        F.count(F.lit(1)).alias("months"),
        F.count_if("is_hidden").alias("hidden_months"),
        F.count_if(F.col("mortgages_in_arrears").isNull()).alias("missing_counts"),
        F.count_if(F.col("mortgages_in_arrears") == 0).alias("zero_counts"),
    )
    broken = (
        quality.broken_suppression(fact, "is_hidden", "mortgages_in_arrears")
        .groupBy("region_name")
        .agg(F.count(F.lit(1)).alias("contradictions"))
    )
    return per_region.join(broken, "region_name", "left").na.fill(0, ["contradictions"])


_BY_MONTH_LENDING = LINES + """,
lent AS (
  SELECT date_key, mi, SUM(funds) AS funds,
         SUM(CAST(rate AS DECIMAL(18,4)) * CAST(funds AS DECIMAL(18,2))) AS weighted,
         SUM(CASE WHEN lead = 'Variable rate' THEN funds END) AS variable
  FROM residential GROUP BY date_key, mi
)
"""


@query("lending_total", _BY_MONTH_LENDING + """
SELECT date_key, CAST(funds * 1000000 AS DOUBLE) AS new_mortgage_lending FROM lent""")
def lending_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.new_mortgage_lending(roles.star(spark, sf_dir), ("date_key",))


@query("lending_12_months", _BY_MONTH_LENDING + f""",
spread AS (
  SELECT m.mi, SUM(funds) OVER w AS year, COUNT(l.mi) OVER w AS seen
  FROM months m LEFT JOIN lent l ON l.mi = m.mi
  WINDOW w AS (ORDER BY m.mi RANGE BETWEEN 11 PRECEDING AND CURRENT ROW))
SELECT {month_key("mi")} AS date_key, CAST(year * 1000000 AS DOUBLE)
       AS new_mortgage_lending_12_months FROM spread WHERE seen > 0""")
def lending_12_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.new_mortgage_lending_12_months(roles.star(spark, sf_dir), ("date_key",))


@query("weighted_rate", _BY_MONTH_LENDING + """
SELECT date_key, CAST(ROUND(CAST(CAST(weighted AS DOUBLE) / NULLIF(CAST(funds AS DOUBLE), 0)
       AS DECIMAL(38,10)), 8) AS DOUBLE) AS average_rate_on_new_lending FROM lent""")
def weighted_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "average_rate_on_new_lending"
    rate = measures.average_rate_on_new_lending(roles.star(spark, sf_dir), ("date_key",))
    return rate.withColumn(name, rounded(name, 8))


@query("variable_share", _BY_MONTH_LENDING + """
SELECT date_key, CAST(variable AS DOUBLE) / NULLIF(CAST(funds AS DOUBLE), 0)
       AS variable_rate_share FROM lent""")
def variable_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.variable_rate_share(roles.star(spark, sf_dir), ("date_key",))


_PRICES = LINES + """,
monthly AS (
  SELECT component, date_key, mi, CAST(SUM(idx) AS DOUBLE) / CAST(COUNT(idx) AS DOUBLE) AS v
  FROM component GROUP BY ALL
)
"""


@query("price_index_avg", _PRICES + """
SELECT component AS component_name, date_key, v AS price_index FROM monthly""")
def price_index_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.price_index(roles.star(spark, sf_dir), ("component_name", "date_key"))


@query("price_index_change", _PRICES + """
SELECT a.component AS component_name, a.date_key,
       (a.v - b.v) / NULLIF(b.v, 0) AS price_index_change_pct
FROM monthly a LEFT JOIN monthly b ON b.component = a.component AND b.mi = a.mi - 12""")
def price_index_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.star(spark, sf_dir)
    return measures.price_index_change_pct(star, ("component_name", "date_key"))


@query("coverage_guard", HOUSING + f"""
SELECT geo AS member, COUNT(DISTINCT coverage) = 1 AS one_coverage_selected,
       CASE WHEN COUNT(DISTINCT coverage) <> 1 THEN '{vocab.COVERAGE_WARNING}' END
         AS coverage_warning
FROM housing GROUP BY geo
UNION ALL
SELECT year_month, COUNT(DISTINCT coverage) = 1,
       CASE WHEN COUNT(DISTINCT coverage) <> 1 THEN '{vocab.COVERAGE_WARNING}' END
FROM housing GROUP BY year_month""")
def coverage_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.star(spark, sf_dir)

    def guarded(by: str) -> DataFrame:
        selected = measures.one_coverage_selected(star, (by,))
        warned = measures.coverage_warning(star, (by,))
        return selected.join(warned, by).withColumnRenamed(by, "member")

    return stack([guarded("geo_name"), guarded("year_month")])


@query("exclude_aggregates", HOUSING + """
SELECT date_key, coverage AS coverage_name, CAST(SUM(units) AS DOUBLE) AS everything,
       CAST(SUM(CASE WHEN NOT agg THEN units END) AS DOUBLE) AS parts_only,
       CAST(SUM(CASE WHEN NOT agg OR level = 'Country' THEN units END) AS DOUBLE)
         AS parts_and_country
FROM housing WHERE is_total AND stage = 'Starts' GROUP BY date_key, coverage""")
def exclude_aggregates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a plain sum would claim, next to sums that leave published totals out."""
    star = roles.star(spark, sf_dir)
    starts = measures.in_context(
        star, "fact_housing_activity", ["coverage_name", "geo_level", "is_aggregate"],
        {"dim_construction_stage": F.col("stage_short") == "Starts",
         "dim_dwelling_type": F.col("is_total")},
    )
    by = ["date_key", "coverage_name"]

    def total(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*by).agg(F.sum("units").alias(name))

    return (
        total(starts, "everything")
        .join(total(exclude_aggregates(starts, keep_levels=()), "parts_only"), by, "left")
        .join(total(exclude_aggregates(starts), "parts_and_country"), by, "left")
    )


# Checks -----------------------------------------------------------------------------


def _check_sql(detail_shift: bool) -> str:
    """All comparisons of the six checks; optionally with June's published value off."""
    shift = "* CASE WHEN contains(detail, '-06') THEN 1.03::DOUBLE ELSE 1 END" if detail_shift else ""
    return EVERYTHING + f""",
comparison AS (
  SELECT '{vocab.CHECK_ARREARS_TOTAL}' AS check_name, year_month AS detail,
         CAST(SUM(total) FILTER (NOT nat) AS DOUBLE) AS ours,
         CAST(SUM(total) FILTER (nat) AS DOUBLE) AS theirs, 'percent' AS kind
  FROM arrears_typed GROUP BY year_month
  UNION ALL
  SELECT '{vocab.CHECK_ARREARS_RATE}', year_month || ' / ' || region,
         100.0::DOUBLE * CAST(late AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0),
         CAST(rate AS DOUBLE), 'points'
  FROM arrears_typed WHERE rate IS NOT NULL AND late IS NOT NULL
  UNION ALL
  SELECT '{vocab.CHECK_PROVINCES}', year_month || ' / ' || coverage,
         CAST(SUM(units) FILTER (level = 'Province') AS DOUBLE),
         CAST(SUM(units) FILTER (level = 'Country') AS DOUBLE), 'percent'
  FROM housing WHERE stage = 'Starts' AND is_total AND coverage = '{vocab.TOWNS}'
  GROUP BY year_month, coverage
  UNION ALL
  SELECT '{vocab.CHECK_DWELLINGS}', year_month || ' / ' || geo || ' / ' || stage,
         CAST(SUM(units) FILTER (NOT is_total) AS DOUBLE),
         CAST(SUM(units) FILTER (is_total) AS DOUBLE), 'percent'
  FROM housing GROUP BY year_month, geo, stage, coverage
  HAVING SUM(units) FILTER (is_total) > 0
  UNION ALL
  SELECT '{vocab.CHECK_LENDING}', strftime(make_date(date_key // 10000, date_key // 100 % 100, 1),
         '%Y-%m'), CAST(SUM(funds) FILTER (lead <> 'Total') AS DOUBLE),
         CAST(SUM(funds) FILTER (lead = 'Total') AS DOUBLE), 'percent'
  FROM origination WHERE subject LIKE 'residential%' GROUP BY date_key
  UNION ALL
  SELECT '{vocab.CHECK_COMPLETE}', 'fact_housing_activity', CAST(COUNT(*) AS DOUBLE),
         CAST(COUNT(*) AS DOUBLE), 'all'
  FROM housing
),
shifted AS (SELECT * REPLACE (theirs {shift} AS theirs) FROM comparison),
scored AS (
  SELECT check_name, detail, ours AS our_value, theirs AS published_value, kind,
         CASE WHEN kind = 'points' THEN abs(ours - theirs)
              ELSE 100.0::DOUBLE * abs(ours - theirs) / NULLIF(abs(theirs), 0) END AS difference,
         CASE kind WHEN 'points' THEN {vocab.MAX_POINT_GAP}::DOUBLE WHEN 'all' THEN 0::DOUBLE
              ELSE {vocab.MAX_PERCENT_GAP}::DOUBLE END AS allowed,
         CASE WHEN kind = 'points' THEN 'pp' ELSE '%' END AS units
  FROM shifted
),
verdict AS (
  SELECT check_name, detail, our_value, published_value, difference, allowed, units,
         COALESCE(difference <= allowed, FALSE) AS close_enough,
         (check_name = '{vocab.CHECK_ARREARS_TOTAL}' AND detail = '1999-06')
         OR (check_name = '{vocab.CHECK_ARREARS_RATE}' AND detail = '2000-06 / Quebec')
           AS known_problem
  FROM scored
),
judged AS (SELECT *, close_enough OR known_problem AS passed FROM verdict)
"""


_CLEAN, _SEEDED = _check_sql(False), _check_sql(True)
_SCORED_COLUMNS = (
    "check_name, detail, our_value, published_value, difference, allowed, units, close_enough"
)
# Exceptions granted to the seeded defects: one check total, one row.
GRANTED = (
    (vocab.CHECK_ARREARS_TOTAL, "1999-06"),
    (vocab.CHECK_ARREARS_RATE, "2000-06 / Quebec"),
)


@query("reconcile_parts_total", _CLEAN + f"""
SELECT {_SCORED_COLUMNS} FROM judged WHERE check_name IN (
  '{vocab.CHECK_ARREARS_TOTAL}', '{vocab.CHECK_PROVINCES}', '{vocab.CHECK_LENDING}')""")
def reconcile_parts_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.star(spark, sf_dir)
    compared = [
        checks.arrears_add_up(star), checks.provinces_add_up(star), checks.lending_adds_up(star)
    ]
    return reconcile.score(stack(compared), "percent")


@query("reconcile_rate_points", _CLEAN + f"""
SELECT {_SCORED_COLUMNS} FROM judged WHERE check_name = '{vocab.CHECK_ARREARS_RATE}'""")
def reconcile_rate_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.score(checks.arrears_rate_matches(roles.star(spark, sf_dir)), "points")


@query("reconcile_four_keys", _CLEAN + f"""
SELECT {_SCORED_COLUMNS} FROM judged WHERE check_name = '{vocab.CHECK_DWELLINGS}'""")
def reconcile_four_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.star(spark, sf_dir)
    return reconcile.score(checks.dwellings_add_up(star, EVERY_YEAR), "percent")


def june_off(frame: DataFrame) -> DataFrame:
    """A defect to catch: what was published for each June is 3 % too high."""
    wrong = F.when(F.col("detail").contains("-06"), 1.03).otherwise(1.0)
    return frame.withColumn("published_value", F.col("published_value") * wrong)


def seeded_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six checks over defective published numbers, two of the defects excused."""
    star = roles.star(spark, sf_dir)
    percent_checks = stack([
        checks.arrears_add_up(star), checks.provinces_add_up(star),
        checks.dwellings_add_up(star, EVERY_YEAR), checks.lending_adds_up(star),
    ])
    scored = stack([
        reconcile.score(june_off(percent_checks), "percent"),
        reconcile.score(june_off(checks.arrears_rate_matches(star)), "points"),
        reconcile.score(checks.nothing_lost(star), "percent", allowed=0.0),
    ])
    return reconcile.verdict(scored, GRANTED)


@query("check_verdict", _SEEDED + f"""
SELECT {_SCORED_COLUMNS}, known_problem, passed FROM judged""")
def check_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeded_results(spark, sf_dir)


@query("check_rollup", _SEEDED + """
SELECT check_name, COUNT(*) AS comparisons, MAX(difference) AS worst_gap,
       COUNT(*) FILTER (close_enough) AS matched,
       COUNT(*) FILTER (NOT close_enough AND known_problem) AS known_problems,
       COUNT(*) FILTER (NOT close_enough AND NOT known_problem) AS failures,
       100.0::DOUBLE * CAST(COUNT(*) FILTER (close_enough) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)
         AS matched_percent
FROM judged GROUP BY check_name""")
def check_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.rollup(seeded_results(spark, sf_dir))


@query("check_report", _SEEDED + """,
per_check AS (
  SELECT check_name, COUNT(*) AS comparisons, COUNT(*) FILTER (close_enough) AS matched,
         COUNT(*) FILTER (NOT close_enough AND known_problem) AS known_problems,
         COUNT(*) FILTER (NOT close_enough AND NOT known_problem) AS failures,
         MAX(difference) AS gap
  FROM judged GROUP BY check_name)
SELECT 'check' AS line, check_name, NULL AS detail, comparisons, matched, known_problems, failures,
       100.0::DOUBLE * CAST(matched AS DOUBLE) / CAST(comparisons AS DOUBLE) AS matched_percent, gap
FROM per_check
UNION ALL SELECT 'total', NULL, NULL, SUM(comparisons)::BIGINT, SUM(matched)::BIGINT,
       SUM(known_problems)::BIGINT, SUM(failures)::BIGINT,
       100.0::DOUBLE * CAST(SUM(matched) AS DOUBLE) / CAST(SUM(comparisons) AS DOUBLE), MAX(gap)
FROM per_check
UNION ALL SELECT 'known problem', check_name, detail, NULL, NULL, NULL, NULL, NULL, difference
FROM judged WHERE NOT close_enough AND known_problem""")
def check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.report(seeded_results(spark, sf_dir))


@query("check_first5", _SEEDED + f"""
SELECT {_SCORED_COLUMNS}, known_problem, passed, nth FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY check_name ORDER BY detail, our_value) AS INTEGER)
    AS nth
  FROM judged WHERE NOT close_enough AND NOT known_problem) WHERE nth <= 5""")
def check_first5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.first_failures(seeded_results(spark, sf_dir))


@query("check_stack", _CLEAN + """
SELECT check_name, units, COUNT(*) AS comparisons FROM judged GROUP BY check_name, units""")
def check_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = checks.all_checks(roles.star(spark, sf_dir), from_year=EVERY_YEAR)
    return results.groupBy("check_name", "units").agg(F.count(F.lit(1)).alias("comparisons"))


@query("quality_measures", _SEEDED + """,
counted AS (SELECT check_name, COUNT(*) AS n, COUNT(*) FILTER (passed) AS ok
            FROM judged GROUP BY check_name)
SELECT check_name, n AS checks_run, ok AS checks_passed,
       CAST(ok AS DOUBLE) / CAST(n AS DOUBLE) AS check_pass_rate,
       CASE WHEN n = ok THEN 'All numbers match the published figures'
            ELSE format('{:,}', n - ok) || ' numbers need review' END AS data_quality_status
FROM counted""")
def quality_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_publication_root(spark, sf_dir, 'results')}/check_results"
    warehouse.tables.write_table(checks.to_stored(seeded_results(spark, sf_dir)), path)
    star = {"check_results": warehouse.tables.read_table(spark, path, CHECK_RESULTS)}
    by = ("check_name",)
    frames = [
        measure(star, by)
        for measure in (measures.checks_run, measures.checks_passed, measures.check_pass_rate,
                        measures.data_quality_status)
    ]
    return reduce(lambda left, right: left.join(right, "check_name"), frames)


@query("quality_text", _CHANGED + f""",
through AS (SELECT 'Data up to ' || strftime(MAX(m), '%B %Y') AS t FROM housing),
scope AS (
  SELECT s.geo, s.date_key, s.units - l.units AS change, CAST(s.units - l.units AS DOUBLE)
         / NULLIF(CAST(l.units AS DOUBLE), 0) AS pct
  FROM starts s LEFT JOIN starts l ON l.coverage = s.coverage AND l.geo = s.geo
    AND l.mi = s.mi - 12
  WHERE s.level = 'Province' AND s.coverage = '{vocab.TOWNS}'
)
SELECT geo AS geo_name, date_key, CASE WHEN change IS NULL THEN '{vocab.NO_COMPARABLE_MONTH}'
  ELSE geo || ': housing starts ' || CASE WHEN change >= 0 THEN 'up' ELSE 'down' END || ' '
    || format('{{:,}}', CAST(ROUND(abs(change), 0) AS BIGINT)) || ' homes ('
    || CAST(CAST(ROUND(CAST(abs(pct) * 100 AS DECIMAL(30,10)), 1) AS DECIMAL(30,1)) AS VARCHAR)
    || '%) vs the same month last year' END AS headline, t AS data_through
FROM scope, through""")
def quality_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.star(spark, sf_dir)
    sentences = measures.headline(star, ("geo_name", "date_key"), towns(), **PROVINCES)
    through = measures.data_through(star).select("data_through").scalar()
    return sentences.withColumn("data_through", through)


@query("flow_vs_snapshot", LINES + """,
last AS (SELECT MAX(date_key) AS k FROM origination),
sums AS (SELECT CAST(SUM(funds) AS DOUBLE) AS flow, CAST(SUM(balance) AS DOUBLE) AS snapshot
         FROM origination, last WHERE date_key = k AND lead <> 'Total')
SELECT flow, snapshot, COALESCE(flow > 0 AND snapshot > 0 AND snapshot > flow * 10, FALSE)
       AS plausible FROM sums""")
def flow_vs_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.star(spark, sf_dir)
    detailed = star["fact_mortgage_originations"].join(
        star["dim_credit_product"].filter(~F.col("is_total")), "credit_product_key", "left_semi"
    )
    return quality.flow_vs_snapshot(
        detailed, "funds_advanced_millions", "outstanding_balance_millions"
    )


@query("history_span", HOUSING + """
SELECT MIN(year) AS first_year, MAX(year) AS last_year, MAX(year) - MIN(year) AS years,
       MAX(year) - MIN(year) >= 5 AS long_enough FROM housing WHERE units IS NOT NULL""")
def history_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.star(spark, sf_dir)
    dated = views.with_dates(star["fact_housing_activity"], star, "year")
    return quality.history_span(dated, "units", F.col("year"), at_least=5)


@query("view_nonempty", """
SELECT unnest(['pipeline_health', 'what_changed', 'arrears_trend']) AS name, TRUE AS non_empty""")
def view_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.is_non_empty(views.all_views(roles.star(spark, sf_dir)))


@query("member_count", """
SELECT 10::BIGINT AS members, TRUE AS as_expected""")
def member_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = roles.star(spark, sf_dir)["dim_geography"]
    return quality.member_count(dim, "province_code", F.col("geo_level") == "Province", 10)


# Builders: each fact with its keys resolved back to labels ------------------------------


@query("fact_housing_activity", HOUSING + """
SELECT date_key, geo AS geo_name, dwelling AS dwelling_type_name, stage AS stage_short,
       coverage AS coverage_name, CAST(units AS DOUBLE) AS units FROM housing""")
def fact_housing_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["date_key", "geo_name", "dwelling_type_name", "stage_short", "coverage_name"]
    rows = measures.in_context(roles.star(spark, sf_dir), "fact_housing_activity", by)
    return rows.select(*by, "units")


@query("fact_market_absorption", LINES + """
SELECT date_key, geo AS geo_name, dwelling AS dwelling_type_name,
       CAST(absorptions AS DOUBLE) AS absorptions, CAST(unabsorbed AS DOUBLE)
         AS unabsorbed_inventory FROM absorption""")
def fact_market_absorption(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["date_key", "geo_name", "dwelling_type_name"]
    rows = measures.in_context(roles.star(spark, sf_dir), "fact_market_absorption", by)
    return rows.select(*by, "absorptions", "unabsorbed_inventory")


@query("fact_unoccupied_housing", LINES + """
SELECT date_key, geo AS geo_name, dwelling AS dwelling_type_name,
       CAST(units AS DOUBLE) AS unoccupied_units FROM unoccupied""")
def fact_unoccupied_housing(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["date_key", "geo_name", "dwelling_type_name"]
    rows = measures.in_context(roles.star(spark, sf_dir), "fact_unoccupied_housing", by)
    return rows.select(*by, "unoccupied_units")


@query("fact_mortgage_arrears", ARREARS + """
SELECT date_key, region AS region_name, CAST(total AS DOUBLE) AS total_mortgages,
       CAST(late AS DOUBLE) AS mortgages_in_arrears, CAST(rate AS DOUBLE) AS arrears_rate,
       hidden AS is_hidden FROM arrears_typed""")
def fact_mortgage_arrears(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["date_key", "region_name"]
    rows = measures.in_context(roles.star(spark, sf_dir), "fact_mortgage_arrears", by)
    shown = rows.select(*by, "total_mortgages", "mortgages_in_arrears", "arrears_rate", "is_hidden")
    return _counts_as_double(shown, "total_mortgages", "mortgages_in_arrears")


@query("uom_split", LINES + """
SELECT date_key, product AS product_name, CAST(SUM(funds) AS DOUBLE) AS funds_advanced_millions,
       CAST(SUM(balance) AS DOUBLE) AS outstanding_balance_millions,
       CAST(MAX(rate) AS DOUBLE) AS interest_rate
FROM origination GROUP BY ALL""")
def uom_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["date_key", "product_name"]
    rows = measures.in_context(roles.star(spark, sf_dir), "fact_mortgage_originations", by)
    names = FACTS["fact_mortgage_originations"].fieldNames()[2:]
    return rows.select(*by, *names)


@query("fact_price_index", LINES + """
SELECT date_key, geo AS geo_name, component AS component_name, CAST(idx AS DOUBLE) AS index_value
FROM component""")
def fact_price_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["date_key", "geo_name", "component_name"]
    rows = measures.in_context(roles.star(spark, sf_dir), "fact_price_index", by)
    return rows.select(*by, "index_value")


@query("fact_mortgage_rate", LINES + """
SELECT date_key, CAST(rate AS DOUBLE) AS rate_5year FROM mortgage_rate""")
def fact_mortgage_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.star(spark, sf_dir)["fact_mortgage_rate"].select("date_key", "rate_5year")


@query("dim_geography", HOUSING + """,
named AS (
  SELECT DISTINCT geo, level, province, agg, CASE level WHEN 'Country' THEN 0
         WHEN 'Region' THEN 10 WHEN 'Province' THEN 20 ELSE 40 END AS sort_order FROM label
)
SELECT CAST(row_number() OVER (ORDER BY sort_order, geo) AS INTEGER) AS geography_key,
       geo AS geo_name, level AS geo_level, province AS province_name, agg AS is_aggregate,
       CAST(sort_order AS INTEGER) AS sort_order FROM named
UNION ALL SELECT -1, 'Unknown', 'Unknown', NULL, FALSE, 9999""")
def dim_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.star(spark, sf_dir)["dim_geography"].drop("province_code", "arrears_region")


@query("dim_credit_product", LINES + """,
named AS (SELECT DISTINCT product, lead, subject FROM origination)
SELECT CAST(row_number() OVER (ORDER BY product) AS INTEGER) AS credit_product_key,
       product AS product_name,
       CASE WHEN subject LIKE 'residential%' THEN 'Residential mortgage'
            WHEN subject LIKE 'non-res%' THEN 'Commercial mortgage'
            WHEN subject LIKE 'business%' THEN 'Business loan' ELSE 'Consumer credit' END
         AS product_family,
       CASE lead WHEN 'Fixed rate' THEN 'Fixed' WHEN 'Variable rate' THEN 'Variable'
            ELSE 'All' END AS rate_type,
       CASE WHEN contains(subject, 'uninsured') THEN 'Uninsured'
            WHEN contains(subject, 'insured') THEN 'Insured' ELSE 'All' END AS insurance_status,
       lead = 'Total' AS is_total FROM named
UNION ALL SELECT -1, 'Unknown', NULL, NULL, NULL, FALSE""")
def dim_credit_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.star(spark, sf_dir)["dim_credit_product"]


@query("dim_dwelling_type", """
SELECT unnest([1, 2, 3, 4, 5, -1])::INTEGER AS dwelling_type_key,
       unnest(['Single-detached units', 'Semi-detached units', 'Row units',
               'Apartment and other units', 'Total units', 'Unknown']) AS dwelling_type_name,
       unnest(['Single-detached', 'Semi-detached', 'Row houses', 'Apartments & other',
               'All types', 'Unknown']) AS dwelling_category,
       unnest([FALSE, FALSE, FALSE, FALSE, TRUE, FALSE]) AS is_total,
       unnest([1, 2, 3, 4, 9, 999])::INTEGER AS sort_order""")
def dim_dwelling_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.star(spark, sf_dir)["dim_dwelling_type"]


@query("dim_price_component", LINES + """
SELECT CAST(row_number() OVER (ORDER BY component) AS INTEGER) AS price_component_key,
       component AS component_name FROM (SELECT DISTINCT component FROM component)
UNION ALL SELECT -1, 'Unknown'""")
def dim_price_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.star(spark, sf_dir)["dim_price_component"]


# Publication ---------------------------------------------------------

_REGION_LIST = f""",
region_list AS (SELECT unnest([{", ".join(f"'{r[0]}'" for r in vocab.ARREARS_REGIONS)}]) AS region)
"""


def _publication_root(spark: SparkSession, sf_dir: str, name: str) -> str:
    folder = sf_dir.strip("/").replace("/", "_")
    return f"{shared_dir(spark)}/{name}-{spark.sparkContext.applicationId}-{folder}"


def _published(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, str]:
    star, root = roles.star(spark, sf_dir), _publication_root(spark, sf_dir, name)
    version = uuid4().hex
    results, reasons = warehouse.judged(
        checks.all_checks(star, from_year=EVERY_YEAR), f"{root}/work/{version}"
    )
    manifest = warehouse.publish(star, results, reasons, root, version)
    if manifest is None:
        raise ValueError("; ".join(reasons))
    return manifest, root


_EXPORTED = """
SELECT 'fact_housing_activity' AS table_name, COUNT(*) AS n_rows FROM housing
UNION ALL SELECT 'fact_market_absorption', COUNT(*) FROM absorption
UNION ALL SELECT 'fact_unoccupied_housing', COUNT(*) FROM unoccupied
UNION ALL SELECT 'fact_mortgage_arrears', COUNT(*) FROM arrears_typed
UNION ALL SELECT 'fact_mortgage_originations', COUNT(*) FROM
  (SELECT DISTINCT date_key, product FROM origination)
UNION ALL SELECT 'fact_price_index', COUNT(*) FROM component
UNION ALL SELECT 'fact_mortgage_rate', COUNT(*) FROM mortgage_rate
UNION ALL SELECT 'pipeline_health', COUNT(*) FROM
  (SELECT DISTINCT date_key, coverage, geo, dwelling FROM housing
   WHERE NOT agg OR level = 'Country')
UNION ALL SELECT 'what_changed', COUNT(*) FROM housing a JOIN housing b
  ON b.coverage = a.coverage AND b.geo = a.geo AND b.mi = a.mi - 12
  AND b.stage = 'Starts' AND b.is_total
  WHERE a.stage = 'Starts' AND a.is_total AND (NOT a.agg OR a.level = 'Country')
UNION ALL SELECT 'arrears_trend', COUNT(*) FROM arrears_typed
UNION ALL SELECT 'check_results', COUNT(*) FROM judged
UNION ALL SELECT 'dim_date', COUNT(*) FROM months
UNION ALL SELECT 'dim_geography', COUNT(*) + 1 FROM
  (SELECT geo FROM housing UNION SELECT geo FROM absorption)
UNION ALL SELECT 'dim_credit_product', COUNT(DISTINCT product) + 1 FROM origination
UNION ALL SELECT 'dim_price_component', COUNT(DISTINCT component) + 1 FROM component
UNION ALL SELECT 'dim_dwelling_type', COUNT(DISTINCT dwelling) + 1 FROM typed_lines
UNION ALL SELECT 'dim_construction_stage', COUNT(DISTINCT stage) + 1 FROM housing
UNION ALL SELECT 'dim_coverage', COUNT(DISTINCT coverage) + 1 FROM housing
UNION ALL SELECT 'dim_arrears_region', COUNT(*) + 1 FROM region_list"""


@query("publish_manifest", _CLEAN + _REGION_LIST + f"""
SELECT *, TRUE AS has_bytes FROM ({_EXPORTED})""")
def publish_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check, export all 19 tables, and report rows per table; file sizes vary."""
    manifest = _published(spark, sf_dir, "export")[0]
    return manifest.select("table_name", "n_rows", (F.col("n_bytes") > 0).alias("has_bytes"))


@query("export_rows", _CLEAN + _REGION_LIST + _EXPORTED)
def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the export in force, read back table by table."""
    root = _published(spark, sf_dir, "readback")[1]
    return row_totals(warehouse.read_export(spark, root))


@query("gate_publish", _SEEDED + """,
failed AS (SELECT CAST(COUNT(DISTINCT check_name) AS INTEGER) AS n FROM judged WHERE NOT passed)
SELECT 'clean' AS version, 0 AS reasons, TRUE AS published, 'clean' AS in_force
UNION ALL SELECT 'defective', n, FALSE, 'clean' FROM failed""")
def gate_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean run is published; a defective one is refused and changes nothing."""
    star = roles.star(spark, sf_dir)
    root = f"{_publication_root(spark, sf_dir, 'gate')}/{uuid4().hex}"
    outcome = []
    for version, results in (
        ("clean", checks.all_checks(star, from_year=EVERY_YEAR)),
        ("defective", seeded_results(spark, sf_dir)),
    ):
        stored, reasons = warehouse.judged(results, f"{root}/work/{version}")
        manifest = warehouse.publish(star, stored, reasons, root, version)
        in_force = warehouse.tables.current_version(spark, root)
        outcome.append((version, len(reasons), manifest is not None, in_force))
    return spark.createDataFrame(
        outcome, "version string, reasons int, published boolean, in_force string"
    )


@query("latest_period", LINES + """
SELECT date_key, geo AS geo_name, component AS component_name, CAST(idx AS DOUBLE) AS index_value
FROM component WHERE date_key = (SELECT MAX(date_key) FROM component)""")
def latest_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.star(spark, sf_dir)
    by = ["date_key", "geo_name", "component_name"]
    latest = {**star, "fact_price_index": latest_only(star["fact_price_index"])}
    return measures.in_context(latest, "fact_price_index", by).select(*by, "index_value")


_KEPT = """
SELECT 'housing_activity' AS release, SUM(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS total
FROM orders JOIN customer ON c_custkey = o_custkey
UNION ALL SELECT 'absorptions', SUM(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
UNION ALL SELECT 'unoccupied', SUM(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_returnflag = 'N'
UNION ALL SELECT 'originations', SUM(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
UNION ALL SELECT 'arrears', COUNT(*)::DOUBLE FROM events"""


@query("rows_kept", _KEPT)
def rows_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came in, per release, is in its fact: nothing is lost before the first month,
    after the last one, or to a label."""
    star = roles.star(spark, sf_dir)
    parts = star["dim_dwelling_type"].filter(~F.col("is_total")).select("dwelling_type_key")
    country = star["dim_geography"].filter(F.col("geo_level") == "Country").select("geography_key")
    regions = star["dim_arrears_region"].filter("is_national").select("arrears_region_key")
    detailed = star["dim_credit_product"].filter(~F.col("is_total")).select("credit_product_key")

    def total(release: str, fact: str, value: Column, *picked: DataFrame) -> DataFrame:
        rows = star[fact]
        for members in picked:
            rows = rows.join(members, members.columns[0], "left_semi")
        return rows.agg(F.sum(value).cast("double").alias("total")).select(
            F.lit(release).alias("release"), "total")

    absorbed = F.coalesce("absorptions", F.lit(0)) + F.coalesce("unabsorbed_inventory", F.lit(0))
    return stack([
        total("housing_activity", "fact_housing_activity", F.col("units"), parts, country),
        total("absorptions", "fact_market_absorption", absorbed, parts, country),
        total("unoccupied", "fact_unoccupied_housing", F.col("unoccupied_units"), parts, country),
        total("originations", "fact_mortgage_originations", F.col("funds_advanced_millions"), detailed),
        total("arrears", "fact_mortgage_arrears", F.col("total_mortgages"), regions),
    ])


# Sources, dimensions and display, end to end ------------------------------------------


@query("read_release_text", """
SELECT n_name AS geo, COUNT(*) AS months, SUM(price)::DOUBLE AS total, MIN(m) AS first_month
FROM (SELECT n_name, strftime(o_orderdate, '%Y-%m') AS m, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS price
      FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL)
GROUP BY 1""")
def read_release_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as the CSV of a registered release, found by its number and title,
    read back as text and parsed."""
    release = releases.REGISTRY["absorptions"]
    raw = f"{_publication_root(spark, sf_dir, 'raw')}/{uuid4().hex}"
    orders = roles.table(spark, sf_dir, "orders").join(
        roles.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).join(roles.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    monthly = orders.groupBy(
        F.date_format("o_orderdate", "yyyy-MM").alias("REF_DATE"), F.col("n_name").alias("GEO")
    ).agg(sum_of_amounts("o_totalprice").cast("string").alias("VALUE"))
    monthly.withColumn("Type of dwelling unit", F.lit('Total "units"')).write.csv(
        release.path(raw), header=True, escape='"')
    read = releases.read_release(spark, raw, release.name)
    (frame, title), = releases.with_prefix({release.name: read}, "Type of")
    known = frame.filter(F.col(f"`{title}`") == 'Total "units"')
    return known.groupBy(F.col("GEO").alias("geo")).agg(
        F.count(F.lit(1)).alias("months"), F.sum(decimal_cell("VALUE")).cast("double").alias("total"),
        F.min("REF_DATE").alias("first_month"))


@query("read_arrears_text", ARREARS + """
SELECT CASE WHEN nat THEN 'everywhere' ELSE covers END AS covers, COUNT(*) AS months,
       SUM(total)::DOUBLE AS total, SUM(late)::DOUBLE AS late, COUNT(*) FILTER (hidden) AS hidden
FROM arrears_typed GROUP BY ALL""")
def read_arrears_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as the CSV of arrears rows, read back as text, and built into the
    fact by region."""
    raw = f"{_publication_root(spark, sf_dir, 'arrears')}/{uuid4().hex}"
    roles.arrears(roles.events_base(spark, sf_dir)).write.csv(
        releases.arrears_path(raw), header=True, escape='"')
    releases.require_whole_lines(spark, [releases.arrears_path(raw)])
    star = roles.star(spark, sf_dir)
    fact = facts.mortgage_arrears(releases.read_arrears(spark, raw), star)
    region = star["dim_arrears_region"].select(
        "arrears_region_key", F.when(F.col("is_national"), "everywhere").otherwise(
            F.col("covers_provinces")).alias("covers"))
    return fact.join(region, "arrears_region_key").groupBy("covers").agg(
        F.count(F.lit(1)).alias("months"), F.sum("total_mortgages").cast("double").alias("total"),
        F.sum("mortgages_in_arrears").cast("double").alias("late"),
        F.count_if("is_hidden").alias("hidden"))


@query("stage_dimension", HOUSING + """
SELECT CASE stage WHEN 'Starts' THEN 'Housing starts' WHEN 'Completions' THEN 'Housing completions'
            ELSE 'Housing under construction' END AS stage_name, stage AS stage_short,
       CAST(CASE stage WHEN 'Starts' THEN 1 WHEN 'Under construction' THEN 2 ELSE 3 END AS INTEGER) AS stage_order,
       COUNT(*) AS n_rows, CAST(SUM(units) AS DOUBLE) AS units
FROM housing GROUP BY ALL
UNION ALL SELECT 'Unknown', 'Unknown', 9, 0, NULL""")
def stage_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every member of the stage dimension with the rows of the fact that point at it."""
    star = roles.star(spark, sf_dir)
    rows = star["fact_housing_activity"].groupBy("stage_key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("units").alias("units"))
    return dims.dim_construction_stage(spark).join(rows, "stage_key", "left").select(
        "stage_name", "stage_short", "stage_order", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "units")


@query("read_report_files", """
SELECT c_nationkey || '-' || CAST(year(o_orderdate) AS INTEGER) AS report,
       CAST(row_number() OVER (PARTITION BY c_nationkey, year(o_orderdate) ORDER BY o_orderkey) - 1
            AS INTEGER) AS page_no,
       o_orderkey AS order_key, CAST(o_orderpriority AS VARCHAR) AS priority
FROM orders JOIN customer ON c_custkey = o_custkey""")
def read_report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders printed a page each, a report file per nation and year, read back page by
    page: numbered by their place in the file, however the file is split."""
    folder = f"{_publication_root(spark, sf_dir, 'reports')}/{uuid4().hex}"
    printed = roles.table(spark, sf_dir, "orders").join(
        roles.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select(
        F.concat_ws("-", "c_nationkey", F.year("o_orderdate")).alias("report"), "o_orderkey",
        F.concat(F.lit("REGION: "), "o_orderkey", F.lit("\n"), "o_orderpriority").alias("page"))
    printed.repartition("report").sortWithinPartitions("report", "o_orderkey").select(
        "report", "page").write.partitionBy("report").option("lineSep", "\f").text(folder)
    pages = releases.read_report_pages(spark, folder)
    return pages.select(
        F.regexp_extract("doc_id", "report=([^/]+)/", 1).alias("report"), "page_no",
        F.regexp_extract("text", "REGION: ([0-9]+)", 1).cast("bigint").alias("order_key"),
        F.substring_index("text", "\n", -1).alias("priority"))


@query("views_in_sql", _CHANGED + """
SELECT year, geo_level, COUNT(*) AS places, MAX(units) AS most FROM changed GROUP BY ALL""")
def views_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views answer SQL under their own names."""
    warehouse.register_views(roles.star(spark, sf_dir))
    return spark.sql(
        "SELECT year, geo_level, COUNT(*) AS places, CAST(MAX(units) AS DOUBLE) AS most"
        " FROM what_changed GROUP BY year, geo_level")


@query("months_in_range", LINES + """
SELECT date_key, COUNT(*) AS n_rows FROM component
WHERE date_key BETWEEN (SELECT MIN(date_key) FROM component WHERE date_key % 10000 = 601)
  AND (SELECT MAX(date_key) FROM component WHERE date_key % 10000 = 601) GROUP BY date_key""")
def months_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored fact read between two Junes: month bounds prune its folders and files."""
    fact = roles.star(spark, sf_dir)["fact_price_index"]
    junes = fact.filter(F.col("date_key") % 10000 == 601).agg(F.min("date_key"), F.max("date_key")).first()
    folder = f"{_publication_root(spark, sf_dir, 'pruned')}/{uuid4().hex}"
    warehouse.tables.write_table(fact, folder, ("date_key", "geography_key"))
    read = warehouse.tables.read_table(spark, folder, FACTS["fact_price_index"], *junes)
    return read.groupBy("date_key").agg(F.count(F.lit(1)).alias("n_rows"))


@query("display_order", HOUSING + """,
shown AS (SELECT DISTINCT stage FROM housing)
SELECT stage AS stage_short, CAST(row_number() OVER (ORDER BY CASE stage WHEN 'Starts' THEN 1
         WHEN 'Under construction' THEN 2 ELSE 3 END, stage) AS INTEGER) AS position FROM shown""")
def display_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages that have data, in the order they are shown."""
    star = roles.star(spark, sf_dir)
    stages = star["dim_construction_stage"].join(star["fact_housing_activity"], "stage_key", "left_semi")
    ordered = warehouse.in_display_order(stages, "dim_construction_stage", "stage_short")
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return ordered.select("stage_short", place.alias("position"))


def _quoted_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


@query("dim_coverage", HOUSING + f"""
SELECT coverage AS coverage_name, d AS description, coverage = '{vocab.TOWNS}' AS is_default
FROM (SELECT DISTINCT coverage FROM housing) JOIN (VALUES
  {", ".join(f"({_quoted_text(name)}, {_quoted_text(text)})" for name, text, _ in vocab.COVERAGES)}
) AS said(name, d) ON name = coverage""")
def dim_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverages that have data, as described by their publisher."""
    star = roles.star(spark, sf_dir)
    used = star["dim_coverage"].join(star["fact_housing_activity"], "coverage_key", "left_semi")
    return used.drop("coverage_key")


@query("dim_arrears_region", ARREARS + """
SELECT region AS region_name, ANY_VALUE(covers) AS covers_provinces, BOOL_OR(nat) AS is_national,
       COUNT(*) AS months FROM arrears GROUP BY region""")
def dim_arrears_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions with the months they report; none lands on the Unknown member."""
    star = roles.star(spark, sf_dir)
    rows = star["fact_mortgage_arrears"].join(star["dim_arrears_region"], "arrears_region_key")
    return rows.groupBy("region_name", "covers_provinces", "is_national").agg(
        F.count(F.lit(1)).alias("months"))


@query("rows_in_boxes", LINES + """
SELECT date_key, geo AS geo_name, component AS component_name, CAST(idx AS DOUBLE) AS index_value
FROM component WHERE date_key = (SELECT MAX(date_key) FROM component)
  OR geo = (SELECT MIN(geo) FROM component)""")
def rows_in_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One place, and the last month, from a fact stored so that either leaves files out."""
    star = roles.star(spark, sf_dir)
    fact, places = star["fact_price_index"].drop(FOLDER), star["dim_geography"]
    folder = f"{_publication_root(spark, sf_dir, 'boxes')}/{uuid4().hex}"
    warehouse.tables.write_table(fact, folder, GRAIN["fact_price_index"], boxes=True)
    read = warehouse.tables.read_table(spark, folder, FACTS["fact_price_index"], folders=True)
    place = places.join(read, "geography_key", "left_semi").agg(
        F.min_by("geography_key", "geo_name")).first()[0]
    here = read.filter(F.col("geography_key") == place)
    last = latest_only(read).filter(F.col("geography_key") != place)
    by = ["date_key", "geo_name", "component_name"]
    asked = {**star, "fact_price_index": here.unionByName(last)}
    return measures.in_context(asked, "fact_price_index", by).select(*by, "index_value")


@query("export_altered", LINES + """
SELECT 'fact_price_index' AS table_name, COUNT(*) AS n_rows, COUNT(*) AS rows_now FROM component""")
def export_altered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported facts against facts in which one month's values are off: rows agree, digests do not."""
    star = roles.star(spark, sf_dir)
    facts = {name: star[name].drop(FOLDER) for name in FACTS}
    folder = f"{_publication_root(spark, sf_dir, 'digests')}/{uuid4().hex}"
    manifest = warehouse.tables.export_tables(facts, folder, GRAIN, boxes=True)
    index = facts["fact_price_index"]
    off = F.when(F.col("date_key") == last_period_with_data(index), F.col("index_value") + 1)
    altered = index.withColumn("index_value", F.coalesce(off, F.col("index_value")).cast("decimal(12,4)"))
    found = warehouse.tables.altered_tables(manifest, {**facts, "fact_price_index": altered})
    return found.select("table_name", "n_rows", "rows_now")
