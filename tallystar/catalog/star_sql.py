"""SQL fragments that derive the star's content straight from the base tables.

They know nothing of dimension keys, release text or builders, so agreement with the
DataFrame queries says something about all three.
"""

from tallystar import vocab

_PROVINCES = ", ".join(f"'{p}'" for p in vocab.PROVINCES)

_PLACE = f"""
place AS (
  SELECT n_nationkey AS nk, n_nationkey % 10 < 4 AS atlantic,
         list_extract([{_PROVINCES}], n_nationkey % 10 + 1) AS province,
         CASE WHEN n_nationkey >= 10 THEN n_name END AS metro
  FROM nation
)"""


def month_key(index: str) -> str:
    """Key of the month with an index, years times twelve plus months from zero."""
    return f"CAST(({index}) // 12 * 10000 + (({index}) % 12 + 1) * 100 + 1 AS INTEGER)"


_EVENT_MONTH = """CAST(DATE '1999-01-01' + to_months(CAST(date_diff('day', DATE '2024-01-01',
              CAST(ts AS DATE)) AS INTEGER)) AS DATE)"""

# Every month from the first to the last of any release.
_CALENDAR = f"""
calendar AS (
  SELECT CAST(MIN(year(d) * 12 + month(d) - 1) AS BIGINT) AS lo,
         CAST(MAX(year(d) * 12 + month(d) - 1) AS BIGINT) AS hi
  FROM (SELECT o_orderdate AS d FROM orders JOIN customer ON c_custkey = o_custkey
        UNION ALL SELECT l_shipdate FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
        UNION ALL SELECT {_EVENT_MONTH} FROM events)
),
months AS (SELECT unnest(range(lo, hi + 1)) AS mi FROM calendar)"""

# Label, level, coverage side and province of every amount.
_LABELS = """
label AS (
  SELECT nk, 'Canada' AS geo, 'Country' AS level, NULL AS province, TRUE AS agg FROM place
  UNION ALL SELECT nk, province, 'Province', province, FALSE FROM place
  UNION ALL SELECT nk, 'Atlantic provinces', 'Region', NULL, TRUE FROM place WHERE atlantic
  UNION ALL SELECT nk, metro || ', ' || province, 'CMA', province, FALSE FROM place
            WHERE metro IS NOT NULL
)"""

_HOUSING = f"""
orders_base AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, c_nationkey AS nk,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Single-detached units'
              WHEN '2-HIGH' THEN 'Semi-detached units' WHEN '3-MEDIUM' THEN 'Row units'
              ELSE 'Apartment and other units' END AS dwelling,
         CASE o_orderstatus WHEN 'O' THEN 'Starts' WHEN 'P' THEN 'Under construction'
              ELSE 'Completions' END AS stage,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS units
  FROM orders JOIN customer ON c_custkey = o_custkey
  GROUP BY ALL
),
typed AS (
  SELECT * FROM orders_base
  UNION ALL SELECT m, nk, 'Total units', stage, units FROM orders_base
),
housing AS (
  SELECT m, CAST(strftime(m, '%Y%m01') AS INTEGER) AS date_key, strftime(m, '%Y-%m') AS year_month,
         CAST(year(m) AS INTEGER) AS year, CAST(year(m) * 12 + month(m) - 1 AS INTEGER) AS mi,
         CASE WHEN level = 'CMA' THEN '{vocab.METROS}' ELSE '{vocab.TOWNS}' END AS coverage,
         geo, level, province, agg, dwelling, dwelling = 'Total units' AS is_total, stage,
         SUM(CASE WHEN geo = 'Atlantic provinces' AND dwelling = 'Total units'
                   AND month(m) % 3 = 0 THEN NULL ELSE units END) AS units
  FROM typed JOIN label USING (nk) GROUP BY ALL
)"""

_LINES = """
lines AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, s_nationkey AS nk,
         l_linenumber AS line, l_returnflag AS flag, l_linestatus AS status,
         SUM(CAST(l_quantity AS DECIMAL(18,2))) AS quantity,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS price,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS discount,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))) AS tax
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL
),
dated AS (
  SELECT *, CAST(strftime(m, '%Y%m01') AS INTEGER) AS date_key, strftime(m, '%Y-%m') AS year_month,
         CAST(year(m) AS INTEGER) AS year, CAST(year(m) * 12 + month(m) - 1 AS INTEGER) AS mi,
         CASE line % 4 WHEN 0 THEN 'Single-detached units' WHEN 1 THEN 'Semi-detached units'
              WHEN 2 THEN 'Row units' ELSE 'Apartment and other units' END AS dwelling
  FROM lines
),
typed_lines AS (
  SELECT * FROM dated
  UNION ALL SELECT * REPLACE ('Total units' AS dwelling) FROM dated
),
absorption AS (
  SELECT date_key, year_month, year, mi, geo, level, province, agg, dwelling,
         dwelling = 'Total units' AS is_total,
         SUM(CASE WHEN status = 'F' THEN quantity END) AS absorptions,
         SUM(CASE WHEN status = 'O' THEN quantity END) AS unabsorbed
  FROM typed_lines JOIN label USING (nk) GROUP BY ALL
),
unoccupied AS (
  SELECT date_key, geo, dwelling, SUM(quantity) AS units
  FROM typed_lines JOIN label USING (nk) WHERE flag = 'N' GROUP BY ALL
),
component AS (
  SELECT date_key, mi, geo, CASE line % 3 WHEN 0 THEN 'Total (house and land)'
         WHEN 1 THEN 'House only' ELSE 'Land only' END AS component,
         CAST(CAST(SUM(price) AS DOUBLE) / CAST(SUM(quantity) AS DOUBLE) / 9.97::DOUBLE
              AS DECIMAL(12,4)) AS idx
  FROM dated JOIN label USING (nk) GROUP BY ALL
),
product_line AS (
  SELECT date_key, mi, price, discount,
         CASE WHEN line > 4 THEN 'Other' WHEN flag = 'R' THEN 'Variable rate'
              ELSE 'Fixed rate' END AS lead,
         CASE WHEN status = 'F' THEN 'insured' ELSE 'uninsured' END AS insured, line
  FROM dated
),
product_month AS (
  SELECT date_key, mi, lead,
         CASE WHEN line <= 4 THEN 'residential mortgages, ' || insured || ', ' ||
                list_extract(['less than 1 year', 'from 1 to less than 3 years',
                              'from 3 to less than 5 years', '5 years and more'], line)
              WHEN line = 5 THEN 'non-residential mortgages'
              WHEN line = 6 THEN 'business loans' ELSE 'consumer credit' END AS subject,
         SUM(price) AS price, SUM(discount) AS discount
  FROM product_line GROUP BY ALL
  UNION ALL
  SELECT date_key, mi, 'Total', 'residential mortgages, ' || insured, SUM(price), SUM(discount)
  FROM product_line WHERE line <= 4 GROUP BY ALL
),
product AS (
  SELECT *, SUM(price) OVER (PARTITION BY lead, subject ORDER BY mi
                             ROWS UNBOUNDED PRECEDING) AS balance,
         CAST(CAST(discount AS DOUBLE) / NULLIF(CAST(price AS DOUBLE), 0) * 100
              AS DECIMAL(9,4)) AS rate
  FROM product_month
),
origination AS (
  SELECT date_key, mi, lead || ', funds advanced, ' || subject AS product, lead, subject,
         price AS funds, CAST(NULL AS DECIMAL(38,2)) AS balance, rate FROM product
  UNION ALL
  SELECT date_key, mi, lead || ', outstanding balances, ' || subject, lead, subject,
         NULL, balance, NULL FROM product
),
residential AS (
  SELECT * FROM origination WHERE subject LIKE 'residential%' AND lead <> 'Total'
),
reading AS (
  SELECT date_key, mi, line, CAST(CAST(SUM(tax) AS DOUBLE)
         / NULLIF(CAST(SUM(price) AS DOUBLE), 0) * 100 AS DECIMAL(9,4)) AS r
  FROM dated GROUP BY ALL
),
mortgage_rate AS (
  SELECT date_key, mi, CAST(CAST(SUM(r) AS DOUBLE) / CAST(COUNT(r) AS DOUBLE)
         AS DECIMAL(9,4)) AS rate
  FROM reading GROUP BY ALL
)"""

_REGIONS = [r for r in vocab.ARREARS_REGIONS if not r[3]]
_REGION_NAMES = ", ".join(f"'{r[0]}'" for r in _REGIONS)
_REGION_COVERS = ", ".join(f"'{r[2]}'" for r in _REGIONS)

_ARREARS = f"""
event_month AS (
  SELECT {_EVENT_MONTH} AS m,
         user_id % {len(_REGIONS)} AS k, COUNT(*) AS total,
         COUNT(*) FILTER (event_type = 'error') AS late
  FROM events GROUP BY ALL
),
both_levels AS (
  SELECT m, list_extract([{_REGION_NAMES}], k + 1) AS region,
         list_extract([{_REGION_COVERS}], k + 1) AS covers, FALSE AS nat,
         k < {len(_REGIONS) - 1} AS shown, total, late FROM event_month
  UNION ALL
  SELECT m, 'Canada', 'everywhere', TRUE, TRUE, CAST(SUM(total) AS BIGINT),
         CAST(SUM(late) AS BIGINT) FROM event_month GROUP BY m
),
arrears AS (
  SELECT CAST(strftime(m, '%Y%m01') AS INTEGER) AS date_key, strftime(m, '%Y-%m') AS year_month,
         CAST(year(m) AS INTEGER) AS year, CAST(year(m) * 12 + month(m) - 1 AS INTEGER) AS mi,
         m, region, covers, nat, total, CASE WHEN shown THEN late END AS late,
         CASE WHEN shown THEN CAST((20000 * late + total) // (2 * total) AS DECIMAL(18,2)) / 100
              END AS rate_d,
         NOT shown AS hidden
  FROM both_levels
),
arrears_typed AS (
  SELECT * EXCLUDE (rate_d), CAST(rate_d AS DECIMAL(9,4)) AS rate FROM arrears
)"""


def _with(*fragments: str) -> str:
    return "WITH " + ",\n".join(f.strip() for f in (_PLACE, _LABELS, _CALENDAR, *fragments))


# Each may be continued with ", more AS (...)" or ended with a SELECT.
HOUSING = _with(_HOUSING)
LINES = _with(_LINES)
ARREARS = _with(_LINES, _ARREARS)
EVERYTHING = _with(_HOUSING, _LINES, _ARREARS)
