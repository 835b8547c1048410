"""Measures: a number under a filter context, as a DataFrame.

Every measure is called as ``measure(star, by=(...), where={...})`` and returns the
``by`` columns plus one column named after the measure.

* ``by`` may name any column of the fact's dimensions, or ``date_key``.
* ``where`` maps a dimension to a condition on it, a Column or SQL text.  Conditions
  are applied to the dimension before it is joined, so they prune the fact.

Three rules keep numbers honest.  Rates are ratios of sums.  Two coverages are never
added: a group that holds both is NULL.  Totals are never mixed with their parts: place
measures must be told one ``level`` and whether to read dwelling ``"total"`` or
``"parts"``.  A missing number is NULL everywhere, never zero.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.functions.scalars import percent_text, ratio, thousands
from tallystar.operators.aggregates import mean, ratio_of_sums, weighted_mean
from tallystar.operators.calendar import within_calendar
from tallystar.operators.timeseries import (
    last_period_with_data,
    mark_last_period,
    month_index,
    month_of_index,
    share_of_movement,
)
from tallystar.schemas import DIMENSIONS, FACTS, KEY, RELATIONSHIPS
from tallystar.sources.tables import FOLDER, within_months

Star = Mapping[str, DataFrame]
Where = Mapping[str, Column | str] | None
Measure = Callable[..., DataFrame]

CALENDAR_COLUMNS = DIMENSIONS["dim_date"].fieldNames()
MILLION = 1_000_000


# Context -------------------------------------------------------------------------


def _conditions(where: Where) -> dict[str, Column]:
    return {
        dim: F.expr(condition) if isinstance(condition, str) else condition
        for dim, condition in (where or {}).items()
    }


def _also(where: Where, dim: str, condition: Column) -> dict[str, Column]:
    """``where`` with one more condition on a dimension."""
    merged = _conditions(where)
    merged[dim] = merged[dim] & condition if dim in merged else condition
    return merged


def in_context(star: Star, fact: str, by: Sequence[str], where: Where = None) -> DataFrame:
    """The fact joined to just those dimensions that filter it or name its groups.

    A condition on the calendar keeps the scan to the year folders that it names.
    """
    where = _conditions(where)
    reachable = [dim for dim, target in RELATIONSHIPS if target == fact]
    rows = star[fact]
    stray = set(where) - set(reachable)
    if stray:
        raise ValueError(f"{fact} has no relationship to {', '.join(sorted(stray))}")
    if "dim_date" in where:
        rows = within_months(rows, star["dim_date"].filter(where["dim_date"]))
    rows = rows.drop(FOLDER)
    wanted = [c for c in by if c not in FACTS[fact].fieldNames()]
    for dim in reachable:
        members = star[dim].filter(where[dim]) if dim in where else star[dim]
        shown = [c for c in wanted if c in DIMENSIONS[dim].fieldNames()]
        wanted = [c for c in wanted if c not in shown]
        if shown:
            rows = rows.join(members.select(KEY[dim], *shown), KEY[dim])
        elif dim in where and dim != "dim_date":
            rows = rows.join(members.select(KEY[dim]), KEY[dim], "left_semi")
    if wanted:
        raise ValueError(f"{fact} has no dimension column {', '.join(wanted)}")
    return rows


def _periods(by: Sequence[str]) -> list[str]:
    return [c for c in by if c in CALENDAR_COLUMNS]


MONTH_GRAIN = {"date_key", "date", "year_month"}


def _dated(by: Sequence[str]) -> list[str]:
    """``by``, with the month where it names no period."""
    return list(by) if _periods(by) else [*by, "date_key"]


def _moved(star: Star, months: int) -> Star:
    """The star as it will look ``months`` later, within the same calendar.

    Re-dating the facts shifts the dates in context for any measure and any period:
    a month, quarter or year then holds what it held ``months`` before, whether or not
    a series has a row of its own there.
    """
    later = {
        fact: within_calendar(
            star[fact].drop(FOLDER).withColumn(
                "date_key", month_of_index(month_index("date_key") + months)),
            star["dim_date"],
        )
        for fact in FACTS if fact in star
    }
    return {**star, **later}


def _monthly_context(by: Sequence[str], where: Where) -> tuple[list[str], dict, Column | None]:
    """Series keys, the context without its dates, and the date condition.

    Trailing measures look outside the dates in context, so those are applied to the
    result.
    """
    context = _conditions(where)
    dates = context.pop("dim_date", None)
    return [c for c in by if c not in CALENDAR_COLUMNS], context, dates


def _over_months(
    monthly: DataFrame, keys: Sequence[str], reach: int, sums: Mapping[str, tuple[str, int, int]],
    shape: Callable = F.sum,
) -> DataFrame:
    """For every month, ``sums``: name to (column, nearest, farthest month back).

    Each monthly row is laid on the months that look back on it, so a month that a series
    skips still sees the months before it.  ``_own`` says whether it has a row itself.
    Rows are one per series and month, so the copies are few.
    """
    back = F.explode(F.sequence(F.lit(0), F.lit(reach - 1)))
    laid = monthly.withColumn("_back", back).withColumn(
        "date_key", month_of_index(month_index("date_key") + F.col("_back")))
    seen = {
        name: shape(F.when(F.col("_back").between(near, far), F.col(column))).alias(name)
        for name, (column, near, far) in sums.items()
    }
    return laid.groupBy(*keys, "date_key").agg(
        F.max(F.col("_back") == 0).alias("_own"), *seen.values()
    )


def _as_asked(
    star: Star, monthly: DataFrame, values: Sequence[str], by: Sequence[str], dates: Column | None
) -> DataFrame:
    """Monthly values cut to the periods in context, each seen from its last month.

    Without a period, the last month with a row of its own stands for all.
    """
    calendar = star["dim_date"] if dates is None else star["dim_date"].filter(dates)
    periods = _periods(by)
    if set(periods) & MONTH_GRAIN:
        shown = calendar.select("date_key", *[c for c in periods if c != "date_key"])
    elif periods:
        shown = calendar.groupBy(*periods).agg(F.max("date_key").alias("date_key"))
    else:
        shown = calendar.select("date_key")
    known = monthly.join(F.broadcast(shown), "date_key")
    if not periods:
        known = known.filter(F.col("date_key") == last_period_with_data(known.filter("_own")))
    return known.select(*by, *values)


# Shapes --------------------------------------------------------------------------


def _one_coverage(value: Column, coverage: Column) -> Column:
    return F.when(F.min(coverage) == F.max(coverage), value)


def _place_context(where: Where, level: str, dwelling: str) -> dict[str, Column]:
    if dwelling == "total":
        types = F.col("is_total")
    elif dwelling == "parts":
        types = F.col("dwelling_category").isin(*vocab.DWELLING_PARTS)
    else:
        raise ValueError("dwelling must be 'total' or 'parts'")
    where = _also(where, "dim_dwelling_type", types)
    return _also(where, "dim_geography", ~F.col("is_aggregate") & (F.col("geo_level") == level))


def _flow(rows: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum(value).alias(name))


def _snapshot(
    rows: DataFrame, by: Sequence[str], value: str, name: str, guard: str | None = None
) -> DataFrame:
    marked = mark_last_period(rows, value, _periods(by), name="_at_last")
    total = F.sum(F.when(F.col("_at_last"), F.col(value)))
    if guard:
        total = _one_coverage(total, F.when(F.col("_at_last"), F.col(guard)))
    return marked.groupBy(*by).agg(total.alias(name))


def _in_last_month(frame: DataFrame, own: DataFrame, by: Sequence[str]) -> DataFrame:
    """Without a period in ``by``, the rows of the last month of ``own``."""
    if _periods(by):
        return frame
    return frame.filter(F.col("date_key") == last_period_with_data(own))


def _shifted(base: Measure, months: int, name: str) -> Measure:
    """The measure as it stood ``months`` earlier, for every period that then had it."""

    def measure(star: Star, by: Sequence[str] = (), where: Where = None, **kw) -> DataFrame:
        asked = _dated(by)
        earlier = base(_moved(star, months), asked, where, **kw)
        if not _periods(by):
            earlier = _in_last_month(earlier, base(star, asked, where, **kw), by)
        if not by:  # a single number is there even when it is blank
            return earlier.agg(F.max(base.__name__).alias(name))
        return earlier.select(*by, F.col(base.__name__).alias(name))

    return _named(measure, name, f"{base.__name__} {months} months earlier.")


def _beside_last_year(star: Star, base: Measure, by: Sequence[str], where: Where, kw) -> DataFrame:
    """The measure with itself twelve months earlier as ``_year_ago``."""
    asked = _dated(by)
    now = base(star, asked, where, **kw)
    then = base(_moved(star, 12), asked, where, **kw).withColumnRenamed(
        base.__name__, "_year_ago")
    paired = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in asked]
    both = now.alias("a").join(then.alias("b"), paired, "left").select("a.*", "b._year_ago")
    return _in_last_month(both, now, by)


def _against_last_year(base: Measure, name: str, compare: Callable[[Column, Column], Column]):
    """A comparison of the measure with itself twelve months earlier."""

    def measure(star: Star, by: Sequence[str] = (), where: Where = None, **kw) -> DataFrame:
        both = _beside_last_year(star, base, by, where, kw)
        compared = compare(F.col(base.__name__), F.col("_year_ago"))
        return both.select(*by, compared.alias(name))

    return _named(measure, name, f"{base.__name__} compared with twelve months earlier.")


def _trailing(base: Measure, months: int, name: str, shape: Callable = F.sum) -> Measure:
    """Total, or mean, of the measure over the ``months`` that end with the period."""

    def measure(star: Star, by: Sequence[str] = (), where: Where = None, **kw) -> DataFrame:
        keys, context, dates = _monthly_context(by, where)
        monthly = base(star, [*keys, "date_key"], context, **kw)
        looked = _over_months(
            monthly, keys, months, {name: (base.__name__, 0, months - 1)}, shape)
        return _as_asked(star, looked, [name], by, dates)

    return _named(measure, name, f"{base.__name__} over the last {months} months.")


def _named(measure: Measure, name: str, doc: str) -> Measure:
    measure.__name__, measure.__doc__ = name, doc
    return measure


def _difference(now: Column, then: Column) -> Column:
    return now - then


def _relative(now: Column, then: Column) -> Column:
    return ratio(now - then, then)


# Coverage ------------------------------------------------------------------------


def one_coverage_selected(star: Star, by: Sequence[str] = (), where: Where = None) -> DataFrame:
    rows = in_context(star, "fact_housing_activity", by, where)
    return rows.groupBy(*by).agg(
        (F.countDistinct("coverage_key") == 1).alias("one_coverage_selected")
    )


def coverage_warning(star: Star, by: Sequence[str] = (), where: Where = None) -> DataFrame:
    guard = one_coverage_selected(star, by, where)
    text = F.when(~F.col("one_coverage_selected"), F.lit(vocab.COVERAGE_WARNING))
    return guard.select(*by, text.alias("coverage_warning"))


# Housing -------------------------------------------------------------------------


def _housing_rows(star, stage, by, where, level, dwelling) -> DataFrame:
    where = _place_context(where, level, dwelling)
    where = _also(where, "dim_construction_stage", F.col("stage_short") == stage)
    return in_context(star, "fact_housing_activity", by, where)


def _housing_flow(stage: str, name: str) -> Measure:
    def measure(star: Star, by: Sequence[str] = (), where: Where = None, *,
                level: str, dwelling: str) -> DataFrame:
        rows = _housing_rows(star, stage, by, where, level, dwelling)
        units = _one_coverage(F.sum("units"), F.col("coverage_key"))
        return rows.groupBy(*by).agg(units.alias(name))

    return _named(measure, name, f"Units, stage {stage}; NULL over more than one coverage.")


housing_starts = _housing_flow("Starts", "housing_starts")
housing_completions = _housing_flow("Completions", "housing_completions")


def under_construction(star: Star, by: Sequence[str] = (), where: Where = None, *,
                       level: str, dwelling: str) -> DataFrame:
    """A count at a moment: the last month with data, not a sum of months."""
    rows = _housing_rows(star, "Under construction", by, where, level, dwelling)
    return _snapshot(rows, by, "units", "under_construction", guard="coverage_key")


housing_starts_last_year = _shifted(housing_starts, 12, "housing_starts_last_year")
housing_starts_change = _against_last_year(housing_starts, "housing_starts_change", _difference)
housing_starts_change_pct = _against_last_year(
    housing_starts, "housing_starts_change_pct", _relative
)
housing_starts_12_months = _trailing(housing_starts, 12, "housing_starts_12_months")
housing_completions_12_months = _trailing(
    housing_completions, 12, "housing_completions_12_months"
)


_STAGES = {"starts": "Starts", "built": "Completions", "open": "Under construction"}
_PACE = {
    "starts": ("starts", 0, 0), "built": ("built", 0, 0), "open": ("open", 0, 0),
    "starts_year": ("starts", 0, 11), "built_year": ("built", 0, 11),
}


def _pace(star, by, where, level, dwelling, reach, sums) -> tuple[DataFrame, Column | None]:
    """Monthly stages of each series with what its past months add up to, from one pass."""
    keys, context, dates = _monthly_context(by, where)
    context = _place_context(context, level, dwelling)
    rows = in_context(
        star, "fact_housing_activity", [*keys, "date_key", "stage_short"], context
    )
    monthly = rows.groupBy(*keys, "date_key").agg(*[
        _one_coverage(
            F.sum(F.when(F.col("stage_short") == stage, F.col("units"))), F.col("coverage_key")
        ).alias(name)
        for name, stage in _STAGES.items()
    ])
    return _over_months(monthly, keys, reach, sums), dates


def _backlog(still_open: str, built_year: str) -> Column:
    return ratio(still_open, F.col(built_year).cast("double") / 12)


def completion_ratio(star: Star, by: Sequence[str] = (), where: Where = None, *,
                     level: str, dwelling: str) -> DataFrame:
    """Trailing-year completions over trailing-year starts."""
    paced, dates = _pace(star, by, where, level, dwelling, 12, _PACE)
    value = paced.withColumn("completion_ratio", ratio("built_year", "starts_year"))
    return _as_asked(star, value, ["completion_ratio"], by, dates)


def backlog_months(star: Star, by: Sequence[str] = (), where: Where = None, *,
                   level: str, dwelling: str) -> DataFrame:
    """Months to finish what is under construction at the trailing year's pace."""
    paced, dates = _pace(star, by, where, level, dwelling, 12, _PACE)
    value = paced.withColumn("backlog_months", _backlog("open", "built_year"))
    return _as_asked(star, value, ["backlog_months"], by, dates)


backlog_months_last_year = _shifted(backlog_months, 12, "backlog_months_last_year")
backlog_months_change = _against_last_year(backlog_months, "backlog_months_change", _difference)


def housing_panel(star: Star, by: Sequence[str] = (), where: Where = None, *,
                  level: str, dwelling: str) -> DataFrame:
    """All housing measures of each month side by side, from one pass over the fact.

    Asking for the measures one by one reads the fact once each; a report that shows
    several should ask for the panel.  Goes by month, so ``date_key`` is always included;
    a month has a row if the series has one there, or any measure does.
    """
    keys = [c for c in by if c not in CALENDAR_COLUMNS]
    sums = {
        **_PACE, "starts_then": ("starts", 12, 12), "open_then": ("open", 12, 12),
        "built_year_then": ("built", 12, 23),
    }
    paced, dates = _pace(star, by, where, level, dwelling, 24, sums)
    change = F.col("starts") - F.col("starts_then")
    now, then = _backlog("open", "built_year"), _backlog("open_then", "built_year_then")
    panel = paced.withColumns({
        "housing_starts": F.col("starts"),
        "housing_completions": F.col("built"),
        "under_construction": F.col("open"),
        "housing_starts_last_year": F.col("starts_then"),
        "housing_starts_change": change,
        "housing_starts_change_pct": ratio(change, "starts_then"),
        "housing_starts_12_months": F.col("starts_year"),
        "housing_completions_12_months": F.col("built_year"),
        "completion_ratio": ratio("built_year", "starts_year"),
        "backlog_months": now,
        "backlog_months_last_year": then,
        "backlog_months_change": now - then,
    })
    shown = F.col("_own") | F.coalesce(*HOUSING_PANEL).isNotNull()
    return _as_asked(star, panel.filter(shown), HOUSING_PANEL, [*keys, "date_key"], dates)


HOUSING_PANEL = (
    "housing_starts", "housing_completions", "under_construction", "housing_starts_last_year",
    "housing_starts_change", "housing_starts_change_pct", "housing_starts_12_months",
    "housing_completions_12_months", "completion_ratio", "backlog_months",
    "backlog_months_last_year", "backlog_months_change",
)


def _absorption_rows(star, by, where, level, dwelling) -> DataFrame:
    where = _place_context(where, level, dwelling)
    return in_context(star, "fact_market_absorption", by, where)


def unsold_inventory(star: Star, by: Sequence[str] = (), where: Where = None, *,
                     level: str, dwelling: str) -> DataFrame:
    rows = _absorption_rows(star, by, where, level, dwelling)
    return _snapshot(rows, by, "unabsorbed_inventory", "unsold_inventory")


def homes_sold_or_rented(star: Star, by: Sequence[str] = (), where: Where = None, *,
                         level: str, dwelling: str) -> DataFrame:
    rows = _absorption_rows(star, by, where, level, dwelling)
    return _flow(rows, by, "absorptions", "homes_sold_or_rented")


def percent_unsold(star: Star, by: Sequence[str] = (), where: Where = None, *,
                   level: str, dwelling: str) -> DataFrame:
    rows = _absorption_rows(star, by, where, level, dwelling)
    marked = mark_last_period(rows, "unabsorbed_inventory", _periods(by), name="_at_last")
    sums = marked.groupBy(*by).agg(
        F.sum(F.when(F.col("_at_last"), F.col("unabsorbed_inventory"))).alias("_unsold"),
        F.sum("absorptions").alias("_sold"),
    )
    share = ratio("_unsold", F.col("_unsold") + F.col("_sold"))
    return sums.select(*by, share.alias("percent_unsold"))


# Arrears -------------------------------------------------------------------------


def _arrears_rows(star: Star, by: Sequence[str], where: Where) -> DataFrame:
    """Regions without the national row, unless the context picks regions itself."""
    columns = set(DIMENSIONS["dim_arrears_region"].fieldNames())
    picked = "dim_arrears_region" in (where or {}) or columns & set(by)
    if not picked:
        where = _also(where, "dim_arrears_region", ~F.col("is_national"))
    return in_context(star, "fact_mortgage_arrears", by, where)


def total_mortgages(star: Star, by: Sequence[str] = (), where: Where = None) -> DataFrame:
    return _flow(_arrears_rows(star, by, where), by, "total_mortgages", "total_mortgages")


def mortgages_in_arrears(star: Star, by: Sequence[str] = (), where: Where = None) -> DataFrame:
    rows = _arrears_rows(star, by, where)
    return _flow(rows, by, "mortgages_in_arrears", "mortgages_in_arrears")


def arrears_rate(star: Star, by: Sequence[str] = (), where: Where = None) -> DataFrame:
    """Sum of arrears over sum of mortgages."""
    rows = _arrears_rows(star, by, where)
    rate = ratio_of_sums("mortgages_in_arrears", "total_mortgages")
    return rows.groupBy(*by).agg(rate.alias("arrears_rate"))


arrears_rate_last_year = _shifted(arrears_rate, 12, "arrears_rate_last_year")
arrears_rate_change_points = _against_last_year(
    arrears_rate, "arrears_rate_change_points", lambda now, then: (now - then) * 100
)


arrears_rate_3_month_average = _trailing(
    arrears_rate, 3, "arrears_rate_3_month_average", F.avg
)


def mortgage_rate(star: Star, by: Sequence[str] = (), where: Where = None) -> DataFrame:
    rows = in_context(star, "fact_mortgage_rate", by, where)
    return rows.groupBy(*by).agg(mean("rate_5year").alias("mortgage_rate"))


mortgage_rate_18_months_ago = _shifted(mortgage_rate, 18, "mortgage_rate_18_months_ago")


# What changed --------------------------------------------------------------------


def share_of_national_change(star: Star, by: Sequence[str] = ("geo_name", "date_key"),
                             where: Where = None, *, level: str, dwelling: str) -> DataFrame:
    """A place's change over the total absolute change of all places of its level."""
    if "geo_name" not in by:
        raise ValueError("share_of_national_change goes by geo_name")
    everywhere = _conditions(where)
    places = everywhere.pop("dim_geography", None)
    changes = housing_starts_change(star, by, everywhere, level=level, dwelling=dwelling)
    group = [c for c in by if c != "geo_name"]
    keyed = changes if group else changes.withColumn("_all", F.lit(0))
    shared = share_of_movement(
        keyed, "housing_starts_change", group or ["_all"], "share_of_national_change", 1.0
    )
    if places is not None:  # the place filter narrows what is shown, not what is shared
        chosen = star["dim_geography"].filter(places).select("geo_name")
        shared = shared.join(chosen, "geo_name", "left_semi")
    return shared.select(*by, "share_of_national_change")


def headline_text(place: Column, change: Column, change_pct: Column) -> Column:
    direction = F.when(change >= 0, "up").otherwise("down")
    sentence = F.concat(
        place, F.lit(": housing starts "), direction, F.lit(" "), thousands(F.abs(change)),
        F.lit(" homes ("), F.coalesce(percent_text(F.abs(change_pct)), F.lit("")),
        F.lit(") vs the same month last year"),
    )
    return F.when(change.isNull(), F.lit(vocab.NO_COMPARABLE_MONTH)).otherwise(sentence)


def headline(star: Star, by: Sequence[str] = (), where: Where = None, *,
             level: str, dwelling: str) -> DataFrame:
    """One sentence per group: direction, size and percent of the change."""
    both = _beside_last_year(star, _starts_of_place, by, where, {"level": level, "dwelling": dwelling})
    now, then = F.col("_starts_of_place"), F.col("_year_ago")
    text = headline_text(F.col("_place"), now - then, ratio(now - then, then))
    return both.select(*by, text.alias("headline"))


def _starts_of_place(star: Star, by: Sequence[str] = (), where: Where = None, *,
                     level: str, dwelling: str) -> DataFrame:
    """Starts, and the one place they are of; the country if there are several."""
    rows = _housing_rows(
        star, "Starts", [*by, *({"geo_name"} - set(by))], where, level, dwelling
    ).withColumn("_name", F.col("geo_name"))
    one = F.when(F.min("_name") == F.max("_name"), F.min("_name")).otherwise(vocab.COUNTRY)
    return rows.groupBy(*by).agg(
        _one_coverage(F.sum("units"), F.col("coverage_key")).alias("_starts_of_place"),
        one.alias("_place"),
    )


# Lending -------------------------------------------------------------------------


def _lending_rows(star: Star, by: Sequence[str], where: Where) -> DataFrame:
    detailed = (F.col("product_family") == vocab.RESIDENTIAL) & ~F.col("is_total")
    return in_context(
        star, "fact_mortgage_originations", by, _also(where, "dim_credit_product", detailed)
    )


def _in_dollars(frame: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """The source publishes millions."""
    return frame.select(*by, (F.col(name) * MILLION).alias(name))


def new_mortgage_lending(star: Star, by: Sequence[str] = (), where: Where = None) -> DataFrame:
    name = "new_mortgage_lending"
    lent = _flow(_lending_rows(star, by, where), by, "funds_advanced_millions", name)
    return _in_dollars(lent, by, name)


new_mortgage_lending_12_months = _trailing(
    new_mortgage_lending, 12, "new_mortgage_lending_12_months"
)


def mortgage_debt_outstanding(
    star: Star, by: Sequence[str] = (), where: Where = None
) -> DataFrame:
    name = "mortgage_debt_outstanding"
    owed = _snapshot(
        _lending_rows(star, by, where), by, "outstanding_balance_millions", name
    )
    return _in_dollars(owed, by, name)


def average_rate_on_new_lending(
    star: Star, by: Sequence[str] = (), where: Where = None
) -> DataFrame:
    """Weighted by what was actually lent."""
    rate = weighted_mean("interest_rate", "funds_advanced_millions")
    rows = _lending_rows(star, by, where)
    return rows.groupBy(*by).agg(rate.alias("average_rate_on_new_lending"))


def variable_rate_share(star: Star, by: Sequence[str] = (), where: Where = None) -> DataFrame:
    fetched = [*by, *({"rate_type"} - set(by))]
    rows = _lending_rows(star, fetched, where)
    funds, kind = F.col("funds_advanced_millions"), F.col("rate_type")
    share = ratio_of_sums(
        F.when(kind == "Variable", funds), F.when(kind.isin("Variable", "Fixed"), funds)
    )
    return rows.groupBy(*by).agg(share.alias("variable_rate_share"))


# Prices --------------------------------------------------------------------------


def price_index(star: Star, by: Sequence[str] = (), where: Where = None) -> DataFrame:
    """Mean index.  Only ever compare an index with itself over time."""
    rows = in_context(star, "fact_price_index", by, where)
    return rows.groupBy(*by).agg(mean("index_value").alias("price_index"))


price_index_change_pct = _against_last_year(price_index, "price_index_change_pct", _relative)


# Data quality --------------------------------------------------------------------


def _check_counts(star: Star, by: Sequence[str], condition: Column | None) -> DataFrame:
    results = star["check_results"]
    if condition is not None:
        results = results.filter(condition)
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("checks_run"),
        F.count_if(F.col("passed")).alias("checks_passed"),
    )


def checks_run(star: Star, by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    return _check_counts(star, by, where).select(*by, "checks_run")


def checks_passed(star: Star, by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    return _check_counts(star, by, where).select(*by, "checks_passed")


def check_pass_rate(star: Star, by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    rate = ratio("checks_passed", "checks_run").alias("check_pass_rate")
    return _check_counts(star, by, where).select(*by, rate)


def quality_text(failed: Column) -> Column:
    return F.when(failed == 0, F.lit(vocab.ALL_NUMBERS_MATCH)).otherwise(
        F.concat(thousands(failed), F.lit(" numbers need review"))
    )


def data_quality_status(
    star: Star, by: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    failed = F.col("checks_run") - F.col("checks_passed")
    text = quality_text(failed).alias("data_quality_status")
    return _check_counts(star, by, where).select(*by, text)


def through_text(date: Column) -> Column:
    return F.concat(F.lit("Data up to "), F.date_format(date, "MMMM yyyy"))


def data_through(star: Star, by: Sequence[str] = (), where: Where = None, *,
                 fact: str = "fact_housing_activity") -> DataFrame:
    """Last month that has data; the calendar itself may run ahead of it."""
    rows = in_context(star, fact, [*by, "date"], where)
    return rows.groupBy(*by).agg(through_text(F.max("date")).alias("data_through"))


MEASURES: dict[str, Measure] = {
    measure.__name__: measure
    for measure in (
        one_coverage_selected, coverage_warning, housing_starts, housing_completions,
        under_construction, housing_starts_last_year, housing_starts_change,
        housing_starts_change_pct, housing_starts_12_months, housing_completions_12_months,
        completion_ratio, backlog_months, backlog_months_last_year, backlog_months_change,
        unsold_inventory, homes_sold_or_rented, percent_unsold, total_mortgages,
        mortgages_in_arrears, arrears_rate, arrears_rate_last_year, arrears_rate_change_points,
        arrears_rate_3_month_average, mortgage_rate, mortgage_rate_18_months_ago,
        share_of_national_change, headline, new_mortgage_lending,
        new_mortgage_lending_12_months, mortgage_debt_outstanding,
        average_rate_on_new_lending, variable_rate_share, price_index, price_index_change_pct,
        checks_run, checks_passed, check_pass_rate, data_quality_status, data_through,
    )
}

def displayed(frame: DataFrame, name: str) -> DataFrame:
    """The measure's column as the text a reader should see."""
    style, places = vocab.DISPLAY[name]
    value = F.col(name).cast("decimal(38,10)")

    def number(v: Column) -> Column:
        return F.format_number(F.round(v, places), places)

    if style == "percent":
        text = percent_text(F.col(name), places)
    elif style == "millions":
        text = F.concat(F.lit("$"), number(value / MILLION), F.lit(" M"))
    elif style == "billions":
        text = F.concat(F.lit("$"), number(value / (1000 * MILLION)), F.lit(" B"))
    elif style == "signed":
        shown = F.round(value, places)
        text = F.concat(F.when(shown > 0, "+").otherwise(""), number(value))
    else:
        text = number(value)
    return frame.withColumn(name, text)
