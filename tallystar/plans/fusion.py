"""Many measures under one filter context, from one pass over each fact.

A measure called by itself reads its fact once, and twice if it looks at last year.  Here
a list of measures becomes one graph per fact:

1. **States.**  Every measure rests on sums, counts, least and greatest values of the rows
   that meet its conditions.  Conditions that differ between measures become flags, so one
   aggregate by series and month holds the states of all of them.
2. **Offsets.**  A month is laid on the months that look back on it: on itself, on the
   same month of next year, on the eleven that follow.  Shifts and trailing totals are
   sums over offsets, so last year needs no second scan and no join.
3. **Values.**  One aggregate by the groups asked for picks each measure's states by
   offset; differences, ratios and texts are columns over it.

What follows the first aggregate has at most a row per series and month.  It is stored
where it is read again: to find the last month with data when no month is asked for, or
to total the movement of all places.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.functions.scalars import month_index, month_of_index, ratio
from tallystar.plans import measures as one_by_one
from tallystar.plans.measures import (
    CALENDAR_COLUMNS, MILLION, MONTH_GRAIN, Star, Where, _also, _conditions, _difference,
    _place_context, _relative,
)
from tallystar.schemas import CHECK_RESULTS, DIMENSIONS, FACTS, KEY, RELATIONSHIPS
from tallystar.session import shared_dir
from tallystar.sources.tables import FOLDER, within_months


@dataclass(frozen=True, eq=False)
class Request:
    """The context that all measures of a list share."""

    by: tuple[str, ...]
    where: Mapping[str, Column]
    level: str | None = None
    dwelling: str | None = None

    @property
    def periods(self) -> list[str]:
        return [c for c in self.by if c in CALENDAR_COLUMNS]

    @property
    def series(self) -> list[str]:
        return [c for c in self.by if c not in CALENDAR_COLUMNS]

    @property
    def by_month(self) -> bool:
        return bool(set(self.periods) & MONTH_GRAIN)


Get = Callable[[str], Column]
#: Nearest and farthest month back, and the name of the month they are seen from, if one.
When = tuple[int, int, str | None]


@dataclass(frozen=True, eq=False)
class Base:
    """Rows of a fact under conditions, and what is added up over them.

    ``states`` names (how, of what SQL expression); the same states of several months combine to the
    state of all of them.  ``value`` makes the measure of them.
    """

    fact: str
    conditions: Callable[[Request], dict[str, Column]]
    states: Mapping[str, tuple[str, str]]
    value: Callable[[Get], Column]
    attributes: tuple[str, ...] = ()


@dataclass(frozen=True, eq=False)
class Now:
    """The base over the months of the period."""

    base: Base


@dataclass(frozen=True, eq=False)
class AtLast:
    """The base in the last month, of all groups, that has a value of ``state``; states in
    ``whole`` are of the whole period."""

    base: Base
    state: str
    whole: tuple[str, ...] = ()


@dataclass(frozen=True, eq=False)
class Trailing:
    """Monthly values over the months up to the period's last: name to (value of the base's
    states, nearest and farthest month back, how)."""

    base: Base
    terms: Mapping[str, tuple[Callable[[Get], Column], int, int, str]]
    value: Callable[[Get], Column]

    @property
    def reach(self) -> int:
        return 1 + max(far for _, _, far, _ in self.terms.values())


@dataclass(frozen=True, eq=False)
class Earlier:
    """The node as it stood ``months`` before."""

    node: Now | Trailing
    months: int


@dataclass(frozen=True, eq=False)
class Compared:
    """The node with itself twelve months before; ``compare`` also gets its states now."""

    node: Now | Trailing
    compare: Callable[[Column, Column, Get], Column]


@dataclass(frozen=True, eq=False)
class Shared:
    """A comparison as a share of its total absolute value over all places."""

    node: Compared


# Definitions ---------------------------------------------------------------------


def _place(request: Request) -> dict[str, Column]:
    if request.level is None or request.dwelling is None:
        raise ValueError("place measures must be told one level and a dwelling reading")
    return _place_context(request.where, request.level, request.dwelling)


def _place_stage(stage: str, everywhere: bool = False) -> Callable[[Request], dict]:
    def conditions(request: Request) -> dict[str, Column]:
        if everywhere:
            rest = {dim: c for dim, c in request.where.items() if dim != "dim_geography"}
            request = Request(request.by, rest, request.level, request.dwelling)
        return _also(_place(request), "dim_construction_stage", F.col("stage_short") == stage)

    return conditions


_COVER = {"cover_low": ("min", "coverage_key"), "cover_high": ("max", "coverage_key")}
_UNITS = {**_COVER, "units": ("sum", "units")}


def _guarded(state: str) -> Callable[[Get], Column]:
    """NULL over more than one coverage."""
    return lambda get: F.when(get("cover_low") == get("cover_high"), get(state))


def _stage(stage: str, everywhere: bool = False) -> Base:
    return Base(
        "fact_housing_activity", _place_stage(stage, everywhere), _UNITS, _guarded("units"))


def _amount(fact: str, column: str, conditions: Callable, scale: int = 1) -> Base:
    def value(get: Get) -> Column:
        return get(column) if scale == 1 else get(column) * scale

    return Base(fact, conditions, {column: ("sum", column)}, value)


def _mean(fact: str, column: str) -> Base:
    return Base(
        fact, lambda request: dict(request.where),
        {"total": ("sum", column), "known": ("count", column)},
        lambda get: ratio(get("total"), get("known")))


def _quotient(fact: str, conditions, above: str, below: str, attributes=()) -> Base:
    return Base(
        fact, conditions, {"above": ("sum", above), "below": ("sum", below)},
        lambda get: ratio(get("above"), get("below")), attributes)


def _total(base: Base, months: int, how: str = "sum") -> Trailing:
    return Trailing(base, {"total": (base.value, 0, months - 1, how)}, lambda get: get("total"))


def _arrears(request: Request) -> dict[str, Column]:
    regions = set(DIMENSIONS["dim_arrears_region"].fieldNames())
    if "dim_arrears_region" in request.where or regions & set(request.by):
        return dict(request.where)
    return _also(request.where, "dim_arrears_region", ~F.col("is_national"))


def _lending(request: Request) -> dict[str, Column]:
    detailed = (F.col("product_family") == vocab.RESIDENTIAL) & ~F.col("is_total")
    return _also(request.where, "dim_credit_product", detailed)


def _plain_context(request: Request) -> dict[str, Column]:
    return dict(request.where)


def _headline(now: Column, then: Column, get: Get) -> Column:
    place = F.when(get("place_low") == get("place_high"), get("place_low")).otherwise(vocab.COUNTRY)
    return one_by_one.headline_text(place, now - then, ratio(now - then, then))


def _plainly(compare: Callable[[Column, Column], Column]) -> Callable:
    return lambda now, then, _: compare(now, then)


_starts, _built = _stage("Starts"), _stage("Completions")
_stages = Base("fact_housing_activity", _place, {**_COVER, **{
    name: ("sum", f"CASE WHEN stage_short = '{stage}' THEN units END")
    for name, stage in (("starts", "Starts"), ("built", "Completions"), ("open", "Under construction"))
}}, lambda get: get("starts"), ("stage_short",))
_done = Trailing(
    _stages, {"starts": (_guarded("starts"), 0, 11, "sum"), "built": (_guarded("built"), 0, 11, "sum")},
    lambda get: ratio(get("built"), get("starts")))
_backlog = Trailing(
    _stages, {"open": (_guarded("open"), 0, 0, "sum"), "built": (_guarded("built"), 0, 11, "sum")},
    lambda get: ratio(get("open"), get("built").cast("double") / 12))
_covered = Base(
    "fact_housing_activity", _plain_context, _COVER,
    lambda get: F.coalesce(get("cover_low") == get("cover_high"), F.lit(False)))
_named = Base(
    "fact_housing_activity", _place_stage("Starts"),
    {**_UNITS, "place_low": ("min", "geo_name"), "place_high": ("max", "geo_name")},
    _guarded("units"), ("geo_name",))
_absorbed = _amount("fact_market_absorption", "absorptions", _place)
_unsold = _amount("fact_market_absorption", "unabsorbed_inventory", _place)
_unsold_and_sold = Base(
    "fact_market_absorption", _place, {**_unsold.states, **_absorbed.states},
    lambda get: ratio(
        get("unabsorbed_inventory"), get("unabsorbed_inventory") + get("absorptions")))
_arrears_rate = _quotient("fact_mortgage_arrears", _arrears, "mortgages_in_arrears", "total_mortgages")
_lent = _amount("fact_mortgage_originations", "funds_advanced_millions", _lending, MILLION)
_FUNDS = "funds_advanced_millions"
_price = _mean("fact_price_index", "index_value")
_rate = _mean("fact_mortgage_rate", "rate_5year")
_gap, _gap_pct = _plainly(_difference), _plainly(_relative)
#: Every measure of a star as a node.
DEFINITIONS = {
    "one_coverage_selected": Now(_covered),
    "coverage_warning": Now(Base(
        _covered.fact, _plain_context, _COVER,
        lambda get: F.when(~_covered.value(get), F.lit(vocab.COVERAGE_WARNING)))),
    "housing_starts": Now(_starts),
    "housing_completions": Now(_built),
    "under_construction": AtLast(_stage("Under construction"), "units"),
    "housing_starts_last_year": Earlier(Now(_starts), 12),
    "housing_starts_change": Compared(Now(_starts), _gap),
    "housing_starts_change_pct": Compared(Now(_starts), _gap_pct),
    "housing_starts_12_months": _total(_starts, 12),
    "housing_completions_12_months": _total(_built, 12),
    "completion_ratio": _done,
    "backlog_months": _backlog,
    "backlog_months_last_year": Earlier(_backlog, 12),
    "backlog_months_change": Compared(_backlog, _gap),
    "unsold_inventory": AtLast(_unsold, "unabsorbed_inventory"),
    "homes_sold_or_rented": Now(_absorbed),
    "percent_unsold": AtLast(_unsold_and_sold, "unabsorbed_inventory", ("absorptions",)),
    "total_mortgages": Now(_amount("fact_mortgage_arrears", "total_mortgages", _arrears)),
    "mortgages_in_arrears": Now(_amount("fact_mortgage_arrears", "mortgages_in_arrears", _arrears)),
    "arrears_rate": Now(_arrears_rate),
    "arrears_rate_last_year": Earlier(Now(_arrears_rate), 12),
    "arrears_rate_change_points": Compared(
        Now(_arrears_rate), lambda now, then, _: (now - then) * 100),
    "arrears_rate_3_month_average": _total(_arrears_rate, 3, "avg"),
    "mortgage_rate": Now(_rate),
    "mortgage_rate_18_months_ago": Earlier(Now(_rate), 18),
    "share_of_national_change": Shared(Compared(Now(_stage("Starts", everywhere=True)), _gap)),
    "headline": Compared(Now(_named), _headline),
    "new_mortgage_lending": Now(_lent),
    "new_mortgage_lending_12_months": _total(_lent, 12),
    "mortgage_debt_outstanding": AtLast(
        _amount("fact_mortgage_originations", "outstanding_balance_millions", _lending, MILLION),
        "outstanding_balance_millions"),
    "average_rate_on_new_lending": Now(_quotient(
        _lent.fact, _lending, f"interest_rate * {_FUNDS}", _FUNDS)),
    "variable_rate_share": Now(_quotient(
        _lent.fact, _lending, f"CASE WHEN rate_type = 'Variable' THEN {_FUNDS} END",
        f"CASE WHEN rate_type IN ('Variable', 'Fixed') THEN {_FUNDS} END", ("rate_type",))),
    "price_index": Now(_price),
    "price_index_change_pct": Compared(Now(_price), _gap_pct),
    "data_through": Now(Base(
        "fact_housing_activity", _plain_context, {"last": ("max", "date_key")},
        lambda get: one_by_one.through_text(F.to_date(get("last").cast("string"), "yyyyMMdd")))),
}


#: Measures of the table of checks, which has no calendar.
OF_CHECKS = ("checks_run", "checks_passed", "check_pass_rate", "data_quality_status")

#: How states of several months combine, where not as those of rows do.
_AGAIN = {"count": "sum"}


def _base(node) -> Base:
    return node.base if hasattr(node, "base") else _base(node.node)


# Compilation ---------------------------------------------------------------------


@dataclass
class _Fact:
    """The graph of one fact: what each of the two aggregates computes."""

    request: Request
    conditions: dict[str, dict[str, Column]] = field(default_factory=dict)
    attributes: dict[str, tuple[str, ...]] = field(default_factory=dict)
    states: dict[str, tuple[str, str, str]] = field(default_factory=dict)
    monthly: dict[str, Column] = field(default_factory=dict)
    offsets: set[int] = field(default_factory=set)
    lasts: dict[str, str] = field(default_factory=dict)
    picked: dict[str, str] = field(default_factory=dict)
    names: dict[tuple, str] = field(default_factory=dict)

    def _name(self, kind: str, *key) -> tuple[str, bool]:
        """A column name for the key, and whether it is new."""
        known = len(self.names)
        name = self.names.setdefault((kind, *key), f"_{kind}{known}")
        return name, len(self.names) > known

    def rows_of(self, base: Base) -> str:
        """Name of the rows that the base reads; bases under like conditions share it."""
        if ("base", base) not in self.names:
            conditions = base.conditions(self.request)
            conditions.pop("dim_date", None)  # dates choose the months that are shown
            text = tuple(sorted((dim, str(c)) for dim, c in conditions.items()))
            name, _ = self._name("rows", text, base.attributes)
            self.conditions.setdefault(name, conditions)
            self.attributes[name] = base.attributes
            self.names["base", base] = name
        return self.names["base", base]

    def state(self, base: Base, how: str, of: str) -> str:
        """Column of the first aggregate: a state of the base's rows by series and month."""
        owner = self.rows_of(base)
        name, new = self._name("state", owner, how, of)
        if new:
            self.states[name] = (owner, how, of)
        return name

    def rows(self, base: Base) -> str:
        return self.state(base, "count", "1")

    def month_value(self, base: Base, value: Callable[[Get], Column]) -> str:
        """The base's value month by month."""
        name, new = self._name("value", self.rows_of(base), value)
        if new:
            self.monthly[name] = value(lambda s: F.col(self.state(base, *base.states[s])))
        return name

    def pick(self, how: str, column: str, when: When) -> Column:
        """Column of the second aggregate: a state of the months that ``when`` chooses."""
        name, new = self._name("pick", how, column, when)
        if new:
            self.picked[name] = f"{_AGAIN.get(how, how)}(CASE WHEN {self._months(when)} THEN {column} END)"
        return F.col(name)

    def last(self, near: int, far: int, known: str) -> str:
        """Name of the greatest month, over all groups, on which months that far back and
        with the state are laid."""
        self.offsets.update(range(near, far + 1))
        name, new = self._name("last", near, far, known)
        if new:
            self.lasts[name] = f"max(CASE WHEN _off BETWEEN {near} AND {far} AND {known} THEN date_key END)"
        return name

    def _months(self, when: When) -> str:
        near, far, at = when
        self.offsets.update(range(near, far + 1))
        chosen = f"_off BETWEEN {near} AND {far}"
        if at is None:
            return chosen
        return f"{chosen} AND {'_end' if at == '_end' else f'date_key = {at}'}"

    def has(self, column: str, above: int | None = None) -> str:
        """Name of a flag by series and month: the state is known, or above a number."""
        name, new = self._name("has", column, above)
        if new:
            self.monthly[name] = F.expr(f"{column} IS NOT NULL" if above is None else f"{column} > {above}")
        return name

    def node(self, node, shift: int = 0, timed: bool = False) -> tuple[Column, Column, Get]:
        """(value, whether the group has it, states) as columns over the second aggregate.

        ``timed`` asks, without a period, for the last month instead of all of them.
        """
        timed = timed and not self.request.periods
        if isinstance(node, Earlier):
            return self.node(node.node, shift + node.months, True)
        if isinstance(node, Shared):
            return self.node(node.node)
        if isinstance(node, Compared):
            now, there, get = self.node(node.node, shift, True)
            then = self.node(node.node, shift + 12, True)[0]
            return node.compare(now, then, get), there, get
        base = node.base
        rows = self.rows(base)
        if isinstance(node, Trailing):
            at = None
            if not self.request.periods:
                at = self.last(0, node.reach - 1 if timed else 0, self.has(rows, 0))
            elif not self.request.by_month:
                at = "_end"
            terms = {
                name: self.pick(how, self.month_value(base, value), (near + shift, far + shift, at))
                for name, (value, near, far, how) in node.terms.items()}
            there = self.pick("count", rows, (shift, shift + node.reach - 1, at)) > 0
            return node.value(terms.__getitem__), there, terms.__getitem__
        at = self.last(0, 0, self.has(rows, 0)) if timed else None
        when = chosen = (shift, shift, at)
        whole: tuple[str, ...] = ()
        if isinstance(node, AtLast):
            whole = node.whole
            if not self.request.by_month:
                known = self.has(self.state(base, *base.states[node.state]))
                chosen = (shift, shift, self.last(0, 0, known))
        got = {
            name: self.pick(how, self.state(base, how, of), when if name in whole else chosen)
            for name, (how, of) in base.states.items()}
        return base.value(got.__getitem__), self.pick("count", rows, when) > 0, got.__getitem__

    # Execution

    def months_seen(self, star: Star) -> DataFrame:
        """The months in context and those that they look back on."""
        back = F.expr(f"explode(array({', '.join(map(str, sorted(self.offsets)))}))")
        chosen = star["dim_date"].filter(self.request.where["dim_date"])
        return chosen.select("date_key", back.alias("_back")).select(
            month_of_index(month_index("date_key") - F.col("_back")).alias("date_key"))

    def first_aggregate(self, star: Star, fact: str) -> DataFrame:
        """States by series and month: the one scan of the fact."""
        request, conditions = self.request, self.conditions
        reachable = [dim for dim, target in RELATIONSHIPS if target == fact]
        used = {dim for of_base in conditions.values() for dim in of_base}
        if stray := used - set(reachable):
            raise ValueError(f"{fact} has no relationship to {', '.join(sorted(stray))}")
        wanted = [c for c in dict.fromkeys(
            [*request.series, *(a for named in self.attributes.values() for a in named)])
            if c not in FACTS[fact].fieldNames()]
        flags: dict[str, list[str]] = {name: [] for name in conditions}
        rows = star[fact]
        if "dim_date" in request.where:
            rows = within_months(rows, self.months_seen(star))
        rows = rows.drop(FOLDER)
        for dim in reachable:
            if dim == "dim_date":
                continue
            shown = [c for c in wanted if c in DIMENSIONS[dim].fieldNames()]
            wanted = [c for c in wanted if c not in shown]
            here = {name: of_base[dim] for name, of_base in conditions.items() if dim in of_base}
            if not shown and not here:
                continue
            members = star[dim]
            alike = len(here) == len(conditions) and len({str(c) for c in here.values()}) == 1
            if alike:
                members = members.filter(next(iter(here.values())))
            marks = {} if alike else {str(c): c for c in here.values()}
            named = {text: f"_{dim}_{k}" for k, text in enumerate(marks)}
            members = members.select(
                KEY[dim], *shown, *[F.coalesce(c, F.lit(False)).alias(named[t]) for t, c in marks.items()])
            rows = rows.join(members, KEY[dim])
            if not alike:
                for name, c in here.items():
                    flags[name].append(named[str(c)])
        if wanted:
            raise ValueError(f"{fact} has no dimension column {', '.join(wanted)}")
        holds = {name: " AND ".join(of_base) or "true" for name, of_base in flags.items()}
        if all(of_base for of_base in flags.values()):
            rows = rows.filter(" OR ".join(f"({held})" for held in dict.fromkeys(holds.values())))
        return rows.groupBy(*request.series, "date_key").agg(*[
            F.expr(f"{how}({of if holds[owner] == 'true' else f'CASE WHEN {holds[owner]} THEN {of} END'}) AS {name}")
            for name, (owner, how, of) in self.states.items()])

    def run(self, star: Star, fact: str) -> DataFrame:
        """The second aggregate: a row per group with all picked states."""
        request = self.request
        months = self.first_aggregate(star, fact)
        if self.lasts:
            months = _stored(months)
        months = months.withColumns(self.monthly) if self.monthly else months
        laid = months.withColumn("_off", F.expr(f"explode(array({', '.join(map(str, sorted(self.offsets)))}))"))
        laid = laid.withColumn("date_key", month_of_index(month_index("date_key") + F.col("_off")))
        calendar = star["dim_date"]
        if "dim_date" in request.where:
            calendar = calendar.filter(request.where["dim_date"])
        shown = [c for c in request.periods if c != "date_key"]
        end = F.lit(True)
        if request.periods and not request.by_month:
            end = F.col("date_key") == F.max("date_key").over(Window.partitionBy(*request.periods))
        calendar = calendar.select("date_key", *shown, end.alias("_end"))
        laid = laid.join(F.broadcast(calendar), "date_key")
        if self.lasts:
            lasts = [F.expr(f"{text} AS {name}") for name, text in self.lasts.items()]
            if request.periods:
                known = laid.groupBy(*request.periods).agg(*lasts)  # a row per period
                laid = laid.join(F.broadcast(known), list(request.periods))
            else:
                known = laid.agg(*lasts).first()
                laid = laid.withColumns({n: F.lit(known[n]).cast("int") for n in self.lasts})
        return laid.groupBy(*request.by).agg(*[F.expr(f"{text} AS {n}") for n, text in self.picked.items()])


def _stored(frame: DataFrame) -> DataFrame:
    shared_dir(frame.sparkSession)
    return frame.checkpoint()


def _of_fact(star: Star, fact: str, names: Sequence[str], request: Request) -> DataFrame:
    """Groups of one fact with (there, value) of each measure as a struct of its name."""
    graph = _Fact(request)
    nodes = {name: graph.node(DEFINITIONS[name]) for name in names}
    groups = graph.run(star, fact)
    places = request.where.get("dim_geography")
    for name in names:
        if not isinstance(DEFINITIONS[name], Shared):
            continue
        if "geo_name" not in request.by:
            raise ValueError(f"{name} goes by geo_name")
        value, there, get = nodes[name]
        groups = _stored(groups.withColumn(f"_{name}", value))
        group = [c for c in request.by if c != "geo_name"]
        keyed = groups.withColumn("_group", F.lit(0))
        totals = keyed.where(there).groupBy("_group", *group).agg(
            F.sum(F.abs(F.col(f"_{name}"))).alias("_movement"))
        paired = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in ("_group", *group)]
        groups = keyed.alias("a").join(totals.alias("b"), paired, "left").select("a.*", "b._movement")
        groups = groups.drop("_group").withColumnRenamed("_movement", f"_movement_{name}")
        if places is not None:  # narrows what is shown, not what it is a share of
            chosen = star["dim_geography"].filter(places).select("geo_name").distinct()
            groups = groups.join(chosen.withColumn(f"_shown_{name}", F.lit(True)), "geo_name", "left")
            there = there & F.col(f"_shown_{name}")
        share = ratio(F.col(f"_{name}").cast("double"), f"_movement_{name}")
        nodes[name] = share, there, get
    return groups.select(*request.by, *[
        F.struct(there.alias("there"), F.when(there, value).alias("value")).alias(name)
        for name, (value, there, _) in nodes.items()])


def _of_checks(star: Star, names: Sequence[str], by: Sequence[str], condition: Column | None) -> DataFrame:
    """Groups of the table of checks, likewise, from one count."""
    if stray := set(by) - set(CHECK_RESULTS.fieldNames()):
        raise ValueError(f"check_results has no column {', '.join(sorted(stray))}")
    run, good = F.col("checks_run"), F.col("checks_passed")
    values = {
        "checks_run": run, "checks_passed": good, "check_pass_rate": ratio(good, run),
        "data_quality_status": one_by_one.quality_text(run - good),
    }
    counts = one_by_one._check_counts(star, by, condition)
    return counts.select(*by, *[
        F.struct(F.lit(True).alias("there"), values[name].alias("value")).alias(name) for name in names])


def _graphs(
    star: Star, names: Sequence[str], by: Sequence[str], where: Where,
    level: str | None, dwelling: str | None, checks_where: Column | None,
) -> DataFrame:
    if unknown := set(names) - set(DEFINITIONS) - set(OF_CHECKS):
        raise ValueError(f"no such measure: {', '.join(sorted(unknown))}")
    request = Request(tuple(by), _conditions(where), level, dwelling)
    by_fact: dict[str, list[str]] = {}
    for name in names:
        if name not in OF_CHECKS:
            by_fact.setdefault(_base(DEFINITIONS[name]).fact, []).append(name)
    frames = [_of_fact(star, fact, mine, request) for fact, mine in by_fact.items()]
    if checks := [n for n in names if n in OF_CHECKS]:
        frames.append(_of_checks(star, checks, by, checks_where))
    if len(frames) == 1:
        return frames[0]
    # One row per group and fact: stacked, each group's rows are folded into one.
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.groupBy(*by).agg(*[F.first(n, ignorenulls=True).alias(n) for n in names])


def together(
    star: Star, names: Sequence[str], by: Sequence[str] = (), where: Where = None, *,
    level: str | None = None, dwelling: str | None = None, checks_where: Column | None = None,
) -> DataFrame:
    """``by`` and one column per measure, as each would give by itself.

    A group has a row if any of the measures has one there; a measure without one is NULL.
    Without ``by`` there is one row.  Each fact is scanned once, whatever the list.
    """
    groups = _graphs(star, names, by, where, level, dwelling, checks_where)
    if by:
        groups = groups.where(" OR ".join(f"coalesce({n}.there, false)" for n in names))
    return groups.select(*by, *[F.col(f"{n}.value").alias(n) for n in names])


def listed(
    star: Star, names: Sequence[str], by: Sequence[str] = (), where: Where = None, *,
    level: str | None = None, dwelling: str | None = None, checks_where: Column | None = None,
) -> DataFrame:
    """The same as rows (measure, by, value): those that each measure would give by itself.

    For numbers; values are doubles.
    """
    groups = _graphs(star, names, by, where, level, dwelling, checks_where)
    entries = ", ".join(
        f"struct('{n}' AS measure, coalesce({n}.there, false) AS _there, CAST({n}.value AS DOUBLE) AS value)"
        for n in names)
    return groups.select(*by, F.expr(f"inline(array({entries}))")).where("_there").select("measure", *by, "value")
