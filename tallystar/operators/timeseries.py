"""Time intelligence over monthly series.

Input contract: at most one row per (series keys, month).  A series then never has
more rows than the calendar has months, so a window per series stays small however
large the source was; aggregate to that grain first.

``mode="calendar"`` measures distance in months and is right when months are
missing.  ``mode="rows"`` counts rows and matches a plain ROWS frame or LAG.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions.scalars import (
    ColumnOrName,
    col,
    month_index,
    month_of_index,
    percent,
    ratio,
)
from tallystar.sources.tables import FOLDER


def _series(keys: Sequence[ColumnOrName], month: ColumnOrName, mode: str):
    if mode not in ("calendar", "rows"):
        raise ValueError(f"mode must be 'calendar' or 'rows', not {mode!r}")
    if not keys:
        raise ValueError("a window needs series keys; use shift_months for a single series")
    order = month_index(month) if mode == "calendar" else col(month)
    return Window.partitionBy(*keys).orderBy(order)


def _trailing(keys, month, n: int, mode: str):
    spec = _series(keys, month, mode)
    return spec.rangeBetween(1 - n, 0) if mode == "calendar" else spec.rowsBetween(1 - n, 0)


def rolling_sum(
    value: ColumnOrName,
    keys: Sequence[ColumnOrName],
    month: ColumnOrName = "date_key",
    n: int = 12,
    mode: str = "calendar",
    require_full: bool = False,
) -> Column:
    """Sum over the last ``n`` months; optionally NULL until ``n`` rows are present."""
    frame = _trailing(keys, month, n, mode)
    total = F.sum(value).over(frame)
    if require_full:
        return F.when(F.count(F.lit(1)).over(frame) == n, total)
    return total


def rolling_mean(
    value: ColumnOrName,
    keys: Sequence[ColumnOrName],
    month: ColumnOrName = "date_key",
    n: int = 3,
    mode: str = "calendar",
) -> Column:
    """Mean of the per-month values of the last ``n`` months."""
    return F.avg(value).over(_trailing(keys, month, n, mode))


def value_months_ago(
    value: ColumnOrName,
    keys: Sequence[ColumnOrName],
    month: ColumnOrName = "date_key",
    n: int = 12,
    mode: str = "calendar",
) -> Column:
    """The series' value ``n`` months (or rows) earlier; NULL if there is none."""
    spec = _series(keys, month, mode)
    if mode == "rows":
        return F.lag(value, n).over(spec)
    return F.max(value).over(spec.rangeBetween(-n, -n))


def moved_months(
    monthly: DataFrame,
    columns: dict[str, str],
    n: int,
    month: str = "date_key",
    keys: Sequence[str] = (),
) -> DataFrame:
    """The table as it will look ``n`` months later: each row re-dated, columns renamed."""
    return monthly.select(
        *keys,
        month_of_index(month_index(month) + n).alias(month),
        *[F.col(source).alias(name) for source, name in columns.items()],
    )


def shift_months(
    monthly: DataFrame,
    columns: dict[str, str],
    n: int,
    month: str = "date_key",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Left-join each month's row to the one ``n`` months earlier.

    ``columns`` maps a source column to the name its shifted copy gets.  Without
    ``keys`` the table is one row per month, hence bounded, and the shifted copy is
    broadcast; an un-partitioned window would put everything in one task instead.
    """
    moved = moved_months(monthly, columns, n, month, keys)
    paired = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in (*keys, month)]
    side = (moved if keys else F.broadcast(moved)).alias("b")
    return monthly.alias("a").join(side, paired, "left").select(
        "a.*", *[F.col(f"b.`{name}`") for name in columns.values()]
    )


def last_period_with_data(frame: DataFrame, value: str | None = None,
                          month: str = "date_key") -> Column:
    """Scalar subquery: the latest month, of those with a value if one is named.

    Where the frame shows the folders it is stored in, only the last of them is read: the
    folders' names tell which that is.
    """
    known = frame if value is None else frame.filter(F.col(value).isNotNull())
    if value is None and _by_year(frame, month):
        known = known.filter(F.col(FOLDER) == frame.select(F.max(FOLDER)).scalar())
    return known.select(F.max(month)).scalar()


def _by_year(frame: DataFrame, month: str) -> bool:
    """Whether ``frame`` shows the year folders of its month."""
    return month == "date_key" and FOLDER in frame.columns


def latest_only(frame: DataFrame, month: str = "date_key") -> DataFrame:
    """Rows of the latest month of ``frame``; of a fact by year, from the last folder."""
    last = last_period_with_data(frame, month=month)
    if _by_year(frame, month):
        frame = frame.filter(F.col(FOLDER) == frame.select(F.max(FOLDER)).scalar())
    return frame.filter(F.col(month) == last)


def mark_last_period(
    frame: DataFrame,
    value: str,
    periods: Sequence[str] = (),
    month: str = "date_key",
    name: str = "at_last",
) -> DataFrame:
    """Flag the rows of the last month with data: one for the whole frame, or one per
    ``periods`` group (a year, say), never one per series."""
    if not periods:
        return frame.withColumn(name, F.col(month) == last_period_with_data(frame, value, month))
    lasts = (
        frame.filter(F.col(value).isNotNull()).groupBy(*periods).agg(F.max(month).alias("_last"))
    )
    dated = frame.join(lasts, list(periods), "left")
    return dated.withColumn(name, F.col(month) == F.col("_last")).drop("_last")


def semi_additive_last(
    frame: DataFrame,
    value: str,
    by: Sequence[str],
    name: str,
    month: str = "date_key",
    periods: Sequence[str] = (),
) -> DataFrame:
    """Sum of a snapshot at the last month with data.

    A series without a row that month is NULL: it does not fall back on a date of
    its own.
    """
    marked = mark_last_period(frame, value, periods, month, "_at_last")
    at_last = F.sum(F.when(F.col("_at_last"), F.col(value))).alias(name)
    return marked.groupBy(*periods, *by).agg(at_last)


def year_over_year(
    frame: DataFrame,
    value: str,
    keys: Sequence[ColumnOrName],
    last_year: str,
    change: str,
    change_pct: str | None = None,
    month: str = "date_key",
    mode: str = "calendar",
) -> DataFrame:
    """Add last year's value, the change and optionally the percent change."""
    out = frame.withColumn(last_year, value_months_ago(value, keys, month, 12, mode))
    out = out.withColumn(change, F.col(value) - F.col(last_year))
    return out if change_pct is None else out.withColumn(change_pct, percent(change, last_year))


def share_of_movement(
    frame: DataFrame, change: str, group: Sequence[str], name: str, scale: float = 100.0
) -> DataFrame:
    """Signed share of the total absolute change within each group.

    The denominators come from an aggregate joined back, not from a window: a group
    may hold any number of members, and a window would gather it in one task.
    """
    totals = frame.groupBy(*group).agg(F.sum(F.abs(F.col(change))).alias("_movement"))
    paired = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group]
    joined = frame.alias("a").join(totals.alias("b"), paired, "left")
    share = ratio(F.lit(scale) * F.col(f"a.{change}").cast("double"), "_movement").alias(name)
    return joined.select(*[F.col(f"a.`{c}`") for c in frame.columns], share)


def forward_fill(
    frame: DataFrame,
    value: str,
    keys: Sequence[str],
    position: str,
    name: str,
    block: int = 4096,
) -> DataFrame:
    """Carry the last non-null ``value`` forward along an integer ``position``.

    Levels keep one huge key out of a single task: within blocks of ``block`` positions a
    window does the filling; what a block inherits comes from one summary row per block,
    filled the same way within blocks of blocks; and what these inherit from one row per
    block of blocks.  A key with a million million sparse positions has some sixty
    thousand of those.
    """
    blocked = frame.withColumn("_block", F.floor(F.col(position) / block).cast("long"))
    known = F.col(value).isNotNull()
    tail = F.max_by(F.when(known, F.col(value)), F.when(known, F.col(position)))
    tails = blocked.groupBy(*keys, "_block").agg(tail.alias("_tail"))
    carried = _carried(tails, keys, "_block", block)
    paired = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in (*keys, "_block")]
    joined = blocked.alias("a").join(carried.alias("b"), paired).select("a.*", "b._carried")
    inside = (
        Window.partitionBy(*keys, "_block")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("_carried"))
    return joined.withColumn(name, filled).drop("_block", "_carried")


def _carried(tails: DataFrame, keys: Sequence[str], at: str, block: int, levels: int = 1):
    """What each row's place inherits: the last non-null ``_tail`` before it."""
    before = Window.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    if not levels:
        return tails.withColumn(
            "_carried", F.last("_tail", ignorenulls=True).over(before.partitionBy(*keys)))
    upper = f"{at}_of"
    grouped = tails.withColumn(upper, F.floor(F.col(at) / block).cast("long"))
    known = F.col("_tail").isNotNull()
    tops = grouped.groupBy(*keys, upper).agg(
        F.max_by(F.when(known, F.col("_tail")), F.when(known, F.col(at))).alias("_tail"))
    inherited = _carried(tops, keys, upper, block, levels - 1).select(
        *keys, upper, F.col("_carried").alias("_above"))
    paired = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in (*keys, upper)]
    inside = F.last("_tail", ignorenulls=True).over(before.partitionBy(*keys, upper))
    joined = grouped.alias("a").join(inherited.alias("b"), paired).select("a.*", "b._above")
    return joined.withColumn("_carried", F.coalesce(inside, F.col("_above"))).drop(upper, "_above")


def first_per_key(
    frame: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName]
) -> DataFrame:
    """Keep the first row of each key.

    An aggregate with map-side combine, so a key repeated any number of times is
    reduced before the shuffle instead of being sorted in one task.
    """
    rest = [c for c in frame.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*[col(o) for o in order])).alias("_first")
    kept = frame.groupBy(*keys).agg(first)
    return kept.select(*[
        F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in frame.columns
    ])
