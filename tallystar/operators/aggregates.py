"""Aggregates that respect how a measure may be added up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions.scalars import ColumnOrName, col, hundredths, ratio


def exclude_aggregates(
    frame: DataFrame,
    flag: str = "is_aggregate",
    level: str = "geo_level",
    keep_levels: Sequence[str] = ("Country",),
) -> DataFrame:
    """Leave out published totals, except those of the named levels."""
    wanted = ~F.col(flag)
    if keep_levels:
        wanted = wanted | F.col(level).isin(*keep_levels)
    return frame.filter(wanted)


def sums_by_label(
    frame: DataFrame,
    keys: Sequence[ColumnOrName],
    label: ColumnOrName,
    value: ColumnOrName,
    columns: Mapping[str, str],
) -> DataFrame:
    """Rows to columns: one sum per (output name -> label value), in one pass."""
    picked = col(label)
    return frame.groupBy(*keys).agg(*[
        F.sum(F.when(picked == wanted, col(value))).alias(name)
        for name, wanted in columns.items()
    ])


def ratio_of_sums(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Sum both, then divide: never a mean of rates."""
    return ratio(F.sum(col(numerator)), F.sum(col(denominator)))


def weighted_mean(value: ColumnOrName, weight: ColumnOrName) -> Column:
    return ratio(F.sum(col(value) * col(weight)), F.sum(col(weight)))


def sum_of_amounts(amount: ColumnOrName) -> Column:
    """Exact sum of two-decimal doubles, as a decimal.

    Adds whole hundredths, which costs a fraction of casting every row to decimal; a sum
    too large for a long fails instead of wrapping.
    """
    cents = F.sum(hundredths(amount)).cast("decimal(20,0)")
    return (cents * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(20,2)")


def mean(value: ColumnOrName) -> Column:
    """Mean of a decimal as double: exact sum, one division."""
    return ratio(F.sum(col(value)), F.count(col(value)))


def top_k(frame: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows.  End the order with a unique column to make ties stable."""
    return frame.orderBy(*order).limit(k)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name of any number of frames."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def row_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, one row each."""
    return stack([
        frame.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, frame in tables.items()
    ])
