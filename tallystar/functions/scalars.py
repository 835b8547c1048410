"""Scalar expressions: month keys, tolerant casts, guarded ratios, text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def month_key_of_text(ref_date: ColumnOrName) -> Column:
    """``'2026-05'`` -> ``20260501``.  A malformed month fails the load."""
    return F.concat(F.replace(col(ref_date), F.lit("-"), F.lit("")), F.lit("01")).cast("int")


def month_key_of_date(date: ColumnOrName) -> Column:
    return (F.year(col(date)) * 10000 + F.month(col(date)) * 100 + 1).cast("int")


def month_start(timestamp: ColumnOrName) -> Column:
    return F.trunc(col(timestamp).cast("date"), "month")


def month_index(date_key: ColumnOrName) -> Column:
    """Months since year 0, so that calendar distance is plain subtraction."""
    key = col(date_key)
    year = F.floor(key / 10000)
    month = F.floor(key / 100) % 100
    return (year * 12 + month - 1).cast("int")


def month_of_index(index: ColumnOrName) -> Column:
    """Inverse of :func:`month_index`."""
    i = col(index)
    return (F.floor(i / 12) * 10000 + (i % 12 + 1) * 100 + 1).cast("int")


def year_of_key(date_key: ColumnOrName) -> Column:
    return F.floor(col(date_key) / 10000).cast("int")


def month_of_key(date_key: ColumnOrName) -> Column:
    return (F.floor(col(date_key) / 100) % 100).cast("int")


def decimal_cell(cell: ColumnOrName, kind: str = "decimal(18,2)") -> Column:
    """Text cell to number; blanks and footnote letters mean "not published".

    A number too large for ``kind`` is an error, not an unpublished one.
    """
    number = col(cell).try_cast(kind)
    too_large = number.isNull() & col(cell).rlike(r"^\s*[+-]?[0-9]+(\.[0-9]*)?\s*$")
    return F.when(
        too_large, F.raise_error(F.concat(F.lit(f"number beyond {kind}: "), col(cell)))
    ).otherwise(number)


def count_cell(cell: ColumnOrName) -> Column:
    """Text cell to a whole count; ``'3.7'`` rounds to 4 instead of being lost."""
    return F.round(col(cell).try_cast("decimal(38,6)"), 0).try_cast("bigint")


def hundredths(amount: ColumnOrName) -> Column:
    """A two-decimal double as a whole number of hundredths, for cheap exact sums."""
    return F.rint(col(amount) * 100).cast("bigint")


def or_unknown(key: ColumnOrName, unknown: int = -1) -> Column:
    return F.coalesce(col(key), F.lit(unknown))


def ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Double division; NULL when the denominator is zero or missing."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def percent(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    return F.try_divide(
        F.lit(100.0) * col(numerator).cast("double"), col(denominator).cast("double")
    )


def detail(*parts: ColumnOrName) -> Column:
    """``a / b / c``; NULL if any part is, so a broken label cannot hide."""
    joined = [col(parts[0])]
    for part in parts[1:]:
        joined += [F.lit(" / "), col(part)]
    return F.concat(*joined)


def thousands(value: ColumnOrName) -> Column:
    """Whole number with separators, rounding half away from zero."""
    return F.format_number(F.round(col(value).cast("decimal(38,6)"), 0), 0)


def percent_text(share: ColumnOrName, places: int = 1) -> Column:
    """``0.1234`` -> ``12.3%``."""
    scaled = F.round((col(share).cast("double") * 100).cast("decimal(30,10)"), places)
    return F.concat(scaled.cast(f"decimal(30,{places})").cast("string"), F.lit("%"))


def rounded(value: ColumnOrName, places: int) -> Column:
    """Rounded for display.  Rounds the decimal value, so it is exact at ties."""
    return F.round(col(value).cast("decimal(38,10)"), places).cast("double")
