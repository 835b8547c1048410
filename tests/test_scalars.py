from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystar.functions import scalars as s


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_month_keys(spark):
    assert one(spark, s.month_key_of_text(F.lit("2026-05"))) == 20260501
    assert one(spark, s.month_key_of_date(F.lit("2026-05-17").cast("date"))) == 20260501
    for key in (19900101, 19991201, 20000101):
        assert one(spark, s.month_of_index(s.month_index(F.lit(key)))) == key
    assert one(spark, s.month_index(F.lit(20000101)) - s.month_index(F.lit(19991201))) == 1


def test_a_malformed_month_fails_the_load(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, s.month_key_of_text(F.lit("May 2026")))


@pytest.mark.parametrize("cell, number, count", [
    ("1234.50", Decimal("1234.50"), 1235), ("", None, None), ("12F", None, None),
    ("..", None, None), (None, None, None), ("3.7", Decimal("3.70"), 4), ("0", Decimal("0.00"), 0),
])
def test_tolerant_cells(spark, cell, number, count):
    assert one(spark, s.decimal_cell(F.lit(cell).cast("string"))) == number
    assert one(spark, s.count_cell(F.lit(cell).cast("string"))) == count


def test_ratios_are_guarded(spark):
    assert one(spark, s.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, s.ratio(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(spark, s.ratio(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, s.percent(F.lit(1), F.lit(4))) == 25.0


def test_text(spark):
    assert one(spark, s.detail(F.lit("a"), F.lit("b"))) == "a / b"
    assert one(spark, s.detail(F.lit("a"), F.lit(None).cast("string"))) is None
    assert one(spark, s.thousands(F.lit(1234567.5))) == "1,234,568"
    assert one(spark, s.percent_text(F.lit(0.12345))) == "12.3%"
    assert one(spark, s.rounded(F.lit(2.345), 2)) == 2.35


def test_hundredths_are_exact(spark):
    assert one(spark, s.hundredths(F.lit(68423.46))) == 6842346
    assert one(spark, s.hundredths(F.lit(-0.07))) == -7
