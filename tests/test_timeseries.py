import random

import pytest
from pyspark.sql import functions as F

from tallystar.operators import timeseries as ts
from tests.conftest import tuples


@pytest.fixture(scope="module")
def gappy(spark):
    """Series a has every month of 2000-2001 but 2000-06; b has two months."""
    rows = [
        ("a", year * 10000 + month * 100 + 1, 100 + month + 12 * (year - 2000))
        for year in (2000, 2001) for month in range(1, 13) if (year, month) != (2000, 6)
    ]
    rows += [("b", 20000101, 5), ("b", 20010101, 8)]
    return spark.createDataFrame(rows, "s string, date_key int, v int")


def at(frame, series, key, column):
    return frame.filter((F.col("s") == series) & (F.col("date_key") == key)).first()[column]


def test_rolling_modes_differ_over_a_gap(gappy):
    rolled = gappy.withColumns({
        "rows": ts.rolling_sum("v", ["s"], mode="rows"),
        "cal": ts.rolling_sum("v", ["s"]),
        "full": ts.rolling_sum("v", ["s"], require_full=True),
    })
    all_2000 = sum(100 + m for m in range(1, 13) if m != 6)
    assert at(rolled, "a", 20001201, "cal") == all_2000
    assert at(rolled, "a", 20010101, "cal") == all_2000 - 101 + 113
    # Twelve rows back from 2001-01 still includes 2000-01, thirteen months ago.
    assert at(rolled, "a", 20010101, "rows") == all_2000 + 113
    assert at(rolled, "a", 20001201, "full") is None
    assert at(rolled, "a", 20010601, "full") == sum(
        v for k, v in [(m, 100 + m) for m in range(7, 13)] + [(m, 112 + m) for m in range(1, 7)]
    )
    assert at(rolled, "b", 20010101, "cal") == 8
    assert at(rolled, "b", 20010101, "rows") == 13


def test_year_over_year_modes_differ_over_a_gap(gappy):
    cal = ts.year_over_year(gappy, "v", ["s"], "ly", "d", "p")
    rows = ts.year_over_year(gappy, "v", ["s"], "ly", "d", "p", mode="rows")
    assert at(cal, "a", 20010601, "ly") is None
    # Between 2001-05 and 2000-05 only eleven rows lie, so a row lag lands in 2000-04.
    assert at(cal, "a", 20010501, "ly") == 105
    assert at(rows, "a", 20010501, "ly") == 104
    assert at(cal, "b", 20010101, "d") == 3
    assert at(cal, "b", 20010101, "p") == 60.0
    assert at(rows, "b", 20010101, "ly") is None


def test_shift_months_crosses_gaps_and_years(spark):
    rates = spark.createDataFrame(
        [(19990101, 1.0), (20000701, 2.0), (20000801, 3.0)], "date_key int, r double"
    )
    shifted = ts.shift_months(rates, {"r": "r18"}, 18)
    assert tuples(shifted) == [
        (19990101, 1.0, None), (20000701, 2.0, 1.0), (20000801, 3.0, None)
    ]
    keyed = rates.withColumn("k", F.lit("x"))
    assert tuples(ts.shift_months(keyed, {"r": "r18"}, 18, keys=["k"]), "r18") == [
        (1.0,), (None,), (None,)
    ]
    unnamed = rates.withColumn("k", F.lit(None).cast("string"))
    assert tuples(ts.shift_months(unnamed, {"r": "r18"}, 18, keys=["k"]), "r18") == [
        (1.0,), (None,), (None,)
    ]


def test_mean_of_the_last_three_months(gappy):
    means = gappy.withColumn("m", ts.rolling_mean("v", ["s"]))
    assert at(means, "a", 20000701, "m") == (105 + 107) / 2
    assert at(means, "a", 20000401, "m") == (102 + 103 + 104) / 3


def test_windows_refuse_a_missing_key(spark):
    with pytest.raises(ValueError, match="series keys"):
        ts.rolling_sum("v", [])
    with pytest.raises(ValueError, match="mode"):
        ts.rolling_sum("v", ["s"], mode="weeks")


def test_semi_additive_uses_one_date_for_all(gappy):
    extra = gappy.filter("s = 'a' or date_key = 20000101")
    latest = ts.semi_additive_last(extra, "v", ["s"], "x")
    # b stopped earlier: it is NULL, not its own last value.
    assert tuples(latest) == [("a", 124), ("b", None)]
    yearly = ts.semi_additive_last(
        gappy.withColumn("y", F.floor(F.col("date_key") / 10000)), "v", ["s"], "x", periods=["y"]
    )
    assert tuples(yearly, "y", "s", "x") == [
        (2000, "a", 112), (2000, "b", None), (2001, "a", 124), (2001, "b", None)
    ]


def test_the_last_month_must_have_data(spark):
    rows = [("a", 20000101, 1), ("a", 20000201, 2), ("a", 20000301, None)]
    frame = spark.createDataFrame(rows, "s string, date_key int, v int")
    assert tuples(ts.semi_additive_last(frame, "v", ["s"], "x")) == [("a", 2)]


def test_latest_only(gappy):
    assert tuples(ts.latest_only(gappy)) == [("a", 20011201, 124)]


def test_share_of_movement(spark):
    rows = [(1, None, "p", 30.0), (1, None, "q", -10.0), (1, "x", "r", 0.0), (2, "x", "p", None)]
    frame = spark.createDataFrame(rows, "k int, g string, m string, d double")
    shared = ts.share_of_movement(frame, "d", ["k", "g"], "share")
    assert tuples(shared, "k", "m", "share") == [
        (1, "p", 75.0), (1, "q", -25.0), (1, "r", None), (2, "p", None)
    ]


@pytest.mark.parametrize("block", [1, 3, 7, 4096])
def test_forward_fill_matches_a_plain_loop(spark, block):
    rng = random.Random(block)
    rows, expected = [], []
    for key in ("hot", "cold", "empty", None):
        carried = None
        for position in sorted(rng.sample(range(200), 90 if key == "hot" else 9)):
            value = rng.randrange(100) if key != "empty" and rng.random() < 0.2 else None
            carried = value if value is not None else carried
            rows.append((key, position, value))
            expected.append((key, position, value, carried))
    frame = spark.createDataFrame(rows, "k string, pos int, v int")
    filled = ts.forward_fill(frame, "v", ["k"], "pos", "f", block=block)
    assert tuples(filled, "k", "pos", "v", "f") == sorted(expected, key=repr)


def test_first_per_key_keeps_the_first_row_whole(spark):
    rows = [("a", 2, None), ("a", 1, "x"), ("a", 3, "y"), ("b", 1, None)]
    frame = spark.createDataFrame(rows, "k string, o int, v string")
    assert tuples(ts.first_per_key(frame, ["k"], ["o"])) == [("a", 1, "x"), ("b", 1, None)]
