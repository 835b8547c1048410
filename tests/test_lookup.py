import random

import pytest
from pyspark.sql import functions as F

from tallystar.operators import lookup
from tallystar.operators.calendar import month_calendar, within_calendar
from tests.conftest import tuples


@pytest.fixture(scope="module")
def dim(spark):
    frame = spark.createDataFrame([(1, "red"), (2, "blue")], "key int, label string")
    return lookup.with_unknown(frame, {"key": -1, "label": "Unknown"})


def test_unknown_member_is_seeded(dim):
    assert tuples(dim) == [(-1, "Unknown"), (1, "red"), (2, "blue")]


def test_lookup_keeps_every_fact(spark, dim):
    facts = spark.createDataFrame(
        [("red", 1), ("green", 2), (None, 3), ("blue", 4), ("red", 5)], "colour string, n int"
    )
    keyed = lookup.lookup_key(facts, dim, "colour", "label", "key")
    assert tuples(keyed, "n", "key") == [(1, 1), (2, -1), (3, -1), (4, 2), (5, 1)]


def test_constant_key(spark, dim):
    row = spark.range(1).select(
        lookup.constant_key(dim, "blue", "label", "key").alias("known"),
        lookup.constant_key(dim, "green", "label", "key").alias("unknown"),
    ).first()
    assert tuple(row) == (2, -1)


def test_literal_frames_have_a_known_size(spark, dim, capsys):
    dim.explain()
    assert "ExistingRDD" not in capsys.readouterr().out.split("Union")[-1].split("\n")[1]


@pytest.mark.parametrize("n", [1, 17, 5000])
def test_surrogate_keys_follow_the_order_without_gaps(spark, n):
    labels = [f"label {i:05d}" for i in range(n)]
    shuffled = random.Random(n).sample(labels, n)
    frame = spark.createDataFrame([(x, len(x) % 2) for x in shuffled], "label string, o int")
    keyed = lookup.surrogate_key(frame.repartition(8), "key", ["o", "label"])
    ranked = sorted(((len(x) % 2, x) for x in labels))
    assert sorted((r["key"], r["label"]) for r in keyed.collect()) == [
        (i, label) for i, (_, label) in enumerate(ranked, start=1)
    ]


def test_surrogate_keys_of_nothing(spark):
    frame = spark.createDataFrame([], "label string")
    assert lookup.surrogate_key(frame, "key", ["label"]).count() == 0


def test_distinct_labels_skip_blanks(spark):
    one = spark.createDataFrame([("x",), ("",), (None,)], "`Type of unit` string")
    two = spark.createDataFrame([("x",), ("y",)], "GEO string")
    found = lookup.distinct_labels([(one, "Type of unit"), (two, "GEO")], "label")
    assert tuples(found) == [("x",), ("y",)]


def test_a_repeated_label_stops_the_build(spark, dim):
    assert lookup.require_unique_label(dim, "label") is dim
    with pytest.raises(ValueError, match="red"):
        lookup.require_unique_label(dim.union(dim.filter("label = 'red'")), "label")


def test_unclassified_leaves_out_the_seed(spark):
    frame = spark.createDataFrame(
        [(-1, "Unknown"), (1, "CMA"), (2, "Unknown")], "key int, level string"
    )
    assert tuples(lookup.unclassified(frame, "level", "key"), "key") == [(2,)]


def test_calendar(spark):
    calendar = month_calendar(spark, "1999-11", "2000-02")
    assert tuples(calendar, "date_key", "year_month", "month_name", "quarter_name") == [
        (19991101, "1999-11", "November", "1999 Q4"),
        (19991201, "1999-12", "December", "1999 Q4"),
        (20000101, "2000-01", "January", "2000 Q1"),
        (20000201, "2000-02", "February", "2000 Q1"),
    ]
    facts = spark.createDataFrame([(19991001,), (19991101,), (20000301,)], "date_key int")
    assert tuples(within_calendar(facts, calendar)) == [(19991101,)]
    assert within_calendar(facts, calendar).select(F.count("*")).first()[0] == 1
