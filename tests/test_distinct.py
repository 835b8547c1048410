"""Distinct counts from merged bitmaps equal those from the rows, at every level."""

import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tallystar.operators.distinct import distinct_count, distinct_states, rolled_up

LEVELS = [("month", "place"), ("month",), ("place",), ()]


@pytest.fixture(scope="module")
def rows(spark):
    """Place 1 holds a third of the rows; keys lie on both sides of bucket borders and of 0."""
    rng = random.Random(2)
    edges = [None, 0, 1, -1, -32768, -32769, 32767, 32768, 32769, 65536, 2**40, -(2**40)]
    return spark.createDataFrame(
        [(rng.randrange(4), rng.choice([1, 1, 2, 3, None]), rng.choice([*edges, rng.randrange(-99999, 99999)]))
         for _ in range(4000)] + [(9, 9, None)] * 3, "month int, place int, key bigint")


@pytest.mark.parametrize("by", LEVELS)
def test_every_level_equals_the_rows(rows, by):
    states = distinct_states(rows, "key", ["month", "place"])
    want = tuples(rows.groupBy(*by).agg(F.countDistinct("key")))
    assert tuples(distinct_count(states, by, "n"), *by, "n") == want
    # In two steps, too, and with the months dealt over two tables.
    halves = [distinct_states(rows.filter(f"month % 2 = {k}"), "key", ["month", "place"]) for k in (0, 1)]
    both = halves[0].unionByName(halves[1])
    assert tuples(distinct_count(rolled_up(both, by), by, "n"), *by, "n") == want


def test_edges(rows):
    empty = distinct_states(rows.limit(0), "key", ["month"])
    assert tuples(distinct_count(empty, ["month"], "n")) == []
    assert tuples(distinct_count(empty, [], "n")) == [(0,)]
    with pytest.raises(ValueError, match="integers"):
        distinct_states(rows.select(F.col("key").cast("string")), "key", [])
