"""One key holding a third of all rows must neither change results nor stay in one task."""

import random

import pytest
from pyspark.sql import functions as F

from tallystar.operators import lookup
from tallystar.operators import timeseries as ts
from tallystar.operators.reconcile import totals_side_by_side
from tests.conftest import tuples

FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def no_broadcast(spark):
    before = {key: spark.conf.get(key, None) for key in FORCED}
    for key, value in FORCED.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_hot_label_is_split_in_a_lookup(spark, no_broadcast, capsys):
    label = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), F.col("id") % 5000))
    facts = spark.range(0, 200_000, 1, 8).select(label.alias("label"), F.xxhash64("id").alias("v"))
    dim = spark.range(5000).select(
        (F.col("id") + 1).cast("int").alias("key"), F.concat(F.lit("l"), "id").alias("name")
    )
    keyed = lookup.lookup_key(facts, dim, "label", "name", "key")
    rows = keyed.collect()
    keyed.explain()
    assert len(rows) == 200_000
    assert sum(row["key"] == -1 for row in rows) == len(range(0, 200_000, 3))
    assert "skew=true" in capsys.readouterr().out


def test_operators_agree_with_plain_loops_when_one_series_dominates(spark, no_broadcast):
    rng = random.Random(11)
    months = [y * 10000 + m * 100 + 1 for y in range(1995, 2005) for m in range(1, 13)]
    series = {"hot": months, **{f"s{i}": rng.sample(months, 8) for i in range(30)}}
    values = {(s, k): rng.randrange(1, 100) for s, keys in series.items() for k in keys}
    frame = spark.createDataFrame(
        [(s, k, v) for (s, k), v in values.items()], "s string, date_key int, v int"
    )

    def index(key):
        return key // 10000 * 12 + key // 100 % 100 - 1

    def brute(s, key):
        mine = {index(k): v for (name, k), v in values.items() if name == s}
        i = index(key)
        return sum(mine.get(i - n, 0) for n in range(12)), mine.get(i - 12)

    computed = frame.withColumns({
        "year": ts.rolling_sum("v", ["s"]), "ago": ts.value_months_ago("v", ["s"]),
    })
    assert tuples(computed, "s", "date_key", "year", "ago") == sorted(
        ((s, k, *brute(s, k)) for s, k in values), key=repr
    )
    shared = ts.share_of_movement(frame, "v", ["date_key"], "share")
    total = {k: sum(v for (_, month), v in values.items() if month == k) for k in months}
    assert tuples(shared, "s", "date_key", "share") == sorted(
        ((s, k, 100.0 * v / total[k]) for (s, k), v in values.items()), key=repr
    )
    beside = totals_side_by_side(
        frame, ["date_key"], "v", F.col("s") != "hot", F.col("s") == "hot"
    )
    expected = [
        (k, total[k] - values["hot", k], values["hot", k])
        for k in months if total[k] > values["hot", k]
    ]
    assert tuples(beside, "date_key", "our_value", "published_value") == sorted(expected, key=repr)


def test_first_row_of_a_key_with_very_many_rows(spark):
    rows = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") < 99_990, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (-F.col("id")).alias("o"),
    )
    kept = dict(tuples(ts.first_per_key(rows, ["k"], ["o"])))
    assert len(kept) == 11 and kept["hot"] == -99_989
