import pytest
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.operators import reconcile
from tests.conftest import tuples


def compared(spark, *rows):
    return spark.createDataFrame(
        list(rows), "check_name string, detail string, our_value double, published_value double"
    )


@pytest.mark.parametrize("kind, ours, published, passes", [
    ("percent", 101.0, 100.0, True),
    ("percent", 101.01, 100.0, False),
    ("percent", 99.0, 100.0, True),
    ("percent", -99.0, -100.0, True),
    ("percent", 5.0, 0.0, False),
    ("percent", None, 100.0, False),
    ("points", 0.5, 0.515625, True),
    ("points", 0.5, 0.53125, False),
    ("points", 0.5, None, False),
])
def test_tolerances(spark, kind, ours, published, passes):
    scored = reconcile.score(compared(spark, ("c", "d", ours, published)), kind)
    assert scored.first()["close_enough"] is passes


def test_unknown_kind(spark):
    with pytest.raises(ValueError, match="kind"):
        reconcile.score(compared(spark, ("c", "d", 1.0, 1.0)), "ratio")


@pytest.fixture(scope="module")
def results(spark):
    rows = compared(
        spark,
        ("a", "ok", 100.0, 100.0), ("a", "excused", 150.0, 100.0), ("b", "ok", 1.0, 1.0),
        *[("b", f"bad {i}", 2.0 + i, 1.0) for i in range(7)],
        ("b", "excused", 9.0, 1.0),
    )
    return reconcile.verdict(reconcile.score(rows, "percent"), [("a", "excused")])


def test_exceptions_apply_to_their_own_check_only(results):
    passed = dict(tuples(results.filter("detail = 'excused'"), "check_name", "passed"))
    assert passed == {"a": True, "b": False}


def test_rollup(results):
    assert tuples(
        reconcile.rollup(results), "check_name", "comparisons", "worst_gap", "matched",
        "known_problems", "failures", "matched_percent",
    ) == [("a", 2, 50.0, 1, 1, 0, 50.0), ("b", 9, 800.0, 1, 0, 8, 100 / 9)]


def test_first_failures_per_check(results):
    shown = tuples(reconcile.first_failures(results), "check_name", "nth", "detail")
    assert shown == [("b", i + 1, f"bad {i}") for i in range(5)]


def test_first_failures_are_cut_before_the_shuffle(results, capsys):
    reconcile.first_failures(results).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_gate(spark, results):
    assert reconcile.gate(results.filter("check_name = 'a'"), ["a"]) == []
    assert reconcile.gate(results, ["a", "b"]) == ["b: 8 of 9 failed"]
    # A check that compared nothing fails as well.
    assert reconcile.gate(results.filter("check_name = 'a'"), ["a", "c"]) == [
        "c: compared nothing"
    ]


def test_pair_totals_needs_a_positive_published_total(spark):
    parts = spark.createDataFrame([(1, 5), (2, 7), (3, 9)], "k int, total int")
    published = spark.createDataFrame([(1, 5), (2, 0), (3, None)], "k int, total int")
    paired = reconcile.pair_totals(parts, published, ["k"])
    assert tuples(paired, "k", "our_value", "published_value") == [(1, 5, 5)]


def test_side_by_side_totals_equal_joined_ones(spark):
    rows = spark.createDataFrame(
        [(1, "p", 2), (1, "p", 3), (1, "t", 5), (2, "p", 7), (3, "t", 9), (4, "t", 0),
         (4, "p", 1), (5, "p", None), (5, "t", 4), (6, "x", 1)],
        "k int, kind string, v int",
    )
    part, total = F.col("kind") == "p", F.col("kind") == "t"

    def summed(condition):
        return rows.filter(condition).groupBy("k").agg(F.sum("v").alias("total"))

    joined = reconcile.pair_totals(summed(part), summed(total), ["k"])
    beside = reconcile.totals_side_by_side(rows, ["k"], "v", part, total)
    columns = ("k", "our_value", "published_value")
    assert tuples(beside, *columns) == tuples(joined, *columns) == [(1, 5, 5), (5, None, 4)]


def test_completeness_allows_no_gap(spark):
    def passes(*keys):
        fact = spark.createDataFrame([(k,) for k in keys], "key int")
        row = reconcile.completeness(fact, ["key"], vocab.CHECK_COMPLETE, "fact")
        return reconcile.score(row, "percent", allowed=0.0).first()["close_enough"]

    assert passes(*range(1, 300))
    assert not passes(-1, *range(1, 300))


def test_a_pair_listed_twice_excuses_one_comparison(spark):
    rows = [("c", "x", 1.0, 3.0, 2.0, 0.01, "%", False), ("c", "y", 1.0, 1.0, 0.0, 0.01, "%", True)]
    scored = spark.createDataFrame(
        rows, "check_name string, detail string, our_value double, published_value double,"
        " difference double, allowed double, units string, close_enough boolean")
    judged = reconcile.verdict(scored, [("c", "x"), ("c", "x")])
    assert tuples(judged, "detail", "known_problem", "passed") == [("x", True, True), ("y", False, True)]
    lines = {(r["line"], r["check_name"]): r for r in reconcile.report(judged).collect()}
    assert lines["total", None]["comparisons"] == 2 and lines["total", None]["known_problems"] == 1
    assert lines["known problem", "c"]["gap"] == 2.0 and lines["check", "c"]["failures"] == 0
