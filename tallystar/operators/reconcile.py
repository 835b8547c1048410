"""Comparing what we computed with what the publisher printed.

A comparison is a row (check_name, detail, our_value, published_value).  Scoring
adds the gap and a verdict.  Details stay distributed, however many there are; only
the roll-up, one row per check, is ever small.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallystar import vocab
from tallystar.functions.scalars import ratio
from tallystar.operators.lookup import literal_frame

COMPARISON = ("check_name", "detail", "our_value", "published_value")


def pair_totals(
    parts: DataFrame, published: DataFrame, keys: Sequence[str], positive_only: bool = True
) -> DataFrame:
    """Join our totals to published ones on ``keys``; both carry column ``total``."""
    paired = parts.withColumnRenamed("total", "our_value").join(
        published.withColumnRenamed("total", "published_value"), list(keys)
    )
    return paired.filter("published_value > 0") if positive_only else paired


def totals_side_by_side(
    rows: DataFrame, keys: Sequence[str], value: str, is_part: Column, is_published: Column
) -> DataFrame:
    """Parts and published totals that sit in the same table, in one pass.

    Equals :func:`pair_totals` over two filtered sums, without scanning the table twice
    and without the join.
    """
    summed = rows.filter(is_part | is_published).groupBy(*keys).agg(
        F.sum(F.when(is_part, F.col(value))).alias("our_value"),
        F.sum(F.when(is_published, F.col(value))).alias("published_value"),
        F.count_if(is_part).alias("_parts"),
    )
    return summed.filter("published_value > 0 AND _parts > 0").drop("_parts")


def comparison(frame: DataFrame, check: str, detail: Column) -> DataFrame:
    return frame.select(
        F.lit(check).alias("check_name"),
        detail.alias("detail"),
        F.col("our_value").cast("double").alias("our_value"),
        F.col("published_value").cast("double").alias("published_value"),
    )


def completeness(
    fact: DataFrame, keys: Sequence[str], check: str, detail: str,
    unknown: int = vocab.UNKNOWN_KEY,
) -> DataFrame:
    """Rows whose keys are all known against all rows, as one comparison."""
    known = F.lit(True)
    for key in keys:
        known = known & (F.col(key) != unknown)
    counted = fact.agg(
        F.count_if(known).alias("our_value"), F.count(F.lit(1)).alias("published_value")
    )
    return comparison(counted, check, F.lit(detail))


def score(comparisons: DataFrame, kind: str, allowed: float | None = None) -> DataFrame:
    """Add difference, allowed, units and close_enough.

    ``percent`` measures the gap against the published number, ``points`` takes it as
    is: a percentage of a percentage says nothing.  A missing gap is a failure.
    """
    gap = F.abs(F.col("our_value") - F.col("published_value"))
    if kind == "percent":
        difference = ratio(F.lit(100.0) * gap, F.abs("published_value"))
        limit, units = vocab.MAX_PERCENT_GAP, "%"
    elif kind == "points":
        difference, limit, units = gap, vocab.MAX_POINT_GAP, "pp"
    else:
        raise ValueError(f"kind must be 'percent' or 'points', not {kind!r}")
    limit = limit if allowed is None else allowed
    return comparisons.select(
        *COMPARISON,
        difference.alias("difference"),
        F.lit(float(limit)).alias("allowed"),
        F.lit(units).alias("units"),
        F.coalesce(difference <= limit, F.lit(False)).alias("close_enough"),
    )


def verdict(scored: DataFrame, known: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """Add known_problem and passed; the allow-list is a literal, so it is broadcast."""
    schema = StructType([StructField(c, StringType(), False) for c in ("check_name", "detail")])
    listed = literal_frame(scored.sparkSession, list(dict.fromkeys(known)), schema)
    flagged = scored.join(
        F.broadcast(listed.withColumn("_listed", F.lit(True))), ["check_name", "detail"], "left"
    )
    known_problem = F.coalesce("_listed", F.lit(False))
    return flagged.select(
        *scored.columns,
        known_problem.alias("known_problem"),
        (F.col("close_enough") | known_problem).alias("passed"),
    )


def rollup(results: DataFrame) -> DataFrame:
    """One row per check: comparisons, worst gap, matched, known and real failures."""
    missed = ~F.col("close_enough")
    return (
        results.groupBy("check_name")
        .agg(
            F.count(F.lit(1)).alias("comparisons"),
            F.max("difference").alias("worst_gap"),
            F.count_if(F.col("close_enough")).alias("matched"),
            F.count_if(missed & F.col("known_problem")).alias("known_problems"),
            F.count_if(missed & ~F.col("known_problem")).alias("failures"),
        )
        .withColumn("matched_percent", ratio(F.lit(100.0) * F.col("matched"), "comparisons"))
    )


def report(results: DataFrame) -> DataFrame:
    """What a reader of the checks wants: a line per check, each known problem with its
    gap, and the grand total over all comparisons."""
    counts = ("comparisons", "matched", "known_problems", "failures")
    per_check = rollup(results)
    line = lambda kind, name, detail, gap, *numbers, share: [
        F.lit(kind).alias("line"), name.alias("check_name"), detail.alias("detail"),
        *[n.alias(c) for c, n in zip(counts, numbers)],
        share.alias("matched_percent"), gap.alias("gap")]
    nothing, no_count = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    no_share = F.lit(None).cast("double")
    checks = per_check.select(*line(
        "check", F.col("check_name"), nothing, F.col("worst_gap"), *[F.col(c) for c in counts],
        share=F.col("matched_percent")))
    total = per_check.agg(
        *[F.sum(c).alias(c) for c in counts], F.max("worst_gap").alias("worst_gap")
    ).select(*line(
        "total", nothing, nothing, F.col("worst_gap"), *[F.col(c) for c in counts],
        share=ratio(F.lit(100.0) * F.col("matched"), "comparisons")))
    known = results.filter(~F.col("close_enough") & F.col("known_problem")).select(*line(
        "known problem", F.col("check_name"), F.col("detail"), F.col("difference"),
        *[no_count] * len(counts), share=no_share))
    return checks.unionByName(total).unionByName(known)


def first_failures(results: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` real failures of each check, by detail.

    Spark cuts each map task's rows to the first ``n`` before shuffling.
    """
    real = results.filter(~F.col("close_enough") & ~F.col("known_problem"))
    order = Window.partitionBy("check_name").orderBy("detail", "our_value")
    return real.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= n)


def gate(results: DataFrame, expected_checks: Iterable[str]) -> list[str]:
    """Reasons not to publish; empty when everything that should pass did.

    An expected check that compared nothing is a reason, not a warning.
    """
    summary = {row["check_name"]: row for row in rollup(results).collect()}
    reasons = [f"{check}: compared nothing" for check in expected_checks if check not in summary]
    reasons += [
        f"{check}: {row['failures']} of {row['comparisons']} failed"
        for check, row in sorted(summary.items())
        if row["failures"]
    ]
    return reasons
