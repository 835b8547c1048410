"""Quality rules by robust multivariate outliers.

Every text is reduced in its row to a few counts; nothing but these is shuffled.  Per
language and source, and per language, the minimum-covariance-determinant estimate of
their transformed values is found by concentration steps: start from robust location and
scale, keep the share of documents nearest to the current centre, estimate again from
these, until the determinant stops falling.  The estimate of a language and source is
drawn towards its language's by a weight that falls as its rows grow.  Documents whose
Mahalanobis distance from the final estimate is too large are rejected.

A group's estimate is made of sums, so a source that holds a third of all rows costs one
partial sum per task.  The half-set is cut at a rank found from counts per distance bin,
which are bounded however large the group is.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.common import space_words, stored

MIN_WORDS = 50
MAX_REPEATED_SHARE = 50
COVERED = 0.75
#: Rows that a language's estimate counts for in a source's: as many as it has free numbers.
PRIOR_ROWS = 20
STEPS = 12
#: Chance that a regular document lies beyond the cut, were its vector normal.
TAIL = 1e-9
#: Least standard deviation that a dimension is given, in its transformed unit.
FLOORS = {"x_length": 0.3, "x_word": 0.1, "x_symbols": 0.08, "x_lines": 0.3, "x_repeat": 0.12}
DIMENSIONS = tuple(FLOORS)
BINS_PER_DOUBLING = 32
#: Splits of texts whose counts one task of a step reads; counts are some 5 % of a text.
SPLITS_PER_TASK = 16
#: Groups whose estimates are sent to the rows, some 200 bytes each; more are joined.
BROADCAST_GROUPS = 100_000


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Windows are hashed to 64 bits and sorted with their places; equal neighbours are
    repeats.  The places covered by repeats are then summed, in order, without overlap.
    """
    n = F.size(words)
    windows = F.transform(
        F.sequence(F.lit(1), n - 2),
        lambda i: F.struct(
            F.xxhash64(
                F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)
            ).alias("h"),
            i.alias("i")))
    return F.when(n >= 3, F.sort_array(windows))


def _covered(windows: Column) -> Column:
    """Places covered by windows of three that stand next to their equal."""
    last = F.size(windows) - 1
    hash_at = lambda k: windows[k]["h"]
    repeated = F.filter(windows, lambda w, k: (
        ((k > 0) & (hash_at(F.greatest(k - 1, F.lit(0))) == w["h"]))
        | ((k < last) & (hash_at(F.least(k + 1, last)) == w["h"]))))
    places = F.array_sort(F.transform(repeated, lambda w: w["i"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    total = F.aggregate(
        places, start,
        lambda so_far, i: F.struct(
            (so_far["n"] + (i + 3 - F.greatest(i, so_far["end"]))).alias("n"),
            (i + 3).alias("end")),
        lambda so_far: so_far["n"])
    return F.coalesce(total, F.lit(0).cast("long"))


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(
        F.split(F.col("body"), "\n"), lambda line: F.btrim(line, F.lit(" \t\x0b\f\r")) != "")
    rows = docs.select("doc_id", "lang", "source", text.alias("body"))
    # In steps, so that the words of a text are split once.
    split = rows.select(
        "doc_id", "lang", "source", space_words(F.col("body")).alias("words"),
        (F.length("body") - F.length(F.translate("body", " \t\n\x0b\f\r", ""))).alias("blanks"),
        F.length("body").alias("chars"),
        (F.length("body") - F.length(F.translate("body", "#*$%&|<>", ""))).alias("symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).alias("dup_lines"))
    sorted_windows = split.select(
        "doc_id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        (F.col("chars") - F.col("blanks")).cast("long").alias("word_chars"),
        F.col("symbols").cast("long").alias("n_symbols"),
        F.col("dup_lines").cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("windows"))
    return sorted_windows.withColumn("n_repeat_words", _covered(F.col("windows"))).drop("windows")


def _gathered(counts: DataFrame) -> DataFrame:
    """Stored counts in fewer, fuller partitions, without a shuffle.

    They come in one partition per split of texts, of which they are a small part, and the
    steps of the estimate would pay a task and a shuffle block for each, again and again.
    """
    session = counts.sparkSession
    last = counts.select(F.spark_partition_id().alias("split")).agg(F.max("split")).first()[0]
    splits = (last or 0) + 1
    return counts.coalesce(max(session.sparkContext.defaultParallelism, splits // SPLITS_PER_TASK))


def _transformed(counts: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return counts.select(
        "*",
        F.log1p("n_words").alias("x_length"),
        F.log1p(F.col("word_chars") / words).alias("x_word"),
        F.sqrt(F.col("n_symbols") / words).alias("x_symbols"),
        F.log1p("n_dup_lines").alias("x_lines"),
        F.sqrt(F.col("n_repeat_words") / words).alias("x_repeat"),
    )


def _moments(rows: DataFrame) -> DataFrame:
    """Mean and covariance per group, floors added, as arrays; covariance by columns of L.

    The Cholesky factor L and the log determinant come with it.
    """
    p = len(DIMENSIONS)
    x = [F.col(d) for d in DIMENSIONS]
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    sums = rows.groupBy("group").agg(
        F.count("*").alias("m"),
        *[F.avg(x[i]).alias(f"mu{i}") for i in range(p)],
        *[F.avg(x[i] * x[j]).alias(f"xx{i}{j}") for i, j in pairs])
    floors = list(FLOORS.values())

    def covariance(i: int, j: int) -> Column:
        value = F.col(f"xx{i}{j}") - F.col(f"mu{i}") * F.col(f"mu{j}")
        return F.greatest(value, F.lit(0.0)) + floors[i] ** 2 if i == j else value

    return _factored(sums, covariance)


def _factored(groups: DataFrame, covariance: Callable[[int, int], Column]) -> DataFrame:
    """The groups' means mu, Cholesky factor L of their covariance, and log determinant."""
    p = len(DIMENSIONS)
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    for i, j in pairs:
        value = covariance(i, j)
        for k in range(j):
            value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        entry = F.sqrt(F.greatest(value, F.lit(1e-12))) if i == j else value / F.col(f"l{j}{j}")
        groups = groups.withColumn(f"l{i}{j}", entry)
    determinant = sum((2 * F.log(f"l{i}{i}") for i in range(p)), F.lit(0.0))
    return groups.select(
        "group", determinant.alias("log_det"),
        *[f"mu{i}" for i in range(p)], *[f"l{i}{j}" for i, j in pairs])


def _drawn(estimate: DataFrame, parents: DataFrame, prior_rows: float) -> DataFrame:
    """Estimates drawn towards their parents' by ``prior_rows`` / (n + ``prior_rows``).

    ``parents`` has (group, parent, n); ``estimate`` holds groups and parents.
    """
    p = len(DIMENSIONS)
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    numbers = [*[f"mu{i}" for i in range(p)], *[f"l{i}{j}" for i, j in pairs]]
    own = estimate.select("group", F.struct(*numbers).alias("own"))
    parent = estimate.select(F.col("group").alias("parent"), F.struct(*numbers).alias("of_parent"))
    weight = F.col("n") / (F.col("n") + F.lit(float(prior_rows)))
    both = parents.join(own, "group").join(parent, "parent").withColumn("weight", weight)

    def mixed(a: Column, b: Column) -> Column:
        return F.col("weight") * a + (1 - F.col("weight")) * b

    def covariance(i: int, j: int) -> Column:
        entry = lambda side: sum(
            (F.col(f"{side}.l{i}{k}") * F.col(f"{side}.l{j}{k}") for k in range(j + 1)), F.lit(0.0))
        return mixed(entry("own"), entry("of_parent"))

    for i in range(p):
        both = both.withColumn(f"mu{i}", mixed(F.col(f"own.mu{i}"), F.col(f"of_parent.mu{i}")))
    return _factored(both, covariance)


def _distance() -> Column:
    """Squared Mahalanobis distance, by forward substitution."""
    z: list[Column] = []
    for i, name in enumerate(DIMENSIONS):
        value = F.col(name) - F.col(f"mu{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * z[k]
        z.append(value / F.col(f"l{i}{i}"))
    return sum((v * v for v in z), F.lit(0.0))


def _bin(distance: Column) -> Column:
    return F.floor(F.log2(F.greatest(distance, F.lit(1e-9))) * BINS_PER_DOUBLING).cast("int")


def _few(groups: DataFrame) -> bool:
    """Whether the groups of a stored frame are few enough to be broadcast."""
    return groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS


def _beside(rows: DataFrame, groups: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """Rows with the numbers of their group, where they lie if the groups are few."""
    return rows.join(F.broadcast(groups) if few else groups, "group", how)


def _nearest(rows: DataFrame, estimate: DataFrame, covered: float, few: bool) -> DataFrame:
    """The rows nearest to their group's centre: whole bins, until the share is covered."""
    measured = _beside(rows, estimate, few).withColumn("bin", _bin(_distance()))
    bins = measured.groupBy("group", "bin").agg(F.count("*").alias("n"))
    of_group = Window.partitionBy("group")
    upto = F.sum("n").over(of_group.orderBy("bin"))
    reached = F.when(upto >= F.ceil(F.sum("n").over(of_group) * covered), F.col("bin"))
    cut = bins.withColumn("reached", reached).groupBy("group").agg(F.min("reached").alias("cut"))
    return _beside(measured, cut, few).where("bin <= cut").select("group", *DIMENSIONS)


def _chi2(p: int, x: float) -> float:
    """Chi-square distribution function, by the series of the incomplete gamma function."""
    a, half = p / 2, x / 2
    if half > a + 40:
        # Upper tail by continued fraction.
        b, c = half + 1 - a, 1e300
        d = 1 / b
        h = d
        for i in range(1, 500):
            an = -i * (i - a)
            b += 2
            d = 1 / (an * d + b)
            c = b + an / c
            h *= d * c
        return 1 - math.exp(-half + a * math.log(half) - math.lgamma(a)) * h
    term = total = 1 / a
    n = a
    while term > total * 1e-17:
        n += 1
        term *= half / n
        total += term
    return total * math.exp(-half + a * math.log(half) - math.lgamma(a)) if half else 0.0


def chi2_quantile(p: int, q: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2(p, mid) < q else (low, mid)
    return high


def mcd(rows: DataFrame, covered: float = COVERED, steps: int = STEPS) -> DataFrame:
    """Minimum-covariance-determinant estimate per group.

    ``rows`` has ``group`` and the dimensions, and is read twice per step, so it must come
    from a stored table.  The start leaves the outer quarters of every dimension out.  Each step can
    only lower the determinants; the driver sees their sum.
    """
    quarters = stored(rows.groupBy("group").agg(*[
        F.percentile_approx(d, [0.25, 0.5, 0.75], 1000).alias(f"q_{d}") for d in DIMENSIONS]))
    few = _few(quarters)
    near = F.lit(True)
    for d, floor in FLOORS.items():
        spread = F.greatest(F.col(f"q_{d}")[2] - F.col(f"q_{d}")[0], F.lit(2 * floor))
        near = near & (F.abs(F.col(d) - F.col(f"q_{d}")[1]) <= spread)
    first = stored(_moments(_beside(rows, quarters, few).where(near)))
    # A group whose middle is empty starts from all of its rows.
    missing = _moments(_beside(rows, first.select("group"), few, "left_anti"))
    estimate = stored(first.unionByName(missing))
    total = estimate.agg(F.sum("log_det")).first()[0]
    for _ in range(steps):
        better = stored(_moments(_nearest(rows, estimate, covered, few)))
        now = better.agg(F.sum("log_det")).first()[0]
        if total is None or now > total - 1e-9:
            break
        estimate, total = better, now
    return estimate


def assess(
    docs: DataFrame,
    covered: float = COVERED,
    prior_rows: float = PRIOR_ROWS,
    tail: float = TAIL,
    min_words: int = MIN_WORDS,
    max_repeated_share: int = MAX_REPEATED_SHARE,
) -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed, kept, and the distance.

    ``base_failed``: under ``min_words`` words, or more than ``max_repeated_share`` per
    cent of them repeated.  ``kept``: not failed, and within the cut of its group.

    Groups are language and source; the estimate of n rows weighs n, its language's
    ``prior_rows``.  Null language or source is a value of its own.  A null text has no words
    and fails.  Repeated rows count as often as they stand.  Distances are scaled so
    that, were the vectors normal, ``tail`` of the regular ones would lie beyond.
    """
    named = {
        "own": F.to_json(F.struct("lang", "source"), {"ignoreNullFields": "false"}),
        "parent": F.to_json(F.struct("lang"), {"ignoreNullFields": "false"}),
    }
    counts = _gathered(stored(_transformed(text_counts(docs)).withColumns(named)))
    grouped = counts.withColumn("group", F.col("own"))
    twice = counts.select(F.explode(F.array("own", "parent")).alias("group"), *DIMENSIONS)
    parents = counts.groupBy(F.col("own").alias("group"), "parent").agg(F.count("*").alias("n"))
    estimate = stored(_drawn(mcd(twice, covered), parents, prior_rows))
    p = len(DIMENSIONS)
    # The covered part understates the scatter by a known factor.
    scale = covered / _chi2(p + 2, chi2_quantile(p, covered))
    distance = F.coalesce(_distance() / F.lit(scale), F.lit(0.0))
    failed = (F.col("n_words") < min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeated_share)
    return _beside(grouped, estimate, _few(estimate), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (distance <= chi2_quantile(p, 1 - tail))).alias("kept"),
        distance.alias("distance"))
