"""URL filters: a temporal join of captures with a dated list.

A list is a log of dated entries: a host pattern is added to a category or removed from
it.  Each entry holds from its date until the next entry of its pattern and category,
which turns the log into validity intervals.  A capture is judged by the entries in force
when it was fetched, on its host and on every parent domain.

The as-of join is an equality join: time is cut into periods, an interval is repeated for
each period it touches and a capture falls into one, so (pattern, period) is the key and
the exact times are compared within it.  A host with a third of all captures is spread
over its periods, and Spark splits what is still skewed, as nothing but a join needs the
rows of a key together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD_SECONDS = 30 * 86_400
#: Fixed value: scheme, user and host of a URL.
HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """Lower-case host without a final dot; null if the URL has none."""
    host = F.rtrim(F.lower(F.regexp_extract(url, HOST_PATTERN, 1)), F.lit("."))
    return F.when(host != "", host)


def validity(entries: DataFrame) -> DataFrame:
    """Intervals in force: pattern, category, valid_from, valid_to (null: still in force).

    ``entries`` has pattern, category, listed_at (seconds) and action, "add" or "remove".
    Entries without a pattern, a time or a known action are no entries; a null category is
    a category.  At the same second a removal comes after an addition.  An addition of
    what is in force, or a removal of what is not, changes nothing.
    """
    log = Window.partitionBy("pattern", "category").orderBy("listed_at", "action")
    return (
        entries.where("pattern IS NOT NULL AND listed_at IS NOT NULL AND action IN ('add', 'remove')")
        .withColumn("valid_to", F.lead("listed_at").over(log))
        .where("action = 'add' AND (valid_to IS NULL OR valid_to > listed_at)")
        .select("pattern", "category", F.col("listed_at").alias("valid_from"), "valid_to")
    )


def as_of_matches(
    captures: DataFrame, intervals: DataFrame, period_seconds: int = PERIOD_SECONDS
) -> DataFrame:
    """Every (capture, interval in force at its time), for host and parent domains.

    ``captures`` has capture (any type), host and fetched_at (seconds).
    """
    ends = captures.agg(F.min("fetched_at"), F.max("fetched_at")).first()
    labels = F.split("host", r"\.")
    keyed = captures.select(
        "capture", "fetched_at",
        F.floor(F.col("fetched_at") / period_seconds).alias("period"),
        F.explode(F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))).alias("pattern"))
    # Only periods with captures matter: the first and last fetch bound the intervals.
    first, last = (F.lit(v).cast("long") for v in ends)
    within = intervals.where((F.col("valid_from") <= last) & (F.coalesce("valid_to", last + 1) > first))
    begin = F.greatest(F.col("valid_from"), first)
    end = F.least(F.coalesce("valid_to", last + 1), last + 1) - 1
    periods = within.withColumn("period", F.explode(F.sequence(
        F.floor(begin / period_seconds), F.floor(end / period_seconds))))
    return (
        keyed.join(periods, ["pattern", "period"])
        .where("fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to)")
        .select("capture", "pattern", "category", "valid_from", "valid_to"))


def evaluate(
    captures: DataFrame, entries: DataFrame, period_seconds: int = PERIOD_SECONDS
) -> DataFrame:
    """One row per capture: page_id, url, host, fetched_at, blocked, categories, matched.

    ``captures`` has page_id, url and fetched_at.  ``categories`` are those in force,
    sorted and comma-joined; ``matched`` is the longest pattern in force.  A null URL, one
    without a host, or a null time matches nothing.  Rows that repeat id, URL and time are
    one capture.  Other columns are not read.  Empty tables block nothing.
    """
    hosts = captures.select("page_id", "url", host_of(F.col("url")).alias("host"), "fetched_at")
    rows = hosts.withColumn("capture", F.struct("page_id", "url", "host", "fetched_at"))
    usable = rows.where("host IS NOT NULL AND fetched_at IS NOT NULL")
    found = as_of_matches(usable.select("capture", "host", "fetched_at"), validity(entries), period_seconds)
    length = F.length("pattern")
    every = rows.select("capture", F.lit(None).cast("string").alias("pattern"),
                        F.lit(None).cast("string").alias("category")).unionByName(
        found.select("capture", "pattern", "category"))
    judged = every.groupBy("capture").agg(
        F.count("pattern").alias("n"),
        F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"),
        F.max(F.when(F.col("pattern").isNotNull(), F.struct(length.alias("n"), "pattern")))["pattern"].alias("matched"))
    return judged.select("capture.*", (F.col("n") > 0).alias("blocked"), "categories", "matched")
