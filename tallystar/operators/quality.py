"""Data-quality tests.  Each returns the offending rows or one row of evidence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.operators.aggregates import stack
from tallystar.operators.lookup import duplicate_keys
from tallystar.operators.timeseries import last_period_with_data
from tallystar.session import shared_dir
from tallystar.vocab import UNKNOWN_KEY

__all__ = [
    "broken_suppression", "duplicate_keys", "flow_vs_snapshot", "history_span",
    "is_non_empty", "member_count", "orphan_count", "orphans", "referential_integrity",
    "unknown_rows",
]


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Facts whose key is in no dimension row."""
    side = dim.select(F.col(dim_key or key).alias(key))
    return fact.join(side, key, "left_anti")


def orphan_count(
    fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None
) -> DataFrame:
    """Number of orphan rows, joining one row per distinct key instead of every fact."""
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return orphans(per_key, dim, key, dim_key).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows")
    )


#: Buckets of 32,768 keys, 4 kB each, that the bitmaps of all dimensions may have.
KEY_BUCKETS = 4096
_WORDS = 512  # longs per bucket


def key_bitmaps(members: Mapping[str, DataFrame]) -> DataFrame:
    """``(dim, bucket, words)``: the keys of each dimension as bits of longs.

    ``members`` holds one integer column per dimension.
    """
    keys = stack([
        frame.select(F.lit(dim).alias("dim"), F.col(frame.columns[0]).cast("bigint").alias("key"))
        for dim, frame in members.items()]).filter("key IS NOT NULL")
    word = "conv(hex(substring(bits, 8 * i + 1, 8)), 16, -10)"
    return keys.groupBy("dim", F.bitmap_bucket_number("key").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits")
    ).select("dim", "bucket", F.expr(
        f"transform(sequence(0, {_WORDS - 1}), i -> CAST({word} AS BIGINT))").alias("words"))


def _has_bit(words: Column, key: Column) -> Column:
    """Whether the key's bit is set in its bucket; false without a bucket."""
    place = F.bitmap_bit_position(key)
    # A word was read from bytes, so its first byte is the highest; bits count from the lowest.
    shift = (7 - F.floor(place % 64 / 8)) * 8 + place % 8
    bit = F.getbit(F.get(words, F.floor(place / 64).cast("int")), shift.cast("int"))
    return F.coalesce(bit == 1, F.lit(False))


def referential_integrity(
    tables: Mapping[str, DataFrame],
    edges: Sequence[tuple[str, str, str, str]],
    key_buckets: int = KEY_BUCKETS,
) -> DataFrame:
    """Orphans per edge ``(dim, dim key, fact, fact key)``; a missing key is one.

    Integer keys of dimensions become bitmaps, whose size is checked before they go to the
    facts: a row's keys are looked up where the row lies, all edges of a fact in one scan,
    and only counts are shuffled.  Keys of other types, or too many or too scattered for
    bitmaps, are counted and joined instead.
    """
    whole = ("tinyint", "smallint", "int", "bigint")
    sides = {(dim, key): tables[dim].select(key) for dim, key, _, _ in edges}
    plain = all(
        frame.schema[0].dataType.simpleString() in whole
        for frame in [*sides.values(), *(tables[fact].select(key) for _, _, fact, key in edges)])
    if not plain:
        return _counted_integrity(tables, edges)
    named = {f"{dim}.{key}": frame for (dim, key), frame in sides.items()}
    shared_dir(next(iter(tables.values())).sparkSession)
    bitmaps = key_bitmaps(named).checkpoint()
    if bitmaps.count() > key_buckets:
        return _counted_integrity(tables, edges)
    parts = []
    for fact in dict.fromkeys(edge[2] for edge in edges):
        own = [edge for edge in edges if edge[2] == fact]
        rows = tables[fact].select(*dict.fromkeys(key for _, _, _, key in own))
        missing = []
        for n, (dim, dim_key, _, key) in enumerate(own):
            bits = bitmaps.filter(F.col("dim") == f"{dim}.{dim_key}").select(
                F.col("bucket").alias(f"_bucket{n}"), F.col("words").alias(f"_words{n}"))
            rows = rows.join(
                F.broadcast(bits), F.bitmap_bucket_number(F.col(key).cast("bigint")) == F.col(f"_bucket{n}"), "left")
            missing.append(F.count_if(~_has_bit(F.col(f"_words{n}"), F.col(key).cast("bigint"))).alias(f"_edge{n}"))
        found = rows.agg(*missing)
        parts.append(found.select(F.inline(F.array(*[
            F.struct(F.lit(dim).alias("dim"), F.lit(fact).alias("fact"), F.lit(key).alias("key"),
                     F.col(f"_edge{n}").alias("orphan_rows"))
            for n, (dim, _, _, key) in enumerate(own)]))))
    return stack(parts)


def _counted_integrity(
    tables: Mapping[str, DataFrame], edges: Sequence[tuple[str, str, str, str]],
) -> DataFrame:
    """The same by counts: one row per edge and distinct key meets the dimensions."""
    parts = []
    for fact in dict.fromkeys(edge[2] for edge in edges):
        own = [(number, *edge) for number, edge in enumerate(edges) if edge[2] == fact]
        keys = F.array(*[
            F.struct(F.lit(n).alias("edge"), F.col(key).cast("string").alias("value"))
            for n, _, _, _, key in own])
        counted = tables[fact].select(F.inline(keys)).groupBy("edge", "value").agg(
            F.count(F.lit(1)).alias("_rows"))
        members = stack([
            tables[dim].select(F.lit(n).alias("edge"), F.col(dim_key).cast("string").alias("value"))
            for n, dim, dim_key, _, _ in own]).distinct().withColumn("_known", F.lit(True))
        names = F.array(*[
            F.struct(F.lit(n).alias("edge"), F.lit(dim).alias("dim"), F.lit(fact).alias("fact"),
                     F.lit(key).alias("key"))
            for n, dim, _, _, key in own])
        orphaned = F.when(F.col("_known").isNull(), F.col("_rows"))
        found = counted.join(members, ["edge", "value"], "left").groupBy("edge").agg(
            F.sum(orphaned).alias("_orphans"))
        listed = tables[fact].sparkSession.range(1).select(F.inline(names))
        parts.append(listed.join(found, "edge", "left").select(
            "dim", "fact", "key", F.coalesce("_orphans", F.lit(0)).alias("orphan_rows")))
    return stack(parts)


def unknown_rows(fact: DataFrame, keys: Sequence[str], unknown: int = UNKNOWN_KEY) -> DataFrame:
    """Rows per key that landed on the Unknown member, all keys in one pass."""
    counts = fact.agg(
        *[F.count_if(F.col(k) == unknown).alias(k) for k in keys],
        F.count(F.lit(1)).alias("total_rows"),
    )
    return counts.unpivot(["total_rows"], list(keys), "key", "unknown_rows")


def member_count(dim: DataFrame, member: str, where: Column, expected: int) -> DataFrame:
    found = dim.filter(where & F.col(member).isNotNull()).agg(
        F.countDistinct(member).alias("members")
    )
    return found.withColumn("as_expected", F.col("members") == expected)


def broken_suppression(fact: DataFrame, flag: str, value: str) -> DataFrame:
    """Rows marked hidden that still carry a value."""
    return fact.filter(F.col(flag) & F.col(value).isNotNull())


def flow_vs_snapshot(
    fact: DataFrame, flow: str, snapshot: str, month: str = "date_key", factor: int = 10
) -> DataFrame:
    """Latest month's flow and snapshot; plausible if the snapshot dwarfs the flow."""
    latest = fact.filter(F.col(month) == last_period_with_data(fact, month=month))
    sums = latest.agg(F.sum(flow).alias("flow"), F.sum(snapshot).alias("snapshot"))
    plausible = (
        (F.col("flow") > 0) & (F.col("snapshot") > 0)
        & (F.col("snapshot") > F.col("flow") * factor)
    )
    return sums.withColumn("plausible", F.coalesce(plausible, F.lit(False)))


def history_span(fact: DataFrame, value: str, year: Column, at_least: int = 10) -> DataFrame:
    """Years between the first and the last published value."""
    span = fact.filter(F.col(value).isNotNull()).agg(
        F.min(year).alias("first_year"), F.max(year).alias("last_year")
    )
    years = F.col("last_year") - F.col("first_year")
    return span.withColumn("years", years).withColumn(
        "long_enough", F.coalesce(years >= at_least, F.lit(False))
    )


def is_non_empty(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Per frame, whether it holds a row; reads no further than the first."""
    return stack([
        frame.limit(1).agg((F.count(F.lit(1)) > 0).alias("non_empty")).select(
            F.lit(name).alias("name"), "non_empty"
        )
        for name, frame in frames.items()
    ])
