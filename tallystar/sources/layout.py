"""Stored order on several keys at once.

A fact sorted by month holds every place in every file, so a filter on a place reads all
of them.  Here the ranks of several keys are interleaved bit by bit, highest bits first: a
stretch of the resulting order is a box, narrow in each key, and the least and greatest
values that Parquet keeps per file and row group then serve a filter on any of the keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A rank has at most so many bits: 256 parts of equal row counts per key.
RANK_BITS = 8
#: Bits of an order value, which is a non-negative long.
ORDER_BITS = 63
#: Sampling error of the bounds, as a share of one part.
_ACCURACY = 16


def rank_bounds(
    frame: DataFrame, keys: Sequence[str], bits: int = RANK_BITS
) -> tuple[int, dict[str, list[int]]]:
    """Row count, and per key rising values that split all rows into parts of equal count.

    One aggregate with map-side combine; what reaches the driver is at most
    ``2 ** bits - 1`` numbers per key, however large the table.  A value that holds many
    rows is named once, so a key of few values gets one part per value.  Keys that are
    null everywhere, and all keys of an empty table, have no bounds.
    """
    if len(keys) * bits > ORDER_BITS:
        raise ValueError(f"{len(keys)} keys of {bits} bits do not fit in {ORDER_BITS}")
    parts = 2 ** bits
    shares = [n / parts for n in range(1, parts)]
    rows, *found = frame.agg(F.count(F.lit(1)), *[
        F.percentile_approx(F.col(key).cast("bigint"), shares, _ACCURACY * parts)
        for key in keys
    ]).first()
    return rows, {key: sorted(set(cut or ())) for key, cut in zip(keys, found, strict=True)}


def rank_among(value: Column, bounds: Sequence[int]) -> Column:
    """Number of bounds below ``value``, by halving; 0 for null."""
    if not bounds:
        return F.lit(0)
    known = F.array(*[F.lit(bound).cast("bigint") for bound in bounds])
    steps = F.array(*[F.lit(2 ** n) for n in reversed(range(len(bounds).bit_length()))])
    wanted = value.cast("bigint")
    return F.aggregate(
        steps, F.lit(0),
        lambda rank, step: F.when(F.get(known, rank + step - 1) < wanted, rank + step).otherwise(rank),
    )


def interleaved(ranks: Sequence[tuple[str, int]]) -> Column:
    """One long from ``(column, bits)`` ranks, taking the highest bit of each in turn.

    A rank of fewer bits runs out earlier, so that every key is halved equally often as
    long as it can be.
    """
    deepest = max((bits for _, bits in ranks), default=0)
    picks = [
        (name, bits - 1 - level)
        for level in range(deepest) for name, bits in ranks if level < bits
    ]
    order = F.lit(0).cast("bigint")
    for place, (name, bit) in enumerate(reversed(picks)):
        one = F.shiftright(F.col(name).cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
        order = order.bitwiseOR(F.shiftleft(one, place))
    return order


def with_box_order(
    frame: DataFrame, values: Mapping[str, Column], bounds: Mapping[str, Sequence[int]], name: str
) -> DataFrame:
    """``frame`` with the interleaved order of ``values`` as column ``name``."""
    ranked = {f"_rank{n}": (key, rank_among(value, bounds[key]))
              for n, (key, value) in enumerate(values.items())}
    out = frame.withColumns({rank: column for rank, (_, column) in ranked.items()})
    order = interleaved([(rank, len(bounds[key]).bit_length()) for rank, (key, _) in ranked.items()])
    return out.withColumn(name, order).drop(*ranked)
