"""Distinct counts that merge: exact, and rolled up without the rows.

``countDistinct`` has to see all rows again for each level it is asked at, since counts of
parts cannot be added.  Bitmaps of keys can be merged: one pass leaves a bitmap per finest
group and bucket of 32,768 keys, and any coarser level is the union of these.

A bitmap takes 4 kB whether its bucket holds one key or all, so this pays where keys are
dense in their groups: users by day, places by month.  Keys are integers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WHOLE = ("tinyint", "smallint", "int", "bigint")


def distinct_states(frame: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """``(*by, bucket, bits)``: the keys of each group.  Null keys count as none.

    Bitmaps are built map-side: a group that holds a third of all rows costs one bitmap
    per bucket and task.
    """
    kind = frame.schema[key].dataType.simpleString()
    if kind not in _WHOLE:
        raise ValueError(f"keys must be integers, and {key} is {kind}")
    number = F.col(f"`{key}`").cast("bigint")
    # A group of null keys alone keeps an empty bitmap, so that it counts 0.
    bucket = F.coalesce(F.bitmap_bucket_number(number), F.lit(1).cast("bigint"))
    return frame.groupBy(*by, bucket.alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def rolled_up(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """States of coarser groups: ``by`` names some of the columns of ``states``, or none."""
    return states.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_count(states: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``(*by, name)``: distinct keys per group of ``by``; one row in all without any."""
    per_bucket = rolled_up(states, by).withColumn("_keys", F.bitmap_count("bits"))
    return per_bucket.groupBy(*by).agg(
        F.coalesce(F.sum("_keys"), F.lit(0).cast("bigint")).alias(name))
