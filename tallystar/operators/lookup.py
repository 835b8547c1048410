"""Dimension keys: numbering members, seeding Unknown, resolving labels."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallystar.functions.scalars import ColumnOrName, col, or_unknown
from tallystar.session import shared_dir
from tallystar.vocab import UNKNOWN_KEY

_ARROW = {
    "integer": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(),
}
_SLOT_BITS = 33  # monotonically_increasing_id keeps the partition number above bit 33


def distinct_labels(sources: Iterable[tuple[DataFrame, str]], name: str) -> DataFrame:
    """Every non-empty label found in ``(frame, column)`` pairs, once."""
    columns = [frame.select(F.col(f"`{column}`").alias(name)) for frame, column in sources]
    stacked = reduce(DataFrame.unionByName, columns)
    return stacked.filter(F.col(name) != "").distinct()


def surrogate_key(members: DataFrame, key: str, order_by: list[ColumnOrName]) -> DataFrame:
    """Number members 1..n in the given order, without gathering them in one task.

    A distributed sort gives every row a (partition, position) slot; the running
    total of partition sizes, one row per partition, turns slots into ranks.  The
    sorted rows are checkpointed because slots must not change between the two reads.
    """
    shared_dir(members.sparkSession)
    slotted = (
        members.orderBy(*order_by)
        .withColumn("_slot", F.monotonically_increasing_id())
        .checkpoint()
    )
    partition = F.shiftright("_slot", _SLOT_BITS)
    position = F.col("_slot").bitwiseAND((1 << _SLOT_BITS) - 1)
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slotted.groupBy(partition.alias("_partition"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    ranked = slotted.withColumn("_partition", partition).join(F.broadcast(offsets), "_partition")
    rank = (F.col("_before") + position + 1).cast("int").alias(key)
    return ranked.select(rank, *members.columns)


def literal_frame(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """Rows written in Python as a DataFrame whose size the planner knows.

    Built from an Arrow table: a plain list becomes a scan of unknown size, and joins
    with it would be shuffled.
    """
    nullable = StructType([StructField(f.name, f.dataType) for f in schema.fields])
    arrow = pa.Table.from_pylist(
        [dict(zip(nullable.names, row, strict=True)) for row in rows],
        schema=pa.schema([(f.name, _ARROW[f.dataType.typeName()]) for f in nullable.fields]),
    )
    return spark.createDataFrame(arrow, nullable)


def with_unknown(dim: DataFrame, unknown: dict) -> DataFrame:
    """Prepend the Unknown member, so unmatched facts have a row to point at."""
    row = tuple(map(unknown.get, dim.columns))
    return literal_frame(dim.sparkSession, [row], dim.schema).unionByName(dim)


def lookup_key(
    fact: DataFrame,
    dim: DataFrame,
    label: ColumnOrName,
    dim_label: str,
    key: str,
    unknown: int = UNKNOWN_KEY,
) -> DataFrame:
    """Attach ``key`` by label; facts with an unknown label get ``unknown``, none are lost."""
    side = dim.select(F.col(dim_label).alias("_label"), F.col(key).alias("_key"))
    joined = fact.join(side, col(label) == F.col("_label"), "left")
    return joined.withColumn(key, or_unknown("_key", unknown)).drop("_label", "_key")


def constant_key(dim: DataFrame, label: str, dim_label: str, key: str,
                 unknown: int = UNKNOWN_KEY) -> Column:
    """Key of one fixed label: a scalar subquery, since there is nothing to join on."""
    found = dim.filter(F.col(dim_label) == label).select(F.max(key))
    return or_unknown(found.scalar(), unknown)


def duplicate_keys(frame: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Key combinations that occur more than once, with their row count."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def require_unique_label(dim: DataFrame, label: str) -> DataFrame:
    """``dim`` itself; fails if a label repeats, since a lookup would then fan out."""
    repeated = duplicate_keys(dim, [label]).limit(5).collect()
    if repeated:
        names = ", ".join(str(row[label]) for row in repeated)
        raise ValueError(f"dimension label {label} is not unique: {names}")
    return dim


def unclassified(dim: DataFrame, level: str, key: str) -> DataFrame:
    """Members no classification rule claimed, leaving out the seeded one."""
    return dim.filter((F.col(level) == "Unknown") & (F.col(key) != UNKNOWN_KEY))


def pick(struct: Column, *names: str) -> list[Column]:
    """Fields of a struct column as top-level columns."""
    return [struct[name].alias(name) for name in names]
