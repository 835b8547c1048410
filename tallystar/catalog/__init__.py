"""Named queries over the driver's tables, each with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(frame: DataFrame) -> DataFrame:
    """Types every engine prints alike: decimals as double, dates as text."""
    shown = []
    for field in frame.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, DateType):
            column = column.cast("string")
        shown.append(column.alias(field.name))
    return frame.select(*shown)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL where SQL can express it."""

    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: comparable(run(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
