"""Raw releases: all-text CSV files, and report pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallystar import vocab

ARREARS_COLUMNS = ("region", "month", "total_mortgages", "mortgages_in_arrears", "arrears_rate")


@dataclass(frozen=True)
class Release:
    """One published table: its number names the file, its name the folder."""

    pid: str
    name: str
    description: str = ""

    def path(self, raw_dir: str) -> str:
        return f"{raw_dir.rstrip('/')}/{self.name}/{self.pid}.csv"


REGISTRY = {name: Release(pid, name, text) for pid, name, text in vocab.RELEASES}


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column text.

    Number columns carry footnote letters, so conversion is left to tolerant casts.
    Files stay splittable: values with line breaks are not supported, and
    ``require_whole_lines`` refuses them.
    """
    return spark.read.csv(path, header=True, inferSchema=False, escape='"', encoding="UTF-8")


def broken_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, n)``: lines with an odd number of quotes, where a value has a line break."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.text(path).filter(quotes % 2 == 1).groupBy(
        F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))


def require_whole_lines(spark: SparkSession, paths: Sequence[str]) -> None:
    """Fail on CSV files in which a value spans lines, instead of reading it in pieces."""
    broken = broken_lines(spark, list(paths)).orderBy("file").limit(5).collect()
    if broken:
        named = ", ".join(f"{r['file']} ({r['n']} lines)" for r in broken)
        raise ValueError(f"values with line breaks are not supported: {named}")


def read_release(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    return read_text_csv(spark, REGISTRY[name].path(raw_dir))


def arrears_path(raw_dir: str) -> str:
    return f"{raw_dir.rstrip('/')}/arrears/arrears.csv"


def read_arrears(spark: SparkSession, raw_dir: str) -> DataFrame:
    schema = StructType([StructField(c, StringType()) for c in ARREARS_COLUMNS])
    return spark.read.csv(arrears_path(raw_dir), header=True, schema=schema, escape='"')


def read_all(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """Every release of the registry, and the arrears rows."""
    paths = [release.path(raw_dir) for release in REGISTRY.values()]
    require_whole_lines(spark, [*paths, arrears_path(raw_dir)])
    releases = {name: read_release(spark, raw_dir, name) for name in REGISTRY}
    return {**releases, "arrears": read_arrears(spark, raw_dir)}


def read_report_pages(spark: SparkSession, path: str) -> DataFrame:
    """Report text files to ``(doc_id, page_no, text)``; form feeds separate pages.

    Files are read page by page and may be split between tasks; pages are numbered from 0
    by their place in the file.  A split's rows stand in its task in order, so a page's
    number is that of its split's first page and the rows in between.  Only the counts of
    splits, a row each, are gathered and broadcast: text stays where it is read, and one
    huge file is as many tasks as it has splits.
    """
    pages = spark.read.text(path, lineSep="\f").select(
        F.col("_metadata.file_path").alias("doc_id"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        F.col("value").alias("text"),
    )
    earlier = Window.partitionBy("doc_id").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    splits = (
        pages.groupBy("doc_id", "_block")
        .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_pages"))
        .select("doc_id", "_block", (
            F.coalesce(F.sum("_pages").over(earlier), F.lit(0)) - F.col("_first")
        ).alias("_shift"))
    )
    return pages.join(F.broadcast(splits), ["doc_id", "_block"]).select(
        "doc_id", (F.col("_row") + F.col("_shift")).cast("int").alias("page_no"), "text")


def column_starting_with(frame: DataFrame, prefix: str) -> str | None:
    """First column with the prefix: the same column is titled differently per release."""
    return next((c for c in frame.columns if c.startswith(prefix)), None)


def with_column(releases: Mapping[str, DataFrame], name: str) -> list[tuple[DataFrame, str]]:
    """``(frame, column)`` of the releases that have the column at all."""
    return [(frame, name) for frame in releases.values() if name in frame.columns]


def with_prefix(releases: Mapping[str, DataFrame], prefix: str) -> list[tuple[DataFrame, str]]:
    found = [(frame, column_starting_with(frame, prefix)) for frame in releases.values()]
    return [(frame, column) for frame, column in found if column is not None]
