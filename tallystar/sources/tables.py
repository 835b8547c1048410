"""Tables on shared storage: clustered writes, manifests, gated publication."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallystar.functions.scalars import year_of_key
from tallystar.sources.layout import rank_bounds, with_box_order

PUBLICATIONS = "publications"
#: Name under which a read fact shows the folder its rows lie in.
FOLDER = "stored_year"
_CONCURRENT_WRITES = 8


def at_once(tasks: Iterable[Callable]) -> list:
    """Run independent Spark actions side by side, so small ones do not queue."""
    with ThreadPoolExecutor(_CONCURRENT_WRITES) as pool:
        futures = [pool.submit(task) for task in tasks]
        return [future.result() for future in futures]


def conform(frame: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema``, in its order and types."""
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


#: Rows a file of a table stored in boxes has, about: few enough for narrow boxes.
ROWS_PER_FILE = 4_000_000
#: Digits of a sum of 64-bit hashes over any number of rows a table can have.
_DIGEST = "decimal(38,0)"


def row_digest(columns: Iterable[str]) -> Column:
    """Aggregate: a number that any changed, lost or repeated row changes, in any order.

    The sum of a hash per row.  Nulls are hashed as flags, since the hash itself skips them.
    """
    cells = [F.col(f"`{c}`") for c in columns]
    hashed = F.xxhash64(*cells, *[cell.isNull() for cell in cells])
    return F.coalesce(F.sum(hashed.cast("decimal(28,0)")), F.lit(0)).cast(_DIGEST).cast("string")


def write_table(
    frame: DataFrame,
    path: str,
    cluster: tuple[str, ...] = (),
    boxes: bool = False,
    rows_per_file: int = ROWS_PER_FILE,
) -> int:
    """Overwrite a table and return its row count, counted while writing.

    ``cluster`` names the key columns of a big fact, month first: rows are stored by year
    and sorted by them within each file.  The input is evaluated once: years are brought
    together by a rebalance, which splits a heavy one by size instead of sampling the
    input for ranges first.

    With ``boxes`` the files of a year cover narrow ranges of *every* cluster key, so that
    a filter on any of them leaves files out.  That takes two more passes over the key
    columns, for the bounds and for the ranges; the input should be a stored table.
    """
    return _written(frame, path, cluster, boxes, rows_per_file)[0]


def _written(
    frame: DataFrame, path: str, cluster: tuple[str, ...], boxes: bool = False,
    rows_per_file: int = ROWS_PER_FILE,
) -> tuple[int, str]:
    """Write as :func:`write_table` does; rows and digest, both taken while writing."""
    seen = Observation()
    laid_out = frame
    if cluster and boxes:
        laid_out = _in_boxes(frame, cluster, rows_per_file)
    elif cluster:
        laid_out = (
            frame.withColumn("year", year_of_key(cluster[0]))
            .hint("rebalance", "year")
            .sortWithinPartitions("year", *cluster)
        )
    observed = laid_out.observe(
        seen, F.count(F.lit(1)).alias("rows"), row_digest(frame.columns).alias("digest"))
    writer = observed.write.mode("overwrite")
    if cluster and boxes:
        # Ranges are drawn from a sample; only one that came out far too large is cut.
        writer = writer.option("maxRecordsPerFile", 2 * rows_per_file)
    (writer.partitionBy("year") if cluster else writer).parquet(path)
    return seen.get.get("rows", 0), seen.get.get("digest", "0")


def _in_boxes(frame: DataFrame, cluster: tuple[str, ...], rows_per_range: int) -> DataFrame:
    """Rows by year, and within a year by the interleaved ranks of all cluster keys.

    A folder holds one year, so months are ranked within theirs.  The number of ranges
    follows the number of rows.  Ranges end with a hash of the row, so that rows piled up
    on one key still go to many tasks.
    """
    month = F.col(cluster[0]) % 10000
    values = {cluster[0]: month, **{key: F.col(key) for key in cluster[1:]}}
    rows, bounds = rank_bounds(frame.select(*[v.alias(k) for k, v in values.items()]), list(values))
    ordered = with_box_order(
        frame.withColumn("year", year_of_key(cluster[0])), values, bounds, "_box")
    ranges = max(1, -(-rows // rows_per_range))
    return (
        ordered.repartitionByRange(ranges, "year", "_box", F.xxhash64(*frame.columns))
        .sortWithinPartitions("year", "_box")
        .drop("_box")
    )


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    first_month: int | None = None,
    last_month: int | None = None,
    folders: bool = False,
) -> DataFrame:
    """A stored table; month bounds prune year folders as well as row groups.

    With ``folders``, a table stored by year also shows it as ``stored_year``, so that a
    join with chosen months can prune folders at run time.
    """
    frame = spark.read.parquet(path)
    for bound, keep in ((first_month, "__ge__"), (last_month, "__le__")):
        if bound is not None:
            frame = frame.filter(getattr(F.col("date_key"), keep)(bound))
            if "year" in frame.columns and "year" not in schema.fieldNames():
                frame = frame.filter(getattr(F.col("year"), keep)(bound // 10000))
    by_year = folders and "year" in frame.columns and "year" not in schema.fieldNames()
    shown = [F.col("year").alias(FOLDER)] if by_year else []
    return frame.select(*schema.fieldNames(), *shown)


def within_months(fact: DataFrame, months: DataFrame) -> DataFrame:
    """Rows of the given months: a semi join that never reads the folders of other years.

    ``months`` has a ``date_key`` column and is broadcast: a row per month at most, however
    large the fact.  Where the fact shows its folders the join carries the year, which lets
    the scan leave out folders once the months are known.
    """
    keys = months.select("date_key").distinct()
    on = ["date_key"]
    if FOLDER in fact.columns:
        keys = keys.withColumn(FOLDER, year_of_key("date_key"))
        on.append(FOLDER)
    return fact.join(F.broadcast(keys), on, "left_semi")


def stored_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes per table folder; lists the files, without reading their content."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
    )
    below = F.substring_index("path", f"{folder}/", -1)
    return files.groupBy(F.substring_index(below, "/", 1).alias("table_name")).agg(
        F.sum("length").alias("n_bytes")
    )


def export_tables(
    tables: Mapping[str, DataFrame],
    target: str,
    cluster: Mapping[str, tuple[str, ...]] | None = None,
    boxes: bool = False,
) -> DataFrame:
    """Write each table to its own folder; returns the manifest: rows, digest and bytes.

    Tables stay separate: joining them into one flat table would lose shared filters.
    ``boxes`` stores tables of two or more cluster keys as :func:`write_table` says.
    """
    cluster = cluster or {}
    spark = next(iter(tables.values())).sparkSession

    def export(name: str) -> tuple[str, int, str]:
        keys = cluster.get(name, ())
        return name, *_written(tables[name], f"{target}/{name}", keys, boxes and len(keys) > 1)

    written = at_once([lambda name=name: export(name) for name in tables])
    counted = spark.createDataFrame(written, "table_name string, n_rows bigint, digest string")
    return counted.join(stored_bytes(spark, target), "table_name", "left")


def altered_tables(manifest: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Manifest rows whose table, as read now, has other rows: ``rows_now``, ``digest_now``.

    Row and byte counts can agree while values differ; the digest tells.  A table that the
    manifest names and ``tables`` lacks is altered too.
    """
    now = reduce(DataFrame.unionByName, [
        frame.agg(F.count(F.lit(1)).alias("rows_now"), row_digest(frame.columns).alias("digest_now"))
        .select(F.lit(name).alias("table_name"), "rows_now", "digest_now")
        for name, frame in tables.items()
    ])
    same = (F.col("n_rows") == F.col("rows_now")) & (F.col("digest") == F.col("digest_now"))
    return manifest.join(now, "table_name", "left").filter(~F.coalesce(same, F.lit(False)))


def manifest_totals(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.count(F.lit(1)).alias("n_tables"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_bytes").alias("n_bytes"),
    )


def publish(
    tables: Mapping[str, DataFrame],
    root: str,
    version: str,
    reasons: list[str],
    cluster: Mapping[str, tuple[str, ...]] | None = None,
    boxes: bool = False,
) -> DataFrame | None:
    """Export under ``root/version`` and announce it, unless there are reasons not to.

    Readers follow the latest announcement.  It is appended after the last table is
    complete, so a refused or broken run leaves the previous export in force.  A version
    that was announced is never written again: its readers may still be there.
    """
    if reasons:
        return None
    spark = next(iter(tables.values())).sparkSession
    log = _announcements(spark, root)
    if log is not None and not log.filter(F.col("version") == version).isEmpty():
        raise ValueError(f"version {version} is published already")
    manifest = export_tables(tables, f"{root}/{version}", cluster, boxes)
    announced = manifest.groupBy().agg(F.sum("n_rows").alias("n_rows")).select(
        F.lit(version).alias("version"), "n_rows", F.current_timestamp().alias("published_at")
    )
    announced.write.mode("append").parquet(f"{root}/{PUBLICATIONS}")
    return manifest


def current_version(spark: SparkSession, root: str) -> str | None:
    """Version announced last; None before the first publication."""
    log = _announcements(spark, root)
    if log is None:
        return None
    return log.agg(F.max_by("version", "published_at")).first()[0]


def _announcements(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{root}/{PUBLICATIONS}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
