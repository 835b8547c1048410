"""Build, check, publish: the monthly run as a whole.

Every run is a full rebuild, because publishers revise old months.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.operators.aggregates import row_totals
from tallystar.operators.lookup import require_unique_label, unclassified
from tallystar.operators.reconcile import gate
from tallystar.operators.report_text import arrears_release, extract_records
from tallystar.plans.checks import EXPECTED, all_checks, to_stored
from tallystar.plans.dims import all_dims
from tallystar.plans.facts import all_facts
from tallystar.plans.views import all_views
from tallystar.schemas import (
    CHECK_RESULTS,
    DIMENSIONS,
    FACTS,
    GRAIN,
    LABEL,
)
from tallystar.sources import tables
from tallystar.sources.releases import read_all, read_report_pages

Star = dict[str, DataFrame]


def stage(releases: Mapping[str, DataFrame], workdir: str) -> Star:
    """Parse each release once; labels, headers and loads then read columns of Parquet."""
    spark = next(iter(releases.values())).sparkSession

    def keep(name: str) -> tuple[str, DataFrame]:
        path = f"{workdir}/staged/{name}"
        releases[name].write.mode("overwrite").parquet(path)
        return name, spark.read.parquet(path)

    return dict(tables.at_once([lambda name=name: keep(name) for name in releases]))


def build(
    spark: SparkSession,
    releases: Mapping[str, DataFrame],
    workdir: str,
    end_month: str,
    start_month: str = vocab.START_MONTH,
) -> Star:
    """Dimensions and facts, stored under ``workdir`` and read back.

    Stored dimensions have a known size, which is what lets the planner decide per
    lookup whether a dimension is small enough to broadcast.
    """
    staged = stage(releases, workdir)

    def keep(name: str, frame: DataFrame, schema, cluster=()) -> tuple[str, DataFrame]:
        path = f"{workdir}/star/{name}"
        tables.write_table(frame, path, cluster)
        return name, tables.read_table(spark, path, schema, folders=name in FACTS)

    builders = all_dims(spark, staged, end_month, start_month)

    def keep_dim(name: str) -> tuple[str, DataFrame]:
        name, dim = keep(name, builders[name](), DIMENSIONS[name])
        if name in LABEL:
            require_unique_label(dim, LABEL[name])
        return name, dim

    dims = dict(tables.at_once([lambda name=name: keep_dim(name) for name in builders]))
    facts = all_facts(staged, dims)
    stored = tables.at_once([
        lambda name=name: keep(name, facts[name], FACTS[name], GRAIN[name]) for name in facts
    ])
    return {**dims, **dict(stored)}


def load(spark: SparkSession, workdir: str, folders: bool = False) -> Star:
    """A star stored by :func:`build`, or the tables of an export.

    With ``folders``, facts show the folder their rows lie in, by which measures prune.
    """
    return {
        name: tables.read_table(spark, f"{workdir}/{name}", schema, folders=folders and name in FACTS)
        for name, schema in {**DIMENSIONS, **FACTS}.items()
    }


def unclassified_places(star: Star) -> DataFrame:
    """Places that need a new classification rule."""
    return unclassified(star["dim_geography"], "geo_level", "geography_key")


def judged(results: DataFrame, workdir: str) -> tuple[DataFrame, list[str]]:
    """Run checks once, store every comparison, and say what forbids publishing.

    Each call stores in a folder of its own: frames read from an earlier one stay good.
    """
    path = f"{workdir}/check_details-{uuid4().hex}"
    results.write.parquet(path)
    stored = results.sparkSession.read.parquet(path)
    return stored, gate(stored, EXPECTED)


def register_views(star: Star, views: Mapping[str, DataFrame] | None = None) -> None:
    """Make every table and view answerable from SQL under its own name."""
    for name, frame in {**star, **(views or all_views(star))}.items():
        frame.drop(tables.FOLDER).createOrReplaceTempView(name)


def in_display_order(dim: DataFrame, table: str, label: str) -> DataFrame:
    """Members in the order they should be shown, not alphabetically."""
    return dim.orderBy(vocab.SORT_BY[table, label], label)


def publish(
    star: Star, results: DataFrame, reasons: list[str], root: str, version: str,
    boxes: bool = False,
) -> DataFrame | None:
    """Export dimensions, facts, views and check results, unless a check forbids it.

    With ``boxes``, facts are stored so that a filter on any of their keys leaves files
    out, not only one on the month.
    """
    stored = {name: frame.drop(tables.FOLDER) for name, frame in star.items()}
    everything = {**stored, **all_views(star), "check_results": to_stored(results)}
    return tables.publish(everything, root, version, reasons, GRAIN, boxes)


def run(
    spark: SparkSession,
    raw_dir: str,
    workdir: str,
    root: str,
    version: str,
    end_month: str,
    known: Iterable[tuple[str, str]] = vocab.KNOWN_SOURCE_PROBLEMS,
    reports: str | None = None,
    boxes: bool = False,
) -> tuple[DataFrame | None, list[str]]:
    """Raw files to a published export.  Returns the manifest, or why there is none.

    Every run works in a folder of its own below ``workdir``, so runs side by side never
    overwrite what another still reads.  ``boxes`` as in :func:`publish`.

    Arrears come from the report text files in ``reports`` if given, else from the
    already extracted rows next to the other releases.
    """
    workdir = f"{workdir}/run-{uuid4().hex}"
    releases = read_all(spark, raw_dir)
    if reports is not None:
        records = extract_records(read_report_pages(spark, reports), ("region", "month"))
        releases["arrears"] = arrears_release(records)
    star = build(spark, releases, workdir, end_month)
    results, reasons = judged(all_checks(star, known), workdir)
    return publish(star, results, reasons, root, version, boxes), reasons


def read_export(spark: SparkSession, root: str, folders: bool = False) -> Star | None:
    """Tables of the export in force; ``folders`` as in :func:`load`."""
    version = tables.current_version(spark, root)
    if version is None:
        return None
    folder = f"{root}/{version}"
    views = {
        name: spark.read.parquet(f"{folder}/{name}")
        for name in ("pipeline_health", "what_changed", "arrears_trend")
    }
    results = tables.read_table(spark, f"{folder}/check_results", CHECK_RESULTS)
    return {**load(spark, folder, folders), **views, "check_results": results}


def fact_rows(star: Star) -> DataFrame:
    """Total rows over all facts."""
    totals = row_totals({name: star[name] for name in FACTS})
    return totals.agg(F.sum("n_rows").alias("n_rows"))
