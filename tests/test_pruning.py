"""Calendar conditions keep scans to the year folders they name."""

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tallystar.operators.calendar import month_calendar
from tallystar.operators.timeseries import latest_only
from tallystar.plans import fusion, measures
from tallystar.schemas import FACTS
from tallystar.sources import tables

YEARS = range(1990, 2020)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A fact of thirty years in folders, and the same rows without them."""
    folder = str(tmp_path_factory.mktemp("pruned"))
    calendar = month_calendar(spark, f"{YEARS[0]}-01", f"{YEARS[-1]}-12")
    calendar.coalesce(1).write.parquet(f"{folder}/dim_date")
    months = spark.read.parquet(f"{folder}/dim_date")
    skipped = F.col("date_key") % 700 < 600  # months without a rate
    rates = months.where(skipped).select(
        "date_key", (F.col("month") + F.col("year") % 7).cast("decimal(9,4)").alias("rate_5year"))
    schema = FACTS["fact_mortgage_rate"]
    tables.write_table(rates, f"{folder}/rates", ("date_key",))
    read = lambda **kw: tables.read_table(spark, f"{folder}/rates", schema, **kw)
    return (
        {"dim_date": months, "fact_mortgage_rate": read(folders=True)},
        {"dim_date": months, "fact_mortgage_rate": read()},
    )


def folders_read(frame):
    """Folders that scans by year read, counted after the rows were fetched."""
    execution = frame._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    plan = execution.executedPlan()
    final = plan.finalPhysicalPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    todo, counts = [final], []
    while todo:
        node = todo.pop()
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if node.nodeName().strip() == "Scan parquet" and "year" in node.relation().partitionSchema().simpleString():
            counts.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return counts


WHERES = [
    "year = 2005", "year BETWEEN 2003 AND 2004", "month = 6 AND year >= 2017", "year_month = '2011-01'",
    "year = 1980",
]


@pytest.mark.parametrize("where", WHERES)
def test_pruned_measures_equal_whole_scans(stored, where):
    by_folder, plain = stored
    for name in ("mortgage_rate", "mortgage_rate_18_months_ago"):
        measure = measures.MEASURES[name]
        for by in ((), ("year",)):
            context = {"dim_date": where}
            want = tuples(measure(plain, by, context))
            assert tuples(measure(by_folder, by, context)) == want
            if by:
                assert tuples(fusion.together(by_folder, [name], by, context)) == want


def test_scans_read_the_named_folders(stored):
    by_folder, _ = stored
    rows = measures.in_context(by_folder, "fact_mortgage_rate", ("date_key",), {"dim_date": "year BETWEEN 2003 AND 2004"})
    assert "dynamicpruning" in rows._jdf.queryExecution().toString()
    assert folders_read(rows) == [2]
    both = fusion.together(
        by_folder, ["mortgage_rate", "mortgage_rate_18_months_ago"], ("date_key",), {"dim_date": "year = 2005"})
    # The year itself and those eighteen months before it.
    assert folders_read(both) == [3]


def test_all_folders_without_a_condition(stored):
    by_folder, _ = stored
    assert folders_read(measures.in_context(by_folder, "fact_mortgage_rate", ("date_key",))) == [len(YEARS)]
    assert tables.FOLDER not in measures.in_context(by_folder, "fact_mortgage_rate", ("year",)).columns


def test_the_last_period_reads_one_folder(stored, spark):
    by_folder, plain = (star["fact_mortgage_rate"] for star in stored)
    latest = latest_only(by_folder)
    assert tuples(latest, *plain.columns) == tuples(latest_only(plain))
    assert folders_read(latest) == [1]
    # The month itself is looked up in that folder, and the folder's name without columns.
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("DynamicFilters") >= 1 or plan.count("PartitionFilters: [isnotnull(year") >= 1
    early = by_folder.filter(F.col("date_key") < 19990101)
    assert tuples(latest_only(early), *plain.columns) == tuples(
        latest_only(plain.filter(F.col("date_key") < 19990101)))
    assert latest_only(by_folder.filter("rate_5year < 0")).count() == 0
