"""Commerce tables in the roles of statistical releases.

The driver's tables hold orders and events, not housing statistics.  This module
aggregates them once, map-side first, to monthly grain and lays the result out the way
publishers do: long, all text, totals beside their parts, two overlapping coverages.
From there on the ordinary builders, views and measures apply.

==================  =======================================================
release             stands for
==================  =======================================================
housing_activity    orders by province of the customer's nation, plus totals
housing_cma         the same orders for nations that play metro areas
absorptions         shipped quantity, closed (flow) and open (snapshot) lines
unoccupied          shipped quantity not returned
originations        line prices by product sentence, with balances and rates
price_index         price per unit by place and component
mortgage_rate       tax share of price, several readings per month
arrears             a day of the event stream as one month; errors are arrears
==================  =======================================================
"""

from __future__ import annotations

from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.functions.scalars import hundredths, month_start, ratio
from tallystar.operators.aggregates import sum_of_amounts
from tallystar.plans import warehouse
from tallystar.session import shared_dir

TOTAL = "Total units"
ATLANTIC = "Atlantic provinces"
FIRST_EVENT_DAY, FIRST_ARREARS_MONTH = "2024-01-01", "1999-01-01"

DWELLING_OF_PRIORITY = {
    "1-URGENT": "Single-detached units",
    "2-HIGH": "Semi-detached units",
    "3-MEDIUM": "Row units",
}
DWELLING_OF_LINE = ("Single-detached units", "Semi-detached units", "Row units")
DWELLING_REST = "Apartment and other units"
STAGE_OF_STATUS = {"O": "Housing starts", "P": "Housing under construction",
                   "F": "Housing completions"}
TERMS = ("less than 1 year", "from 1 to less than 3 years", "from 3 to less than 5 years",
         "5 years and more")
BASE_PRICE = 9.97  # price per unit at which the index would stand at 1
COMPONENTS = ("Total (house and land)", "House only", "Land only")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation key to the province, metro and total labels it counts towards."""
    provinces = F.array(*[F.lit(p) for p in vocab.PROVINCES])
    ordinal = F.col("n_nationkey") % len(vocab.PROVINCES)
    province = F.element_at(provinces, (ordinal + 1).cast("int"))
    labels = [
        F.lit(vocab.COUNTRY), province, F.when(ordinal < 4, F.lit(ATLANTIC)),
    ]
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nk"),
        F.array_compact(F.array(*labels)).alias("town_labels"),
        F.when(F.col("n_nationkey") >= 10, F.concat("n_name", F.lit(", "), province)).alias(
            "metro_label"
        ),
    )


def _lookup(value: Column, names: dict, rest: str | None = None) -> Column:
    picked = F.coalesce(*[F.when(value == k, F.lit(v)) for k, v in names.items()])
    return picked if rest is None else F.coalesce(picked, F.lit(rest))


def orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per month, nation, dwelling and stage: the only pass over orders."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", month_start("o_orderdate").alias("month"),
        _lookup(F.col("o_orderpriority"), DWELLING_OF_PRIORITY, DWELLING_REST).alias("dwelling"),
        _lookup(F.col("o_orderstatus"), STAGE_OF_STATUS).alias("stage"),
        "o_totalprice",
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("month", F.col("c_nationkey").alias("nk"), "dwelling", "stage")
        .agg(sum_of_amounts("o_totalprice").alias("units"))
    )


def lines_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines per month, place of the supplier, line number and flags: the only pass.

    Amounts and rates have two decimals at the source, so sums of their products are
    exact in ten-thousandths.
    """
    price = hundredths("l_extendedprice")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    summed = (
        table(spark, sf_dir, "lineitem")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(
            month_start("l_shipdate").alias("month"),
            F.col("s_nationkey").alias("nk"),
            F.col("l_linenumber").alias("line"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_linestatus").alias("status"),
        )
        .agg(
            sum_of_amounts("l_quantity").alias("quantity"),
            sum_of_amounts("l_extendedprice").alias("price"),
            F.sum(price * hundredths("l_discount")).alias("discount"),
            F.sum(price * hundredths("l_tax")).alias("tax"),
        )
    )
    fine = F.lit("0.0001").cast("decimal(5,4)")
    return summed.withColumns({
        "discount": (F.col("discount").cast("decimal(20,0)") * fine).cast("decimal(24,4)"),
        "tax": (F.col("tax").cast("decimal(20,0)") * fine).cast("decimal(24,4)"),
    })


def _ref_date() -> Column:
    return F.date_format("month", "yyyy-MM").alias("REF_DATE")


def _with_totals(dwelling: Column) -> Column:
    return F.explode(F.array(dwelling, F.lit(TOTAL)))


def _place_rows(base: DataFrame, spark: SparkSession, sf_dir: str, metro_too: bool) -> DataFrame:
    """One row per label an amount counts towards."""
    known = base.join(places(spark, sf_dir), "nk")
    labels = F.col("town_labels")
    if metro_too:
        labels = F.array_compact(F.concat(labels, F.array("metro_label")))
    return known.withColumn("GEO", F.explode(labels))


def housing(spark: SparkSession, sf_dir: str, base: DataFrame) -> dict[str, DataFrame]:
    def release(rows: DataFrame) -> DataFrame:
        both = rows.withColumn("Type of unit", _with_totals(F.col("dwelling")))
        summed = both.groupBy(
            _ref_date(), "GEO", "Type of unit", F.col("stage").alias("Housing estimates")
        ).agg(F.sum("units").alias("units"))
        # A footnote letter where the publisher holds a figure back.
        quarter_end = F.substring("REF_DATE", 6, 2).isin("03", "06", "09", "12")
        withheld = (
            (F.col("GEO") == ATLANTIC) & (F.col("Type of unit") == TOTAL) & quarter_end
        )
        value = F.when(withheld, F.lit("x")).otherwise(F.col("units").cast("string"))
        return summed.withColumn("VALUE", value).drop("units")

    metros = base.join(places(spark, sf_dir), "nk").filter(F.col("metro_label").isNotNull())
    return {
        "housing_activity": release(_place_rows(base, spark, sf_dir, metro_too=False)),
        "housing_cma": release(metros.withColumn("GEO", F.col("metro_label"))),
    }


def _dwelling_of_line() -> Column:
    kind = F.col("line") % 4
    return _lookup(kind, dict(enumerate(DWELLING_OF_LINE)), DWELLING_REST)


def absorptions(spark: SparkSession, sf_dir: str, base: DataFrame) -> DataFrame:
    rows = _place_rows(base, spark, sf_dir, metro_too=True)
    measure = F.when(F.col("status") == "F", "Absorptions").otherwise("Unabsorbed inventory")
    both = rows.withColumn("Type of dwelling unit", _with_totals(_dwelling_of_line()))
    summed = both.groupBy(
        _ref_date(), "GEO", "Type of dwelling unit", measure.alias("Completed dwelling units")
    ).agg(F.sum("quantity").cast("string").alias("VALUE"))
    return summed


def unoccupied(spark: SparkSession, sf_dir: str, base: DataFrame) -> DataFrame:
    rows = _place_rows(base.filter(F.col("flag") == "N"), spark, sf_dir, metro_too=True)
    both = rows.withColumn("Type of unit", _with_totals(_dwelling_of_line()))
    return both.groupBy(_ref_date(), "GEO", "Type of unit").agg(
        F.sum("quantity").cast("string").alias("VALUE")
    )


def originations(base: DataFrame) -> DataFrame:
    """Funds advanced, running balances and rates per product sentence.

    The balance window runs per product over monthly rows, never over lines.
    """
    line = F.col("line")
    residential = line <= len(TERMS)
    kind = F.when(F.col("flag") == "R", "Variable rate").otherwise("Fixed rate")
    insured = F.when(F.col("status") == "F", "insured").otherwise("uninsured")
    term = F.get(F.array(*[F.lit(t) for t in TERMS]), line - 1)
    lead = F.when(residential, kind).otherwise(F.lit("Other"))
    subject = (
        F.when(residential, F.concat(F.lit("residential mortgages, "), insured, F.lit(", "), term))
        .when(line == 5, "non-residential mortgages")
        .when(line == 6, "business loans")
        .otherwise("consumer credit")
    )
    detailed = base.groupBy("month", lead.alias("lead"), subject.alias("subject")).agg(
        F.sum("price").alias("price"), F.sum("discount").alias("discount")
    )
    subtotals = (
        base.filter(residential)
        .groupBy(
            "month", F.lit("Total").alias("lead"),
            F.concat(F.lit("residential mortgages, "), insured).alias("subject"),
        )
        .agg(F.sum("price").alias("price"), F.sum("discount").alias("discount"))
    )
    products = detailed.unionByName(subtotals)
    so_far = Window.partitionBy("lead", "subject").orderBy("month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    tallied = products.withColumn("balance", F.sum("price").over(so_far))

    def sentence(measure: str) -> Column:
        return F.concat("lead", F.lit(f", {measure}, "), "subject")

    rate = (ratio("discount", "price") * 100).cast("decimal(9,4)")
    rows = F.array(
        F.struct(sentence("funds advanced").alias("Components"),
                 F.lit("Dollars").alias("Unit of measure"),
                 F.col("price").cast("string").alias("VALUE")),
        F.struct(sentence("outstanding balances").alias("Components"),
                 F.lit("Dollars").alias("Unit of measure"),
                 F.col("balance").cast("string").alias("VALUE")),
        F.struct(sentence("funds advanced").alias("Components"),
                 F.lit("Interest rate").alias("Unit of measure"),
                 rate.cast("string").alias("VALUE")),
    )
    return tallied.select(_ref_date(), F.inline(rows))


def price_index(spark: SparkSession, sf_dir: str, base: DataFrame) -> DataFrame:
    rows = _place_rows(base, spark, sf_dir, metro_too=True)
    component = _lookup(F.col("line") % 3, dict(enumerate(COMPONENTS)))
    index = (ratio(F.sum("price"), F.sum("quantity")) / BASE_PRICE).cast("decimal(12,4)")
    return rows.groupBy(
        _ref_date(), "GEO", component.alias("New housing price indexes")
    ).agg(index.cast("string").alias("VALUE"))


def mortgage_rate(base: DataFrame) -> DataFrame:
    rate = (ratio(F.sum("tax"), F.sum("price")) * 100).cast("decimal(9,4)")
    readings = base.groupBy(_ref_date(), "line").agg(rate.cast("string").alias("VALUE"))
    return readings.drop("line")


def events_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per month and region code: the only pass over events."""
    regional = [code for _, code, _, national, _ in vocab.ARREARS_REGIONS if not national]
    code = F.element_at(
        F.array(*[F.lit(c) for c in regional]),
        (F.col("user_id") % len(regional) + 1).cast("int"),
    )
    day = F.datediff(F.col("ts").cast("date"), F.lit(FIRST_EVENT_DAY).cast("date"))
    month = F.add_months(F.lit(FIRST_ARREARS_MONTH).cast("date"), day)
    return table(spark, sf_dir, "events").groupBy(
        month.alias("month"), code.alias("code")
    ).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("event_type") == "error").alias("late"),
    )


def arrears(base: DataFrame) -> DataFrame:
    """Regions and their national row; the last region's count is withheld."""
    regional = [code for _, code, _, national, _ in vocab.ARREARS_REGIONS if not national]
    with_national = F.explode(F.array("code", F.lit("CANADA")))
    summed = base.withColumn("region", with_national).groupBy("month", "region").agg(
        F.sum("total").alias("total"), F.sum("late").alias("late")
    )
    rounded_up = F.expr("(20000 * late + total) div (2 * total)")
    rate = (rounded_up.cast("decimal(9,2)") / 100).cast("decimal(9,2)")
    shown = F.col("region") != regional[-1]
    return summed.select(
        "region",
        F.date_format("month", "yyyy-MM").alias("month"),
        F.col("total").cast("string").alias("total_mortgages"),
        F.when(shown, F.col("late").cast("string")).alias("mortgages_in_arrears"),
        F.when(shown, rate.cast("string")).alias("arrears_rate"),
    )


def releases(
    spark: SparkSession, sf_dir: str, workdir: str
) -> tuple[dict[str, DataFrame], str, str]:
    """All releases, from one stored aggregate per big table, and the months they span."""

    def kept(name: str, frame: DataFrame) -> DataFrame:
        path = f"{workdir}/base/{name}"
        frame.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    orders, lines, events = bases = warehouse.tables.at_once([
        lambda: kept("orders", orders_base(spark, sf_dir)),
        lambda: kept("lines", lines_base(spark, sf_dir)),
        lambda: kept("events", events_base(spark, sf_dir)),
    ])
    months = reduce(DataFrame.unionByName, [base.select("month") for base in bases])
    first, last = months.agg(
        F.date_format(F.min("month"), "yyyy-MM"), F.date_format(F.max("month"), "yyyy-MM")
    ).first()
    laid_out = {
        **housing(spark, sf_dir, orders),
        "absorptions": absorptions(spark, sf_dir, lines),
        "unoccupied": unoccupied(spark, sf_dir, lines),
        "originations": originations(lines),
        "price_index": price_index(spark, sf_dir, lines),
        "mortgage_rate": mortgage_rate(lines),
        "arrears": arrears(events),
    }
    return laid_out, first, last


def build_star(spark: SparkSession, sf_dir: str, workdir: str) -> warehouse.Star:
    """The whole star built from the tables in ``sf_dir``."""
    laid_out, first, last = releases(spark, sf_dir, workdir)
    return warehouse.build(spark, laid_out, workdir, last, first)


_BUILT: dict[tuple[str, str, int], warehouse.Star] = {}
_BUILDING = Lock()
INPUTS = ("nation", "customer", "supplier", "orders", "lineitem", "events")


def _inputs_mark(spark: SparkSession, sf_dir: str) -> int:
    """A number that changes with the input files; lists them, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
        [f"{sf_dir}/{name}.parquet" for name in INPUTS])
    mark = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
    return int(files.agg(mark).first()[0])


def star(spark: SparkSession, sf_dir: str) -> warehouse.Star:
    """The star of ``sf_dir``, built on first use in an application and stored.

    Changed inputs are built anew; one build runs at a time.
    """
    application = spark.sparkContext.applicationId
    with _BUILDING:
        key = (application, sf_dir, _inputs_mark(spark, sf_dir))
        if key not in _BUILT:
            folder = sf_dir.strip("/").replace("/", "_")
            workdir = f"{shared_dir(spark)}/star-{application}-{folder}-{key[2] % 10**9}"
            _BUILT[key] = build_star(spark, sf_dir, workdir)
        return _BUILT[key]
