"""Records from report pages: section headers carried forward, several records per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.operators.timeseries import first_per_key, forward_fill


def _blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def page_header(text: str = "text", pattern: str = vocab.REPORT_HEADER) -> Column:
    """Section name printed on a page; NULL on a continuation page."""
    return _blank_to_null(F.trim(F.regexp_extract(text, pattern, 1)))


def page_sections(
    pages: DataFrame, doc: str = "doc_id", page: str = "page_no", text: str = "text"
) -> DataFrame:
    """``(doc, page, region)`` of every page; pages before the first header go."""
    headers = pages.select(doc, page, page_header(text).alias("_header"))
    filled = forward_fill(headers, "_header", [doc], page, "region").drop("_header")
    return filled.filter(F.col("region").isNotNull())


def records_on_lines(
    pages: DataFrame, text: str = "text", pattern: str = vocab.REPORT_RECORD
) -> DataFrame:
    """Explode pages into lines and lines into records."""
    lines = pages.select(
        *[c for c in pages.columns if c != text],
        F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "_line"),
    )
    groups = [
        F.regexp_extract_all("_line", F.lit(pattern), F.lit(i)).alias(name)
        for i, name in enumerate(("month", "total", "arrears", "rate"), start=1)
    ]
    zipped = lines.select(
        *[c for c in lines.columns if c != "_line"],
        F.posexplode(F.arrays_zip(*groups)).alias("record_no", "_record"),
    )
    return zipped.select(
        *[c for c in zipped.columns if c != "_record"],
        *[_blank_to_null(F.col("_record")[g]).alias(g) for g in ("month", "total", "arrears", "rate")],
    )


def extract_records(
    pages: DataFrame, keys: Sequence[str] = ("doc_id", "region", "month")
) -> DataFrame:
    """``(doc_id, page_no, text)`` pages to one record per key, the first in reading order.

    ``suppressed`` marks a count the report leaves out, ``parse_failed`` a printed
    one that is no number; the two must not be confused.  Lines are parsed where the
    page lies and meet their section afterwards, so page text is never shuffled.
    """
    raw = records_on_lines(pages).join(page_sections(pages), ["doc_id", "page_no"])
    number = {
        name: F.replace(F.col(name), F.lit(","), F.lit("")).try_cast("bigint")
        for name in ("total", "arrears")
    }
    rate = F.col("rate").try_cast("double")

    def unreadable(name: str, value: Column) -> Column:
        return F.col(name).isNotNull() & value.isNull()

    parsed = raw.select(
        "doc_id", "page_no", "line_no", "record_no", "region", "month",
        number["total"].alias("total_mortgages"),
        number["arrears"].alias("mortgages_in_arrears"),
        rate.alias("arrears_rate"),
        F.col("arrears").isNull().alias("suppressed"),
        (
            unreadable("total", number["total"])
            | unreadable("arrears", number["arrears"])
            | unreadable("rate", rate)
        ).alias("parse_failed"),
    )
    place = [c for c in ("doc_id", "page_no", "line_no", "record_no") if c not in keys]
    first = first_per_key(parsed, list(keys), place)
    return first.drop("page_no", "line_no", "record_no")


def arrears_release(records: DataFrame) -> DataFrame:
    """Extracted records as the all-text release the arrears fact is built from.

    A hidden count is missing; an unreadable one is text that is no number, so that the
    builder does not take it for hidden.
    """
    count = F.coalesce(F.col("mortgages_in_arrears").cast("string"), F.lit("unreadable"))
    return records.select(
        "region",
        "month",
        F.col("total_mortgages").cast("string").alias("total_mortgages"),
        F.when(~F.col("suppressed"), count).alias("mortgages_in_arrears"),
        F.col("arrears_rate").cast("string").alias("arrears_rate"),
    )
