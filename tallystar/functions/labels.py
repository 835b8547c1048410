"""Classification of published labels as ordered Column rules.

Releases list totals next to the parts they contain.  Classification decides, per
label, what level it describes and whether adding it to its neighbours would count
something twice.  A label no rule claims is reported as Unknown, never guessed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar import vocab
from tallystar.functions.scalars import ColumnOrName, col


def stripped(label: ColumnOrName) -> Column:
    """Label without surrounding white space of any kind."""
    return F.regexp_replace(col(label), r"(?U)^\s+|\s+$", "")


def _literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def _first_match(candidates: Iterable[str], test) -> Column:
    return F.coalesce(*[F.when(test(c), F.lit(c)) for c in candidates])


def last_chunk(label: ColumnOrName) -> Column:
    """Text after the last comma, or the whole label without one."""
    return stripped(F.substring_index(col(label), ",", -1))


def province_of(label: ColumnOrName) -> Column:
    """Province named by a place label, by the most specific reading available.

    A named half ("X part,") wins over the text after the last comma, which wins
    over the first province mentioned anywhere.
    """
    name = col(label)
    tail = last_chunk(name)
    provinces = list(vocab.PROVINCES)
    return F.coalesce(
        _first_match(provinces, lambda p: name.contains(f"{p} part,")),
        F.when(tail.isin(provinces), tail),
        _first_match(provinces, name.contains),
    )


def province_code(province: ColumnOrName) -> Column:
    return _literal_map(vocab.PROVINCES)[col(province)]


def arrears_region(code: ColumnOrName) -> Column:
    return _literal_map(vocab.ARREARS_REGION_OF_PROVINCE)[col(code)]


# Outcome of each rule: level, display order, whether it is always a total.
_LEVELS = {
    "country": ("Country", vocab.SORT_COUNTRY, True),
    "known total": ("Region", vocab.SORT_KNOWN_TOTAL, True),
    "province": ("Province", vocab.SORT_PROVINCE, False),
    "excluding": ("Region", vocab.SORT_EXCLUDING, True),
    "combined": ("Region", vocab.SORT_COMBINED, True),
    "metro": ("CMA", vocab.SORT_METRO, False),
    "unknown": ("Unknown", vocab.SORT_UNKNOWN, False),
}


def place_rule(name: Column, province: Column) -> Column:
    """Name of the first rule that claims a stripped label."""
    return (
        F.when(name == vocab.COUNTRY, "country")
        .when(name.isin(*vocab.KNOWN_TOTALS), "known total")
        .when(name.isin(*vocab.PROVINCES), "province")
        .when(name.contains(" excluding "), "excluding")
        .when(name.contains(", and "), "combined")
        .when(name.contains(",") & province.isNotNull(), "metro")
        .otherwise("unknown")
    )


def with_place(frame: DataFrame, label: str) -> DataFrame:
    """Add level, province, arrears region, total flag and display order of a place label.

    Done in steps, so that each later expression refers to a computed column instead
    of repeating the province search.
    """
    found = frame.withColumn("_name", stripped(label)).withColumn(
        "_mentioned", province_of("_name")
    )
    ruled = found.withColumn("_rule", place_rule(F.col("_name"), F.col("_mentioned")))
    rule = F.col("_rule")
    has_province = rule.isin("province", "excluding", "combined", "metro")
    # The combined row of a place split by a border stands next to its two halves.
    both_halves = (
        (rule == "metro")
        & last_chunk("_name").contains("/")
        & ~F.col("_name").contains(" part,")
    )
    level, order, total = (
        _literal_map({name: outcome[i] for name, outcome in _LEVELS.items()})[rule]
        for i in range(3)
    )
    return (
        ruled.withColumns({
            "geo_level": level,
            "province_name": F.when(has_province, F.col("_mentioned")),
            "is_aggregate": total | both_halves,
            "sort_order": order,
        })
        .withColumn("province_code", province_code("province_name"))
        .withColumn("arrears_region", arrears_region("province_code"))
        .drop("_name", "_mentioned", "_rule")
    )


def dwelling(label: ColumnOrName) -> Column:
    """Struct (dwelling_category, is_total, sort_order) for one published spelling."""
    name = col(label)

    def outcome(category: Column, total: bool, order: int) -> Column:
        return F.struct(
            category.alias("dwelling_category"),
            F.lit(total).alias("is_total"),
            F.lit(order).alias("sort_order"),
        )

    known = F.create_map(*[
        part
        for spelling, (category, total, order) in vocab.DWELLING_SPELLINGS.items()
        for part in (F.lit(spelling), outcome(F.lit(category), total, order))
    ])
    return F.coalesce(
        known[F.lower(name)], outcome(name, False, vocab.DWELLING_UNLISTED_SORT)
    )


def credit_product(label: ColumnOrName) -> Column:
    """Struct (product_family, rate_type, insurance_status, is_total) of a product sentence."""
    sentence = F.lower(col(label))

    def mentions(*phrases: str) -> Column:
        found = sentence.contains(phrases[0])
        for phrase in phrases[1:]:
            found = found | sentence.contains(phrase)
        return found

    family = F.coalesce(
        *[F.when(mentions(*phrases), F.lit(name)) for phrases, name in vocab.PRODUCT_FAMILIES],
        F.lit(vocab.PRODUCT_FAMILY_OTHER),
    )
    rate = (
        F.when(mentions("fixed rate"), "Fixed")
        .when(mentions("variable rate"), "Variable")
        .otherwise("All")
    )
    # "uninsured" contains "insured", so it is tested first.
    insurance = (
        F.when(mentions("uninsured"), "Uninsured")
        .when(mentions("insured"), "Insured")
        .otherwise("All")
    )
    return F.struct(
        family.alias("product_family"),
        rate.alias("rate_type"),
        insurance.alias("insurance_status"),
        sentence.startswith("total,").alias("is_total"),
    )
