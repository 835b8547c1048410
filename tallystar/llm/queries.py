"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm import (
    exact_dedup, language_id, license_scan, line_dedup, mixing, packing, quality_rules, simhash,
    source_divergence, sql, suffix_dedup, toxicity, url_filter, whitening,
)
from tallystar.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(table(spark, sf_dir, "documents")).drop("distance")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


#: The pages carry no times and no list: both are made from ids and hosts, so that they
#: grow with the table.  A page is fetched some minutes after the one before it.
FETCH_START, FETCH_STEP, FETCH_SPAN = 1_704_067_200, 2_221, 365 * 86_400


def dated_pages(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", (
        F.pmod(F.col("page_id") * FETCH_STEP, F.lit(FETCH_SPAN)) + FETCH_START).alias("fetched_at"))


def list_of_hosts(pages: DataFrame) -> DataFrame:
    """Log of a block list over the pages' domains: two in three are listed for a while,
    half of these again later."""
    labels = F.split(url_filter.host_of(F.col("url")), r"\.")
    domain = F.array_join(F.slice(
        labels, F.when(F.size(labels) > 3, 2).otherwise(1), F.size(labels)), ".")
    digest = F.md5("pattern")
    part = lambda at: F.conv(F.substring(digest, at, 4), 16, 10).cast("long")
    day = 86_400
    hosts = pages.select(domain.alias("pattern")).where("pattern IS NOT NULL").distinct().select(
        "pattern", part(1).alias("kind"), (part(5) % 300).alias("first"),
        (part(9) % 60 + 1).alias("stay"), (part(13) % 40 + 1).alias("gap"))
    start = F.lit(FETCH_START) + F.col("first") * day
    end = start + F.col("stay") * day
    event = lambda at, action: F.struct(at.alias("listed_at"), F.lit(action).alias("action"))
    twice = F.col("kind") % 2 == 0
    log = F.when(twice, F.array(event(start, "add"), event(end, "remove"), event(end + F.col("gap") * day, "add")))
    return hosts.where("kind % 3 > 0").select(
        "pattern", F.when(F.col("kind") % 5 < 2, "adult").otherwise("spam").alias("category"),
        F.inline(log.otherwise(F.array(event(start, "add"), event(end, "remove")))))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.evaluate(dated_pages(pages), list_of_hosts(pages))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeated_lines(docs).select(
        "row.doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_license_scan": op2_license_scan,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_url_filter": op7_url_filter,
    "op8_mixing": op8_mixing,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_line_dedup": op12_line_dedup,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES: dict[str, str] = {
    "op2_license_scan": sql.LICENSE_SCAN,
    "op7_url_filter": sql.url_filter(FETCH_START, FETCH_STEP, FETCH_SPAN),
    "op8_mixing": sql.MIXING,
    "op9_exact_dedup": sql.EXACT_DEDUP,
    "op12_line_dedup": sql.LINE_DEDUP,
    "op13_source_divergence": sql.SOURCE_DIVERGENCE,
}
