"""Expressions and helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.session import shared_dir

#: Fixed values of the contracts: what separates words, and what a word of a licence is.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
ID_SEED_MODULUS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder.

    Only for narrow tables: counts, digests, edges.  Spark removes the files with the
    frame when ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    shared_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


#: Rows of whole texts that are handed to Python at once, at most.
ROWS_PER_BATCH = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, with the session told to hand texts to Python in small batches.

    The setting only bounds memory, and only ever gets smaller.
    """
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_CONF)) <= ROWS_PER_BATCH:
        conf.set(_BATCH_CONF, str(ROWS_PER_BATCH))
    return docs


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text, modulo five, is 0."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % ID_SEED_MODULUS == 0, F.lit(False))


def space_words(text: Column) -> Column:
    """Words between runs of space, tab, newline, vertical tab, form feed and return."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, SPACE_RUN))


def unit_fraction(value: Column, seed: str) -> Column:
    """A reproducible number in [0, 1) for each value, the same in every engine."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(value, F.lit("\x00null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, or that with enough underscores that no column of the frames has it."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Up to so many ids, a few ten bytes each, are broadcast to find their rows; more are joined.
BROADCAST_IDS = 1_000_000


def join_ids(
    docs: DataFrame, ids: DataFrame, how: str, broadcast_ids: int = BROADCAST_IDS
) -> DataFrame:
    """``docs`` joined with a table whose only common column is ``doc_id``, null with null.

    The table is counted: a small one goes to the texts, so that these stay where they
    are; with a larger one, both are dealt by id.
    """
    name = unused("joined_id", docs, ids)
    ids = stored(ids.withColumnRenamed("doc_id", name))
    if ids.count() <= broadcast_ids:
        ids = F.broadcast(ids)
    joined = docs.join(ids, docs["doc_id"].eqNullSafe(ids[name]), how)
    return joined.drop(name)


def row_mark(text: Column) -> Column:
    """A number that tells the texts of one id apart; null as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def one_of_each_group(
    docs: DataFrame, decided: DataFrame, broadcast_ids: int = BROADCAST_IDS
) -> DataFrame:
    """``docs`` with one row of each group: the smallest id, null last, then the smallest mark.

    ``decided`` has (doc_id, mark, root) for every row of ``docs``, ``mark`` by
    ``row_mark`` and ``root`` naming the row's group.  A row goes by its id and its text
    together, so another text under the same id, or without one, stays.
    """
    decided = stored(decided)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    keepers = decided.groupBy("root").agg(F.min(order).alias("keeper"), F.count("*").alias("n"))
    # Groups of one need no join.
    groups = keepers.where("n > 1").select("root", "keeper")
    rows = decided.join(groups, "root").groupBy("doc_id", "mark").agg(
        F.first(F.col("doc_id").eqNullSafe(F.col("keeper.doc_id"))
                & (F.col("mark") == F.col("keeper.mark"))).alias("keeps"),
        F.count("*").alias("n")).where("not keeps or n > 1")
    rows = stored(rows.select(F.col("doc_id").alias("joined_id"), F.col("mark").alias("joined_mark"), "keeps"))
    small = rows.count() <= broadcast_ids
    name = unused("joined_with", docs)
    marked = docs.withColumn(name, row_mark(F.col("text")))

    def joined(wanted: DataFrame, how: str) -> DataFrame:
        wanted = wanted.drop("keeps")
        same = marked["doc_id"].eqNullSafe(wanted["joined_id"]) & (
            marked[name] == wanted["joined_mark"])
        return marked.join(F.broadcast(wanted) if small else wanted, same, how)

    left = joined(rows, "left_anti").drop(name)
    twice = rows.where("keeps")
    if twice.isEmpty():
        return left
    # The keeper stands there more than once, id and text alike.
    once = joined(twice, "left_semi").dropDuplicates(["doc_id", name])
    return left.unionByName(once.drop(name))
