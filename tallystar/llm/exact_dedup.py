"""Exact deduplication as a stateful stream.

Each row leaves its digest, its id and the place of its content.  A structured stream
reads these and keeps, per digest, the smallest id with its place and the number of rows,
in a disk-backed state store that never expires.  Rows may arrive in any order and in
later runs; the state is all that is remembered of earlier ones.  After the stream has
drained, the state is read once and written as a table.  Rows whose digest another row holds are then
compared with that row's full bytes, so a digest shared by different texts never merges
them.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.common import BROADCAST_IDS, SPACE_RUN, join_ids, stored, unused
from tallystar.session import shared_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: With every store that is opened, once per part of the state and batch and once per part
#: and reading, Spark leaves native memory behind.  So both follow the rows, not the files
#: or the session's partitions: batches of so many bytes, parts of so many arrivals, about.
BYTES_PER_BATCH = 1 << 30
ARRIVALS_PER_STORE = 500_000
_STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # State is many small rows: a small write buffer is enough, and stores are open per core.
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "16",
    # A store is closed when its task ends, so open ones follow the cores, not the keys.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    # One cache for all stores of an executor; otherwise each store's own outlives it.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
}
ARRIVALS = "digest string, doc_id long, locator string"


def normalised(text: Column) -> Column:
    """Null as empty, every run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


@contextmanager
def _conf(spark: SparkSession, wanted: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _parts(spark: SparkSession, arrivals: str, arrivals_per_store: int) -> int:
    """Parts of a new state: as the arrivals ask for, one per core at least."""
    wanted = -(-spark.read.schema(ARRIVALS).parquet(arrivals).count() // arrivals_per_store)
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(most, max(wanted, spark.sparkContext.defaultParallelism))


def absorb(
    spark: SparkSession,
    arrivals: str,
    state: str,
    bytes_per_batch: int = BYTES_PER_BATCH,
    arrivals_per_store: int = ARRIVALS_PER_STORE,
) -> None:
    """Run the stream over what is new in folder ``arrivals``; ``state`` remembers the rest.

    The first run settles into how many parts the state is dealt.
    """
    incoming = (
        spark.readStream.schema(ARRIVALS).option("maxBytesPerTrigger", bytes_per_batch)
        .parquet(arrivals)
    )
    holders = incoming.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "locator")).alias("holder"),
        F.count("*").alias("n"),
    )
    parts = str(_parts(spark, arrivals, arrivals_per_store))
    with _conf(spark, _STREAM_CONF | {"spark.sql.shuffle.partitions": parts}):
        stream = (
            holders.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", state).trigger(availableNow=True).start()
        )
        stream.awaitTermination()


def holders(spark: SparkSession, state: str) -> DataFrame:
    """The state as a table: digest, keep_id, locator, n."""
    kept = spark.read.format("statestore").load(state)
    held = kept.select("key.digest", F.struct("value.*").alias("value"))
    names = held.schema["value"].dataType.names
    return held.select(
        "digest",
        F.col("value")[names[0]]["doc_id"].alias("keep_id"),
        F.col("value")[names[0]]["locator"].alias("locator"),
        F.col("value")[names[1]].alias("n"),
    )


def exact_groups(
    docs: DataFrame,
    digest_of=lambda text: F.sha2(text, 256),
    bytes_per_batch: int = BYTES_PER_BATCH,
    broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null and empty texts are equal.  A null id is ordered after all others.  Of rows that
    repeat both id and text, all carry the same answer; ``deduplicated`` leaves one.
    ``digest_of`` may be any function of the normalised text; texts it confuses are told
    apart by their bytes.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    work = f"{shared_dir(spark)}/exact-{uuid.uuid4().hex}"
    texts = docs.select("doc_id", normalised(F.col("text")).alias("body"))
    digests = texts.select(
        "doc_id", F.input_file_name().alias("locator"),
        digest_of(F.col("body")).alias("digest"), F.sha2("body", 256).alias("text_sha256"))
    # Written once: the stream and the answer read digests, not texts.
    digests.write.parquet(f"{work}/arrivals")
    absorb(spark, f"{work}/arrivals", f"{work}/state", bytes_per_batch)
    with _conf(spark, _STREAM_CONF):
        holders(spark, f"{work}/state").drop("locator").write.parquet(f"{work}/classes")

    rows = spark.read.schema(f"{ARRIVALS}, text_sha256 string").parquet(f"{work}/arrivals")
    classes = spark.read.schema("digest string, keep_id long, n long").parquet(f"{work}/classes")
    first = rows.select("doc_id", "digest", "text_sha256").join(classes, "digest")
    # Full bytes of both sides of every hit, and only of hits, are moved.
    hits = first.where("n > 1").select("doc_id", "digest", "keep_id")
    bodies = join_ids(
        docs.select("doc_id", "text"), hits.select("doc_id").distinct(), "left_semi", broadcast_ids,
    ).select("doc_id", normalised(F.col("text")).alias("body"))
    bodies = bodies.withColumn("digest", digest_of(F.col("body")))
    keepers = hits.select("digest", "keep_id").distinct()
    held = bodies.join(
        keepers.withColumnRenamed("digest", "kept_digest"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("digest") == F.col("kept_digest")),
        "left_semi",
    ).groupBy("digest").agg(F.min("body").alias("kept_body"))
    checked = bodies.join(held, "digest").where(F.col("body") != F.col("kept_body")).select("digest")
    confused = stored(checked.distinct())
    plain = first.select(
        "doc_id", "keep_id", F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "digest")
    if confused.isEmpty():
        return plain.drop("digest")
    # Digests that different texts share: those rows are grouped by their bytes instead.
    fine = bodies.join(confused, "digest", "left_semi")
    groups = fine.groupBy("digest", "body").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id"))["doc_id"].alias("keep_id"),
        F.count("*").alias("group_size"))
    told_apart = fine.join(groups, ["digest", "body"]).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.sha2("body", 256).alias("text_sha256"))
    return plain.join(confused, "digest", "left_anti").drop("digest").unionByName(told_apart)


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that repeat the text of a row with a smaller id.

    Of rows that repeat both id and text, one stays.
    """
    decided = stored(exact_groups(docs, **options).select("doc_id", "kept", "text_sha256"))
    digest = F.sha2(normalised(F.col("text")), 256)
    names = unused("gone_digests", docs)
    gone = decided.where(~F.col("kept")).groupBy("doc_id").agg(
        F.collect_set("text_sha256").alias(names))
    marked = join_ids(docs, gone, "left")
    left = marked.where(
        F.col(names).isNull() | ~F.array_contains(F.col(names), digest)
    ).drop(names)
    twice = decided.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1")
    twice = stored(twice.select("doc_id").distinct())
    if twice.isEmpty():
        return left
    name = unused("exact_digest", docs)
    again = join_ids(left, twice, "left_semi").withColumn(name, digest)
    return join_ids(left, twice, "left_anti").unionByName(
        again.dropDuplicates(["doc_id", name]).drop(name))
