"""Session helpers: where shared scratch lives, and a local session for tests."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and working tables.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local master, where
    driver and executors share one machine, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallystar-"))
    return context.getCheckpointDir().rstrip("/")


def local_session(name: str = "tallystar", cores: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
