"""Session settings the library relies on, and the shared folder for written intermediates."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings: all of them may be set on a session that somebody else started.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs the next operator another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above this size; smaller generated pieces run several times
    # faster than one interpreted one (the staging models have many CASE expressions).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Spark 4.1 takes a union of bucketed scans for bucketed but only appends their partitions: sums over it are wrong.
    "spark.sql.unionOutputPartitioning": "false",
    # Rows that lie in the order of their groups are summed in that order, not in a map of all groups of a task.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # Times with statistics in the footers, which filters and marks use; the default form has none.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Files of a shuffle go when the statement that made them ends, not when the driver happens to collect garbage: jobs that write
    # several tables hold the shuffles of one of them at a time.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# What is written between the steps of a job is packed more tightly than the session's own tables.
INTERMEDIATE_CODEC = "zstd"

# Upper limits: what one task reads of files and of a shuffle, compressed. Rows of a few packed bytes need many times that
# in memory. A session with smaller values keeps them.
AT_MOST = {
    "spark.sql.files.maxPartitionBytes": 32 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 << 20,
}
# A shuffle starts with so many partitions at least; adaptive execution merges small ones.
_FIRST_PARTITIONS, _LEAST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", 800

# Settings that only a new session takes.
AT_START = {
    # Else every column function looks up its caller for error messages; composing a mart takes thousands of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "layercake", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **AT_START}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the library's SQL settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key, most in AT_MOST.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    wanted = max(int(spark.conf.get(key, "1")) for key in ("spark.sql.shuffle.partitions", _FIRST_PARTITIONS))
    spark.conf.set(_FIRST_PARTITIONS, str(max(wanted, _LEAST_PARTITIONS)))
    return spark


def _bytes(size: str) -> int:
    """A size as settings write it: a number, and a unit from bytes to terabytes."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", size.strip().lower()).groups()
    return int(number) << 10 * "bkmgt".index(unit[:1] or "b")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, visible to all executors.

    Only a local session may leave that setting empty; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if base:
        run = spark.sparkContext.applicationId
        return f"{base.rstrip('/')}/layercake/{run}/{purpose}-{os.urandom(6).hex()}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return tempfile.mkdtemp(prefix=f"layercake-{purpose}-")
