"""Session for tests, benchmarks and local runs; a cluster brings its own."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


# Split a hot join key even where that costs an extra shuffle later in the plan.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Sizes that bound the memory of one task, set where the session names none of its own.
SIZES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
}
#: Bytes of input for which an exchange starts with one more partition.
SHARE = 4 << 20
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tune(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply the settings the plans count on; all of them can change in a running session.

    Exchanges start with a partition per ``SHARE`` of input, and with the session's number of shuffle
    partitions at least. Adaptive execution merges small ones up to its advisory size but cannot cut
    those of a fixed number, whose memory would grow with the input.
    """
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    for key, value in SIZES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    spark.conf.set(INITIAL, str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // SHARE))))
    return spark


def sorted_buckets(spark: SparkSession) -> int:
    """Partitions for a sort of a whole table, which are not merged: a quarter of those that exchanges start with."""
    fixed = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(fixed, int(spark.conf.get(INITIAL, None) or 0) // 4)


def local_session(cores: str = "8", app: str = "tallyhouse", memory: str = "16g", shared: str | None = None) -> SparkSession:
    """``shared`` is the folder for staged tables; by default a new one below the system's temporary folder."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared or tempfile.mkdtemp(prefix="tallyhouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
