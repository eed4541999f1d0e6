"""Session settings the plans are designed for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Adaptive execution re-plans joins from measured shuffle sizes and splits skewed
# join partitions; the forced form also splits them when that costs one more
# shuffle, which is the right trade when a single key holds a third of the rows.
# The JVM never compiles a method of more than 8000 bytes; a stage that would give one
# runs operator by operator, in small methods, instead of interpreted.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


INPUT_PER_PARTITION = 64 << 20  # compressed Parquet bytes behind one shuffle partition


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """A value for ``spark.sql.shuffle.partitions`` when a session for an input of known size is built."""
    return max(cores, -(-input_bytes // INPUT_PER_PARTITION))


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session; its number of shuffle partitions stays."""
    for name, value in TUNING.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: str | int = 8, shuffle_partitions: int | None = None,
                  memory: str = "12g") -> SparkSession:
    """Build a local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("harborline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("HARBORLINE_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
