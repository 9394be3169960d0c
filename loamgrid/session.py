"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Run-time settings, safe to change on a live session.
SETTINGS = {
    # re-plan from measured sizes: partition counts, join choice, skewed partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where an aggregate reuses its partitioning: the
    # extra shuffle is added only when a skewed partition is really found
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Shuffles start with many partitions, which adaptive execution puts together up to
# the advisory size.  A task's hash tables and sorts (some forty times the bytes it
# reads) then hold that much, however large the input: a shuffle of up to 16 GB.
# A scan task buffers the rows it shuffles, so it reads a bounded part of a file
# (a row group at least).
PARTITIONING = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
}
_BEFORE = "loamgrid.before."


def tune(spark: SparkSession, *, partitioning: bool = True) -> SparkSession:
    """Apply the settings to an existing session; without ``partitioning`` its own partition sizes hold again."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in PARTITIONING.items():
        kept = spark.conf.get(_BEFORE + key, None)
        if partitioning and kept is None:
            spark.conf.set(_BEFORE + key, spark.conf.get(key, None) or "")
            spark.conf.set(key, value)
        elif not partitioning and kept is not None:
            spark.conf.unset(_BEFORE + key)
            if kept:
                spark.conf.set(key, kept)
            else:
                spark.conf.unset(key)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("loamgrid")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())
