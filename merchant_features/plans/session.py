"""Session settings the plans rely on; all can be changed on a running session."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when a later step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Apply the settings.

    ``shuffle_partitions`` is the upper bound adaptive execution merges from:
    on a large cluster a few times the number of cores, and enough for
    partitions of about 200 MB.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark
