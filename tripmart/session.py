"""Session settings the jobs are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Bytes one shuffle task should handle, and the least number of shuffle tasks.
TASK_BYTES = 256 << 20
MIN_SHUFFLE_PARTITIONS = 200


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle tasks for an input size; adaptive execution merges what is too small."""
    return max(MIN_SHUFFLE_PARTITIONS, -(-input_bytes // TASK_BYTES))


def configured(builder: SparkSession.Builder, input_bytes: int = 0) -> SparkSession.Builder:
    """A builder with adaptive execution, skew handling and UTC session time."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes)),
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder
