"""Session settings that suit these plans."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session_builder(app_name: str = "cardlens") -> SparkSession.Builder:
    """A builder with adaptive execution on and skew handling at its defaults.

    Master, memory and ``spark.checkpoint.dir`` are left to ``spark-submit``.
    """
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # size of the pieces into which large days and heavy keys are split
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB")
        # lets a shuffled join hash its small side instead of sorting the wide one
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
    )
