"""Session settings used by the tests and the benchmark (local mode).

On a cluster the session comes from the deployment; the library only reads
``spark.checkpoint.dir`` from it. These settings mirror what the operators
assume: adaptive execution (runtime broadcast of small sides, partition
coalescing, skewed-join splitting) and no UI server.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cohortwise")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
