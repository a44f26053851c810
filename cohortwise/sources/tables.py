"""Parquet table access.

Each table is one Parquet dataset under a base directory. Reads are lazy;
Catalyst prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class ParquetTables:
    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return os.path.join(self.base_dir, f"{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(self.path(name))
        return self._frames[name]
