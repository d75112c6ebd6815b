"""Typed scans of the input tables (parquet; Catalyst prunes columns and
pushes filters into the scan)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders`` is a parquet scan."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.base, f"{name}.parquet"))

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.read(name)
        raise AttributeError(name)
