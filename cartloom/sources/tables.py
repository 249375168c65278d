"""Parquet tables of a data folder (``<dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Scan one table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders`` scans ``orders.parquet``."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self._spark, self._dir = spark, data_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self._spark, self._dir, name)
