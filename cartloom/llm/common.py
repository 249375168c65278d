"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.session import scratch_path

#: Removes the shuffle files of a SQL execution at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared scratch folder and read back: cuts the lineage
    in files that survive a lost executor. Nothing reads the shuffle files of the write
    again, so Spark removes them at its end instead of at some later garbage collection."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def lower_az(text: Column) -> Column:
    """``text`` with A-Z (only) lower-cased.

    ``lower`` is much faster than ``translate`` and equals it unless the text holds
    another character that has a lower case.
    """
    other = text.rlike(r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^A-Z]]")
    return F.when(other, F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))
