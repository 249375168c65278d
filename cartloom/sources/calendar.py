"""Day spines (SRC6) and the default run day (SRC7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def day_spine(spark: SparkSession, first: str, last: str, name: str = "day") -> DataFrame:
    """One row per day of the closed range ``[first, last]`` (``yyyy-MM-dd``).

    The row count is the calendar length of the range, independent of data size.
    """
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)),
                             F.expr("INTERVAL 1 DAY"))).alias(name))


def day_spine_of(df: DataFrame, day_col: str, name: str = "day") -> DataFrame:
    """Every day between the first and last day present in ``df[day_col]`` (a DATE).

    Min and max are one partial aggregate; the spine is as long as the calendar span.
    """
    bounds = df.agg(F.min(day_col).alias("lo"), F.max(day_col).alias("hi"))
    return bounds.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias(name))
