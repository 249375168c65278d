"""Run metrics as ``key : value`` text lines, and their extraction (FUN14).

The pipeline itself passes audit DataFrames; these helpers read and write the
line format that log scrapers expect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metric_lines(df: DataFrame, key_cols: list[str], metrics: list[str]) -> DataFrame:
    """One text line ``<metric> : <value>`` per metric and row, keyed by ``key_cols``."""
    stacked = df.select(
        *key_cols,
        F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("bigint").alias("v"))
                            for m in metrics])).alias("m"),
    )
    return stacked.select(*key_cols, F.format_string("%s : %d", "m.metric", "m.v").alias("line"))


def metric_value(line, metric: str | None = None) -> Column:
    """The integer after ``:`` of a metric line; null when the line does not match."""
    pattern = r"^\s*(\S+)\s*:\s*(-?\d+)\s*$"
    value = F.regexp_extract(_c(line), pattern, 2)
    parsed = F.when(value != F.lit(""), value.cast("bigint"))
    if metric is None:
        return parsed
    return F.when(metric_name(line) == F.lit(metric), parsed)


def metric_name(line) -> Column:
    return F.regexp_extract(_c(line), r"^\s*(\S+)\s*:", 1)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def read_metric_lines(spark, path: str) -> DataFrame:
    """Scan log text files and keep the lines that carry a metric."""
    lines = spark.read.text(path)
    return (lines.select(metric_name("value").alias("metric"), metric_value("value").alias("value"))
            .filter(F.col("value").isNotNull()))


#: The run that a log file belongs to: the first day in its path.
RUN_IN_PATH = r"(\d{4}-?\d{2}-?\d{2})"


def read_run_metrics(spark, path: str, run: str = RUN_IN_PATH) -> DataFrame:
    """Counts of log files, one row per run and metric (FUN14): ``run, metric, value, n_values``.

    ``run`` is a pattern whose first group names the run in a file's path; files without it are
    runs of their own (by path). Of a metric that a run logged several times the last line
    counts: of the file that was modified last, the last one in the file (by split, then by
    line), so a re-run's counts win. One scan and one partial aggregate; lines are not moved.
    """
    at = "_metadata."
    lines = spark.read.text(path).select(
        "value", F.monotonically_increasing_id().alias("row"), F.col(f"{at}file_path").alias("file"),
        F.col(f"{at}file_modification_time").alias("written"), F.col(f"{at}file_block_start").alias("split"))
    found = lines.select("row", "file", "written", "split", metric_name("value").alias("metric"), metric_value("value").alias("value"))
    key = F.coalesce(F.nullif(F.regexp_extract("file", run, 1), F.lit("")), F.col("file"))
    return (found.filter(F.col("value").isNotNull()).groupBy(key.alias("run"), "metric")
            .agg(F.max_by("value", F.struct("written", "file", "split", "row")).alias("value"),
                 F.count(F.lit(1)).alias("n_values")))
