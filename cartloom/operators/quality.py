"""Counts, reconciliation and the publish gate (AGG1-AGG4, DQ1-DQ3, JON5).

All counts are grouped aggregates (partial aggregation before the shuffle); the
audit frames have one row per day, so joining them is cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.operators.conform import ref


def _day(col) -> Column:
    return F.to_date(ref(col) if isinstance(col, str) else col)


def source_totals(records: DataFrame, created: str, modified: str,
                  day_name: str = "run_date") -> DataFrame:
    """What the service reports per day (AGG1, AGG2, N12).

    ``total_created`` / ``total_modified``: records whose stamp falls on the day;
    ``total_records``: their sum (a record created and modified that day counts
    twice, as the reference adds them); ``total_distinct``: records on the day.
    """
    c_day, m_day = _day(created), _day(modified)
    days = F.array_compact(F.array_distinct(F.array(c_day, m_day)))
    rows = records.select(F.explode(days).alias(day_name), c_day.alias("_c"), m_day.alias("_m"))
    d = F.col(day_name)
    return (rows.groupBy(day_name)
            .agg(F.count_if(F.col("_c") == d).alias("total_created"),
                 F.count_if(F.col("_m") == d).alias("total_modified"),
                 F.count(F.lit(1)).alias("total_distinct"))
            .withColumn("total_records", F.col("total_created") + F.col("total_modified")))


def day_counts(day_rows: DataFrame, day_col: str, key: str, created: str,
               modified: str) -> DataFrame:
    """Counts of a merged day file (AGG3, AGG4, FLT4-FLT6), for every day at once.

    * ``total``: non-null keys (AGG3);
    * ``created``: created on the day (FLT4);
    * ``modified``: modified on the day but not created on it; a missing creation
      stamp counts as "not created on the day" (FLT5, ``NOT (a <=> b)``);
    * ``total_modified``: created on or before the day and modified on it (FLT6).
    """
    d = F.to_date(ref(day_col))
    c, m = _day(created), _day(modified)
    return (day_rows.groupBy(ref(day_col).alias(day_col))
            .agg(F.count(ref(key)).alias("total"),
                 F.count_if(c == d).alias("created"),
                 F.count_if(~c.eqNullSafe(d) & (m == d)).alias("modified"),
                 F.count_if((c <= d) & (m == d)).alias("total_modified")))


def nonnull_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``count(*)`` and ``count(col)`` per column, one row (AGG3)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count(ref(c)).alias(f"n_{c.replace('.', '_')}") for c in cols])


RECONCILE_MODES = ("or", "and", "created")


def reconcile(source: DataFrame, files: DataFrame, day_col: str = "run_date",
              mode: str = "or") -> DataFrame:
    """Compare the service's totals with the merged files, per day (JON5, DQ1, DQ2).

    ``source``: ``day, total_created, total_modified``; ``files``: ``day, created,
    total_modified``. A day missing on one side counts as zero there.

    * ``or`` (default): pass only if created and modified counts both agree;
    * ``and`` (orders, as the reference): fail only if both disagree;
    * ``created`` (customers): pass if created counts agree.
    """
    if mode not in RECONCILE_MODES:
        raise ValueError(f"mode must be one of {RECONCILE_MODES}")
    s = source.select(ref(day_col).alias(day_col),
                      F.col("total_created").alias("source_created"),
                      F.col("total_modified").alias("source_modified"))
    f = files.select(ref(day_col).alias(day_col), F.col("created").alias("file_created"),
                     F.col("total_modified").alias("file_total_modified"))
    j = s.join(f, on=day_col, how="full_outer")
    zero = F.lit(0).cast("bigint")
    cols = {n: F.coalesce(F.col(n), zero)
            for n in ("source_created", "source_modified", "file_created", "file_total_modified")}
    created_ok = cols["source_created"] == cols["file_created"]
    modified_ok = cols["source_modified"] == cols["file_total_modified"]
    passed = {"or": created_ok & modified_ok,
              "and": created_ok | modified_ok,
              "created": created_ok}[mode]
    return j.select(ref(day_col), *[c.alias(n) for n, c in cols.items()], passed.alias("passed"))


def publish_gate(rows: DataFrame, verdicts: DataFrame, day_col: str = "run_date") -> DataFrame:
    """Rows of passing days only (DQ3): a left-semi join on the day.

    The verdict side has one row per day; Spark sizes it at run time and
    broadcasts it only when it is small.
    """
    ok = verdicts.filter(F.col("passed")).select(ref(day_col).alias(day_col))
    return rows.join(ok, on=day_col, how="left_semi")


def trigger_rows(totals: DataFrame, verdicts: DataFrame, day_col: str = "run_date",
                 total_col: str = "total_records") -> DataFrame:
    """Day-complete markers (SNK5): one per day that is empty (total 0) or passed;
    none after a mismatch. Columns: ``day, total, state``."""
    j = totals.select(ref(day_col), F.col(total_col).alias("total")) \
        .join(verdicts.select(ref(day_col), "passed"), on=day_col, how="left")
    state = (F.when(F.col("total") == 0, F.lit("empty"))
             .when(F.coalesce(F.col("passed"), F.lit(False)), F.lit("published"))
             .otherwise(F.lit("withheld")))
    return j.select(ref(day_col), F.col("total").cast("bigint").alias("total"),
                    state.alias("state")).filter(F.col("state") != "withheld")
