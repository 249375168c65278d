"""The search request over landed or tabular data (SRC2, FLT1, FLT2, SRT1-SRT4).

``search`` reproduces one request of the service: a range filter on one stamp
field (or match-all), a sort, a page ``[start, start + count)`` and ``total``,
the number of all matches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.schemas import PAGE_SIZE
from cartloom.session import scratch_path


def ref(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _lit_ts(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def range_predicate(field: str, lo=None, hi=None, closed: bool = False) -> Column:
    """``lo <= field < hi`` (default) or ``lo <= field <= hi`` (``closed=True``, as the
    service's bare ``from`` / ``to`` bounds) (FLT1). ``None`` bounds are open."""
    col = ref(field)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (col >= _lit_ts(lo))
    if hi is not None:
        cond = cond & ((col <= _lit_ts(hi)) if closed else (col < _lit_ts(hi)))
    return cond


def range_filter(df: DataFrame, field: str, lo=None, hi=None, closed: bool = False) -> DataFrame:
    """Rows of ``df`` in the range; with neither bound this is match-all (FLT2)."""
    if lo is None and hi is None:
        return df
    return df.filter(range_predicate(field, lo, hi, closed))


#: Pages that start beyond this are found by counts of ranges, of about ``RANGE`` rows each.
DEEP, RANGE = 10_000, 100_000


def deep_page(matches: DataFrame, order: Sequence[str], start: int, count: int) -> DataFrame:
    """Rows ``[start, start + count)`` of ``matches`` in ``order``, with ``total`` (SRC2, SRT4).

    The matches are range-partitioned on all sort columns and a row id (so equal rows spread
    too) and landed with the number of their range in the shared folder. The rows of each
    range are counted, and only the ranges that hold the page are read back and sorted: a
    task sees about ``RANGE`` rows, wherever the page is. The driver holds a count per range.
    """
    spark = matches.sparkSession
    n_ranges = max(1, -(-matches.count() // RANGE))
    keys = [ref(c).asc_nulls_first() for c in order]
    ranged = (matches.withColumn("_row", F.monotonically_increasing_id())
              .repartitionByRange(n_ranges, *keys, "_row").withColumn("_range", F.spark_partition_id()))
    path = scratch_path(spark, "search-ranges")
    ranged.write.parquet(path)
    landed = spark.read.schema(ranged.schema).parquet(path)
    sizes = sorted(tuple(r) for r in landed.groupBy("_range").count().collect())
    held, before, total, stop = [], 0, 0, start + count
    for number, size in sizes:
        if total + size > start and total < stop:
            held.append(number)
        elif total + size <= start:
            before = total + size
        total += size
    # A file holds one range, so its statistics skip all other files.
    page = (landed.filter(F.col("_range").isin(held) if held else F.lit(False)).orderBy("_range", *keys, "_row")
            .offset(start - before).limit(count))
    return page.drop("_range", "_row").withColumn("total", F.lit(total).cast("bigint"))


def search(df: DataFrame, field: str | None, lo=None, hi=None, *,
           sort: Sequence[str] = ("creation_date",), start: int = 0,
           count: int = PAGE_SIZE, closed: bool = False) -> DataFrame:
    """One page of a search, with ``total`` (all matches) on every row.

    The sort is completed by the remaining atomic columns (nested ones are left
    out: sorting on whole arrays is costly) so a page is deterministic.
    ``total`` is a scalar subquery: no join and no single-partition window; the
    page is a top-(start + count) per partition (``TakeOrderedAndProject``). A page that
    starts beyond ``DEEP`` is found by :func:`deep_page` instead, so no task holds
    ``start + count`` rows.
    """
    matches = df if field is None else range_filter(df, field, lo, hi, closed)
    total = matches.select(F.count(F.lit(1))).scalar()
    atomic = [f.name for f in matches.schema.fields
              if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    order = list(sort) + [c for c in atomic if c not in sort]
    if start > DEEP:
        return deep_page(matches, order, start, count)
    page = (matches.orderBy(*[ref(c).asc_nulls_first() for c in order])
            .offset(int(start)).limit(int(count)))
    return page.withColumn("total", total)
