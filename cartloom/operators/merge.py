"""Merging slices of a day: union, dedup, change feed, key filter (SET1, SET2,
AGG5, AGG6, FLT3).

Skew: a group of identical rows (or one subset key) may hold a large share of a
day. Distinct rows are a hash aggregate with map-side partial aggregation; the
first row per key is a window whose rows Spark cuts to one per key and task
before the shuffle. No group is gathered whole into one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.functions.timefmt import epoch_micros
from cartloom.operators.conform import ref


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union all by column name; columns missing on one side become null (SET1)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedup_all(df: DataFrame) -> DataFrame:
    """Distinct rows over all columns, nulls equal (AGG5)."""
    return df.dropDuplicates()


def drop_missing_key(df: DataFrame, key: str) -> DataFrame:
    """Keep rows whose ``key`` is present (FLT3)."""
    return df.filter(ref(key).isNotNull())


def _sort_key(df: DataFrame, name: str, descending: bool) -> Column:
    """A column whose ascending order is the wanted order of ``name``."""
    c = ref(name)
    if not descending:
        return c
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return -epoch_micros(c.cast("timestamp_ntz"))
    if isinstance(dtype, T.DateType):
        return -F.datediff(c, F.lit("1970-01-01").cast("date"))
    if isinstance(dtype, T.BooleanType):
        return -c.cast("int")
    if isinstance(dtype, T.NumericType):
        return -c
    raise TypeError(f"descending order on {dtype} is not supported by dedup_first")


def dedup_first(df: DataFrame, subset: Sequence[str],
                order: Sequence[str | tuple[str, bool]] = ()) -> DataFrame:
    """One row per ``subset`` key: the first by ``order``, then by every other
    column ascending (nulls first), so the survivor never depends on file order (AGG6).

    ``order`` items are names (ascending) or ``(name, descending)`` pairs.
    Implemented as ``row_number() = 1``, which Spark limits to one row per key and task
    before the exchange, so a hot key sends one row per task. A 64-bit digest leads
    the partition keys: rows are told apart by it almost always, without comparing
    the wide key column by column.
    """
    subset = list(subset)
    spec: list[tuple[str, bool]] = [(o, False) if isinstance(o, str) else (o[0], bool(o[1]))
                                    for o in order]
    named = [n for n, _ in spec]
    rest = [c for c in df.columns if c not in subset and c not in named]
    keys = [_sort_key(df, n, d) for n, d in spec] + [ref(c).asc_nulls_first() for c in named + rest]
    group = [F.xxhash64(*[ref(c) for c in subset]), *[ref(c) for c in subset]] if subset else [F.lit(0)]
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*keys or [F.lit(0)]))
    first = df.select("*", rank.alias("__rank")).filter(F.col("__rank") == 1)
    return first.select(*[ref(c) for c in df.columns])


def change_feed(df: DataFrame, created: str, modified: str, day_name: str = "run_date") -> DataFrame:
    """Rows created on a day union rows modified on that day, distinct, for every
    day at once (SET2).

    Each row is emitted once per distinct day among its two stamps, which equals
    ``created = D`` UNION ``modified = D`` over a snapshot, without a shuffle.
    """
    days = F.array_compact(F.array_distinct(F.array(F.to_date(ref(created)),
                                                    F.to_date(ref(modified)))))
    return df.select(F.explode(days).alias(day_name), *[ref(c) for c in df.columns])


def merge_slices(frames: Iterable[DataFrame], subset: Sequence[str] | None = None,
                 order: Sequence[str | tuple[str, bool]] = ()) -> DataFrame:
    """Union the slice tables of a day and deduplicate: all columns, or first per
    ``subset`` by ``order``."""
    merged = union_by_name(*list(frames))
    if subset is None:
        return dedup_all(merged)
    return dedup_first(merged, subset, order)
