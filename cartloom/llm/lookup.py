"""Bounded lookup tables inside expressions: hashed slots in one constant array.

The number of slots is a parameter, so the constant has a proven size whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots are kept as an array of arrays of this many, so no task gathers all of them singly.
ROW = 256


def slot_array(df: DataFrame, slot: str, values: dict[str, Column], slots: int) -> Column:
    """A scalar subquery: array of arrays of structs, slot i at [i / ROW][i % ROW].

    ``df`` holds at most one row per slot; ``values`` gives the struct's fields for a slot
    (over the columns of ``df``, which are null for a slot without a row).
    """
    every = df.sparkSession.range(slots).withColumnRenamed("id", slot)
    filled = every.join(df, slot, "left").select(
        F.col(slot), F.struct(*[v.alias(k) for k, v in values.items()]).alias("v"))
    part = F.sort_array(F.collect_list(F.struct(slot, "v")))
    rows = filled.groupBy((F.col(slot) / ROW).cast("long").alias("hi")).agg(
        F.transform(part, lambda x: x["v"]).alias("vs"))
    whole = F.sort_array(F.collect_list(F.struct("hi", "vs")))
    return rows.agg(F.transform(whole, lambda x: x["vs"]).alias("model")).scalar()


def long_array(df: DataFrame, slot: str, value: Column, slots: int) -> Column:
    """A scalar subquery: one plain array of longs, slot i at [i]. ``value`` gives the long
    of a slot (over the columns of ``df``, null for a slot without a row)."""
    every = df.sparkSession.range(slots).withColumnRenamed("id", slot)
    filled = every.join(df, slot, "left").select(F.col(slot), value.alias("v"))
    part = F.sort_array(F.collect_list(F.struct(slot, "v")))
    rows = filled.groupBy((F.col(slot) / ROW).cast("long").alias("hi")).agg(
        F.transform(part, lambda x: x["v"]).alias("vs"))
    whole = F.sort_array(F.collect_list(F.struct("hi", "vs")))
    return rows.agg(F.flatten(F.transform(whole, lambda x: x["vs"])).alias("model")).scalar()


def at(model: Column, slot: Column) -> Column:
    """The struct of ``slot``."""
    return F.get(F.get(model, (F.shiftright(slot, 8)).cast("int")),
                 slot.bitwiseAND(F.lit(ROW - 1)).cast("int"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)
