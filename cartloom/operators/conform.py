"""Conform, drop, mask, defaults, constants (PRJ3-PRJ9, FUN1).

Names may contain dots (``order_customer_info.customer_id``): every reference
goes through :func:`ref`, which back-quotes the name.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.functions.masking import sha256_text
from cartloom.schemas import PERSONALIZATION_OVERRIDE


def ref(name: str) -> Column:
    """A top-level column by exact name (dots allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def conform(df: DataFrame, columns: Iterable[str],
            types: Mapping[str, T.DataType] | None = None, cast_present: bool = False) -> DataFrame:
    """Keep, reorder and null-fill to a fixed column list (PRJ5).

    Absent columns become typed nulls (``types[name]``, else ``STRING``); columns
    not in the list are dropped. Present columns keep their type unless
    ``cast_present`` asks for ``types[name]``.
    """
    types = types or {}
    present = set(df.columns)
    out = []
    for name in columns:
        dtype = types.get(name)
        if name in present:
            c = ref(name)
            if cast_present and dtype is not None and df.schema[name].dataType != dtype:
                c = c.cast(dtype)
            out.append(c.alias(name))
        else:
            out.append(F.lit(None).cast(dtype or T.StringType()).alias(name))
    return df.select(*out)


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns, ignoring absent ones (PRJ3)."""
    dropped = set(names)
    return df.select(*[ref(c) for c in df.columns if c not in dropped])


def drop_required(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns that must exist (PRJ4); a missing one is a schema error."""
    names = list(names)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns to drop are missing: {missing}")
    return drop_columns(df, names)


def with_constant(df: DataFrame, name: str, value, dtype: T.DataType | None = None) -> DataFrame:
    """Add or override a column with a constant (PRJ6, PRJ7)."""
    c = F.lit(value)
    if dtype is not None:
        c = c.cast(dtype)
    if name in df.columns:
        return df.select(*[(c.alias(n) if n == name else ref(n)) for n in df.columns])
    return df.select(*[ref(n) for n in df.columns], c.alias(name))


def override_constant(df: DataFrame, name: str,
                      value: str = PERSONALIZATION_OVERRIDE) -> DataFrame:
    """Replace a required column's content with a constant, keeping its position
    (PRJ4 + PRJ7: drop the existing column, then set the constant)."""
    drop_required(df, [name])
    return with_constant(df, name, value, T.StringType())


def number_text(value: Column, dtype: T.DataType) -> Column:
    """The plain text of a number, as a float prints: ``100.0`` for a decimal 100.00,
    ``12345678.5`` (no exponent from 0.0001 up to 1e16); whole types as they are."""
    if isinstance(dtype, T.DecimalType):
        text = value.cast("string")
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        size = F.abs(value)
        plain = (size >= 1e-4) & (size < 1e16)
        # The shortest digits of the number, written out.
        text = F.when(plain, value.cast("string").try_cast("decimal(38,21)").cast("string")).otherwise(value.cast("string"))
    else:
        return value.cast("string")
    text = F.regexp_replace(text, r"(\.\d+?)0+$", "$1")
    return F.when(text.rlike(r"^-?\d+$"), F.concat(text, F.lit(".0"))).otherwise(text)


def as_text(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Cast chosen columns to text; null stays null (PRJ8). Numbers with a fraction print
    as :func:`number_text` does."""
    names = set(names)
    return df.select(*[number_text(ref(n), df.schema[n].dataType).alias(n) if n in names else ref(n)
                       for n in df.columns])


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Take a default where a key is missing (PRJ9): ``coalesce(col, default)``.

    Keys absent from the frame are added with the default. A ``None`` default
    leaves the column as it is.
    """
    out = []
    for n in df.columns:
        if n in defaults and defaults[n] is not None:
            d = F.lit(defaults[n]).cast(df.schema[n].dataType)
            out.append(F.coalesce(ref(n), d).alias(n))
        else:
            out.append(ref(n))
    for n, v in defaults.items():
        if n not in df.columns:
            out.append(F.lit(v).alias(n))
    return df.select(*out)


def mask_column(df: DataFrame, source: str, target: str, compat: bool = False,
                drop_source: bool = True) -> DataFrame:
    """Add ``target = sha256(source)`` and drop the clear text (FUN1 + PRJ3)."""
    masked = df.withColumn(target, sha256_text(ref(source), compat)) if source in df.columns \
        else df.withColumn(target, sha256_text(F.lit(None).cast("string"), compat))
    return drop_columns(masked, [source]) if drop_source else masked


def rename_separator(names: Iterable[str], sep: str) -> list[str]:
    """Column list with ``.`` replaced by ``sep`` (queries use ``_``; files use ``.``)."""
    return [n.replace(".", sep) for n in names]
