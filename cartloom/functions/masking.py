"""Masking of personal fields (FUN1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartloom.schemas import MISSING_EMAIL_TEXT


def sha256_text(col, compat: bool = False) -> Column:
    """SHA-256 hex of the text of ``col``.

    Default: null stays null. ``compat=True`` hashes a missing value as the
    text ``nan``, as the published files do.
    """
    return F.sha2(masked_text(col, compat), 256)


def masked_text(col, compat: bool = False) -> Column:
    """The text that :func:`sha256_text` hashes."""
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.coalesce(text, F.lit(MISSING_EMAIL_TEXT)) if compat else text
