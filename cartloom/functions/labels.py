"""Label and path helpers (FUN8-FUN11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartloom.schemas import DAY_FILE_FORMAT


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def file_safe_time(col) -> Column:
    """``HH:mm:ss`` -> ``HH_mm_ss`` so a time can sit in a file name (FUN8)."""
    return F.replace(_c(col), F.lit(":"), F.lit("_"))


def slice_label(entity: str, field, start, end) -> Column:
    """``<entity>_on_<field>_<yyyy-MM-dd>_<HH_mm_ss>_to_<HH_mm_ss>.csv`` for a slice (FUN9).

    ``field`` is a column or a literal field name; ``start`` / ``end`` are NTZ stamps.
    """
    field_col = F.lit(field) if isinstance(field, str) and not field.startswith("`") else _c(field)
    return F.format_string(
        "%s_on_%s_%s_%s_to_%s.csv",
        F.lit(entity), field_col, F.date_format(_c(start), "yyyy-MM-dd"),
        file_safe_time(F.date_format(_c(start), "HH:mm:ss")),
        file_safe_time(F.date_format(_c(end), "HH:mm:ss")),
    )


def page_label(label, page_no) -> Column:
    """Insert ``_P<page>`` before ``.csv`` (customer pages, FUN9)."""
    return F.regexp_replace(_c(label), r"\.csv$", F.format_string("_P%d.csv", _c(page_no)))


def day_file_name(entity: str, run_date) -> Column:
    """Lineage value ``<entity>_data_<run_date>.csv`` (PRJ6)."""
    return F.format_string(DAY_FILE_FORMAT, F.lit(entity), _c(run_date))


def substitute_run_date(template, run_date) -> Column:
    """Replace the ``RUN_DATE`` token of a path template (FUN10)."""
    return F.replace(_c(template), F.lit("RUN_DATE"), _c(run_date))


def path_part_from_end(path, n: int) -> Column:
    """The ``n``-th ``/``-separated part counted from the end (1 = file name) (FUN11).

    Null, not an error, when the path has fewer parts.
    """
    return F.try_element_at(F.split(_c(path), "/"), F.lit(-int(n)))
