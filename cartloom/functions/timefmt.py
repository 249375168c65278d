"""Time functions (FUN2-FUN7, SRC7).

All stamps are ``TIMESTAMP_NTZ`` holding UTC wall clock. Every helper here is
independent of ``spark.sql.session.timeZone``: epoch seconds are read from the
clock fields with an explicit ``UTC`` zone, and shifts are NTZ plus day-time
interval arithmetic (``timestampdiff`` / ``timestampadd`` and casts to
``TIMESTAMP`` would go through the session zone).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartloom.schemas import PACIFIC


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_utc(col) -> Column:
    """ISO text (``2024-03-10T09:59:59.000Z``) -> UTC wall clock as ``TIMESTAMP_NTZ`` (FUN3).

    ``Z``, no suffix and ``+00:00`` are UTC; another offset is taken off, so
    ``2024-03-10T09:00:00-07:00`` is 16:00 UTC. Malformed text gives null.
    """
    text = F.trim(_c(col))
    offset = r"([+-])(\d{2}):?(\d{2})$"
    zoned = text.rlike(r"\d{2}:\d{2}(:\d{2}(\.\d+)?)?" + offset)
    clock = (F.when(zoned, F.regexp_replace(text, offset, ""))
             .otherwise(F.regexp_replace(text, "Z$", ""))).try_cast("timestamp_ntz")
    minutes = (F.regexp_extract(text, offset, 2).try_cast("int") * 60
               + F.regexp_extract(text, offset, 3).try_cast("int"))
    signed = F.when(F.regexp_extract(text, offset, 1) == "-", -minutes).otherwise(minutes)
    shift = F.when(zoned, signed).otherwise(F.lit(0))
    return clock - F.make_dt_interval(F.lit(0), F.lit(0), shift, F.lit(0))


def bad_stamp(col) -> Column:
    """Whether stamp text is present but cannot be parsed."""
    return _c(col).isNotNull() & parse_utc(col).isNull()


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(col) -> Column:
    """Whole seconds since 1970-01-01 of an NTZ wall clock read as UTC (FUN7).

    Integer arithmetic on the clock fields (days since the epoch, hour, minute,
    second), which read an NTZ value without any zone, so a DST gap of the
    session zone cannot shift it (``timestampdiff`` on NTZ would).
    """
    c = _c(col)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def epoch_micros(col) -> Column:
    """Microseconds since 1970-01-01 (UTC reading of the wall clock)."""
    return epoch_seconds(col) * 1000000 + F.date_format(_c(col), "SSSSSS").cast("bigint")


def _interval_seconds(seconds) -> Column:
    """A day-time interval of ``seconds`` (a column or an int)."""
    n = seconds if isinstance(seconds, Column) else F.lit(int(seconds))
    days = F.floor(n / F.lit(86400)).cast("int")
    rest = (n - days.cast("bigint") * 86400).cast("decimal(18,6)")
    return F.make_dt_interval(days=days, secs=rest)


def from_epoch_seconds(col) -> Column:
    """Inverse of :func:`epoch_seconds`, as ``TIMESTAMP_NTZ``."""
    return _epoch() + _interval_seconds(_c(col))


def add_seconds(col, seconds) -> Column:
    """``ts + seconds`` (FUN7); NTZ plus a day-time interval is zone-free."""
    return _c(col) + _interval_seconds(seconds)


def seconds_between(start, end) -> Column:
    """``end - start`` in whole seconds of the two stamps (FUN7)."""
    return epoch_seconds(end) - epoch_seconds(start)


def floor_to(col, width_seconds: int) -> Column:
    """Start of the ``width_seconds`` bucket holding ``col`` (epoch aligned).

    For widths dividing a day this is midnight plus the floored time of day: a
    small expression on the clock fields, free of any zone.
    """
    w = int(width_seconds)
    c = _c(col)
    if 86400 % w == 0:
        tod = F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
        start = tod - F.pmod(tod, F.lit(w)) if w > 1 else tod
        return F.to_date(c).cast("timestamp_ntz") + F.make_dt_interval(
            secs=start.cast("decimal(18,6)"))
    secs = epoch_seconds(c)
    return from_epoch_seconds(secs - F.pmod(secs, F.lit(w)))


def to_pacific(col, zone: str = PACIFIC) -> Column:
    """UTC wall clock -> US Pacific wall clock with DST (FUN4), stays NTZ."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(col))


def utc_offset_minutes(col, zone: str = PACIFIC) -> Column:
    """Offset of ``zone`` from UTC at instant ``col``, in minutes (-480 or -420)."""
    diff = epoch_seconds(to_pacific(col, zone)) - epoch_seconds(col)
    return F.floor(diff / F.lit(60)).cast("int")


def pacific_text(col, zone: str = PACIFIC) -> Column:
    """Pacific wall time printed with its offset, e.g. ``2024-03-10 03:00:00-07:00`` (FUN5).

    A fractional second is printed (6 digits) only when it is not zero; null in,
    null out (``concat`` of a null). Kept free of conditional wrappers so the
    zone conversion is computed once per row (common-subexpression elimination
    does not reach into conditional branches).
    """
    local = to_pacific(col, zone)
    off = utc_offset_minutes(col, zone)
    stamp = F.date_format(local, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = F.regexp_replace(stamp, r"\.000000$", "")
    sign = F.substring(F.lit("-+"), (F.signum(off) >= 0).cast("int") + 1, 1)
    hh = F.lpad(F.floor(F.abs(off) / 60).cast("string"), 2, "0")
    mm = F.lpad(F.pmod(F.abs(off), F.lit(60)).cast("string"), 2, "0")
    return F.concat(text, sign, hh, F.lit(":"), mm)


def day_text(col) -> Column:
    """``yyyy-MM-dd`` of a stamp or date (FUN2, FUN6)."""
    return F.date_format(_c(col), "yyyy-MM-dd")


def run_date_text(col) -> Column:
    """``yyyyMMdd`` run-date form of a stamp or date (FUN2)."""
    return F.date_format(_c(col), "yyyyMMdd")


def parse_run_date(col) -> Column:
    """``yyyyMMdd`` text -> DATE (FUN2); malformed text gives null."""
    return F.try_to_date(_c(col), "yyyyMMdd")


def default_run_date(as_of=None) -> Column:
    """The day to load when none is given: the day before ``as_of`` (today) (SRC7)."""
    return F.date_sub(F.current_date() if as_of is None else F.to_date(_c(as_of)), 1)


def day_start(day_col) -> Column:
    """Midnight (NTZ) of a DATE or ``yyyy-MM-dd`` text column."""
    return F.to_date(_c(day_col)).cast("timestamp_ntz")


def utc_text(col) -> Column:
    """UTC wall clock printed as the service sends it: ``2024-03-10T09:59:59.000Z``."""
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def published_stamps(df, pairs) -> "DataFrame":  # noqa: F821 - DataFrame in annotations only
    """Stamps as the published files print them: each ``(utc, pacific)`` pair
    becomes ISO UTC text and Pacific text with its offset (FUN5), in place.
    Applied at the sink only; tables stay typed before it."""
    cols = {}
    for utc, pst in pairs:
        if utc in df.columns:
            cols[utc] = utc_text(F.col(f"`{utc}`"))
            if pst in df.columns:
                cols[pst] = pacific_text(F.col(f"`{utc}`"))
    return df.select(*[(cols[c].alias(c) if c in cols else F.col(f"`{c}`")) for c in df.columns])
