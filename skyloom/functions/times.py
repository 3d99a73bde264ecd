"""Time column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom.constants import MJD_TO_JD

# --- fixed values: header keys that may hold the time, in order of preference
TIME_KEYS = (
    ("OBSMJD", "mjd"), ("MJD-OBS", "mjd"), ("OBSJD", "jd"), ("JD-OBS", "jd"),
    ("DATE-OBS", "iso"), ("UTC-OBS", "iso"), ("OBSDATE", "iso"),
)
UNIX_EPOCH_MJD = 40587.0
DAY_MICROS = 86400e6
HALF_SECOND_DAYS = 0.5 / 86400.0


def jd_to_mjd(jd: Column) -> Column:
    """B16"""
    return jd - MJD_TO_JD


def mjd_to_jd(mjd: Column) -> Column:
    """B16"""
    return mjd + MJD_TO_JD


def wall_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a timestamp's wall clock, free of the session time zone."""
    ntz = ts.cast("timestamp_ntz")
    whole = (F.hour(ntz) * 3600 + F.minute(ntz) * 60).cast("long") * 1_000_000
    second = (F.extract(F.lit("SECOND"), ntz) * 1_000_000).cast("long")
    return F.datediff(ntz.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000_000 + whole + second


def ts_to_mjd(ts: Column) -> Column:
    return wall_micros(ts).cast("double") / DAY_MICROS + UNIX_EPOCH_MJD


def mjd_to_ts(mjd: Column) -> Column:
    micros = F.round((mjd - UNIX_EPOCH_MJD) * DAY_MICROS).cast("long")
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def get_time(header: Column, fmt: str) -> Column:
    """The first time key present in a header map, as ``mjd``, ``jd`` or ``iso``.

    Raises when a header has none of the keys.
    """
    found = []
    for key, kind in TIME_KEYS:
        raw = F.try_element_at(header, F.lit(key))
        if kind == "iso":
            found.append(ts_to_mjd(raw.try_cast("timestamp_ntz")))
        else:
            number = raw.try_cast("double")
            found.append(number if kind == "mjd" else jd_to_mjd(number))
    mjd = F.coalesce(*found, F.raise_error(F.lit("header has no time key")).cast("double"))
    if fmt == "mjd":
        return mjd
    if fmt == "jd":
        return mjd_to_jd(mjd)
    if fmt == "iso":
        return F.date_format(mjd_to_ts(mjd), "yyyy-MM-dd HH:mm:ss.SSS")
    raise ValueError(f"unknown time format {fmt!r}")


def julian_day(ts: Column) -> Column:
    """Integer Julian day of a date."""
    return F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")) + 2440588


def winsize(left: Column, right: Column) -> Column:
    """Length of a bin as a day-time interval."""
    return right - left
