"""Timestamp expressions.

``instant`` is a point in time (TIMESTAMP); ``local_time`` is the wall clock
written in the data itself (TIMESTAMP_NTZ), whatever zone the session runs in.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def instant(text) -> Column:
    """ISO-8601 text with offset -> TIMESTAMP; NULL if it is not a timestamp."""
    return F.trim(_col(text)).try_cast("timestamp")


def local_time(text) -> Column:
    """Date and time as written, whatever the offset -> TIMESTAMP_NTZ; NULL if malformed."""
    return F.trim(_col(text)).try_cast("timestamp_ntz")


def day_text(column) -> Column:
    """``yyyyMMdd``."""
    return F.date_format(_col(column), "yyyyMMdd")


def archive_day(column) -> Column:
    """The day a row is archived under."""
    return F.to_date(_col(column))


def archive_window(column, width: str) -> Column:
    """Label of the fixed window a time falls in: start and end, without colons."""
    window = F.window(_col(column), width)
    bounds = [F.date_format(window[side], "yyyy-MM-dd'T'HH_mm_ss") for side in ("start", "end")]
    return F.concat_ws("--", *bounds)


def parse_day(text: str) -> dt.date:
    """``yyyyMMdd`` request parameter -> date; raises on anything else."""
    return dt.datetime.strptime(text, "%Y%m%d").date()


def minutes_before(moment: dt.datetime, minutes: int) -> dt.datetime:
    return moment - dt.timedelta(minutes=minutes)


def wall_clock(moment: dt.datetime) -> Column:
    """A Python wall-clock time as TIMESTAMP_NTZ, whatever zone Python or the session is in."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def display_time(column, zone: str = "America/New_York", source_zone: str = "UTC") -> Column:
    """Wall clock of ``zone`` for a TIMESTAMP_NTZ held in ``source_zone``."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), _col(column))
