"""Row keys: built for storage order, taken apart for charts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kilnmark.functions.timestamps import _col, day_text
from kilnmark.schemas import DEVICE

# Separator and time formats of the stored keys.
SEPARATOR = "#"
MINUTE_FORMAT = "yyyyMMddHHmm"
CLOCK_FORMAT = "HHmm"
HOUR_FORMAT = "HH"


def _key(device, *parts: Column) -> Column:
    return F.concat_ws(SEPARATOR, *[_col(c) for c in device], *parts)


def cell_key(meter, ts, device=DEVICE) -> Column:
    """``factory#oven#meter#yyyyMMdd#HH``: one hour of one meter."""
    return _key(device, _col(meter), day_text(ts), F.date_format(_col(ts), HOUR_FORMAT))


def batch_key(day, start, end, device=DEVICE) -> Column:
    """``factory#oven#yyyyMMdd#HHmm#HHmm``: one segment."""
    return _key(device, day_text(day), F.date_format(_col(start), CLOCK_FORMAT),
                F.date_format(_col(end), CLOCK_FORMAT))


def running_key(ts, device=DEVICE) -> Column:
    """``factory#oven#yyyyMMddHHmm``: one minute of running averages."""
    return _key(device, F.date_format(_col(ts), MINUTE_FORMAT))


def batch_key_time(key) -> Column:
    """Date plus end time of a batch key -> TIMESTAMP_NTZ."""
    parts = F.split(_col(key), SEPARATOR)
    return F.to_timestamp_ntz(F.concat(parts[2], parts[4]), F.lit(MINUTE_FORMAT))


def running_key_time(key) -> Column:
    """Minute of a running-average key -> TIMESTAMP_NTZ."""
    return F.to_timestamp_ntz(F.split(_col(key), SEPARATOR)[2], F.lit(MINUTE_FORMAT))


def path_label(text) -> Column:
    """A name that any file system accepts: colons become underscores."""
    return F.translate(_col(text), ":", "_")
