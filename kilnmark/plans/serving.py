"""The queries behind the dashboard. "Now" is always a parameter, so answers repeat."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnmark.functions.keys import batch_key_time, running_key_time
from kilnmark.functions.timestamps import minutes_before, parse_day, wall_clock
from kilnmark.functions.values import round2, status_label
from kilnmark.operators.latest import current_row, latest_average
from kilnmark.operators.reshape import meters_to_rows, to_series
from kilnmark.schemas import DEVICE, METERS, SEGMENT_COLUMNS, STATUS

DAY_MINUTES = 24 * 60


def _minute(moment: dt.datetime) -> dt.datetime:
    return moment.replace(second=0, microsecond=0)


def rows_for_windows(sensor: DataFrame, now: dt.datetime, minutes: int = DAY_MINUTES, size_minutes: int = 60,
                     ts: str = "ts") -> DataFrame:
    """The sensor rows that windows ending in ``[now - minutes, now)`` are made of; reaches the scan."""
    first = _minute(minutes_before(now, minutes)) - dt.timedelta(minutes=size_minutes)
    return sensor.where((F.col(ts) >= wall_clock(first)) & (F.col(ts) < wall_clock(_minute(now))))


def running_avg_since(table: DataFrame, now: dt.datetime, minutes: int = DAY_MINUTES,
                      meters: Sequence[str] = METERS) -> DataFrame:
    """Keys in ``[now - minutes, now)`` at minute grain, values to two decimals."""
    in_range = ((F.col("window_end") >= wall_clock(_minute(minutes_before(now, minutes))))
                & (F.col("window_end") < wall_clock(_minute(now))))
    return table.where(in_range).select("key", *[round2(m).alias(m) for m in meters])


def batch_week(table: DataFrame, date: str) -> DataFrame:
    """The seven archive days before ``date`` (``yyyyMMdd``); the day itself is not included.

    Doubles are rounded to two decimals, everything else passes through.
    """
    day = parse_day(date)
    week = table.where((F.col("archive_day") >= F.lit(day - dt.timedelta(days=7)))
                       & (F.col("archive_day") < F.lit(day)))
    return week.select(*[round2(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                         for f in table.schema.fields])


def in_key_order(rows: DataFrame, key: str = "key") -> DataFrame:
    return rows.orderBy(key)


def newest_first(points: DataFrame, x: str = "x", ties: Sequence[str] = ("key", "series")) -> DataFrame:
    return points.orderBy(F.col(x).desc(), *ties)


def current_conditions(sensor: DataFrame, meters: Sequence[str] = METERS, status: str | None = STATUS,
                       by: Sequence[str] = DEVICE, ts: str = "ts") -> DataFrame:
    """Newest row per device: on/off label and two-decimal values."""
    values = [*([status] if status else []), *meters]
    newest = current_row(sensor, values, by, ts)
    label = [_label(sensor, status)] if status else []
    return newest.select(*by, ts, *label, *[round2(m).alias(m) for m in meters])


def _label(sensor: DataFrame, status: str):
    code = F.col(status)
    if isinstance(sensor.schema[status].dataType, T.BooleanType):
        code = code.cast("int").cast("string")
    return status_label(code).alias(status)


def current_averages(averages: DataFrame, by: Sequence[str] = DEVICE) -> DataFrame:
    """Newest average of every meter, two decimals."""
    newest = latest_average(averages, by)
    return newest.select(*by, "meter", "window_end", round2("avg").alias("avg"))


def as_items(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(key, values)``: one map per key, empty cells left out."""
    entries = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns])
    return rows.select("key", F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("values"))


def running_series(answer: DataFrame, dimension: DataFrame, meters: Sequence[str] = METERS) -> DataFrame:
    """Chart points ``(key, series, panel, x, y)`` of ``running_avg_since``; x is the minute of the key."""
    points = meters_to_rows(answer, meters, ["key"], value="y")
    return to_series(points, dimension, running_key_time("key")).select("key", "series", "panel", "x", "y")


def batch_series(week: DataFrame, dimension: DataFrame, marker: str | None = "productHumidity",
                 columns: Mapping[str, str] = SEGMENT_COLUMNS) -> DataFrame:
    """Chart points of ``batch_week``; x is the key's date with its end time."""
    named = week.select("key", *([marker] if marker else []), *[F.col(c).alias(m) for m, c in columns.items()])
    meters = [*([marker] if marker else []), *columns]
    points = meters_to_rows(named, meters, ["key"], value="y")
    return to_series(points, dimension, batch_key_time("key")).select("key", "series", "panel", "x", "y")
