"""Sliding-window averages of every meter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnmark.functions.keys import running_key
from kilnmark.functions.values import meter_message
from kilnmark.operators.reshape import meters_to_rows
from kilnmark.schemas import DEVICE, METERS

SIZE = "1 hour"
SLIDE = "30 minutes"


def running_table(
    sensor: DataFrame,
    meters: Sequence[str] = METERS,
    by: Sequence[str] = DEVICE,
    ts: str = "ts",
    size: str = SIZE,
    slide: str = SLIDE,
) -> DataFrame:
    """``(by, window_start, window_end, <meter>…)``: one row per window, one mean per meter.

    All meters share one aggregate: a row is copied once per window it falls in
    (size / slide times), not once per meter as well, and the copies are folded
    before the shuffle.
    """
    windows = (sensor.groupBy(*by, F.window(ts, size, slide).alias("w"))
               .agg(*[F.avg(m).alias(m) for m in meters]))
    return windows.select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *meters)


def running_averages(
    sensor: DataFrame,
    meters: Sequence[str] = METERS,
    by: Sequence[str] = DEVICE,
    ts: str = "ts",
    size: str = SIZE,
    slide: str = SLIDE,
) -> DataFrame:
    """The same means as rows ``(by, window_start, window_end, meter, avg)``."""
    table = running_table(sensor, meters, by, ts, size, slide)
    return meters_to_rows(table, meters, [*by, "window_start", "window_end"], value="avg")


def running_averages_of_readings(
    readings: DataFrame,
    by: Sequence[str] = DEVICE,
    ts: str = "ts",
    size: str = SIZE,
    slide: str = SLIDE,
) -> DataFrame:
    """Means over readings that are already rows of ``(by, ts, meter, value)``."""
    windows = (readings.groupBy(*by, "meter", F.window(ts, size, slide).alias("w"))
               .agg(F.avg("value").alias("avg")))
    return windows.select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          "meter", "avg")


def keyed_running_table(table: DataFrame, meters: Sequence[str] = METERS, by: Sequence[str] = DEVICE) -> DataFrame:
    """Stored form: key of the minute the window ends, key parts, one column per meter."""
    return table.select(running_key("window_end", by).alias("key"), *by, "window_end", *meters)


def average_messages(averages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep…, key, value)`` messages: the meter, and ``meter,avg`` as text."""
    return averages.select(*keep, F.col("meter").alias("key"), meter_message("meter", "avg").alias("value"))
