"""Newest values: per cell, per device, per meter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnmark.schemas import DEVICE


def last_write(writes: DataFrame, keys: Sequence[str], values: Sequence[str], order: str = "seq") -> DataFrame:
    """One row per key: the values of the write with the largest ``order``.

    ``order`` is unique per key (an arrival number). Repeated writes fold before
    the shuffle; with fixed-width values this is plain hash aggregation.
    """
    return writes.groupBy(*keys).agg(*[F.max_by(v, order).alias(v) for v in values])


def current_row(
    sensor: DataFrame,
    values: Sequence[str],
    by: Sequence[str] = DEVICE,
    ts: str = "ts",
) -> DataFrame:
    """Newest row per device: ``(by, ts, values…)``. Rows are unique per device and ``ts``."""
    return sensor.groupBy(*by).agg(F.max(ts).alias(ts), *[F.max_by(v, ts).alias(v) for v in values])


def latest_average(averages: DataFrame, by: Sequence[str] = DEVICE) -> DataFrame:
    """Newest window of every meter: ``(by, meter, window_end, avg)``."""
    return averages.groupBy(*by, "meter").agg(
        F.max("window_end").alias("window_end"), F.max_by("avg", "window_end").alias("avg"))
