"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnmark.functions.keys import cell_key
from kilnmark.schemas import DEVICE, METERS

# One column per minute of the hour.
MINUTES = [f"{minute:02d}" for minute in range(60)]


def meters_to_rows(
    table: DataFrame,
    meters: Sequence[str] = METERS,
    ids: Sequence[str] = (*DEVICE, "ts"),
    value: str = "value",
) -> DataFrame:
    """One row per meter that has a value: ``(ids, meter, value)``. No shuffle."""
    columns = [F.col(m).cast("double").alias(m) for m in meters]
    return (table.select(*ids, *columns)
            .unpivot(list(ids), list(meters), "meter", value)
            .where(F.col(value).isNotNull()))


def rows_to_meters(
    readings: DataFrame,
    meters: Sequence[str] = METERS,
    ids: Sequence[str] = (*DEVICE, "ts"),
    aggregate=F.avg,
) -> DataFrame:
    """One column per meter: ``(ids, <meter>…)``, in a single aggregation."""
    return readings.groupBy(*ids).agg(*[
        aggregate(F.when(F.col("meter") == m, F.col("value"))).alias(m) for m in meters])


def hour_row(
    readings: DataFrame,
    by: Sequence[str] = DEVICE,
    ts: str = "ts",
    order: str = "seq",
) -> DataFrame:
    """``(key, 00 … 59)``: one row per meter and hour; the last write of a minute wins.

    The pivot first reduces to one value per minute (folded before its shuffle),
    then places at most sixty values per key. Keys are spelled out at the end,
    once per hour instead of once per reading. Hours and minutes are those of
    the session zone.
    """
    hour, minute = F.date_trunc("hour", F.col(ts)), F.date_format(F.col(ts), "mm")
    rows = (readings.select(*by, "meter", hour.alias("hour"), minute.alias("minute"), "value", order)
            .groupBy(*by, "meter", "hour").pivot("minute", MINUTES).agg(F.max_by("value", order)))
    return rows.select(cell_key("meter", "hour", by).alias("key"), *MINUTES)


def hour_map(
    readings: DataFrame,
    by: Sequence[str] = DEVICE,
    ts: str = "ts",
    order: str = "seq",
) -> DataFrame:
    """Compact form of ``hour_row``: ``(key, cells)`` with a map of the minutes present.

    Its list holds at most sixty entries, because cells are unique by then.
    """
    minute_start = F.date_trunc("minute", F.col(ts)).alias("minute_ts")
    cells = readings.groupBy(*by, "meter", minute_start).agg(F.max_by("value", order).alias("value"))
    entry = F.struct(F.date_format("minute_ts", "mm").alias("minute"), F.col("value"))
    hours = (cells.groupBy(*by, "meter", F.date_trunc("hour", F.col("minute_ts")).alias("hour"))
             .agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("cells")))
    return hours.select(cell_key("meter", "hour", by).alias("key"), "cells")


def to_series(points: DataFrame, dimension: DataFrame, x: Column) -> DataFrame:
    """Chart points: ``(ids…, series, panel, x, y)`` from rows with ``meter`` and ``y``.

    ``dimension`` is built from a fixed list of meters, so broadcasting it is safe.
    """
    return points.withColumn("x", x).join(F.broadcast(dimension), "meter")
