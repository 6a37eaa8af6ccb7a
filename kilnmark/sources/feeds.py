"""Both feeds as views over an ``events`` table.

``events(event_id, ts, user_id, event_type, value)`` carries readings of many
devices in arrival order. One event type plays the lab measurement, the others
are meters; ``user_id`` is the oven.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnmark.functions.values import zero_pad
from kilnmark.schemas import LAB, METERS, STATUS

LAB_TYPE = "purchase"
EVENT_METERS = ("click", "error", "signup", "view")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def device_columns() -> list[Column]:
    return [zero_pad(F.col("user_id") % 3 + 1).alias("factory_id"), zero_pad("user_id").alias("oven_id")]


def readings(events: DataFrame, with_lab: bool = False) -> DataFrame:
    """Readings, long: ``(device, ts, seq, meter, value)``; lab values too if asked, as one more meter."""
    meter = F.col("event_type")
    if with_lab:
        meter = F.when(meter == LAB_TYPE, LAB).otherwise(meter)
    else:
        events = events.where(meter != LAB_TYPE)
    return events.select(*device_columns(), "ts", F.col("event_id").alias("seq"), meter.alias("meter"), "value")


def lab_events(events: DataFrame) -> DataFrame:
    """Lab measurements: ``(device, ts, seq, productHumidity)``."""
    return events.where(F.col("event_type") == LAB_TYPE).select(
        *device_columns(), "ts", F.col("event_id").alias("seq"), F.col("value").alias(LAB))


def archive_rows(events: DataFrame) -> DataFrame:
    """Merged rows, one per event: archive day, lab value and one column per meter."""
    kind = F.col("event_type")
    return events.select(
        *device_columns(), "ts", F.to_date("ts").alias("archive_day"), F.col("event_id").alias("seq"),
        F.when(kind == LAB_TYPE, F.col("value")).alias(LAB),
        *[F.when(kind == m, F.col("value")).alias(m) for m in EVENT_METERS])


def status_code() -> Column:
    """The on/off flag as text, ``1`` or ``0``."""
    return (F.col("event_id") % 2).cast("string")


def _time_text() -> Column:
    return F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def export_rows(events: DataFrame) -> DataFrame:
    """Rows in the shape of the raw export (device columns first).

    The six meters are the event value plus their position; the lab value is
    set on lab events only.
    """
    return events.select(
        *device_columns(), F.col("event_id").alias("seq"), _time_text().alias("datetime"),
        F.when(F.col("event_type") == LAB_TYPE, F.col("value")).alias(LAB), status_code().alias(STATUS),
        *[(F.col("value") + i).alias(m) for i, m in enumerate(METERS)])


def faulty_export(events: DataFrame) -> DataFrame:
    """The raw export as text; a ``signup`` above 200 has a bad timestamp, a ``view`` below 5 bad numbers."""
    kind, value = F.col("event_type"), F.col("value")
    time = F.when((kind == "signup") & (value > 200), F.lit("not-a-time")).otherwise(_time_text())
    broken = (kind == "view") & (value < 5)
    return events.select(
        time.alias("datetime"), F.when(kind == LAB_TYPE, value).alias(LAB), status_code().alias(STATUS),
        *[F.when(broken, F.lit("n/a")).otherwise((value + i).cast("string")).alias(m) for i, m in enumerate(METERS)])


def sensor_messages(events: DataFrame) -> DataFrame:
    """Comma messages of the sensor feed, with the faults a feed has.

    An ``error`` event has an empty sensor block, a ``signup`` above 200 a bad
    timestamp, and a ``view`` below 5 text where a number belongs.
    """
    kind, value = F.col("event_type"), F.col("value")
    broken_time = (kind == "signup") & (value > 200)
    broken_number = (kind == "view") & (value < 5)
    fields = [F.when(broken_time, F.lit("not-a-time")).otherwise(_time_text()), status_code()]
    fields += [F.when(kind == "error", F.lit("")).when(broken_number, F.lit("n/a"))
               .otherwise((value + i).cast("string")) for i, _ in enumerate(METERS)]
    return events.select(*device_columns(), F.col("event_id").alias("seq"),
                         F.concat(F.concat_ws(",", *fields), F.lit("\r\n")).alias("value"))


def lab_messages(events: DataFrame) -> DataFrame:
    """Comma messages of the lab feed."""
    return events.where(F.col("event_type") == LAB_TYPE).select(
        *device_columns(), F.col("event_id").alias("seq"),
        F.concat_ws(",", _time_text(), F.col("value").cast("string")).alias("value"))
