"""Keyed tables as partitioned Parquet: idempotent batch appends, last write wins on read.

A write never reads the table back. Each batch lands in its own ``batch_id``
partitions, so a repeated batch replaces itself and nothing
else, and a lost executor costs a task retry. Readers take the newest write per key;
``kilnmark.sources.compaction`` folds batches so that the choice is made once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnmark.functions.timestamps import archive_day, wall_clock
from kilnmark.operators.latest import last_write
from kilnmark.schemas import DEVICE, LAB, METERS, STATUS
from kilnmark.sources.files import Files

BATCH = "batch_id"
#: Folders beside the partitions, which Spark's readers skip: batches on their way, and the partitions of each batch.
STAGED = "_staged"
LISTS = "_batches"
DAY = "archive_day"
CELL_PARTS = (DAY, "meter")
CELL_KEYS = (*DEVICE, DAY, "meter", "minute_ts")


def append_batch(rows: DataFrame, path: str, batch_id: int, parts: Sequence[str] = (DAY,), fmt: str = "parquet",
                 sized: bool = False) -> list[str]:
    """Store one batch below ``parts`` and ``batch_id`` and return its partitions; repeated, it replaces itself.

    The rows are staged first, which tells the partitions without a second run of the plan. A list
    of these and of those of an earlier run is written ahead; then the folders are moved
    to their places, the ones that the batch no longer has are removed, and the list is cut to what
    is there. A run that breaks off anywhere leaves a list with all that the next run must replace.
    Rows are dealt out to files of good size, unless they are ``sized``: then each task writes what it has.
    """
    files = Files(rows.sparkSession, path)
    stage, note = f"{STAGED}/{BATCH}={batch_id}", f"{LISTS}/{batch_id}.json"
    files.delete(stage)
    rows = rows.drop(BATCH)
    (rows if sized else rows.hint("rebalance", *parts)).write.format(fmt).partitionBy(*parts).save(f"{path}/{stage}")
    found = files.leaves(stage, len(parts))
    if not parts and rows.sparkSession.read.format(fmt).schema(rows.schema).load(f"{path}/{stage}").isEmpty():
        found = []
    earlier = files.read_note(note) or []
    files.write_note(note, sorted({*found, *earlier}))
    for part in earlier:
        files.delete(batch_folder(part, batch_id))
    for part in found:
        files.move(f"{stage}/{part}".rstrip("/"), batch_folder(part, batch_id))
    if earlier:
        files.write_note(note, found)
    files.delete(stage)
    return found


def batch_folder(part: str, batch_id: int) -> str:
    """Where the rows of a batch in a partition are, relative to the table."""
    return f"{part}/{BATCH}={batch_id}".lstrip("/")


def read_batch(spark: SparkSession, path: str, batch_id: int, parts: Sequence[str], schema: T.StructType,
               fmt: str = "parquet") -> DataFrame | None:
    """The rows of one batch, without a look at any other folder; None if it has none. ``schema`` is that of its rows."""
    found = Files(spark, path).read_note(f"{LISTS}/{batch_id}.json")
    if not found:
        return None
    names = [f for f in schema.fields if f.name not in (*parts, BATCH)]
    whole = T.StructType([*names, *(schema[p] for p in parts), T.StructField(BATCH, T.LongType())])
    return (spark.read.format(fmt).schema(whole).option("basePath", path)
            .load([f"{path}/{batch_folder(part, batch_id)}" for part in found]))


def replace_days(rows: DataFrame, path: str, parts: Sequence[str] = (DAY,)) -> None:
    """Replace the partitions present in ``rows``: results recomputed from a whole day. All others stay."""
    (rows.hint("rebalance", *parts)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None if nothing was ever written there."""
    try:
        return read_table(spark, path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_newest(spark: SparkSession, path: str, keys: Sequence[str], values: Sequence[str],
                order: str, where: Column | None = None) -> DataFrame:
    """Newest write per key. ``where`` is applied before the choice: put partition columns in it."""
    rows = spark.read.parquet(path)
    if where is not None:
        rows = rows.where(where)
    return last_write(rows, keys, values, order)


def settle(spark: SparkSession, path: str, settled_path: str, keys: Sequence[str], values: Sequence[str],
           order: str, before: dt.date, parts: Sequence[str] = (DAY,)) -> None:
    """Copy days before ``before`` to ``settled_path`` with one row per key."""
    newest = read_newest(spark, path, keys, values, order, F.col(DAY) < F.lit(before))
    replace_days(newest, settled_path, parts)


def cells(readings: DataFrame, ts: str = "ts", order: str = "seq", by: Sequence[str] = DEVICE) -> DataFrame:
    """Readings as cells of the current-conditions table: minute grain, day and meter apart."""
    minute = F.date_trunc("minute", F.col(ts)).cast("timestamp_ntz")
    return readings.select(*by, archive_day(minute).alias(DAY), "meter", minute.alias("minute_ts"), "value", order)


def both_kinds(sensor: DataFrame, lab: DataFrame, keep: Sequence[str] = (*DEVICE, "ts", "seq"),
               meters: Sequence[str] = METERS, status: str | None = STATUS) -> DataFrame:
    """Sensor and lab events as one long feed of readings; the on/off flag becomes 1.0 or 0.0."""
    names = [*meters, *([status] if status else [])]
    wide = sensor.select(*keep, *[F.col(n).cast("double").alias(n) for n in names])
    sensor_rows = wide.unpivot(list(keep), names, "meter", "value")
    lab_rows = lab.select(*keep, F.lit(LAB).alias("meter"), F.col(LAB).alias("value"))
    return sensor_rows.unionByName(lab_rows).where(F.col("value").isNotNull())


def key_range(rows: DataFrame, start: str, stop: str, key: str = "key") -> DataFrame:
    """``start`` <= key < ``stop``, as text."""
    return rows.where((F.col(key) >= start) & (F.col(key) < stop))


def meter_days(rows: DataFrame, meter: str, first: dt.date, stop: dt.date, day: str = DAY) -> DataFrame:
    """One meter over ``[first, stop)``: only those partitions are read."""
    return rows.where((F.col("meter") == meter) & (F.col(day) >= F.lit(first)) & (F.col(day) < F.lit(stop)))


def meter_hour(rows: DataFrame, meter: str, hour: dt.datetime, factory: str | None = None, oven: str | None = None,
               minute_ts: str = "minute_ts", day: str = DAY) -> DataFrame:
    """One hour of one meter, of one device or of all: one partition, then a pushed-down time range."""
    start = hour.replace(minute=0, second=0, microsecond=0)
    stop = start + dt.timedelta(hours=1)
    rows = rows.where((F.col(day) == F.lit(start.date())) & (F.col("meter") == meter)
                      & (F.col(minute_ts) >= wall_clock(start)) & (F.col(minute_ts) < wall_clock(stop)))
    for column, value in (("factory_id", factory), ("oven_id", oven)):
        if value is not None:
            rows = rows.where(F.col(column) == value)
    return rows


def preview(rows: DataFrame, n: int = 20, order: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows as JSON text, for a look at a table (``.show()`` prints it)."""
    if order:
        rows = rows.orderBy(*order)
    return rows.limit(n).select(F.to_json(F.struct("*")).alias("record"))
