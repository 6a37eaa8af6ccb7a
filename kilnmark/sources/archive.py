"""Daily archives of merged rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnmark.functions.timestamps import instant, local_time
from kilnmark.schemas import DEFAULT_FACTORY, DEFAULT_OVEN, DEVICE, LAB, METERS, STATUS

PART = "archive_day"


def write_archive(rows: DataFrame, path: str, fmt: str = "parquet", part: str = PART) -> None:
    """Replace the archive days present in ``rows``, leave all others alone.

    The rebalance hint sizes the files: adaptive execution joins small days and
    splits large ones, so neither a busy day nor a busy device ends in one task.
    """
    (rows.hint("rebalance", part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .format(fmt).partitionBy(part).save(path))


def read_archive(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """One file, one folder or a glob of them; ``archive_file`` names the file of each row.

    With several archives the file (or the ``archive_day`` partition) is a
    grouping column of the analysis: no loop over files.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).withColumn("archive_file", F.col("_metadata.file_path"))


def to_records(rows: DataFrame, local: str = "ts_local", offset: str = "+00:00") -> DataFrame:
    """Merged rows in the field order of the archive record, the timestamp as ISO text."""
    text = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(offset))
    return rows.select(text.alias("timestamp"), LAB, F.col(STATUS).alias("processOn"), *METERS)


def from_records(records: DataFrame, factory: str = DEFAULT_FACTORY, oven: str = DEFAULT_OVEN,
                 keep=("archive_file",)) -> DataFrame:
    """Archive records -> merged rows with device, instant, wall clock and archive day."""
    wall = local_time("timestamp")
    return records.select(
        F.lit(factory).alias("factory_id"), F.lit(oven).alias("oven_id"), instant("timestamp").alias("ts"),
        wall.alias("ts_local"), F.to_date(wall).alias(PART), F.col(LAB).cast("double").alias(LAB),
        F.col("processOn").alias(STATUS), *[F.col(m).cast("double").alias(m) for m in METERS], *keep)


def daily_counts(rows: DataFrame, by=DEVICE, part: str = PART) -> DataFrame:
    """Rows per archive day and device."""
    return rows.groupBy(part, *by).agg(F.count(F.lit(1)).alias("n_rows"))
