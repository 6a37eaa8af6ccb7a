"""Streaming sources. Every result has the columns the batch operators expect."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnmark.schemas import DEFAULT_FACTORY, DEFAULT_OVEN


def file_feed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
              glob: str | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """Files of a folder as they arrive.

    ``options`` takes the source's own settings, such as ``maxFilesPerTrigger``
    or ``latestFirst``.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.options(**(options or {})).load(path)


def topic_messages(spark: SparkSession, servers: str, topic: str, from_start: bool = False,
                   options: Mapping[str, str] | None = None, after: Mapping | None = None) -> DataFrame:
    """``(value, ingest_ts, origin, place)`` of a topic: partition and offset say where a message stands.

    It starts at the latest offsets, at the first ones, or behind the stored position ``after``
    (see ``ingest.positions``). Message keys are ignored. Needs Spark's Kafka module on the
    class path. Once started, the position is kept in the query's checkpoint.
    """
    start = "earliest" if from_start else "latest"
    if after is not None:
        start = json.dumps({topic: after["offsets"]})
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("startingOffsets", start)
            .options(**(options or {})).load()
            .select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("ingest_ts"),
                    F.col("partition").cast("string").alias("origin"), F.col("offset").alias("place")))


def file_messages(spark: SparkSession, path: str, options: Mapping[str, str] | None = None,
                  after: Mapping | None = None) -> DataFrame:
    """``(value, ingest_ts, origin, place)`` of text files with one message per line.

    A message has the time its file was written, the file, and where the stretch of the file begins that a task
    reads; within a stretch lines come in order. ``after`` is a stored position (see
    ``ingest.positions``): only files behind its time and file are read.
    """
    arrived, name = F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")
    lines = spark.readStream.format("text").options(**(options or {})).load(path)
    if after is not None:
        time = F.timestamp_micros(F.lit(after["time"]))
        lines = lines.where((arrived > time) | ((arrived == time) & (name > after["origin"])))
    return lines.select("value", arrived.alias("ingest_ts"), name.alias("origin"),
                        F.col("_metadata.file_block_start").alias("place"))


def with_device(messages: DataFrame, factory: str = DEFAULT_FACTORY, oven: str = DEFAULT_OVEN) -> DataFrame:
    """Device columns for feeds whose messages do not name their device."""
    return messages.select(F.lit(factory).alias("factory_id"), F.lit(oven).alias("oven_id"), "*")


def with_event_time(rows: DataFrame, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Watermark on the data's own time. Watermarks need TIMESTAMP, so wall-clock times are cast."""
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
