"""Streaming jobs: running averages, merge, archive, current rows.

The transformations are the batch operators; what is specific to streams is
the watermark, the output mode and the sink. Feeds are read by ``ingest``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kilnmark.functions.timestamps import archive_window
from kilnmark.operators.latest import current_row
from kilnmark.operators.merge import both_feeds, merge_events
from kilnmark.operators.reshape import rows_to_meters
from kilnmark.operators.running import (
    SIZE,
    SLIDE,
    average_messages,
    keyed_running_table,
    running_averages,
    running_averages_of_readings,
    running_table,
)
from kilnmark.schemas import DEVICE, LAB, METERS, STATUS
from kilnmark.session import adaptive_sink
from kilnmark.sources.compaction import RUNNING, read_keyed
from kilnmark.sources.files import Files
from kilnmark.sources.tables import BATCH, LISTS, append_batch, read_batch
from kilnmark.streaming import ingest
from kilnmark.streaming.feeds import with_device, with_event_time

DELAY = "1 hour"
#: What an average message says beside its key and value.
MESSAGE_NAMES = (*DEVICE, "window_end")


# --- transformations -------------------------------------------------------

def running_stream(sensor: DataFrame, meters: Sequence[str] = METERS, by: Sequence[str] = DEVICE, ts: str = "ts",
                   size: str = SIZE, slide: str = SLIDE, delay: str = DELAY, long: bool = True) -> DataFrame:
    """Sliding means of a wide sensor stream, as rows per meter or one row per window."""
    timed = with_event_time(sensor, ts, delay)
    operator = running_averages if long else running_table
    return operator(timed, meters, by, ts, size, slide)


def running_stream_of_readings(readings: DataFrame, by: Sequence[str] = DEVICE, ts: str = "ts", size: str = SIZE,
                               slide: str = SLIDE, delay: str = DELAY) -> DataFrame:
    return running_averages_of_readings(with_event_time(readings, ts, delay), by, ts, size, slide)


def merge_stream(sensor: DataFrame, lab: DataFrame, values: Sequence[str] = METERS, by: Sequence[str] = DEVICE,
                 ts: str = "ts", order: str = "seq", marker: str = LAB, delay: str = DELAY,
                 shared: Sequence[str] = ()) -> DataFrame:
    """Sensor and lab events merged on device and timestamp.

    The union comes before the watermark: an idle lab feed then does not hold
    back the output, as it would with two watermarks. State is one row per
    device and timestamp, for as long as the delay.
    """
    both = with_event_time(both_feeds(sensor, lab, values, by, ts, order, marker, shared), ts, delay)
    return merge_events(both, values, by, ts, order, marker, shared)


def current_stream(sensor: DataFrame, values: Sequence[str] = METERS, by: Sequence[str] = DEVICE,
                   ts: str = "ts") -> DataFrame:
    """Newest row per device, for update mode. State is one row per device."""
    return current_row(sensor, values, by, ts)


# --- sinks -----------------------------------------------------------------

def table_sink(path: str, parts: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Store every micro-batch in a keyed table; a repeated batch replaces itself."""
    def store(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, path, batch_id, parts)
    return store


def averages_sink(table_path: str, publish: Callable[[DataFrame, int], None], day: str = "day",
                  ) -> Callable[[DataFrame, int], None]:
    """Two outputs of one result: the averages table, then messages built from what was stored.

    Reading the stored batch back keeps the stateful plan from running twice. Beside key and
    value a message says its device and when its window ended.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(day, F.to_date("window_end"))
        append_batch(rows, table_path, batch_id, (day,))
        # Only this batch's folders are listed, however long the table is.
        stored = read_batch(batch.sparkSession, table_path, batch_id, (day,), rows.schema)
        if stored is not None:  # else nothing changed in this batch
            publish(average_messages(stored, MESSAGE_NAMES), batch_id)
    return store


def message_files(path: str) -> Callable[[DataFrame, int], None]:
    """Publish ``(factory_id, oven_id, window_end, key, value)`` messages as files, one folder per batch."""
    def publish(messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
    return publish


def with_headers(messages: DataFrame, names: Sequence[str] = MESSAGE_NAMES) -> DataFrame:
    """``(key, value, headers)``: what a topic takes; the other columns become headers."""
    headers = [F.struct(F.lit(n).alias("key"), F.col(n).cast("string").cast("binary").alias("value")) for n in names]
    return messages.select("key", "value", F.array(*headers).alias("headers"))


def message_topic(servers: str, topic: str) -> Callable[[DataFrame, int], None]:
    """Publish messages to a topic, device and window end as headers (needs Spark's Kafka module)."""
    def publish(messages: DataFrame, batch_id: int) -> None:
        (with_headers(messages).write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).option("includeHeaders", "true").save())
    return publish


# --- archive in sized files ----------------------------------------------------

_NOTE, _CLOSING, _OLD = "_progress.json", "_closing", "_old"
#: Where a closed part has its rows.
CLOSED = -1


def archive_sink(path: str, part: str, label: Callable[[Column], Column], ts: str = "ts",
                 fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Append rows that the watermark has passed to their ``part``; rewrite parts that are over in files of good size.

    A part is over when a row more than a day behind its end has come out, so that wall clocks of any zone
    are over too. Its small files, one or more per trigger, are replaced by few, cut by size: the new folder
    is written beside the archive, then two renames put it in place of the old one. A note says which rows and
    parts are done, so that a batch that is repeated after a failure goes on where it broke off.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark, files = batch.sparkSession, Files(batch.sparkSession, path)
        _swap(files)
        note = files.read_note(_NOTE) or {"batch": -1, "newest": None, "open": []}
        if note["batch"] < batch_id:
            found = append_batch(batch, path, batch_id, (part,), fmt)
            rows = read_batch(spark, path, batch_id, (part,), batch.schema, fmt)
            newest = [] if rows is None else [rows.agg(F.unix_micros(F.max(F.col(ts).cast("timestamp")))).first()[0]]
            note = {"batch": batch_id, "newest": max([n for n in (*newest, note["newest"]) if n is not None], default=None),
                    "open": sorted({*note["open"], *found})}
            files.write_note(_NOTE, note)
        else:  # its rows are stored, but the state behind them is only kept if they are read
            batch.write.format("noop").mode("overwrite").save()
        if note["newest"] is None:
            return
        yesterday = F.timestamp_micros(F.lit(note["newest"])) - F.expr("INTERVAL 1 DAY")
        bound = f"{part}={spark.range(1).select(label(yesterday).cast('string')).first()[0]}"
        over = [p for p in note["open"] if p < bound]
        if over:
            _close(spark, files, path, part, over, fmt)
            _swap(files)
            note["open"] = [p for p in note["open"] if p not in over]
            files.write_note(_NOTE, note)
            _forget_lists(files, batch_id, note["open"])
    return store


def _close(spark: SparkSession, files: Files, path: str, part: str, over: Sequence[str], fmt: str) -> None:
    """Write the parts that are over once more, sized; then note that they may take their places."""
    files.delete(_CLOSING)
    rows = spark.read.format(fmt).option("basePath", path).load([f"{path}/{p}" for p in over]).drop(BATCH)
    # A partition value that looks like a number must come back as it was written.
    rows.withColumn(part, F.col(part).cast("string")).hint("rebalance", part).write.format(fmt).partitionBy(part).save(f"{path}/{_CLOSING}")
    files.write_note(f"{_CLOSING}/{_NOTE}", list(over))


def _swap(files: Files) -> None:
    """Put written parts in their places; a run that broke off in between is brought to its end."""
    for folder in files.read_note(f"{_CLOSING}/{_NOTE}") or []:
        if files.exists(f"{_CLOSING}/{folder}"):
            if files.exists(folder):
                files.move(folder, f"{_OLD}/{folder}")
            files.move(f"{_CLOSING}/{folder}", f"{folder}/{BATCH}={CLOSED}")
    files.delete(_CLOSING)
    files.delete(_OLD)


def _forget_lists(files: Files, batch_id: int, open_parts: Sequence[str]) -> None:
    """Remove the lists of earlier batches whose parts are all over."""
    for name in files.names(LISTS):
        if name.endswith(".json") and int(name.removesuffix(".json")) < batch_id:
            if not set(files.read_note(f"{LISTS}/{name}")) & set(open_parts):
                files.delete(f"{LISTS}/{name}")


# --- running a query -------------------------------------------------------

def start_upserts(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "update", trigger: dict | None = None) -> StreamingQuery:
    """Feed changed rows to ``sink``. ``trigger`` defaults to everything available now."""
    return (stream.writeStream.foreachBatch(adaptive_sink(sink)).outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def start_archive(merged: DataFrame, path: str, checkpoint: str, day_of: str = "ts", fmt: str = "parquet",
                  trigger: dict | None = None, width: str | None = None) -> StreamingQuery:
    """Append rows the watermark has passed, under the day of ``day_of``; finished days get files of good size.

    With ``width`` the archive is cut into windows of that length instead, under
    their ``archive_window`` label.
    """
    part = "archive_day" if width is None else "archive_window"

    def label(time: Column) -> Column:
        return F.to_date(time) if width is None else archive_window(time, width)

    rows = merged.select("*", label(F.col(day_of)).alias(part))
    return start_upserts(rows, archive_sink(path, part, label, fmt=fmt), checkpoint, "append", trigger)


def finish(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for a query that ends by itself, however long it takes; with a ``timeout``, stop it and raise."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"streaming query {query.id} still running after {timeout} s")


def rows_per_batch(query: StreamingQuery) -> list[tuple[int, int]]:
    """(batch, input rows) of the recent progress reports."""
    return [(p["batchId"], p["numInputRows"]) for p in query.recentProgress]


# --- all branches ----------------------------------------------------------

def delay_of(spark: SparkSession, delay: str) -> dt.timedelta:
    """An interval as text, in the words that watermarks take."""
    micros = spark.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {delay}"))).first()[0]
    return dt.timedelta(microseconds=micros)


def merged_journal(rows: DataFrame, delay: str = DELAY) -> DataFrame:
    """Good rows of the journal that were not late, sensor and lab merged on device and time."""
    kept = rows.where(F.col("reason").isNull() & ~F.col("late"))
    # Sensor rows win by their number; a lab row has none, so it never decides about sensor values.
    events = kept.withColumn("seq", F.when(F.col("feed") == ingest.SENSOR_FEED, F.col("seq")))
    return merge_events(with_event_time(events, "ts", delay), [STATUS, *METERS], shared=["ts_local"])


def start_all(sensor_messages: DataFrame, lab_messages: DataFrame, tables_path: str,
              publish: Callable[[DataFrame, int], None], checkpoint: str, delay: str = DELAY, size: str = SIZE,
              slide: str = SLIDE, trigger: dict | None = None) -> list[StreamingQuery]:
    """Message feeds -> journal, cells, current rows, dead letters, late rows; archive, running averages with messages.

    One query reads and parses the feeds into the journal and serves the sinks without state. The
    archive and the averages are queries of their own over the journal's rows that were not late,
    each with its checkpoint, so one that fails or falls behind does not hold up the others. With
    ``availableNow`` they begin when the journal is complete. Events are compared by instant;
    the archive keeps their wall clock too and is cut by its days.
    """
    spark, trigger = sensor_messages.sparkSession, trigger or {"availableNow": True}
    journal = f"{tables_path}/journal"
    sinks = {"cells": ingest.cell_sink(f"{tables_path}/cells"), "current": ingest.current_sink(f"{tables_path}/current"),
             "dead": ingest.dead_letter_sink(f"{tables_path}/dead_letters"), "late": ingest.late_sink(f"{tables_path}/late")}
    first = ingest.start_ingest(with_device(sensor_messages), with_device(lab_messages), journal, sinks,
                                f"{checkpoint}/journal", delay_of(spark, delay), trigger)
    if trigger.get("availableNow"):
        finish(first)
    merged = merged_journal(ingest.journal_feed(spark, journal), delay)
    sensor = ingest.good(ingest.journal_feed(spark, journal), ingest.SENSOR_FEED, late=False)
    averages = running_stream(sensor, size=size, slide=slide, delay=delay)
    return [
        first,
        start_archive(merged, f"{tables_path}/archive", f"{checkpoint}/archive", "ts_local", trigger=trigger),
        start_upserts(averages, averages_sink(f"{tables_path}/running", publish), f"{checkpoint}/running", "update",
                      trigger),
    ]


def read_averages(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The stored running averages as rows, newest value per window and meter; settled days and live batches."""
    newest = read_keyed(spark, path, RUNNING, first, last)
    if newest is None:
        raise FileNotFoundError(f"no running averages at {path}")
    return newest.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


def read_running_table(spark: SparkSession, path: str, meters: Sequence[str] = METERS,
                       first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The stored running averages: newest value per window and meter, one column per meter, keyed.

    ``first`` and ``last`` are the days to read, both included; other partitions are skipped.
    """
    newest = read_averages(spark, path, first, last)
    wide = rows_to_meters(newest.withColumnRenamed("avg", "value"), meters, [*DEVICE, "window_end"], F.max)
    return keyed_running_table(wide, meters)
