"""The registered queries: every operator over the whole ``events`` table."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnmark.functions import (
    archive_window,
    display_time,
    is_on,
    local_time,
    message_value,
    path_label,
    round2,
    wall_clock,
)
from kilnmark.operators import (
    average_messages,
    chronological,
    chronological_rank,
    current_row,
    duplicate_rows,
    duplicate_summary,
    hour_map,
    hour_row,
    interval,
    keyed_running_table,
    markers,
    merge_sensor_lab,
    rows_to_meters,
    running_averages,
    running_averages_of_readings,
    running_table,
    segment_averages,
    segment_table,
)
from kilnmark.plans import batch, serving
from kilnmark.plans.sql_views import register_views
from kilnmark.schemas import DEVICE, LAB, METERS, RAW, SEGMENT_COLUMNS, STATUS, load_schema, series_dimension
from kilnmark.session import fresh_dir
from kilnmark.sources import archive, compaction, delimited, feeds, messages, tables
from kilnmark.sources.files import Files
from kilnmark.streaming import ingest, jobs
from kilnmark.streaming.feeds import file_feed, file_messages, with_device

EVENT_METERS = feeds.EVENT_METERS
EVENT_COLUMNS = {m: f"avg_{m}" for m in EVENT_METERS}
EVENT_SERIES = (
    (LAB, "humidity", "humidity"),
    ("click", "productTemp", "temperature"),
    ("error", "waterTemp", "temperature"),
    ("signup", "waterFlow", "water"),
    ("view", "fanIntensity", "fan"),
)
NOW = dt.datetime(2024, 1, 15, 12, 34, 56)
WEEK_OF = "20240115"


def _rounded(columns, digits: int = 6):
    return [F.round(c, digits).alias(c) for c in columns]


def _day(ts="ts"):
    return F.date_trunc("day", F.col(ts)).cast("timestamp_ntz")


def _utc(ts):
    """Instant -> wall clock in UTC, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(ts).cast("timestamp_ntz"))


def _hour(ts="ts"):
    return F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.read_events(spark, sf_dir)


def _sensor_wide(events: DataFrame) -> DataFrame:
    """Sensor rows with one column per event meter; lab events are not sensor rows."""
    rows = feeds.archive_rows(events.where(F.col("event_type") != feeds.LAB_TYPE))
    return rows.drop(LAB)


def _all_readings(events: DataFrame) -> DataFrame:
    """Sensor readings and lab values as one long feed, from one scan."""
    return feeds.readings(events, with_lab=True)


def _segment_frame(events: DataFrame, within=("archive_day",)) -> DataFrame:
    return segment_averages(feeds.archive_rows(events), EVENT_METERS, within=within)


# --- sources, parsing ------------------------------------------------------

def raw_clean_sorted(spark, sf_dir):
    """Raw ``;`` export -> cleaned, gzipped comma export in time order -> typed rows with their position."""
    raw, clean = fresh_dir(spark, "raw"), fresh_dir(spark, "clean")
    (feeds.export_rows(_events(spark, sf_dir)).select(*RAW.names)
     .write.option("sep", ";").option("header", True).csv(raw))
    rows = delimited.without_corrupt(delimited.read_raw(spark, raw))
    delimited.write_clean(rows, clean, gzip=True)
    back = delimited.with_times(delimited.without_corrupt(delimited.read_raw(spark, clean, sep=",")))
    ranked = chronological_rank(back.drop("ts").withColumnRenamed("ts_local", "ts"))
    return ranked.select("datetime", "ts", LAB, STATUS, *METERS, "position")


def export_dead_letters(spark, sf_dir):
    """Every line of an export with faults: good ones without, bad ones with a reason."""
    raw = fresh_dir(spark, "raw")
    feeds.faulty_export(_events(spark, sf_dir)).write.option("sep", ";").option("header", True).csv(raw)
    lines = delimited.read_raw(spark, raw)
    good = delimited.without_corrupt(lines).select("datetime", F.lit(None).cast("string").alias("reason"))
    dead = delimited.dead_letters(lines).select(F.split("message", ";")[0].alias("datetime"), "reason")
    return good.unionByName(dead)


def rank_with_missing_times(spark, sf_dir):
    """Positions in time of all events; errors have lost their time and have no position."""
    timed = F.when(F.col("event_type") != "error", F.col("ts")).alias("ts")
    return chronological_rank(_events(spark, sf_dir).select("event_id", timed)).select("event_id", "ts", "position")


def chronological_export(spark, sf_dir):
    """The export in time order."""
    rows = feeds.export_rows(_events(spark, sf_dir))
    return chronological(rows, "datetime", ["seq"]).select(*DEVICE, "seq", *RAW.names)


def split_sensor_lab(spark, sf_dir):
    rows = feeds.export_rows(_events(spark, sf_dir))
    sensor, lab = messages.split_export(rows, keep=[*DEVICE, "seq"])
    return (sensor.withColumn("topic", F.lit("sensor"))
            .unionByName(lab.withColumn("topic", F.lit("lab")), allowMissingColumns=True)
            .select("topic", *DEVICE, "seq", "datetime", LAB, STATUS, *METERS))


def parse_payload(spark, sf_dir):
    good, _ = messages.read_sensor(feeds.sensor_messages(_events(spark, sf_dir)), keep=[*DEVICE, "seq"])
    return good.select(*DEVICE, "seq", "datetime", _utc("ts").alias("ts"), "ts_local",
                       STATUS, *METERS)


def parse_lab_payload(spark, sf_dir):
    good, _ = messages.read_lab(feeds.lab_messages(_events(spark, sf_dir)), keep=[*DEVICE, "seq"])
    return good.select(*DEVICE, "seq", _utc("ts").alias("ts"), LAB)


def _definition(number: str) -> str:
    """A record definition of the sensor messages, numbers of the given type."""
    fields = [{"name": n, "type": "string"} for n in ("datetime", STATUS)]
    return json.dumps({"type": "record", "fields": fields + [{"name": m, "type": ["null", number]} for m in METERS]})


def loaded_schema(spark, sf_dir):
    """Sensor messages parsed by a schema from a definition file; a definition with another type is refused."""
    events = _events(spark, sf_dir)
    paths = {}
    for number in ("double", "bytes"):
        paths[number] = fresh_dir(spark, "schema")
        events.limit(1).select(F.lit(_definition(number)).alias("value")).write.text(paths[number])
    try:
        load_schema(spark, paths["bytes"])
        refused = False
    except ValueError:
        refused = True
    rows = messages.parse_messages(feeds.sensor_messages(events), load_schema(spark, paths["double"]), keep=[*DEVICE, "seq"])
    return rows.select(*DEVICE, "seq", "datetime", STATUS, *METERS, F.col(messages.BAD).isNotNull().alias("corrupt"),
                       F.lit(refused).alias("refused"))


def dead_letter(spark, sf_dir):
    _, dead = messages.read_sensor(feeds.sensor_messages(_events(spark, sf_dir)), keep=[*DEVICE, "seq"])
    return dead.select(*DEVICE, "seq", "reason", F.size(F.split("message", ",")).cast("bigint").alias("n_fields"))


def key_by_timestamp(spark, sf_dir):
    rows = messages.keyed(feeds.sensor_messages(_events(spark, sf_dir)), keep=[*DEVICE, "seq"])
    fields = F.split("payload", ",")
    return rows.select(*DEVICE, "seq", "ts_raw", is_on(fields[0]).alias("is_on"),
                       F.size(fields).cast("bigint").alias("n_fields"))


# --- reshaping, keyed table ------------------------------------------------

def unpivot_meters(spark, sf_dir):
    rows = feeds.export_rows(_events(spark, sf_dir))
    return tables.both_kinds(rows, rows, keep=[*DEVICE, "datetime", "seq"])


def current_conditions_wide(spark, sf_dir):
    return hour_row(_all_readings(_events(spark, sf_dir)))


def current_conditions_map(spark, sf_dir):
    hours = hour_map(_all_readings(_events(spark, sf_dir)))
    total = F.aggregate(F.map_values("cells"), F.lit(0.0), lambda a, v: a + v)
    return hours.select("key", F.size("cells").cast("bigint").alias("n_cells"),
                        F.array_join(F.array_sort(F.map_keys("cells")), ",").alias("minutes"),
                        F.round(total, 6).alias("total"))


def upsert_last_wins(spark, sf_dir):
    """Two batches, the first one delivered twice; the newest write of every cell."""
    path = fresh_dir(spark, "cells")
    cells = tables.cells(_all_readings(_events(spark, sf_dir)))
    early = cells.where(F.col("minute_ts") < wall_clock(NOW))
    late = cells.where(F.col("minute_ts") >= wall_clock(NOW))
    for batch_id, part in ((0, early), (1, late), (0, early)):
        tables.append_batch(part, path, batch_id, tables.CELL_PARTS)
    newest = tables.read_newest(spark, path, tables.CELL_KEYS, ["value"], "seq")
    return newest.select(*tables.CELL_KEYS, "value")


def _stored_cells(spark, sf_dir):
    path = fresh_dir(spark, "cells")
    tables.append_batch(tables.cells(_all_readings(_events(spark, sf_dir))), path, 0, tables.CELL_PARTS)
    return path


def meter_prefix_scan(spark, sf_dir):
    """One meter over some days: reads only those partitions."""
    rows = tables.read_table(spark, _stored_cells(spark, sf_dir))
    rows = tables.meter_days(rows, "click", dt.date(2024, 1, 10), dt.date(2024, 1, 15))
    return rows.select(*DEVICE, "archive_day", "meter", "minute_ts", "value", "seq")


def meter_hour_scan(spark, sf_dir):
    """Hour-grain read of one meter."""
    rows = tables.read_table(spark, _stored_cells(spark, sf_dir))
    rows = tables.meter_hour(rows, "view", dt.datetime(2024, 1, 1, 8, 30))
    return rows.select(*DEVICE, "meter", "minute_ts", "value")


def settled_days(spark, sf_dir):
    """Finished days rewritten with one row per cell."""
    path, settled = _stored_cells(spark, sf_dir), fresh_dir(spark, "settled")
    tables.settle(spark, path, settled, tables.CELL_KEYS, ["value"], "seq", NOW.date(), tables.CELL_PARTS)
    return tables.read_table(spark, settled).select(*tables.CELL_KEYS, "value")


def repeated_batch(spark, sf_dir):
    """A batch that is delivered again with its rows on other days: nothing of the first delivery stays."""
    path = fresh_dir(spark, "cells")
    cells = tables.cells(_all_readings(_events(spark, sf_dir)))
    early, late = (cells.where(test) for test in (F.col("minute_ts") < wall_clock(NOW), F.col("minute_ts") >= wall_clock(NOW)))
    moved = late.withColumns({"archive_day": F.date_add("archive_day", 40), "minute_ts": F.col("minute_ts") + F.expr("INTERVAL 40 DAYS")})
    for batch_id, part in ((0, early), (1, moved), (1, late)):
        tables.append_batch(part, path, batch_id, tables.CELL_PARTS)
    return tables.read_newest(spark, path, tables.CELL_KEYS, ["value"], "seq").select(*tables.CELL_KEYS, "value")


def _arrival(days: int):
    """The number of the delivery a row comes with: by its day, a third of the rows one delivery late."""
    late = F.when(F.col("event_id") % 3 == 0, 1).otherwise(0)
    return F.floor((F.dayofmonth("ts") - 1) / days) + late


def settled_plus_live(spark, sf_dir):
    """Cells that arrive in five batches, folded twice on the way: settled days and live batches together."""
    path = fresh_dir(spark, "cells")
    events = _events(spark, sf_dir)
    for batch_id in range(5):
        part = events.where(_arrival(8) == batch_id)
        tables.append_batch(tables.cells(_all_readings(part)), path, batch_id, tables.CELL_PARTS)
        if batch_id in (2, 3):
            compaction.compact(spark, path, compaction.CELLS)
    return compaction.read_keyed(spark, path, compaction.CELLS).select(*tables.CELL_KEYS, "value")


def _growing_averages(spark, sf_dir):
    """A table of running averages whose windows grow over three batches, the first two folded."""
    path = fresh_dir(spark, "running")
    events = _events(spark, sf_dir)
    third = F.pmod(F.col("event_id"), F.lit(3))
    for batch_id, part in enumerate((events.where(third == 0), events.where(third < 2), events)):
        rows = running_averages_of_readings(feeds.readings(part)).withColumn("day", F.to_date("window_end"))
        tables.append_batch(rows, path, batch_id, ("day",))
        if batch_id == 1:
            compaction.compact(spark, path, compaction.RUNNING, through=1)
    return path


def stored_key_range(spark, sf_dir):
    """A range of keys of the stored running averages: days, files and row groups outside are not read."""
    found = compaction.scan_keys(spark, _growing_averages(spark, sf_dir), compaction.RUNNING,
                                 "002#007#202401030000", "002#007#202401200000")
    wide = rows_to_meters(found.withColumnRenamed("avg", "value"), EVENT_METERS, ["key", "window_end"], F.max)
    return wide.select("key", "window_end", *_rounded(EVENT_METERS))


def stored_past_24h(spark, sf_dir):
    """The past day served from the stored table instead of the events."""
    first = NOW - dt.timedelta(days=1)
    table = jobs.read_running_table(spark, _growing_averages(spark, sf_dir), EVENT_METERS, first.date(), NOW.date())
    return serving.in_key_order(serving.running_avg_since(table, NOW, meters=EVENT_METERS))


def settled_running(spark, sf_dir):
    """Running averages of a stream of four micro-batches, folded after the third; the whole table."""
    source, table, checkpoint = (fresh_dir(spark, n) for n in ("source", "running", "checkpoint"))
    events = _events(spark, sf_dir)
    sink = jobs.averages_sink(table, jobs.message_files(fresh_dir(spark, "messages")))
    for k in range(4):
        events.where(F.pmod(F.col("event_id"), F.lit(4)) == k).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.running_stream_of_readings(feeds.readings(file_feed(spark, source, events.schema)), delay="60 days")
        jobs.finish(jobs.start_upserts(stream, sink, checkpoint))
        if k == 2:
            compaction.compact(spark, table, compaction.RUNNING)
    rows = jobs.read_running_table(spark, table, EVENT_METERS)
    return rows.select("key", *DEVICE, "window_end", *_rounded(EVENT_METERS))


# --- merge -----------------------------------------------------------------

def merge_day_buckets(spark, sf_dir):
    """Daily means of every meter merged with the day's highest lab value."""
    events = _events(spark, sf_dir)
    daily = feeds.readings(events).withColumn("ts", _day())
    sensor = rows_to_meters(daily, EVENT_METERS).withColumn("seq", F.lit(0))
    lab = feeds.lab_events(events).withColumn("ts", _day())
    merged = merge_sensor_lab(sensor, lab, EVENT_METERS)
    return merged.select(*DEVICE, "ts", LAB, *_rounded(EVENT_METERS))


def merge_latest_wins(spark, sf_dir):
    """Several sensor rows per bucket: the newest one wins as a whole."""
    rows = (feeds.export_rows(_events(spark, sf_dir)).withColumn("ts", local_time("datetime"))
            .withColumn("ts", _hour()).withColumn("is_on", is_on(STATUS)))
    sensor = rows.where(F.col(LAB).isNull())
    lab = rows.where(F.col(LAB).isNotNull())
    merged = merge_sensor_lab(sensor, lab, ["is_on", *METERS])
    return merged.select(*DEVICE, "ts", LAB, "is_on", *METERS)


def merge_duplicates(spark, sf_dir):
    """Events per side of every device and day."""
    events = _events(spark, sf_dir)
    sensor = feeds.readings(events).withColumn("ts", _day())
    lab = feeds.lab_events(events).withColumn("ts", _day())
    return duplicate_summary(sensor, lab)


def duplicate_events(spark, sf_dir):
    """The readings that share device and hour with another one."""
    hourly = feeds.readings(_events(spark, sf_dir)).withColumn("ts", _hour())
    return duplicate_rows(hourly).select(*DEVICE, "ts", "seq", "meter", "value", "n_rows")


# --- segments --------------------------------------------------------------

def segment_averages_daily(spark, sf_dir):
    """Flagship: averages between lab measurements, per device and archive day."""
    segments = _segment_frame(_events(spark, sf_dir))
    table = segment_table(segments, columns=EVENT_COLUMNS)
    return table.select("key", *DEVICE, "archive_day", "startTimestamp", "endTimestamp", LAB,
                        *_rounded(EVENT_COLUMNS.values()))


def segment_averages_cross_midnight(spark, sf_dir):
    segments = _segment_frame(_events(spark, sf_dir), within=())
    return segments.select(*DEVICE, "start_ts", "end_ts", LAB, "n_rows", *_rounded(EVENT_COLUMNS.values()))


def segment_shifted_archives(spark, sf_dir):
    """Archives cut at six in the morning: keys carry the date of the archive's first marker."""
    rows = feeds.archive_rows(_events(spark, sf_dir)).withColumn(
        "archive_file", F.to_date(F.col("ts") - F.expr("INTERVAL 6 HOURS")).cast("string"))
    table = batch.analyse_files(rows, EVENT_METERS, EVENT_COLUMNS, one_row_per_ts=False)
    return table.select("key", *DEVICE, "startTimestamp", "endTimestamp", LAB, *_rounded(EVENT_COLUMNS.values()))


def segment_all_files(spark, sf_dir):
    """Archive written by day, read back as a whole, analysed, stored and read back."""
    archive_path, table_path = fresh_dir(spark, "archive"), fresh_dir(spark, "segments")
    archive.write_archive(feeds.archive_rows(_events(spark, sf_dir)), archive_path)
    rows = archive.read_archive(spark, archive_path)
    result = batch.analyse_days(rows, EVENT_METERS, EVENT_COLUMNS, one_row_per_ts=False)
    tables.replace_days(result, table_path)
    stored = tables.read_table(spark, table_path)
    return stored.select("key", *DEVICE, "archive_day", "startTimestamp", "endTimestamp", LAB,
                         *_rounded(EVENT_COLUMNS.values()))


def files_reread(spark, sf_dir):
    """Record folders cut at six in the morning, analysed twice one by one, stored and read back."""
    records, table = fresh_dir(spark, "records"), fresh_dir(spark, "segments")
    rows = feeds.export_rows(_events(spark, sf_dir)).withColumn("ts_local", local_time("datetime"))
    merged = archive.to_records(rows.withColumn(STATUS, is_on(STATUS))).withColumn(
        "cut", F.to_date(F.to_timestamp_ntz(F.substring("timestamp", 1, 19)) - F.expr("INTERVAL 6 HOURS")))
    # A cut is written by several tasks, so its folder is the unit of analysis.
    merged.repartition("cut", F.pmod(F.hash("timestamp"), F.lit(4))).write.partitionBy("cut").parquet(records)
    for run in (1, 2):
        batch.run_files(spark, records, table, run, by_folder=True)
    return batch.read_segments(spark, table).select(
        "key", "archive_day", "startTimestamp", "endTimestamp", LAB, *_rounded(SEGMENT_COLUMNS.values()))


def replaced_days(spark, sf_dir):
    """Days whose lab values vanish from the archive have no segments after the next run."""
    path, table = fresh_dir(spark, "archive"), fresh_dir(spark, "segments")
    rows = feeds.archive_rows(_events(spark, sf_dir))
    archive.write_archive(rows, path)
    batch.run_daily(spark, path, table, meters=EVENT_METERS, columns=EVENT_COLUMNS)
    late = rows.where(F.col("archive_day") >= F.lit(NOW.date()))
    archive.write_archive(late.withColumn(LAB, F.lit(None).cast("double")), path)
    batch.run_daily(spark, path, table, first=NOW.date(), meters=EVENT_METERS, columns=EVENT_COLUMNS)
    return batch.read_segments(spark, table, EVENT_COLUMNS).select(
        "key", *DEVICE, "archive_day", "startTimestamp", "endTimestamp", LAB, *_rounded(EVENT_COLUMNS.values()))


def many_ovens(spark, sf_dir):
    """Segments per factory and oven."""
    return _segment_frame(_events(spark, sf_dir)).groupBy(*DEVICE).agg(
        F.count(F.lit(1)).alias("n_segments"), F.sum("n_rows").alias("n_rows"), F.max(LAB).alias("max_humidity"),
        F.round(F.avg("avg_click"), 6).alias("mean_click"))


def lab_markers(spark, sf_dir):
    """The rows that end a segment."""
    return markers(feeds.archive_rows(_events(spark, sf_dir))).select(*DEVICE, "ts", "seq", LAB)


def interval_rows(spark, sf_dir):
    """Rows whose hour is after one moment, up to and including another."""
    after, until = dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 12, 18)
    # The same hours as bounds of the stored column, which reach the scan.
    near = interval(_events(spark, sf_dir), after, until + dt.timedelta(hours=1))
    rows = interval(near.withColumn("ts", _hour()), after, until)
    return rows.select("event_id", "ts", "value")


# --- running averages ------------------------------------------------------

def _running(spark, sf_dir, **window):
    return running_averages_of_readings(feeds.readings(_events(spark, sf_dir)), **window)


def running_avg(spark, sf_dir):
    return _running(spark, sf_dir).withColumn("avg", F.round("avg", 6))


def running_avg_uneven_slide(spark, sf_dir):
    return _running(spark, sf_dir, size="15 minutes", slide="7 minutes").withColumn("avg", F.round("avg", 6))


def running_avg_of_rows(spark, sf_dir):
    """The same means from wide sensor rows."""
    return running_averages(_sensor_wide(_events(spark, sf_dir)), EVENT_METERS).withColumn("avg", F.round("avg", 6))


def _running_keyed(events):
    return keyed_running_table(running_table(_sensor_wide(events), EVENT_METERS), EVENT_METERS)


def running_avg_wide(spark, sf_dir):
    return _running_keyed(_events(spark, sf_dir)).select("key", *DEVICE, "window_end", *_rounded(EVENT_METERS))


def averages_payload(spark, sf_dir):
    """Average messages and the number read back from them."""
    averages = _running(spark, sf_dir).withColumn("avg", round2("avg"))
    sent = average_messages(averages, keep=(*DEVICE, "window_end"))
    return sent.select(*DEVICE, "window_end", F.col("key").alias("topic_key"), F.col("value").alias("payload"),
                       message_value("value").alias("parsed"))


# --- serving ---------------------------------------------------------------

def range_scan_past_24h(spark, sf_dir):
    events = serving.rows_for_windows(_events(spark, sf_dir), NOW)
    return serving.in_key_order(serving.running_avg_since(_running_keyed(events), NOW, meters=EVENT_METERS))


def range_scan_past_minutes(spark, sf_dir):
    now = NOW.replace(minute=5)
    events = serving.rows_for_windows(_events(spark, sf_dir), now, 12)
    return serving.in_key_order(serving.running_avg_since(_running_keyed(events), now, 12, EVENT_METERS))


def key_range_scan(spark, sf_dir):
    rows = tables.key_range(_running_keyed(_events(spark, sf_dir)), "002#007#202401030000", "002#007#202401200000")
    return rows.select("key", "window_end", *_rounded(EVENT_METERS))


def _week(spark, sf_dir):
    table = segment_table(_segment_frame(_events(spark, sf_dir)), columns=EVENT_COLUMNS)
    return serving.batch_week(table, WEEK_OF)


def batch_past_week(spark, sf_dir):
    return serving.in_key_order(_week(spark, sf_dir))


def current_conditions(spark, sf_dir):
    """Newest good sensor row per device, as the page shows it."""
    good, _ = messages.read_sensor(feeds.sensor_messages(_events(spark, sf_dir)), keep=[*DEVICE, "seq"])
    rows = good.drop("ts").withColumnRenamed("ts_local", "ts")
    return serving.current_conditions(rows)


def current_reading(spark, sf_dir):
    """Newest value of every device and meter."""
    return current_row(feeds.readings(_events(spark, sf_dir)), ["value", "seq"], by=(*DEVICE, "meter"))


def stored_current_averages(spark, sf_dir):
    """The newest averages served from the stored table: settled days and live batches."""
    return serving.current_averages(jobs.read_averages(spark, _growing_averages(spark, sf_dir)))


def current_averages(spark, sf_dir):
    return serving.current_averages(_running(spark, sf_dir))


def batch_series(spark, sf_dir):
    points = serving.batch_series(_week(spark, sf_dir), series_dimension(spark, EVENT_SERIES), LAB, EVENT_COLUMNS)
    return serving.newest_first(points)


def running_series(spark, sf_dir):
    events = serving.rows_for_windows(_events(spark, sf_dir), NOW)
    answer = serving.running_avg_since(_running_keyed(events), NOW, meters=EVENT_METERS)
    points = serving.running_series(answer, series_dimension(spark, EVENT_SERIES), EVENT_METERS)
    return serving.newest_first(points)


def running_items(spark, sf_dir):
    """The answer as items ``(key, {meter: value})``, spelled out per entry."""
    events = serving.rows_for_windows(_events(spark, sf_dir), NOW)
    answer = serving.running_avg_since(_running_keyed(events), NOW, meters=EVENT_METERS)
    items = serving.as_items(answer, EVENT_METERS)
    return items.select("key", F.explode("values").alias("column", "cell"))


def display_times(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", display_time("ts").alias("shown"))


# --- archive, SQL, look ----------------------------------------------------

def archive_daily_counts(spark, sf_dir):
    path = fresh_dir(spark, "archive")
    archive.write_archive(feeds.archive_rows(_events(spark, sf_dir)), path)
    counts = archive.daily_counts(archive.read_archive(spark, path))
    label = path_label(F.date_format("archive_day", "yyyy-MM-dd'T'HH:mm:ss"))
    return counts.select("archive_day", *DEVICE, "n_rows", label.alias("label"))


def archive_windows(spark, sf_dir):
    """Segments of archives cut every six hours, named by their window."""
    events = feeds.archive_rows(_events(spark, sf_dir))
    cut = events.select("*", archive_window("ts", "6 hours").alias("archive_window"))
    segments = segment_averages(cut, EVENT_METERS, within=("archive_window",))
    return segments.select(*DEVICE, "archive_window", "start_ts", "end_ts", LAB, "n_rows",
                           *_rounded(EVENT_COLUMNS.values()))


def burst_counts(spark, sf_dir):
    """Rows published per feed and hour."""
    kind = F.when(F.col("event_type") == feeds.LAB_TYPE, "lab").otherwise("sensor").alias("topic")
    return (_events(spark, sf_dir).groupBy(kind, F.window("ts", "1 hour")["start"].alias("burst"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


SQL_VIEW = """
    SELECT s.factory_id, s.oven_id, s.archive_day, count(*) AS n_segments, max(s.productHumidity) AS max_humidity,
           max(w.n_windows) AS n_windows
    FROM segments s
    JOIN (SELECT factory_id, oven_id, CAST(window_end AS DATE) AS archive_day, count(*) AS n_windows
          FROM running GROUP BY factory_id, oven_id, CAST(window_end AS DATE)) w
      ON w.factory_id = s.factory_id AND w.oven_id = s.oven_id AND w.archive_day = s.archive_day
    GROUP BY s.factory_id, s.oven_id, s.archive_day
"""


def sql_view(spark, sf_dir):
    """Plain SQL over the two analysis tables."""
    events = _events(spark, sf_dir)
    register_views(spark, {"segments": segment_table(_segment_frame(events), columns=EVENT_COLUMNS),
                           "running": _running_keyed(events)})
    return spark.sql(SQL_VIEW)


def preview(spark, sf_dir):
    counts = archive.daily_counts(feeds.archive_rows(_events(spark, sf_dir)))
    return tables.preview(counts, 20, ["archive_day", *DEVICE])


# --- streams ---------------------------------------------------------------

def _event_stream(spark, sf_dir, **options):
    schema = _events(spark, sf_dir).schema
    # The pattern covers a single file as well as a folder of part files.
    return file_feed(spark, f"{sf_dir}/events.parquet*", schema, options=options)


def _back_to_local(rows, *names):
    for name in names:
        rows = rows.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return rows


def stream_running_avg(spark, sf_dir):
    """Sliding means of a stream, every change upserted: table and messages from one result."""
    table, sent = fresh_dir(spark, "averages"), fresh_dir(spark, "messages")
    stream = jobs.running_stream_of_readings(feeds.readings(_event_stream(spark, sf_dir)))
    sink = jobs.averages_sink(table, jobs.message_files(sent))
    jobs.finish(jobs.start_upserts(stream, sink, fresh_dir(spark, "checkpoint")))
    newest = tables.read_newest(spark, table, [*DEVICE, "window_start", "window_end", "meter"], ["avg"], tables.BATCH)
    return _back_to_local(newest, "window_start", "window_end").withColumn("avg", F.round("avg", 6))


def stream_messages(spark, sf_dir):
    """Published average messages, counted per meter."""
    table, sent = fresh_dir(spark, "averages"), fresh_dir(spark, "messages")
    stream = jobs.running_stream_of_readings(feeds.readings(_event_stream(spark, sf_dir)))
    sink = jobs.averages_sink(table, jobs.message_files(sent))
    jobs.finish(jobs.start_upserts(stream, sink, fresh_dir(spark, "checkpoint")))
    messages_sent = spark.read.parquet(sent)
    return messages_sent.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_messages"), F.round(F.sum(message_value("value")), 3).alias("total"))


def stream_closed_windows(spark, sf_dir):
    """Append mode: a window comes out once, when the watermark has passed its end."""
    out = fresh_dir(spark, "closed")
    stream = jobs.running_stream(_sensor_wide(_event_stream(spark, sf_dir)), EVENT_METERS, long=False)
    query = (stream.writeStream.format("parquet").outputMode("append").option("path", out)
             .option("checkpointLocation", fresh_dir(spark, "checkpoint")).trigger(availableNow=True).start())
    jobs.finish(query)
    rows = _back_to_local(spark.read.parquet(out), "window_start", "window_end")
    return rows.select(*DEVICE, "window_start", "window_end", *_rounded(EVENT_METERS))


def stream_merge(spark, sf_dir):
    """The two feeds merged per device and day bucket, newest state of every bucket."""
    table = fresh_dir(spark, "merged")
    rows = _event_stream(spark, sf_dir).withColumn("ts", _day())
    values = ["value", "is_on"]
    sensor = (feeds.readings(rows).withColumn("is_on", F.col("seq") % 2 == 1))
    merged = jobs.merge_stream(sensor, feeds.lab_events(rows), values)
    sink = jobs.table_sink(table, ())
    jobs.finish(jobs.start_upserts(merged, sink, fresh_dir(spark, "checkpoint")))
    newest = tables.read_newest(spark, table, [*DEVICE, "ts"], [LAB, *values], tables.BATCH)
    return _back_to_local(newest, "ts")


def _streamed_archive(spark, sf_dir):
    out = fresh_dir(spark, "archive")
    rows = _event_stream(spark, sf_dir)
    sensor = _sensor_wide(rows)
    merged = jobs.merge_stream(sensor, feeds.lab_events(rows), EVENT_METERS)
    jobs.finish(jobs.start_archive(merged, out, fresh_dir(spark, "checkpoint")))
    return _back_to_local(spark.read.parquet(out), "ts")


def stream_archive(spark, sf_dir):
    """Merged rows appended to their archive day once the watermark has passed them."""
    return _streamed_archive(spark, sf_dir).select(*DEVICE, "ts", "archive_day", LAB, *EVENT_METERS)


def stream_segments(spark, sf_dir):
    """Segments of the archive days a stream has finished."""
    rows = _streamed_archive(spark, sf_dir)
    open_day = rows.agg(F.max("archive_day")).first()[0]
    closed = rows.where(F.col("archive_day") < F.lit(open_day))
    table = batch.analyse_days(closed, EVENT_METERS, EVENT_COLUMNS)
    return table.select("key", *DEVICE, "archive_day", "startTimestamp", "endTimestamp", LAB,
                        *_rounded(EVENT_COLUMNS.values()))


def stream_current(spark, sf_dir):
    """Newest reading per device and meter, kept up to date by a stream."""
    table = fresh_dir(spark, "current")
    by = (*DEVICE, "meter")
    stream = jobs.current_stream(feeds.readings(_event_stream(spark, sf_dir)), ["value", "seq"], by)
    jobs.finish(jobs.start_upserts(stream, jobs.table_sink(table, ()), fresh_dir(spark, "checkpoint")))
    return tables.read_newest(spark, table, by, ["ts", "value", "seq"], tables.BATCH)


def stream_cells(spark, sf_dir):
    """Every reading stored in its minute cell by a stream; the newest write wins."""
    table = fresh_dir(spark, "cells")
    cells = tables.cells(feeds.readings(_event_stream(spark, sf_dir), with_lab=True))
    sink = jobs.table_sink(table, tables.CELL_PARTS)
    jobs.finish(jobs.start_upserts(cells, sink, fresh_dir(spark, "checkpoint"), mode="append"))
    newest = tables.read_newest(spark, table, tables.CELL_KEYS, ["value"], "seq")
    return newest.select(*tables.CELL_KEYS, "value")


def stream_late_update(spark, sf_dir):
    """Purchases, errors and views arrive first, the rest a restart later; earlier averages are updated."""
    source, table, checkpoint = (fresh_dir(spark, n) for n in ("late-source", "averages", "checkpoint"))
    events = _events(spark, sf_dir)
    on_time = F.col("event_type").isin("purchase", "error", "view")
    schema = events.schema
    for part in (events.where(on_time), events.where(~on_time)):
        part.write.mode("append").parquet(source)
        stream = jobs.running_stream(_sensor_wide(file_feed(spark, source, schema)), EVENT_METERS,
                                     delay="60 days", long=False)
        jobs.finish(jobs.start_upserts(stream, jobs.table_sink(table, ()), checkpoint))
    newest = tables.read_newest(spark, table, [*DEVICE, "window_start", "window_end"], EVENT_METERS, tables.BATCH)
    return _back_to_local(newest, "window_start", "window_end").select(
        *DEVICE, "window_start", "window_end", *_rounded(EVENT_METERS))


# --- message feeds -----------------------------------------------------------

FIRST_WRITE = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def _write_messages(spark, events, messages, path, step):
    """Append text files of ``messages`` in the order of events, all written at the time of ``step``.

    A message that brings its own line end has only this one; another behind it would be an empty message.
    """
    files = Files(spark, path)
    before = set(files.names())
    # The events are sorted, not the longer messages, and the sample for the ranges makes no text.
    placed = events.select("event_id", "ts", "user_id", "event_type", "value").repartitionByRange("event_id").sortWithinPartitions("event_id")
    messages(placed).select(F.rtrim("value", F.lit("\r\n")).alias("value")).write.mode("append").text(path)
    for name in files.names():
        if name.startswith("part-") and name not in before:
            files.set_time(name, int((FIRST_WRITE + dt.timedelta(hours=step)).timestamp() * 1000))


class _Feeds:
    """The two message feeds as folders of files, and the tables that a stream over them fills step by step."""

    def __init__(self, spark, delay="60 days"):
        self.spark, self.delay = spark, jobs.delay_of(spark, delay)
        self.sensor, self.lab, self.tables, self.checkpoint = (fresh_dir(spark, n) for n in ("sensor", "lab", "tables", "checkpoint"))
        self.journal = f"{self.tables}/journal"

    def deliver(self, events, step):
        _write_messages(self.spark, events, feeds.sensor_messages, self.sensor, step)
        _write_messages(self.spark, events.where(F.col("event_type") == feeds.LAB_TYPE), feeds.lab_messages, self.lab, step)

    def ingest(self, journal=None, checkpoint=None, after=None, **sinks):
        """Everything delivered and not yet read, as one micro-batch; with ``after``, from a stored position on."""
        after = after or {}
        jobs.finish(ingest.start_ingest(
            with_device(file_messages(self.spark, self.sensor, after=after.get(ingest.SENSOR_FEED))),
            with_device(file_messages(self.spark, self.lab, after=after.get(ingest.LAB_FEED))),
            journal or self.journal, {name: sink(f"{self.tables}/{name}") for name, sink in sinks.items()},
            checkpoint or self.checkpoint, self.delay))

    def read(self, journal=None):
        return self.spark.read.schema(ingest.JOURNAL).parquet(journal or self.journal)


def _three_deliveries(spark, sf_dir, **sinks):
    """Messages with the hour as their time, so that many share a minute and device; a third of them comes one delivery late."""
    source = _Feeds(spark)
    events = _events(spark, sf_dir)
    for step in range(3):
        source.deliver(events.where(_arrival(16) == step).withColumn("ts", _hour()), step)
        source.ingest(**sinks)
        yield source


def _last(steps):
    *_, last = steps
    return last


def stream_message_cells(spark, sf_dir):
    """Cells of message files: of several messages in one minute the one written last wins."""
    source = _last(_three_deliveries(spark, sf_dir, cells=ingest.cell_sink))
    newest = tables.read_newest(spark, f"{source.tables}/cells", tables.CELL_KEYS, ["value"], "seq")
    return newest.select(*tables.CELL_KEYS, "value")


def stream_message_merge(spark, sf_dir):
    """Message files merged over several starts of the stream: the sensor row written last, the largest lab value."""
    table, checkpoint = fresh_dir(spark, "merged"), fresh_dir(spark, "checkpoint")
    for source in _three_deliveries(spark, sf_dir):
        merged = jobs.merged_journal(ingest.journal_feed(spark, source.journal), "60 days")
        jobs.finish(jobs.start_upserts(merged, jobs.table_sink(table, ()), checkpoint))
    values = [LAB, STATUS, *METERS]
    return _back_to_local(tables.read_newest(spark, table, [*DEVICE, "ts"], values, tables.BATCH), "ts")


def stream_current_conditions(spark, sf_dir):
    """What the page shows after three deliveries: the newest row, written last among those of its time."""
    source = _last(_three_deliveries(spark, sf_dir, current=ingest.current_sink))
    return _back_to_local(serving.current_conditions(ingest.read_current(spark, f"{source.tables}/current")), "ts")


def stream_arrival_windows(spark, sf_dir):
    """Averages over windows of the time at which messages arrived, whatever time they carry."""
    table, checkpoint = fresh_dir(spark, "averages"), fresh_dir(spark, "checkpoint")
    for source in _three_deliveries(spark, sf_dir):
        sensor = ingest.good(ingest.journal_feed(spark, source.journal), ingest.SENSOR_FEED)
        averages = jobs.running_stream(sensor, ts="ingest_ts", delay="60 days", long=False)
        jobs.finish(jobs.start_upserts(averages, jobs.table_sink(table, ()), checkpoint))
    newest = tables.read_newest(spark, table, [*DEVICE, "window_start", "window_end"], METERS, tables.BATCH)
    return _back_to_local(newest, "window_start", "window_end").select(
        *DEVICE, "window_start", "window_end", *_rounded(METERS))


def replay_from_position(spark, sf_dir):
    """A second reader starts behind the place that the first had reached after its first batch."""
    source = _last(_three_deliveries(spark, sf_dir))
    place = ingest.positions(spark, source.journal, 0)
    again = fresh_dir(spark, "journal")
    source.ingest(again, fresh_dir(spark, "checkpoint"), place)
    rows = source.read(again).where("reason IS NULL")
    return _back_to_local(rows, "ts").select("feed", "ts", F.coalesce(METERS[0], LAB).alias("value"))


def stream_late_rows(spark, sf_dir):
    """Deliveries of ten days each, a tenth of the rows one delivery late: on time and late rows together are all."""
    source = _Feeds(spark, "1 day")
    events = _events(spark, sf_dir)
    late = F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    step = F.floor((F.dayofmonth("ts") - 1) / 10) + late
    for k in range(5):
        source.deliver(events.where(step == k), k)
        source.ingest(late=ingest.late_sink)
    rows = source.read()
    kept = rows.where("reason IS NULL AND NOT late").select("feed", "ts", F.coalesce(METERS[0], LAB).alias("value"), F.lit(False).alias("late"))
    behind = spark.read.parquet(f"{source.tables}/late").select("feed", "ts", F.coalesce(METERS[0], LAB).alias("value"), F.lit(True).alias("late"))
    return _back_to_local(kept.unionByName(behind), "ts")


def stream_sized_archive(spark, sf_dir):
    """An archive that a stream fills over three starts: rows of every day, and whether its files have been joined."""
    source, out, checkpoint = (fresh_dir(spark, n) for n in ("source", "archive", "checkpoint"))
    events = _events(spark, sf_dir)
    for k in range(3):
        events.where(F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)) == k).write.mode("append").parquet(source)
        rows = file_feed(spark, source, events.schema)
        merged = jobs.merge_stream(_sensor_wide(rows), feeds.lab_events(rows), EVENT_METERS)
        jobs.finish(jobs.start_archive(merged, out, checkpoint))
    return spark.read.parquet(out).groupBy("archive_day").agg(
        F.count(F.lit(1)).alias("n_rows"), (F.max(tables.BATCH) == jobs.CLOSED).alias("closed"))


QUERIES = {
    "segment_averages": segment_averages_daily,
    "segment_averages_cross_midnight": segment_averages_cross_midnight,
    "segment_shifted_archives": segment_shifted_archives,
    "segment_all_files": segment_all_files,
    "files_reread": files_reread,
    "replaced_days": replaced_days,
    "many_ovens": many_ovens,
    "lab_markers": lab_markers,
    "interval_rows": interval_rows,
    "raw_clean_sorted": raw_clean_sorted,
    "export_dead_letters": export_dead_letters,
    "rank_with_missing_times": rank_with_missing_times,
    "chronological_export": chronological_export,
    "split_sensor_lab": split_sensor_lab,
    "parse_payload": parse_payload,
    "parse_lab_payload": parse_lab_payload,
    "loaded_schema": loaded_schema,
    "dead_letter": dead_letter,
    "key_by_timestamp": key_by_timestamp,
    "unpivot_meters": unpivot_meters,
    "merge_sensor_lab": merge_day_buckets,
    "merge_latest_wins": merge_latest_wins,
    "merge_duplicates": merge_duplicates,
    "duplicate_events": duplicate_events,
    "running_avg": running_avg,
    "running_avg_uneven_slide": running_avg_uneven_slide,
    "running_avg_of_rows": running_avg_of_rows,
    "running_avg_wide": running_avg_wide,
    "averages_payload": averages_payload,
    "current_conditions_wide": current_conditions_wide,
    "current_conditions_map": current_conditions_map,
    "upsert_last_wins": upsert_last_wins,
    "settled_days": settled_days,
    "repeated_batch": repeated_batch,
    "settled_plus_live": settled_plus_live,
    "settled_running": settled_running,
    "stored_key_range": stored_key_range,
    "stored_past_24h": stored_past_24h,
    "meter_prefix_scan": meter_prefix_scan,
    "meter_hour_scan": meter_hour_scan,
    "range_scan_past_24h": range_scan_past_24h,
    "range_scan_past_minutes": range_scan_past_minutes,
    "key_range_scan": key_range_scan,
    "batch_past_week": batch_past_week,
    "current_row": current_conditions,
    "current_reading": current_reading,
    "current_averages": current_averages,
    "stored_current_averages": stored_current_averages,
    "batch_series": batch_series,
    "running_series": running_series,
    "running_items": running_items,
    "display_time": display_times,
    "archive_daily_counts": archive_daily_counts,
    "archive_windows": archive_windows,
    "burst_counts": burst_counts,
    "sql_view": sql_view,
    "preview": preview,
    "stream_running_avg": stream_running_avg,
    "stream_messages": stream_messages,
    "stream_closed_windows": stream_closed_windows,
    "stream_merge": stream_merge,
    "stream_archive": stream_archive,
    "stream_segments": stream_segments,
    "stream_current": stream_current,
    "stream_cells": stream_cells,
    "stream_late_update": stream_late_update,
    "stream_message_cells": stream_message_cells,
    "stream_message_merge": stream_message_merge,
    "stream_current_conditions": stream_current_conditions,
    "stream_late_rows": stream_late_rows,
    "stream_arrival_windows": stream_arrival_windows,
    "stream_sized_archive": stream_sized_archive,
    "replay_from_position": replay_from_position,
}
