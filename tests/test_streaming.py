import datetime as dt

import pytest
from pyspark.sql import functions as F

from kilnmark.__main__ import main
from kilnmark.operators import running_table
from kilnmark.plans import batch, serving
from kilnmark.schemas import DEVICE, LAB, METERS, RAW
from kilnmark.sources import archive, delimited, feeds, tables
from kilnmark.streaming import jobs
from kilnmark.streaming.feeds import file_feed

SF = "/root/testdata/sf0.001"
SCHEMA = "factory_id string, oven_id string, ts timestamp_ntz, seq int, m double"
START = dt.datetime(2014, 5, 21)


def at(hours):
    return START + dt.timedelta(hours=hours)


def row(hours, seq, value):
    return ("f", "o", at(hours), seq, value)


def arrive(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def dirs(tmp_path):
    return [str(tmp_path / name) for name in ("source", "out", "checkpoint")]


def test_late_rows_update_or_drop(spark, dirs):
    """Within the delay a late row changes the earlier mean; beyond it, it is ignored."""
    source, out, checkpoint = dirs

    def advance():
        feed = file_feed(spark, source, spark.createDataFrame([], SCHEMA).schema, options={"maxFilesPerTrigger": 1})
        stream = jobs.running_stream(feed, ["m"], delay="2 hours", size="1 hour", slide="1 hour", long=False)
        jobs.finish(jobs.start_upserts(stream, jobs.table_sink(out, ()), checkpoint), 120)
        newest = tables.read_newest(spark, out, [*DEVICE, "window_start"], ["m"], tables.BATCH)
        return {r["window_start"]: r["m"] for r in newest.collect()}

    arrive(spark, [row(0.5, 1, 10.0), row(2.5, 2, 20.0)], source)
    assert advance() == {at(0): 10.0, at(2): 20.0}
    arrive(spark, [row(1.5, 3, 30.0), row(0.6, 4, 20.0)], source)  # late, still open
    assert advance() == {at(0): 15.0, at(1): 30.0, at(2): 20.0}
    arrive(spark, [row(9.5, 5, 1.0)], source)
    assert advance() == {at(0): 15.0, at(1): 30.0, at(2): 20.0, at(9): 1.0}
    arrive(spark, [row(0.7, 6, 99.0)], source)  # past the watermark
    assert advance() == {at(0): 15.0, at(1): 30.0, at(2): 20.0, at(9): 1.0}


def test_archive_appends_closed_rows_once(spark, dirs):
    source, out, checkpoint = dirs
    lab_source = source + "-lab"
    schema = spark.createDataFrame([], SCHEMA).schema

    def advance():
        sensor = file_feed(spark, source, schema)
        lab = file_feed(spark, lab_source, schema).withColumnRenamed("m", LAB)
        merged = jobs.merge_stream(sensor, lab, ["m"], delay="1 hour")
        jobs.finish(jobs.start_archive(merged, out, checkpoint), 120)
        return sorted((r["ts"], r[LAB], r["m"]) for r in spark.read.parquet(out).collect())

    arrive(spark, [row(0, 1, 1.0), row(1, 2, 2.0), row(5, 3, 3.0)], source)
    arrive(spark, [row(1, 1, 7.5)], lab_source)
    assert advance() == [(at(0), None, 1.0), (at(1), 7.5, 2.0)]
    arrive(spark, [row(30, 4, 4.0)], source)  # the lab feed stays silent
    assert advance() == [(at(0), None, 1.0), (at(1), 7.5, 2.0), (at(5), None, 3.0)]
    assert {r["archive_day"] for r in spark.read.parquet(out).collect()} == {START.date()}


def test_archive_can_be_cut_by_windows(spark, dirs):
    source, out, checkpoint = dirs
    schema = spark.createDataFrame([], SCHEMA).schema
    arrive(spark, [row(0, 1, 1.0), row(0.2, 2, 2.0), row(0.3, 3, 3.0), row(9, 4, 4.0)], source)
    lab = file_feed(spark, source, schema).where("false").withColumnRenamed("m", LAB)
    merged = jobs.merge_stream(file_feed(spark, source, schema), lab, ["m"], delay="1 hour")
    jobs.finish(jobs.start_archive(merged, out, checkpoint, width="15 minutes"), 120)
    labels = {r["archive_window"]: r["count"] for r in spark.read.parquet(out).groupBy("archive_window").count().collect()}
    assert labels == {"2014-05-21T00_00_00--2014-05-21T00_15_00": 2, "2014-05-21T00_15_00--2014-05-21T00_30_00": 1}


def test_arrival_time_windows(spark, tmp_path):
    """The same operator on the time a message arrived instead of the time it carries."""
    from kilnmark.sources.messages import read_sensor
    from kilnmark.streaming.feeds import file_messages, with_device
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    line = "2014-06-05T06:01:00-04:00,1,47.5,14.5,50.2,38.65,29.9,60.05"
    spark.createDataFrame([(line,)], "value string").write.text(source)
    rows, _ = read_sensor(with_device(file_messages(spark, source)), keep=[*DEVICE, "ingest_ts"])
    means = jobs.running_stream(rows, METERS, ts="ingest_ts", size="1 day", slide="1 day", long=False)
    jobs.finish(jobs.start_upserts(means, jobs.table_sink(out, ()), str(tmp_path / "cp")), 120)
    found = spark.read.parquet(out).first()
    assert found["window_start"].year > 2014 and found["temperatureProcess2"] == 60.05


def test_empty_batch_publishes_nothing(spark, dirs):
    _, out, sent = dirs
    frame = running_table(spark.createDataFrame([], SCHEMA), ["m"]).select(*DEVICE, "window_start", "window_end",
                                                                           F.lit("m").alias("meter"), F.col("m").alias("avg"))
    jobs.averages_sink(out, lambda batch, n: pytest.fail("published"))(frame, 0)


def test_repeated_batch_changes_nothing(spark, dirs):
    _, out, _ = dirs
    frame = running_table(spark.createDataFrame([row(0.5, 1, 10.0)], SCHEMA), ["m"])
    sink = jobs.table_sink(out, ())
    sink(frame, 3)
    sink(frame, 3)
    assert spark.read.parquet(out).count() == frame.count()


def test_progress_counts_rows(spark, dirs):
    source, out, checkpoint = dirs
    arrive(spark, [row(0.5, 1, 10.0), row(2.5, 2, 20.0)], source)
    feed = file_feed(spark, source, spark.createDataFrame([], SCHEMA).schema)
    query = jobs.start_upserts(feed, jobs.table_sink(out, ()), checkpoint, "append")
    jobs.finish(query, 120)
    assert sum(n for _, n in jobs.rows_per_batch(query)) == 2


def test_from_export_to_answers(spark, tmp_path):
    """Raw export -> clean -> messages -> streams -> daily analysis -> answers, by the command line."""
    path = {name: str(tmp_path / name) for name in (
        "raw", "clean", "sensor", "lab", "averages", "tables", "checkpoint", "segments")}
    events = feeds.read_events(spark, SF)
    export = feeds.export_rows(events).select(*RAW.names)
    export.orderBy(F.rand(1)).write.option("sep", ";").option("header", True).csv(path["raw"])

    main(["clean", "--input", path["raw"], "--output", path["clean"], "--gzip"])
    clean = delimited.read_raw(spark, path["clean"], ",")
    assert clean.count() == events.count()

    main(["split", "--input", path["clean"], "--sensor", path["sensor"], "--lab", path["lab"]])
    assert spark.read.text(path["lab"]).count() == events.where("event_type = 'purchase'").count()

    stream = ["stream", "--sensor", path["sensor"], "--lab", path["lab"], "--averages", path["averages"],
              "--tables", path["tables"], "--checkpoint", path["checkpoint"], "--once"]
    main(stream)
    main(stream)  # nothing new: nothing changes

    last = events.agg(F.max("ts")).first()[0]
    stored = archive.read_archive(spark, path["tables"] + "/archive")
    closed = events.where(F.col("ts") <= F.lit(last - dt.timedelta(hours=1)).cast("timestamp_ntz"))
    assert stored.count() == closed.count()
    assert stored.where(F.col(LAB).isNotNull()).count() == closed.where("event_type = 'purchase'").count()

    cells = tables.read_newest(spark, path["tables"] + "/cells", tables.CELL_KEYS, ["value"], "seq")
    minutes = events.select(F.date_trunc("minute", "ts")).distinct().count()
    assert cells.where(F.col("meter") == METERS[0]).count() == minutes
    assert cells.where(F.col("meter") == LAB).count() == (
        events.where("event_type = 'purchase'").select(F.date_trunc("minute", "ts")).distinct().count())

    table = jobs.read_running_table(spark, path["tables"] + "/running")
    batch_table = running_table(events.select(
        F.lit("001").alias("factory_id"), F.lit("001").alias("oven_id"), "ts", F.col("value").alias(METERS[0])), METERS[:1])
    found = {r["window_end"]: round(r[METERS[0]], 6) for r in table.collect()}
    assert found == {r["window_end"]: round(r[METERS[0]], 6) for r in batch_table.collect()}
    assert spark.read.parquet(path["averages"]).count() == len(METERS) * len(found)

    main(["daily", "--archive", path["tables"] + "/archive", "--table", path["segments"]])
    segments = tables.read_table(spark, path["segments"])
    assert segments.count() == batch.analyse_days(stored, ts="ts").count() > 0
    before = segments.count()
    main(["daily", "--archive", path["tables"] + "/archive", "--table", path["segments"],
          "--first", "2024-01-10", "--stop", "2024-01-12"])
    assert tables.read_table(spark, path["segments"]).count() == before

    now = dt.datetime(2024, 1, 15, 12, 34)
    assert serving.running_avg_since(table, now).count() == len(
        [e for e in found if now - dt.timedelta(hours=24) <= e < now])
    main(["past", "--table", path["tables"] + "/running", "--now", "2024-01-15T12:34:00", "--rows", "5"])
    main(["week", "--table", path["segments"], "--date", "20240115", "--rows", "5"])
    main(["look", "--path", path["segments"], "--rows", "2"])
