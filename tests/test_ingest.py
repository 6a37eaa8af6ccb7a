"""Message feeds through the journal: order of writes, sinks that fail, late rows, positions, sized archives."""

import datetime as dt
import glob
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from kilnmark.__main__ import main
from kilnmark.schemas import DEVICE, LAB, METERS, STATUS
from kilnmark.sources import compaction, tables
from kilnmark.sources.files import Files
from kilnmark.streaming import ingest, jobs
from kilnmark.streaming.feeds import file_messages, with_device

HOUR = dt.timedelta(hours=1)
T0 = dt.datetime(2024, 1, 1)
FIRST = METERS[0]


def sensor(hours, value, status="1"):
    time = (T0 + hours * HOUR).isoformat(timespec="seconds")
    return ",".join([f"{time}+00:00", status, *[str(value + i) for i in range(6)]])


def lab(hours, value):
    return f"{(T0 + hours * HOUR).isoformat(timespec='seconds')}+00:00,{value}"


class Plant:
    """Two folders of message files, and everything a stream makes of them."""

    def __init__(self, spark, base, delay=HOUR):
        self.spark, self.base, self.delay, self.n = spark, str(base), delay, 0
        for name in ("sensor", "lab"):
            os.makedirs(f"{base}/{name}")

    def file(self, name, feed, lines, written):
        path = f"{self.base}/{feed}/{name}"
        with open(path, "w") as out:
            out.write("\n".join(lines) + "\n")
        os.utime(path, (written, written))

    def run(self, sinks=None, journal="journal", checkpoint="cp", after=None, options=None):
        after = after or {}
        feeds = [with_device(file_messages(self.spark, f"{self.base}/{n}", options, after.get(n))) for n in ("sensor", "lab")]
        query = ingest.start_ingest(*feeds, f"{self.base}/{journal}", sinks or {}, f"{self.base}/{checkpoint}", self.delay)
        jobs.finish(query, 120)

    def rows(self, journal="journal"):
        return self.spark.read.parquet(f"{self.base}/{journal}")


@pytest.fixture
def plant(spark, tmp_path):
    return Plant(spark, tmp_path)


def test_order_of_writes(spark, plant):
    """By the files' times, then by name, then by line; within one minute the write that comes last wins."""
    plant.file("b", "sensor", [sensor(0, 1), sensor(0, 2), sensor(0, 3), sensor(1, 10)], 2000)
    plant.file("a", "sensor", [sensor(0, 4)], 3000)
    plant.file("z", "sensor", [sensor(1, 20), sensor(1, 30)], 1000)
    plant.file("c", "sensor", [sensor(2, 5), sensor(2, 6)], 2000)
    plant.file("d", "sensor", [sensor(2, 7)], 2000)
    found = []
    for k in range(2):
        plant.run({"cells": ingest.cell_sink(f"{plant.base}/cells{k}")}, f"journal{k}", f"cp{k}")
        rows = plant.rows(f"journal{k}").orderBy("seq").collect()
        assert [r["seq"] for r in rows] == list(range(len(rows)))
        assert [r[FIRST] for r in rows] == [20, 30, 1, 2, 3, 10, 5, 6, 7, 4]
        newest = tables.read_newest(spark, f"{plant.base}/cells{k}", tables.CELL_KEYS, ["value"], "seq")
        found.append({r["minute_ts"].hour: r["value"] for r in newest.where(F.col("meter") == FIRST).collect()})
    assert found[0] == found[1] == {0: 4.0, 1: 10.0, 2: 7.0}


def test_files_are_numbered_as_read(spark, plant, monkeypatch):
    """Stretches of files need no sort; long ones are sorted and get the same numbers."""
    for k, name in enumerate("bacd"):
        plant.file(name, "sensor", [sensor(0, 100 * k + i) for i in range(40)], 2000 - 500 * (k == 2))
        plant.file(name, "lab", [lab(0, 1000 + 100 * k + i) for i in range(10)], 2000)
    sort, calls, number = ingest.numbered, [], ingest.number
    monkeypatch.setattr(ingest, "numbered", lambda *a, **b: calls.append(a) or sort(*a, **b))
    plant.run(None, "read", "cp-read")
    assert not calls
    monkeypatch.setattr(ingest, "number", lambda rows, batch_id, path: number(rows, batch_id, path, longest=39))
    plant.run(None, "dealt", "cp-dealt")
    assert len(calls) == 1
    read, dealt = ([(r["seq"], r["feed"], r[FIRST], r[LAB]) for r in plant.rows(j).orderBy("seq").collect()] for j in ("read", "dealt"))
    assert read == dealt and [r[0] for r in read] == list(range(200))


def test_topics_are_numbered_by_time(spark, tmp_path):
    """Partitions interleave by time, and a batch may hold a topic and files."""
    rows = [("sensor", "1", 5, 3), ("sensor", "0", 9, 1), ("lab", "f", 0, 2), ("lab", "f", 0, 2), ("sensor", "0", 10, 3), ("sensor", "1", 4, 1)]
    rows = spark.createDataFrame(rows, "feed string, origin string, place long, at long").withColumn("ingest_ts", F.timestamp_seconds("at"))
    got, sized = ingest.number(rows.drop("at"), 2, str(tmp_path / "ordered"))
    got = [(r["seq"] - 2 * ingest.BATCH_SPAN, r["origin"], r["place"]) for r in got.orderBy("seq").collect()]
    assert got == [(0, "0", 9), (1, "1", 4), (2, "f", 0), (3, "f", 0), (4, "0", 10), (5, "1", 5)] and not sized


def test_stretch_cut_otherwise_fails(spark, tmp_path, monkeypatch):
    """Lines beyond those counted must not share a number: the batch fails instead."""
    rows = spark.createDataFrame([("sensor", "f", 0)] * 5, "feed string, origin string, place long").coalesce(1)
    rows = rows.withColumn("ingest_ts", F.timestamp_seconds(F.lit(1)))
    starts = ingest._stretch_starts
    assert [r["seq"] for r in ingest.number(rows, 0, "")[0].orderBy("seq").collect()] == list(range(5))
    monkeypatch.setattr(ingest, "_stretch_starts", lambda *a: [(*s[:5], s[5] - 1, s[6]) for s in starts(*a)])
    with pytest.raises(Exception, match="other stretches"):
        ingest.number(rows, 0, "")[0].collect()


def test_deliveries_hold_their_messages_only(spark, tmp_path):
    """A message with a line end of its own is one line, without an empty message behind it."""
    from kilnmark.sources import feeds
    from kilnmark.suite import queries

    events = spark.createDataFrame([(k, T0, 1, "purchase" if k % 4 == 0 else "click", 1.0 + k) for k in range(40)],
                                   "event_id long, ts timestamp, user_id long, event_type string, value double")
    source = queries._Feeds(spark)
    source.deliver(events, 0)
    source.ingest()
    rows = source.read()
    assert rows.where("reason IS NOT NULL").isEmpty()
    assert rows.count() == feeds.sensor_messages(events).count() + feeds.lab_messages(events).count()
    assert [r[FIRST] for r in rows.where("feed = 'sensor'").orderBy("seq").collect()] == [1.0 + k for k in range(40)]


def test_later_batches_come_behind(spark, plant):
    for k in range(3):
        plant.file(f"f{9 - k}", "sensor", [sensor(0, k), sensor(0, k + 0.5)], 1000 + k)
        plant.run()
    assert [r[FIRST] for r in plant.rows().orderBy("seq").collect()] == [0, 0.5, 1, 1.5, 2, 2.5]


def test_sink_that_fails_and_resumes(spark, plant):
    """Others have their rows already; the one that failed gets the same rows, and nobody any twice."""
    calls, broken = [], [True]

    def failing(rows, batch_id):
        tables.append_batch(ingest.good(rows, "sensor"), f"{plant.base}/failing", batch_id, ())
        if broken[0]:
            raise OSError("sink lost")

    def counting(rows, batch_id):
        calls.append((batch_id, rows.count()))

    def files():
        return sorted(glob.glob(f"{plant.base}/journal/batch_id=*/*.parquet"))

    sinks = {"failing": failing, "counting": counting, "cells": ingest.cell_sink(f"{plant.base}/cells"),
             "dead": ingest.dead_letter_sink(f"{plant.base}/dead")}
    plant.file("a", "sensor", [sensor(0, 1), "nonsense", sensor(1, 2)], 1000)
    plant.file("a", "lab", [lab(1, 7.5)], 1000)
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            plant.run(sinks)
    before = files()
    broken[0] = False
    plant.file("b", "sensor", [sensor(2, 3)], 2000)
    plant.run(sinks)
    assert calls == [(0, 4), (1, 1)] and before == files()[:len(before)] and before
    assert sorted(r[FIRST] for r in spark.read.parquet(f"{plant.base}/failing").collect()) == [1, 2, 3]
    assert [(r["message"], r["reason"], r["feed"]) for r in spark.read.parquet(f"{plant.base}/dead").collect()] == [
        ("nonsense", "bad timestamp", "sensor")]
    cells = spark.read.parquet(f"{plant.base}/cells")
    assert cells.where(F.col("meter") == FIRST).count() == 3 and cells.where(F.col("meter") == LAB).count() == 1


def test_late_rows_go_to_the_ledger(spark, plant):
    sinks = {"late": ingest.late_sink(f"{plant.base}/late")}
    steps = [[sensor(5, 1), sensor(4, 2)], [sensor(4.5, 3), sensor(4, 4), sensor(3.9, 5), "bad"], [sensor(30, 6)], [sensor(28, 7), sensor(29.5, 8)]]
    for k, lines in enumerate(steps):
        plant.file(f"f{k}", "sensor", lines, 1000 + k)
        plant.run(sinks)
    late = spark.read.parquet(f"{plant.base}/late")
    # The watermark is an hour behind the newest row of earlier deliveries: at 4, 4 and 29 o'clock.
    assert sorted(r[FIRST] for r in late.collect()) == [4, 5, 7]
    assert sorted(str(r["archive_day"]) for r in late.select("archive_day").distinct().collect()) == ["2024-01-01", "2024-01-02"]
    kept = plant.rows().where("reason IS NULL AND NOT late")
    assert sorted(r[FIRST] for r in kept.collect()) == [1, 2, 3, 6, 8]


def test_stateful_jobs_never_drop_a_row_that_was_on_time(spark, plant):
    """Averages and archive read the journal in other batches than it was written in, and still miss nothing."""
    for k, lines in enumerate([[sensor(5, 1)], [sensor(4.5, 2)], [sensor(9, 3)], [sensor(8.5, 4), sensor(2, 9)]]):
        plant.file(f"f{k}", "sensor", lines, 1000 + k)
        plant.run()
    plant.file("end", "sensor", [sensor(48, 5)], 2000)
    plant.run()
    journal = f"{plant.base}/journal"
    merged = jobs.merged_journal(ingest.journal_feed(spark, journal, {"maxFilesPerTrigger": "1"}), "1 hour")
    jobs.finish(jobs.start_archive(merged, f"{plant.base}/archive", f"{plant.base}/cp-archive", "ts_local"), 120)
    assert sorted(r[FIRST] for r in spark.read.parquet(f"{plant.base}/archive").collect()) == [1, 2, 3, 4]


def test_replay_from_a_position(spark, plant):
    for k in range(3):
        plant.file(f"f{k}", "sensor", [sensor(k, k)], 1000 + k)
        plant.file(f"f{k}", "lab", [lab(k, k + 0.5)], 1000 + k)
        plant.run()
    journal = f"{plant.base}/journal"
    for batch, expected in ((0, [1, 1.5, 2, 2.5]), (1, [2, 2.5]), (2, []), (None, [])):
        place = ingest.positions(spark, journal, batch)
        assert place["sensor"]["origin"].endswith(f"/sensor/f{2 if batch is None else batch}")
        name = f"again-{batch}"
        plant.run(None, name, f"cp-{name}", place)
        got = plant.rows(name).collect() if glob.glob(f"{plant.base}/{name}/batch_id=*") else []
        assert sorted(r[FIRST] if r["feed"] == "sensor" else r[LAB] for r in got) == expected


def test_trimmed_journal_goes_on(spark, plant):
    """Batches that all queries have read can go; what follows is numbered, judged late and read as if they were there."""
    journal, sink = f"{plant.base}/journal", jobs.table_sink(f"{plant.base}/averages", ())

    def averages():
        stream = jobs.running_stream(ingest.good(ingest.journal_feed(spark, journal), "sensor", late=False), [FIRST], long=False)
        jobs.finish(jobs.start_upserts(stream, sink, f"{plant.base}/cp-averages"), 120)

    for k, lines in enumerate([[sensor(5, 1)], [sensor(9, 2)], [sensor(9.25, 4), sensor(6, 9)]]):
        plant.file(f"f{k}", "sensor", lines, 1000 + k)
        plant.run()
        averages()
        ingest.trim_journal(spark, journal, k)
    assert [os.path.basename(p) for p in glob.glob(f"{journal}/batch_id=*")] == ["batch_id=2"]
    rows = {r[FIRST]: (r["seq"] // ingest.BATCH_SPAN, r["late"]) for r in plant.rows().collect()}
    assert rows == {4: (2, False), 9: (2, True)}
    newest = tables.read_newest(spark, f"{plant.base}/averages", [*DEVICE, "window_end"], [FIRST], tables.BATCH)
    assert {r["window_end"].hour + r["window_end"].minute / 60: r[FIRST] for r in newest.collect()} == {5.5: 1, 6: 1, 9.5: 3, 10: 3}


def test_files_of_one_time_are_told_apart(spark, plant):
    plant.file("a", "sensor", [sensor(0, 0)], 1000)
    plant.run()
    place = ingest.positions(spark, f"{plant.base}/journal")
    plant.file("b", "sensor", [sensor(1, 1)], 1000)
    plant.run(None, "again", "cp-again", place)
    assert [r[FIRST] for r in plant.rows("again").collect()] == [1]


def test_offsets_of_partitions(spark):
    """Partitions are numbers: the next offset of each is kept, also of those without a message in the batch."""
    rows = spark.createDataFrame([("sensor", "0", 7, None, None), ("sensor", "1", 3, T0, None), ("sensor", "1", 4, None, "bad")],
                                 "feed string, origin string, place long, ts timestamp, reason string").withColumn(
        "ingest_ts", F.timestamp_seconds(F.col("place")))
    earlier = {"newest": None, "positions": {"sensor": {"time": 1, "origin": "2", "offsets": {"1": 2, "2": 9}}}}
    note = ingest._note(rows, earlier)
    assert note["positions"]["sensor"]["offsets"] == {"0": 8, "1": 5, "2": 9}
    assert earlier["positions"]["sensor"]["offsets"] == {"1": 2, "2": 9}
    assert note["newest"] == int((T0 - dt.datetime(1970, 1, 1)).total_seconds() * 10**6)


def test_message_headers(spark):
    row = spark.createDataFrame([("f", "o", T0, "m", "m,1.0")], "factory_id string, oven_id string, window_end timestamp_ntz, key string, value string")
    made = jobs.with_headers(row).first()
    assert (made["key"], made["value"]) == ("m", "m,1.0")
    assert {h["key"]: bytes(h["value"]).decode() for h in made["headers"]} == {"factory_id": "f", "oven_id": "o", "window_end": "2024-01-01 00:00:00"}


# --- sized archives --------------------------------------------------------------

ROW = "factory_id string, oven_id string, ts timestamp_ntz, seq int, m double"


def archive_step(spark, base, hours):
    rows = [("f", "o", T0 + h * HOUR, k, float(h)) for k, h in enumerate(hours)]
    spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(f"{base}/source")
    feed = spark.readStream.schema(ROW).option("maxFilesPerTrigger", "1").parquet(f"{base}/source")
    merged = jobs.merge_stream(feed, feed.where("false").withColumnRenamed("m", LAB), ["m"], delay="1 hour")
    jobs.finish(jobs.start_archive(merged, f"{base}/archive", f"{base}/cp"), 120)


def day_files(base):
    found = {}
    for f in glob.glob(f"{base}/archive/archive_day=*/*/*.parquet"):
        found.setdefault(f.split("archive_day=")[1][:10], []).append(f)
    return {d: len(names) for d, names in found.items()}


def test_files_of_a_day_do_not_grow_with_triggers(spark, tmp_path):
    steps = [[h, h + 1] for h in range(0, 80, 8)]
    for hours in steps:
        archive_step(spark, tmp_path, hours)
    found = day_files(tmp_path)
    assert found["2024-01-01"] == found["2024-01-02"] == 1 and found["2024-01-03"] > 1
    rows = spark.read.parquet(f"{tmp_path}/archive").collect()
    emitted = [h for hours in steps for h in hours if h <= 72]
    assert sorted(r["m"] for r in rows) == emitted and all(r["archive_day"] == r["ts"].date() for r in rows)
    lists = [n for n in os.listdir(f"{tmp_path}/archive/_batches") if n.endswith(".json") and n[0] != "."]
    assert len(lists) < len(steps)


@pytest.mark.parametrize("step", [0, 1, 3])
def test_archive_swap_that_broke_off_goes_on(spark, tmp_path, monkeypatch, step):
    """Whichever rename of the closing batch is the last one before the driver dies, no row is lost or doubled."""
    for hours in ([0, 5], [24, 30]):
        archive_step(spark, tmp_path, hours)
    move, left = Files.move, [step]

    def failing(self, source, target):
        if source.startswith(("archive_day", "_closing")):
            if not left[0]:
                raise OSError("driver lost")
            left[0] -= 1
        move(self, source, target)

    monkeypatch.setattr(Files, "move", failing)
    try:
        archive_step(spark, tmp_path, [72, 73, 80])
    except StreamingQueryException:
        pass
    monkeypatch.setattr(Files, "move", move)
    archive_step(spark, tmp_path, [81, 90])
    rows = spark.read.parquet(f"{tmp_path}/archive").collect()
    assert sorted(r["m"] for r in rows) == [0, 5, 24, 30, 72, 73, 80, 81]
    assert day_files(tmp_path)["2024-01-01"] == 1


# --- command line -------------------------------------------------------------------

def test_commands_over_the_stored_tables(spark, plant, capsys):
    base = plant.base
    for k in range(3):
        plant.file(f"f{k}", "sensor", [sensor(10 * k + 0.25, k, "0"), sensor(10 * k + 0.75, 10 * k + 1.005)], 1000 + k)
        plant.file(f"f{k}", "lab", [lab(10 * k + 0.75, 7.0)], 1000 + k)
        main(["stream", "--sensor", f"{base}/sensor", "--lab", f"{base}/lab", "--averages", f"{base}/averages",
              "--tables", f"{base}/tables", "--checkpoint", f"{base}/cp", "--once"])
    main(["current", "--table", f"{base}/tables/current"])
    row = spark.read.parquet(f"{base}/tables/current.shown").first()
    assert (row[STATUS], row[FIRST], row["ts"]) == ("ON", 21.01, T0 + 20.75 * HOUR)
    assert len(glob.glob(f"{base}/tables/current/batch_id=*")) == 2
    main(["averages", "--table", f"{base}/tables/running"])
    newest = {r["meter"]: (r["avg"], r["window_end"]) for r in spark.read.parquet(f"{base}/tables/running.current").collect()}
    assert newest[FIRST] == (21.01, T0 + 21.5 * HOUR) and len(newest) == len(METERS)
    before = {tuple(r) for r in jobs.read_averages(spark, f"{base}/tables/running").collect()}
    main(["compact", "--table", f"{base}/tables/running", "--kind", "running"])
    assert "generation 1" in capsys.readouterr().out
    assert {tuple(r) for r in jobs.read_averages(spark, f"{base}/tables/running").collect()} == before
    main(["keys", "--table", f"{base}/tables/running", "--kind", "running", "--start", "001#001#2024010100", "--stop", "001#001#2024010105"])
    keys = {r["key"] for r in spark.read.parquet(f"{base}/tables/running.range").collect()}
    assert keys == {"001#001#202401010030", "001#001#202401010100", "001#001#202401010130"}
    sent = spark.read.parquet(f"{base}/averages")
    assert {*DEVICE, "window_end", "key", "value"} <= set(sent.columns)
    assert compaction.scan_keys(spark, f"{base}/tables/cells", compaction.CELLS, f"001#001#{FIRST}#20240101#00",
                                f"001#001#{FIRST}#20240101#01").count() == 2
    main(["stream", "--sensor", f"{base}/sensor", "--lab", f"{base}/lab", "--averages", f"{base}/averages2", "--tables", f"{base}/tables2",
          "--checkpoint", f"{base}/cp2", "--once", "--behind", f"{base}/tables/journal", "--behind-batch", "1"])
    assert plant.rows("tables2/journal").count() == 3
