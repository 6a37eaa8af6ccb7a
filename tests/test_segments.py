"""Segments against a literal loop over markers, on small and on lopsided data."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kilnmark.operators import first_marker_day, interval, markers, segment_averages, segment_table
from kilnmark.plans import batch
from kilnmark.schemas import LAB, METERS, SEGMENT_COLUMNS
from kilnmark.sources import archive

SCHEMA = f"factory_id string, oven_id string, ts timestamp_ntz, archive_day date, {LAB} double, m double"
DAY = dt.datetime(2014, 5, 21)


def loop(rows, within_day=True):
    """One pass per marker, as the definition reads."""
    groups = defaultdict(list)
    for row in rows:
        groups[(row[0], row[1], row[3] if within_day else None)].append(row)
    found = []
    for (factory, oven, day), members in groups.items():
        after = None
        for end in sorted({r[2] for r in members if r[4] is not None}):
            part = [r for r in members if (after is None or r[2] > after) and r[2] <= end]
            values = [r[5] for r in part if r[5] is not None]
            found.append((factory, oven, day, min(r[2] for r in part), max(r[2] for r in part),
                          max(r[4] for r in part if r[4] is not None), len(part),
                          round(sum(values) / len(values), 6) if values else None))
            after = end
    return sorted(found, key=repr)


def run(spark, rows, within_day=True, **options):
    within = ("archive_day",) if within_day else ()
    frame = segment_averages(spark.createDataFrame(rows, SCHEMA), ["m"], within=within, **options)
    day = F.col("archive_day") if within_day else F.lit(None).cast("date")
    return sorted((tuple(r) for r in frame.select(
        "factory_id", "oven_id", day, "start_ts", "end_ts", LAB, "n_rows", F.round("avg_m", 6)).collect()), key=repr)


def random_rows(seed, n, ovens, days, marker_share, copies=0):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        ts = DAY + dt.timedelta(minutes=rng.randrange(days * 1440))
        # one oven holds about a third of all rows
        oven = "001" if rng.random() < 0.34 else f"{rng.randrange(2, ovens + 2):03d}"
        lab = round(rng.uniform(5, 9), 3) if rng.random() < marker_share else None
        rows.append(("001", oven, ts, ts.date(), lab, None if rng.random() < 0.1 else round(rng.uniform(0, 99), 2)))
    hot = rows[0]
    rows += [hot[:5] + (round(rng.uniform(0, 99), 2),) for _ in range(copies)]
    return rows


@pytest.mark.parametrize("within_day", [True, False])
@pytest.mark.parametrize("case", [
    dict(seed=1, n=400, ovens=3, days=3, marker_share=0.05),
    dict(seed=2, n=400, ovens=2, days=2, marker_share=0.5),
    dict(seed=3, n=300, ovens=20, days=9, marker_share=0.2, copies=150),
    dict(seed=4, n=200, ovens=1, days=40, marker_share=0.02),
])
def test_equals_loop(spark, case, within_day):
    rows = random_rows(**case)
    assert run(spark, rows, within_day) == loop(rows, within_day)


@pytest.mark.parametrize("width", ["1 minute", "3 hours", "1 day"])
def test_slice_width_does_not_matter(spark, width):
    rows = random_rows(5, 300, 2, 3, 0.1)
    for within_day in (True, False):
        assert run(spark, rows, within_day, slice_width=width) == loop(rows, within_day)


def test_unique_rows_need_no_first_step(spark):
    rows = list({(r[1], r[2]): r for r in random_rows(6, 300, 2, 3, 0.1)}.values())
    assert run(spark, rows, one_row_per_ts=True) == loop(rows)
    assert run(spark, rows, False, one_row_per_ts=True) == loop(rows, False)
    copies = random_rows(7, 200, 2, 3, 0.2, copies=40)
    assert run(spark, copies, one_row_per_ts=True) == loop(copies)


def minutes(*marks, lab=7.8):
    marks = set(marks)
    times = (DAY + dt.timedelta(minutes=i) for i in range(1440))
    return [("001", "001", ts, ts.date(), lab if ts.strftime("%H:%M") in marks else None, 1.0) for ts in times]


def test_worked_example(spark):
    """Markers at 3, 12 and 22 o'clock: three segments, the evening is left out."""
    got = [(a.strftime("%H:%M"), b.strftime("%H:%M"), n) for *_, a, b, _lab, n, _avg in
           run(spark, minutes("03:00", "12:00", "22:00"))]
    assert sorted(got) == [("00:00", "03:00", 181), ("03:01", "12:00", 540), ("12:01", "22:00", 600)]


def test_day_without_marker_is_empty_with_schema(spark):
    frame = segment_averages(spark.createDataFrame(minutes(), SCHEMA), ["m"])
    assert frame.count() == 0 and "avg_m" in frame.columns


def test_repeated_marker_time_is_one_segment(spark):
    rows = minutes("03:00")
    again = next(r for r in rows if r[4] is not None)
    assert len(run(spark, [*rows, again[:4] + (9.9, 5.0)])) == 1


def test_key_and_catalog_names(spark):
    ts = [DAY.replace(hour=4, minute=54), DAY.replace(hour=10, minute=58)]
    fields = ", ".join(f"{m} double" for m in METERS)
    rows = spark.createDataFrame(
        [("001", "001", t, t.date(), lab, *[float(i + k) for i in range(6)])
         for k, (t, lab) in enumerate(zip(ts, (None, 7.8)))],
        f"factory_id string, oven_id string, ts timestamp_ntz, archive_day date, {LAB} double, {fields}")
    row = segment_table(segment_averages(rows)).first()
    assert row["key"] == "001#001#20140521#0454#1058"
    assert row["productHumidity"] == 7.8 and row["avginputTemperatureProduct"] == 0.5
    assert set(SEGMENT_COLUMNS.values()) <= set(row.asDict())


def test_files_cut_elsewhere_use_the_first_markers_date(spark):
    late, early = DAY.replace(hour=23, minute=50), DAY + dt.timedelta(days=1, hours=2)
    rows = spark.createDataFrame([("001", "001", late, late.date(), None, 1.0), ("001", "001", early, early.date(), 7.0, 3.0)],
                                 SCHEMA).withColumn("archive_file", F.lit("a"))
    assert batch.analyse_files(rows, ["m"], {"m": "avg"}).first()["key"] == "001#001#20140522#2350#0200"
    assert first_marker_day(rows, within=("archive_file",)).first()["key_day"] == early.date()


def test_instants_order_rows_and_wall_clocks_name_them(spark):
    """The clock goes back an hour between the second and the third row."""
    texts = [("2014-11-02T00:30:00-04:00", None), ("2014-11-02T01:50:00-04:00", 7.0), ("2014-11-02T01:10:00-05:00", None),
             ("2014-11-02T02:30:00-05:00", 8.0)]
    records = spark.createDataFrame([(t, lab, "true", *[1.0] * 6) for t, lab in texts],
                                    f"timestamp string, {LAB} double, processOn string, "
                                    + ", ".join(f"{m} double" for m in METERS)).withColumn("archive_file", F.lit("a"))
    rows = archive.from_records(records)
    for frame in (batch.analyse_days(rows, local="ts_local"), batch.analyse_files(rows, local="ts_local")):
        assert sorted(r["key"] for r in frame.collect()) == ["001#001#20141102#0030#0150", "001#001#20141102#0110#0230"]


def test_record_files_are_analysed_one_by_one(spark, tmp_path):
    """One file per window, two windows in a day; running again changes nothing."""
    records, table = str(tmp_path / "records"), str(tmp_path / "table")
    names = ", ".join(f"{m} double" for m in METERS)
    for hours, lab in ((range(0, 12), 5), (range(12, 24), 20)):
        rows = [(DAY.replace(hour=h), 7.0 if h == lab else None, h % 2 == 0, *[float(h)] * 6) for h in hours]
        frame = spark.createDataFrame(rows, f"ts_local timestamp_ntz, {LAB} double, processIsOn boolean, {names}")
        archive.to_records(frame).coalesce(1).write.mode("append").parquet(records)
    for run in (1, 1, 2):
        batch.run_files(spark, records, table, run)
    got = {r["key"]: r for r in batch.read_segments(spark, table).collect()}
    assert sorted(got) == ["001#001#20140521#0000#0500", "001#001#20140521#1200#2000"]
    assert got["001#001#20140521#1200#2000"]["avgWaterFlowProcess"] == 16.0
    assert batch.read_segments(spark, table, stop=DAY.date()).count() == 0


def test_markers_and_interval(spark):
    frame = spark.createDataFrame(minutes("03:00", "12:00"), SCHEMA)
    assert markers(frame).count() == 2
    part = interval(frame, DAY.replace(hour=3), DAY.replace(hour=12))
    assert part.count() == 540 and part.agg(F.min("ts")).first()[0] == DAY.replace(hour=3, minute=1)


def test_no_group_holds_a_whole_device(spark):
    """Every window of the plan is bounded by a time slice or by an open lane."""
    rows = spark.createDataFrame(minutes("03:00"), SCHEMA)
    plan = segment_averages(rows, ["m"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("__slice" in line or "__lane0" in line for line in windows)
