"""Nothing is lost or left over: bad lines, segments of one minute, days without segments."""

import datetime as dt

from pyspark.sql import functions as F

from kilnmark import __main__ as cli
from kilnmark.plans import batch
from kilnmark.schemas import LAB, METERS, RAW
from kilnmark.sources import archive, delimited

DAY = dt.datetime(2014, 5, 21)
NAMES = ", ".join(f"{m} double" for m in METERS)
GOOD = "2014-06-05T06:01:00-04:00;;1;47.5;14.6;50.2;38.65;29.9;60.05"


def records(spark, path, moments, mode="append"):
    rows = [(t, lab, True, *[1.0] * 6) for t, lab in moments]
    frame = spark.createDataFrame(rows, f"ts_local timestamp_ntz, {LAB} double, processIsOn boolean, {NAMES}")
    archive.to_records(frame).coalesce(1).write.mode(mode).parquet(path)


def test_bad_lines_are_kept_with_a_reason(spark, tmp_path):
    lines = [GOOD, GOOD.replace("2014-06-05T06:01:00-04:00", "not-a-time"), GOOD.replace("47.5", "hot"), GOOD + ";1;2", "2014;1"]
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([";".join(RAW.names), *lines]) + "\n")
    read = delimited.read_raw(spark, str(path))
    dead = {(r["message"], r["reason"]) for r in delimited.dead_letters(read).collect()}
    assert dead == {(lines[1], "bad timestamp"), (lines[2], "bad number"), (lines[3], "malformed"), (lines[4], "malformed")}
    good = delimited.without_corrupt(read)
    assert good.columns == RAW.names and good.count() + len(dead) == len(lines)
    args = cli.parser().parse_args(["clean", "--input", str(path), "--output", str(tmp_path / "out")])
    args.run(spark, args)
    assert spark.read.json(str(tmp_path / "out.dead")).count() == 4


def test_segments_of_one_minute_all_come_back(spark, tmp_path):
    path, table = str(tmp_path / "records"), str(tmp_path / "table")
    records(spark, path, [(DAY.replace(hour=3, second=s), float(s)) for s in (1, 2, 3, 4)])
    for run in (1, 1, 2):
        batch.run_files(spark, path, table, run)
    rows = batch.read_segments(spark, table).collect()
    assert sorted(r[LAB] for r in rows) == [1.0, 2.0, 3.0, 4.0] and len({r["key"] for r in rows}) == 1


def test_the_newest_run_of_a_file_counts_even_without_segments(spark, tmp_path):
    path, table = str(tmp_path / "records"), str(tmp_path / "table")
    first, second = f"{path}/a", f"{path}/b"
    records(spark, first, [(DAY, 1.0)])
    records(spark, second, [(DAY + dt.timedelta(days=1), 2.0)])
    batch.run_files(spark, f"{path}/*", table, 7)
    assert batch.read_segments(spark, table).count() == 2
    batch.run_files(spark, second, table, 7)  # the same number with other days: what it had is gone
    assert [r[LAB] for r in batch.read_segments(spark, table).collect()] == [2.0]
    assert batch.read_segments(spark, table, stop=DAY.date()).count() == 0


def daily(spark, path, days):
    rows = [("f", "o", DAY + dt.timedelta(days=d), (DAY + dt.timedelta(days=d)).date(), lab, *[1.0] * 6) for d, lab in days]
    archive.write_archive(spark.createDataFrame(
        rows, f"factory_id string, oven_id string, ts timestamp_ntz, archive_day date, {LAB} double, {NAMES}"), path)


def test_a_day_without_markers_loses_its_old_segments(spark, tmp_path):
    path, table = str(tmp_path / "archive"), str(tmp_path / "table")
    daily(spark, path, [(0, 1.0), (1, 2.0)])
    batch.run_daily(spark, path, table)
    assert batch.read_segments(spark, table).count() == 2
    daily(spark, path, [(1, None)])
    day = (DAY + dt.timedelta(days=1)).date()
    batch.run_daily(spark, path, table, first=day, stop=day + dt.timedelta(days=1))
    assert [r[LAB] for r in batch.read_segments(spark, table).collect()] == [1.0]


def test_a_table_without_segments_is_empty_with_schema(spark, tmp_path):
    path, table = str(tmp_path / "archive"), str(tmp_path / "table")
    empty = batch.read_segments(spark, table)
    daily(spark, path, [(0, None)])
    batch.run_daily(spark, path, table)
    found = batch.read_segments(spark, table)
    assert found.count() == empty.count() == 0 and found.columns == empty.columns
    assert found.where(F.col("archive_day") == F.lit(DAY.date())).isEmpty()
