import datetime as dt

import pytest
from pyspark.sql import functions as F

from kilnmark.operators import (
    chronological_rank,
    duplicate_rows,
    duplicate_summary,
    hour_map,
    hour_row,
    merge_sensor_lab,
    meters_to_rows,
    rows_to_meters,
)
from kilnmark.plans import serving
from kilnmark.schemas import LAB, METERS, RAW, STATUS
from kilnmark.sources import archive, delimited, messages, tables

HEADER = ";".join(RAW.names)
EXAMPLE = "2014-06-05T06:01:00-04:00;;1;47.5;14.666666666666666;50.2;38.65;29.9;60.05"
WITH_LAB = "2014-05-30T04:10:00-04:00;7.805;0;47.5;14.5;50.2;38.65;29.9;60.05"
EMPTY = "2014-06-05T06:02:00-04:00;;;;;;;;"


def raw(spark, tmp_path, *lines):
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return delimited.read_raw(spark, str(path))


def test_split_and_empty_blocks(spark, tmp_path):
    rows = delimited.without_corrupt(raw(spark, tmp_path, EXAMPLE, WITH_LAB, EMPTY))
    sensor, lab = messages.split_export(messages.drop_empty_sensor_blocks(rows))
    assert sensor.count() == 2
    assert [tuple(r) for r in lab.collect()] == [("2014-05-30T04:10:00-04:00", 7.805)]
    text = {r[0] for r in sensor.select(messages.to_message(sensor.columns)).collect()}
    assert "2014-06-05T06:01:00-04:00,1,47.5,14.666666666666666,50.2,38.65,29.9,60.05" in text


def test_corrupt_lines_stay_apart(spark, tmp_path):
    rows = raw(spark, tmp_path, EXAMPLE, EXAMPLE.replace("47.5", "hot"))
    assert rows.where(F.col(delimited.CORRUPT).isNotNull()).count() == 1
    assert delimited.without_corrupt(rows).count() == 1


@pytest.mark.parametrize("gzip", [False, True])
def test_clean_export_is_sorted_and_replaced(spark, tmp_path, gzip):
    rows = delimited.without_corrupt(raw(spark, tmp_path, EXAMPLE, WITH_LAB))
    out = str(tmp_path / "clean")
    for _ in range(2):
        delimited.write_clean(rows, out, gzip=gzip)
    back = delimited.read_raw(spark, out, ",", partitions=2)
    assert back.count() == 2 and back.where(F.col("waterFlowProcess") == 14.666666666666666).count() == 1
    assert (len(list((tmp_path / "clean").glob("*.gz"))) > 0) == gzip
    lines = [r[0] for r in spark.read.text(out).collect() if not r[0].startswith("datetime")]
    assert lines == sorted(lines)


def test_messages(spark):
    lines = ["2014-06-05T06:01:00-04:00,1,47.5,14.5,50.2,38.65,29.9,60.05\r\n",
             "2014-06-05T06:02:00-04:00,0,47.5,,50.2,38.65,29.9,60.05",
             "yesterday,1,47.5,14.5,50.2,38.65,29.9,60.05",
             "2014-06-05T06:03:00-04:00,1,,,,,,",
             "2014-06-05T06:04:00-04:00,1,hot,14.5,50.2,38.65,29.9,60.05",
             "2014-06-05T06:05:00-04:00,1,47.5",
             ""]
    frame = spark.createDataFrame([("001", "001", line) for line in lines], "factory_id string, oven_id string, value string")
    good, dead = messages.read_sensor(frame)
    rows = {r["datetime"][14:16]: r for r in good.collect()}
    assert sorted(rows) == ["01", "02"]
    assert rows["01"][STATUS] is True and rows["01"]["temperatureProcess2"] == 60.05
    assert rows["01"]["ts_local"] == dt.datetime(2014, 6, 5, 6, 1)
    assert rows["02"][STATUS] is False and rows["02"]["waterFlowProcess"] is None
    reasons = sorted(r["reason"] for r in dead.collect())
    assert reasons == sorted(["bad timestamp", "empty block", "malformed", "malformed", "no timestamp"])
    key = messages.keyed(frame).first()
    assert key["ts_raw"] == "2014-06-05T06:01:00-04:00" and key["payload"].startswith("1,47.5,")


def test_lab_messages(spark):
    frame = spark.createDataFrame([("1", "1", "2014-05-30T04:10:00-04:00, 7.805"), ("1", "1", "2014-05-30T04:10:00-04:00,")],
                                  "factory_id string, oven_id string, value string")
    good, dead = messages.read_lab(frame)
    assert [r[LAB] for r in good.collect()] == [7.805] and [r["reason"] for r in dead.collect()] == ["empty block"]


def at(minute, second=0):
    return dt.datetime(2014, 5, 21, 4, minute, second)


def test_merge_duplicates_and_lone_sides(spark):
    sensor = spark.createDataFrame([("f", "o", at(1), 1, 10.0, True), ("f", "o", at(1), 2, None, False), ("f", "o", at(2), 3, 30.0, True)],
                                   "factory_id string, oven_id string, ts timestamp_ntz, seq int, m double, s boolean")
    lab = spark.createDataFrame([("f", "o", at(1), 7.0), ("f", "o", at(1), 8.0), ("f", "o", at(3), 9.0)],
                                f"factory_id string, oven_id string, ts timestamp_ntz, {LAB} double")
    merged = {r["ts"]: r for r in merge_sensor_lab(sensor, lab, ["m", "s"]).collect()}
    assert merged[at(1)][LAB] == 8.0 and merged[at(1)]["m"] is None and merged[at(1)]["s"] is False
    assert merged[at(2)][LAB] is None and merged[at(2)]["m"] == 30.0
    assert merged[at(3)][LAB] == 9.0 and merged[at(3)]["s"] is None
    counts = {r["ts"]: r for r in duplicate_summary(sensor, lab).collect()}
    assert (counts[at(1)]["n_sensor"], counts[at(1)]["n_lab"], counts[at(1)]["lab_min"]) == (2, 2, 7.0)
    assert duplicate_rows(sensor).count() == 2


def test_reshape(spark):
    wide = spark.createDataFrame([("f", "o", at(1), 1.0, None), ("f", "o", at(2), 2.0, 5.0)],
                                 "factory_id string, oven_id string, ts timestamp_ntz, a double, b double")
    rows = meters_to_rows(wide, ["a", "b"])
    assert rows.count() == 3
    back = rows_to_meters(rows, ["a", "b"])
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, wide.collect()), key=repr)


def test_hour_row_last_write(spark):
    rows = spark.createDataFrame([("f", "o", "m", at(7), 1.0, 1), ("f", "o", "m", at(7, 30), 2.0, 3),
                                  ("f", "o", "m", at(7, 40), 9.0, 2), ("f", "o", "m", at(59), 4.0, 4)],
                                 "factory_id string, oven_id string, meter string, ts timestamp_ntz, value double, seq int")
    row = hour_row(rows).first().asDict()
    assert row["key"] == "f#o#m#20140521#04" and (row["07"], row["59"], row["00"]) == (2.0, 4.0, None)
    assert len(row) == 61
    assert hour_map(rows).first()["cells"] == {"07": 2.0, "59": 4.0}


def test_rank_counts_earlier_rows(spark):
    times = [at(1), at(1), at(1), at(2), at(50), dt.datetime(2014, 5, 23)]
    frame = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    assert sorted(r["position"] for r in chronological_rank(frame).collect()) == [1, 1, 1, 4, 5, 6]


CELL = "factory_id string, oven_id string, ts timestamp_ntz, meter string, value double, seq int"


def test_keyed_table(spark, tmp_path):
    path, settled = str(tmp_path / "cells"), str(tmp_path / "settled")
    first = tables.cells(spark.createDataFrame([("f", "o", at(1), "a", 1.0, 1), ("f", "o", at(2), "b", 5.0, 2)], CELL))
    second = tables.cells(spark.createDataFrame([("f", "o", at(1, 9), "a", 2.0, 3)], CELL))
    newest = lambda: {(r["meter"], r["minute_ts"]): r["value"] for r in tables.read_newest(
        spark, path, tables.CELL_KEYS, ["value"], "seq").collect()}
    tables.append_batch(first, path, 0, tables.CELL_PARTS)
    tables.append_batch(second, path, 1, tables.CELL_PARTS)
    expected = {("a", at(1)): 2.0, ("b", at(2)): 5.0}
    assert newest() == expected
    tables.append_batch(first, path, 0, tables.CELL_PARTS)  # delivered again
    assert newest() == expected and tables.read_table(spark, path).count() == 3
    tables.settle(spark, path, settled, tables.CELL_KEYS, ["value"], "seq", dt.date(2014, 5, 22), tables.CELL_PARTS)
    assert tables.read_table(spark, settled).count() == 2
    hour = tables.meter_hour(tables.read_table(spark, settled), "a", at(30), "f", "o")
    assert [r["value"] for r in hour.collect()] == [2.0]
    assert tables.meter_days(tables.read_table(spark, path), "a", dt.date(2014, 5, 21), dt.date(2014, 5, 22)).count() == 2
    assert '"meter":"a"' in tables.preview(hour).first()[0]


def test_both_kinds(spark, tmp_path):
    rows = delimited.without_corrupt(raw(spark, tmp_path, EXAMPLE, WITH_LAB))
    long = tables.both_kinds(rows, rows.where(F.col(LAB).isNotNull()), keep=["datetime"])
    assert long.count() == 2 * (len(METERS) + 1) + 1
    assert {r["value"] for r in long.where(F.col("meter") == STATUS).collect()} == {0.0, 1.0}


def test_archive_days_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "archive")
    schema = "factory_id string, oven_id string, archive_day date, x int"
    d1, d2 = dt.date(2014, 5, 21), dt.date(2014, 5, 22)
    archive.write_archive(spark.createDataFrame([("f", "o", d1, 1), ("f", "o", d2, 2)], schema), path)
    archive.write_archive(spark.createDataFrame([("f", "o", d2, 3), ("f", "o", d2, 4)], schema), path)
    rows = archive.read_archive(spark, path)
    assert sorted((r["archive_day"], r["x"]) for r in rows.collect()) == [(d1, 1), (d2, 3), (d2, 4)]
    assert archive.daily_counts(rows).where(F.col("archive_day") == d2).first()["n_rows"] == 2
    assert rows.select("archive_file").distinct().count() >= 2


def test_week_excludes_its_date(spark):
    days = [dt.date(2014, 5, 25) + dt.timedelta(days=i) for i in range(10)]
    table = spark.createDataFrame([(f"001#001#{d:%Y%m%d}#0000#0100", d, 1.005) for d in days], "key string, archive_day date, v double")
    answer = serving.in_key_order(serving.batch_week(table, "20140602")).collect()
    assert [r["key"][8:16] for r in answer] == [f"{dt.date(2014, 5, 26) + dt.timedelta(days=i):%Y%m%d}" for i in range(7)]


def test_past_minutes_are_half_open(spark):
    now = dt.datetime(2019, 11, 3, 13, 49, 30)
    ends = [dt.datetime(2019, 11, 3, 13, m) for m in (36, 37, 48, 49)]
    table = spark.createDataFrame([(f"001#001#{e:%Y%m%d%H%M}", e, 1.0) for e in ends], "key string, window_end timestamp_ntz, m double")
    answer = serving.running_avg_since(table, now, 12, ["m"])
    assert sorted(r["key"][-2:] for r in answer.collect()) == ["37", "48"]
