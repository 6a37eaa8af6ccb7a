"""Keyed tables: repeated batches, compaction, ranges of keys."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from kilnmark.schemas import DEVICE
from kilnmark.sources import compaction, tables
from kilnmark.sources.files import Files
from kilnmark.sources.key_ranges import day_range, fixed_parts

START = dt.datetime(2024, 1, 1)
CELL = "factory_id string, oven_id string, archive_day date, meter string, minute_ts timestamp_ntz, value double, seq long"


def cell(day, minute, value, seq, oven="007", meter="click"):
    ts = START + dt.timedelta(days=day, minutes=minute)
    return ("002", oven, ts.date(), meter, ts, float(value), seq)


def append(spark, path, batch_id, rows):
    return tables.append_batch(spark.createDataFrame(rows, CELL), path, batch_id, tables.CELL_PARTS)


def newest(spark, path, **days):
    found = compaction.read_keyed(spark, path, compaction.CELLS, **days)
    return {(r["oven_id"], r["meter"], r["minute_ts"]): r["value"] for r in found.collect()}


def plain(batches):
    best = {}
    for rows in batches:
        for _, oven, _, meter, ts, value, seq in rows:
            if (oven, meter, ts) not in best or best[oven, meter, ts][0] < seq:
                best[oven, meter, ts] = (seq, value)
    return {k: v for k, (_, v) in best.items()}


def test_repeated_batch_drops_partitions_it_no_longer_has(spark, tmp_path):
    path = str(tmp_path / "t")
    append(spark, path, 0, [cell(0, 1, 1, 1)])
    append(spark, path, 1, [cell(3, 1, 2, 2), cell(4, 1, 3, 3)])
    append(spark, path, 1, [cell(4, 1, 4, 4), cell(5, 1, 5, 5)])
    assert {(r["minute_ts"].day, r["value"]) for r in spark.read.parquet(path).collect()} == {(1, 1.0), (5, 4.0), (6, 5.0)}
    append(spark, path, 1, [])
    assert spark.read.parquet(path).count() == 1


@pytest.mark.parametrize("steps", range(4))
def test_batch_that_broke_off_is_replaced_whole(spark, tmp_path, monkeypatch, steps):
    """The driver dies between any two moves of folders; the repeated batch, with other rows, leaves nothing behind."""
    path, left = str(tmp_path / "t"), [steps]
    move = Files.move

    def failing(self, source, target):
        if not left[0]:
            raise OSError("driver lost")
        left[0] -= 1
        move(self, source, target)

    monkeypatch.setattr(Files, "move", failing)
    with pytest.raises(OSError):
        append(spark, path, 7, [cell(d, 1, d, d) for d in range(5)])
    monkeypatch.setattr(Files, "move", move)
    append(spark, path, 7, [cell(9, 1, 9, 9)])
    assert [r["value"] for r in spark.read.parquet(path).collect()] == [9.0]


def batches_of(rng, n=20):
    """Batches over three days each, with cells written again."""
    out, seq = [], 0
    for k in range(n):
        rows = []
        for _ in range(12):
            seq += 1
            rows.append(cell(k // 4 + rng.randrange(3), rng.randrange(4), rng.random(), seq, rng.choice(["007", "008"]),
                             rng.choice(["click", "view"])))
        out.append(rows)
    return out


def folders(path):
    return [os.path.relpath(d, path) for d, _, files in os.walk(path) if any(f.endswith(".parquet") for f in files)]


def test_compaction_keeps_folders_few_and_rows_whole(spark, tmp_path):
    path, batches = str(tmp_path / "t"), batches_of(random.Random(3))
    for k, rows in enumerate(batches):
        append(spark, path, k, rows)
        if k % 4 == 3:
            compaction.compact(spark, path, compaction.CELLS)
            assert newest(spark, path) == plain(batches[:k + 1])
    days = {r[2] for rows in batches for r in rows}
    live = [f for f in folders(path) if not f.startswith("_")]
    settled = [f for f in folders(path) if f.startswith("_settled")]
    # Live: the batches since the last compaction but one. Settled: every day once, and the last generation's before images.
    assert {int(f.rsplit("=", 1)[1]) for f in live} <= set(range(15, 20))
    assert len({f.split("/")[2] for f in settled}) == len(days) and len(settled) <= 2 * 2 * len(days)
    assert len(os.listdir(path + "/_batches")) <= 2 * 5 and len([n for n in os.listdir(path + "/_manifest") if n.endswith(".json") and n[0] != "."]) == 2


def test_compaction_of_nothing_new_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert compaction.read_keyed(spark, path, compaction.CELLS) is None
    assert compaction.compact(spark, path, compaction.CELLS) == compaction.EMPTY
    append(spark, path, 0, [cell(0, 1, 1, 1)])
    assert compaction.compact(spark, path, compaction.CELLS)["generation"] == 0  # the newest batch may be repeated
    append(spark, path, 1, [cell(0, 1, 2, 2)])
    first = compaction.compact(spark, path, compaction.CELLS)
    assert (first["generation"], first["through"]) == (1, 0)
    assert compaction.compact(spark, path, compaction.CELLS) == first
    append(spark, path, 1, [cell(1, 1, 3, 3)])  # the batch that is still live is repeated with a row elsewhere
    assert newest(spark, path) == plain([[cell(0, 1, 1, 1)], [cell(1, 1, 3, 3)]])


def test_compaction_that_broke_off_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    batches = [[cell(0, 1, 1, 1), cell(1, 1, 2, 2)], [cell(0, 1, 3, 3)], [cell(2, 1, 4, 4)]]
    for k, rows in enumerate(batches):
        append(spark, path, k, rows)
    with monkeypatch.context() as m:
        m.setattr(Files, "write_note", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            compaction.compact(spark, path, compaction.CELLS)
    assert newest(spark, path) == plain(batches)
    assert compaction.compact(spark, path, compaction.CELLS)["generation"] == 1
    assert newest(spark, path) == plain(batches)


def test_reader_that_began_before_a_compaction_still_ends(spark, tmp_path):
    path = str(tmp_path / "t")
    batches = [[cell(0, k, k, k)] for k in range(4)]
    for k in range(3):
        append(spark, path, k, batches[k])
    compaction.compact(spark, path, compaction.CELLS)
    reader = compaction.read_keyed(spark, path, compaction.CELLS)
    append(spark, path, 3, batches[3])
    compaction.compact(spark, path, compaction.CELLS)
    assert reader.count() == 3


def test_days_of_a_range(spark):
    keys = lambda a, b, n=2: day_range(a, b, n)
    day = lambda m, d: dt.date(2024, m, d)
    assert keys("002#007#202401030000", "002#007#202401200000") == (day(1, 3), day(1, 20))
    assert keys("002#007#20240103", "002#007#20240110") == (day(1, 3), day(1, 9))  # any key of the 10th sorts after its day
    assert keys("002#007#202402", "002#007#202403") == (day(2, 1), day(2, 29))
    assert keys("002#007#20240103#0600", "002#007#20240103#0700", 2) == (day(1, 3), day(1, 3))
    assert keys("002#007#", "002#008#") is None and keys("002#007#2024", "003#007#2025") is None
    assert keys("f#o#m#20240103#06", "f#o#m#20240103#07", 3) == (day(1, 3), day(1, 3))
    assert fixed_parts("002#007#2024", "002#007#2025") == ["002", "007"]
    first, last = keys("002#007#20240110", "002#007#20240103")
    assert first > last


def test_day_range_holds_every_key(spark):
    """Against all keys of a year, bounds cut anywhere."""
    rng = random.Random(9)
    days = [dt.date(2023, 12, 1) + dt.timedelta(days=k) for k in range(120)]
    keys = [(f"a#b#{d:%Y%m%d}{h:02d}30", d) for d in days for h in (0, 7, 23)]
    for _ in range(300):
        start, stop = sorted(rng.choice(keys)[0][:rng.randrange(4, 17)] for _ in range(2))
        inside = [d for k, d in keys if start <= k < stop]
        found = day_range(start, stop, 2)
        if found and inside:
            assert found[0] <= min(inside) and max(inside) <= found[1]


def scan_metrics(frame):
    """(files, rows) that the file scans of an executed frame have read."""
    plan = frame._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    found = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return tuple(sum(m.apply(name).value() for m in found if m.contains(name)) for name in ("numFiles", "numOutputRows"))


def test_key_range_reaches_partitions_files_and_row_groups(spark, tmp_path, monkeypatch):
    """Both filters stand in the plan, other days' files stay closed, and most row groups of the day too."""
    path = str(tmp_path / "t")
    monkeypatch.setattr(compaction, "ROW_GROUP_BYTES", 1 << 16)
    monkeypatch.setattr(compaction.write_clustered, "__defaults__", (1 << 16,))
    minute = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id div 40000), 0, int(id % 40000 div 40))")
    rows = spark.range(200_000).select(
        F.lit("002").alias("factory_id"), F.format_string("%03d", F.col("id") % 40).alias("oven_id"), minute.alias("minute_ts"),
        F.lit("click").alias("meter"), F.rand(1).alias("value"), F.col("id").alias("seq")).withColumn("archive_day", F.to_date("minute_ts"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        tables.append_batch(rows.where("seq < 199990"), path, 0, tables.CELL_PARTS)
        tables.append_batch(rows.where("seq >= 199990"), path, 1, tables.CELL_PARTS)
        compaction.compact(spark, path, compaction.CELLS)
        bounds = ("002#007#click#20240102#00", "002#007#click#20240102#03")
        found = compaction.scan_keys(spark, path, compaction.CELLS, *bounds)
        got = found.collect()
        text = found._jdf.queryExecution().toString()
        files, scanned = scan_metrics(found)
        stored = sum(len([f for f in names if f.endswith(".parquet")]) for d, _, names in os.walk(path + "/_settled"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    expected = rows.where("oven_id = '007' AND archive_day = date'2024-01-02' AND hour(minute_ts) < 3")
    assert sorted(r["minute_ts"] for r in got) == sorted(r["minute_ts"] for r in expected.collect()) and len(got) == 180
    assert {r["key"] for r in got} == {f"002#007#click#20240102#{h:02d}" for h in range(3)}
    assert "GreaterThanOrEqual(key,002#007#click#20240102#00)" in text and "LessThan(key,002#007#click#20240102#03)" in text
    assert any("PartitionFilters" in line and "archive_day" in line.split("PartitionFilters")[1] for line in text.splitlines())
    assert files < stored / 2 and scanned < 40_000 / 4


def test_scan_reads_live_batches_too(spark, tmp_path):
    path, batches = str(tmp_path / "t"), batches_of(random.Random(4), 7)
    for k, rows in enumerate(batches):
        append(spark, path, k, rows)
        if k == 4:
            compaction.compact(spark, path, compaction.CELLS)
    start, stop = "002#007#click#20240101", "002#007#click#20240103"
    got = compaction.scan_keys(spark, path, compaction.CELLS, start, stop).collect()
    best = plain(batches)
    expected = {k: v for k, v in best.items() if k[0] == "007" and k[1] == "click" and START + dt.timedelta(days=0) <= k[2] < START + dt.timedelta(days=2)}
    assert {(r["oven_id"], r["meter"], r["minute_ts"]): r["value"] for r in got} == expected
    across = compaction.scan_keys(spark, path, compaction.CELLS, "002#007#view", "002#008#click~").collect()
    assert {(r["oven_id"], r["meter"]) for r in across} == {("007", "view"), ("008", "click")}
    assert newest(spark, path, first=dt.date(2024, 1, 2), last=dt.date(2024, 1, 2)) == {
        k: v for k, v in best.items() if k[2].date() == dt.date(2024, 1, 2)}
    assert set(DEVICE) <= set(compaction.read_keyed(spark, path, compaction.CELLS).columns)
