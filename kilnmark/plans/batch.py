"""The daily job: archive -> segments -> batch analysis table, in one plan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnmark.operators.segments import first_segment_day, markers, segment_averages, segment_table
from kilnmark.operators.skew import hot_keys, join_spread
from kilnmark.schemas import DEVICE, LAB, MERGED, METERS, SEGMENT_COLUMNS
from kilnmark.sources.archive import PART, from_records, read_archive
from kilnmark.sources.tables import BATCH, append_batch, replace_days
from kilnmark.sources.tables import stored as stored_table

FILE = "archive_file"


def analyse_days(archive: DataFrame, meters: Sequence[str] = METERS, columns: Mapping[str, str] = SEGMENT_COLUMNS,
                 ts: str = "ts", by: Sequence[str] = DEVICE, one_row_per_ts: bool = True,
                 local: str | None = None) -> DataFrame:
    """Segments of every device and archive day; the archive day is the date of the keys."""
    segments = segment_averages(archive, meters, by, (PART,), ts, one_row_per_ts=one_row_per_ts, local=local)
    return segment_table(segments, PART, columns, by)


def analyse_files(archive: DataFrame, meters: Sequence[str] = METERS, columns: Mapping[str, str] = SEGMENT_COLUMNS,
                  ts: str = "ts", by: Sequence[str] = DEVICE, unit: str = FILE,
                  one_row_per_ts: bool = True, local: str | None = None) -> DataFrame:
    """Segments of every file on its own, wherever the files were cut; the last column names the file.

    The date of the keys is that of the file's first marker, which is the end of its first segment:
    one lookup row per device and file, taken from the segments themselves. The busy devices are
    looked for among the markers, of which there is one per segment.
    """
    segments = segment_averages(archive, meters, by, (unit,), ts, one_row_per_ts=one_row_per_ts, local=local)
    first = first_segment_day(segments, by, (unit,))
    hot = hot_keys(markers(archive), [*by, unit])
    table = join_spread(segments, first, [*by, unit], ["end_ts"], hot=hot)
    return segment_table(table, "key_day", columns, by, keep=[unit])


def analyse_across_midnight(rows: DataFrame, meters: Sequence[str] = METERS,
                            columns: Mapping[str, str] = SEGMENT_COLUMNS, ts: str = "ts",
                            by: Sequence[str] = DEVICE, one_row_per_ts: bool = True) -> DataFrame:
    """Segments over the whole timeline of a device; keys carry the day a segment ends."""
    segments = segment_averages(rows, meters, by, (), ts, one_row_per_ts=one_row_per_ts)
    return segment_table(segments.withColumn("key_day", F.to_date("end_ts")), "key_day", columns, by)


def _within(first: dt.date | None, stop: dt.date | None) -> Column:
    day = F.col(PART)
    inside = F.lit(True) if first is None else day >= F.lit(first)
    return inside if stop is None else inside & (day < F.lit(stop))


def _marked(rows: DataFrame, unit: str) -> DataFrame:
    """The days or files with a lab value: those that have segments."""
    return rows.where(F.col(LAB).isNotNull() & F.col("ts").isNotNull()).select(unit).distinct()


def run_daily(spark: SparkSession, archive_path: str, table_path: str, first: dt.date | None = None,
              stop: dt.date | None = None, fmt: str = "parquet", meters: Sequence[str] = METERS,
              columns: Mapping[str, str] = SEGMENT_COLUMNS) -> None:
    """Analyse archive days ``[first, stop)`` (all of them by default) and replace their results.

    A day of the range that is archived or stored but has no segment gets one row
    without a key. So the partition of a day that lost its segments is replaced
    too, and a table without segments has a schema.
    """
    archive = read_archive(spark, archive_path, fmt=fmt).where(_within(first, stop))
    local = "ts_local" if "ts_local" in archive.columns else None
    days = archive.select(PART)
    if (stored := stored_table(spark, table_path)) is not None:
        days = days.union(stored.where(_within(first, stop)).select(PART))
    idle = days.distinct().join(_marked(archive, PART), PART, "left_anti")
    segments = analyse_days(archive, meters, columns, local=local)
    replace_days(segments.unionByName(idle, allowMissingColumns=True), table_path)


def run_files(spark: SparkSession, path: str, table_path: str, run: int, fmt: str = "parquet",
              by_folder: bool = False) -> None:
    """Analyse archive record files (one, a folder or a glob), each on its own, and store the results by file.

    With ``by_folder`` all files of a folder are one unit of analysis, so that a large cut can be
    written by many tasks; the folder's path then stands for the file's.
    Files may cut days anywhere, so results of other files stay; ``run`` is a
    growing number and the newest run wins per file, which is known by its path.
    A file without segments leaves a row without a key. A run that is repeated replaces
    all that it wrote before. Use a table of its own.
    """
    records = read_archive(spark, path, MERGED if fmt == "parquet" else None, fmt)
    if by_folder:
        records = records.withColumn(FILE, F.regexp_replace(FILE, "/[^/]*$", ""))
    rows = from_records(records)
    result = analyse_files(rows, one_row_per_ts=False, local="ts_local")
    idle = rows.select(FILE).distinct().join(_marked(rows, FILE), FILE, "left_anti")
    result = result.unionByName(idle, allowMissingColumns=True)
    append_batch(result, table_path, run)


def read_segments(spark: SparkSession, path: str, columns: Mapping[str, str] = SEGMENT_COLUMNS,
                  first: dt.date | None = None, stop: dt.date | None = None) -> DataFrame:
    """The batch analysis table of either job, newest run per file; the range skips partitions.

    Keys have minutes only, so segments of one minute share theirs and all come back.
    """
    names = ["key", *DEVICE, PART, "startTimestamp", "endTimestamp", LAB, *columns.values()]
    table = stored_table(spark, path)
    if table is None:
        kinds = {**dict.fromkeys(["key", *DEVICE], "string"), PART: "date",
                 **dict.fromkeys(["startTimestamp", "endTimestamp"], "timestamp_ntz")}
        return spark.range(0).select(*[F.lit(None).cast(kinds.get(n, "double")).alias(n) for n in names])
    rows = table.where(F.col("key").isNotNull()).where(_within(first, stop))
    if BATCH in table.columns:
        # All partitions tell which run is a file's newest: its rows may have moved to other days.
        newest = table.where(F.col(FILE).isNotNull()).groupBy(FILE).agg(F.max(BATCH).alias(BATCH))
        rows = join_spread(rows, newest, [FILE, BATCH], ["startTimestamp"])
    return rows.withColumn(PART, F.col(PART).cast("date")).select(*names)
