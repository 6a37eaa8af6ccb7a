"""Message feeds -> a journal of parsed rows, and from it every sink that needs no state.

A micro-batch is numbered, parsed and stored once, as one folder of the journal that appears by a
single rename. All sinks read that folder. Each has its own note of the last batch it has finished:
when a batch is repeated because one of them failed, the stored rows stand, the others are passed over
and the one that failed gets the same rows again. Stateful jobs read the journal as a stream of their own.

* The number of a message, ``seq``, is its place in the order of writes: by the time of arrival, then
  partition and offset, or file and line. It decides which write wins everywhere.
* A row whose time is not after the watermark (the newest time of all earlier batches, less the
  delay) is late. Late rows stay in the journal and go to a ledger; nothing vanishes.
* The notes of a batch keep how far the feeds were read, so that a feed can start again from there.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kilnmark.operators.latest import current_row
from kilnmark.operators.ordering import numbered
from kilnmark.schemas import DEVICE, LAB, METERS, STATUS
from kilnmark.session import adaptive_sink
from kilnmark.sources.files import Files
from kilnmark.sources.messages import dead_rows, judge_lab, judge_sensor
from kilnmark.sources.tables import (
    BATCH,
    CELL_PARTS,
    DAY,
    LISTS,
    append_batch,
    batch_folder,
    both_kinds,
    cells,
    read_batch,
)

SENSOR_FEED, LAB_FEED = "sensor", "lab"
#: ``seq`` is the number of the batch times this, plus the place in the batch.
BATCH_SPAN = 10**12
PROGRESS, DONE, ORDERED = "_progress", "_done", "_ordered"
_KEEP = (*DEVICE, "seq", "ingest_ts", "origin", "place")
#: Origins of topics are the numbers of partitions, those of files are paths.
PARTITION = "^[0-9]+$"
#: Lines of a stretch that one task parses; splits of Spark's default size hold fewer unless lines are very short.
LONGEST_STRETCH = 10**7
#: With fewer lines in a stretch on average, rows are gathered before they are stored.
SHORT_STRETCH = 50_000
#: In this order a message was written before another.
WRITE_ORDER = ("ingest_ts", "feed", "origin", "place", "line")

JOURNAL = T.StructType([
    T.StructField("feed", T.StringType()), *[T.StructField(d, T.StringType()) for d in DEVICE],
    T.StructField("seq", T.LongType()), T.StructField("ingest_ts", T.TimestampType()),
    T.StructField("origin", T.StringType()), T.StructField("place", T.LongType()),
    T.StructField("datetime", T.StringType()), T.StructField("ts", T.TimestampType()),
    T.StructField("ts_local", T.TimestampNTZType()), T.StructField(STATUS, T.BooleanType()),
    *[T.StructField(m, T.DoubleType()) for m in METERS], T.StructField(LAB, T.DoubleType()),
    T.StructField("message", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("late", T.BooleanType())])

Sink = Callable[[DataFrame, int], None]


def both_messages(sensor: DataFrame, lab: DataFrame) -> DataFrame:
    """Messages of both feeds, with device, in one stream."""
    columns = [*DEVICE, "value", "ingest_ts", "origin", "place"]
    return (sensor.select(F.lit(SENSOR_FEED).alias("feed"), *columns)
            .unionByName(lab.select(F.lit(LAB_FEED).alias("feed"), *columns)))


def parse(messages: DataFrame, watermark: dt.datetime | None) -> DataFrame:
    """Numbered messages as journal rows: good ones typed, bad ones with their text and a reason."""
    judged = (judge_sensor(messages.where(F.col("feed") == SENSOR_FEED), keep=_KEEP).withColumn("feed", F.lit(SENSOR_FEED))
              .unionByName(judge_lab(messages.where(F.col("feed") == LAB_FEED), keep=_KEEP).withColumn("feed", F.lit(LAB_FEED)),
                           allowMissingColumns=True))
    behind = F.lit(False) if watermark is None else F.col("ts") <= F.lit(watermark)
    bad = F.col("reason").isNotNull()
    judged = judged.withColumns({"late": ~bad & F.coalesce(behind, F.lit(False)), "message": F.when(bad, F.col("message"))})
    return judged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in JOURNAL.fields])


def number(messages: DataFrame, batch_id: int, path: str, longest: int = LONGEST_STRETCH) -> tuple[DataFrame, bool]:
    """Messages with ``seq``, their place in the order of writes, and whether each task holds enough of them for a file.

    A task reads a stretch of a file line by line, so files need no sort: one row per stretch goes to the driver,
    and the number of lines before it comes back. Should a second read be cut into other stretches, it fails and the
    batch is repeated. Topics, whose partitions interleave by time, stretches that are not read in one piece and those of more
    than ``longest`` lines (files that cannot be split) are sorted through the folder ``path``.
    """
    lines = messages.withColumn("line", F.monotonically_increasing_id())
    starts = _stretch_starts(lines, longest)
    if starts is None:
        rows = numbered(lines, WRITE_ORDER, "seq", path)
    else:
        known = F.broadcast(messages.sparkSession.createDataFrame(
            starts, "feed string, __time long, origin string, place long, __first long, __n long, __start long"))  # one row per stretch
        at = F.col("line") - F.col("__first")
        seq = F.when((at >= 0) & (at < F.col("__n")), F.col("__start") + at).otherwise(
            F.raise_error(F.lit("the messages of this batch were read in other stretches than they were counted in")))
        rows = (lines.withColumn("__time", F.unix_micros("ingest_ts")).join(known, ["feed", "__time", "origin", "place"], "left")
                .withColumn("seq", seq))
    # What tasks read makes files of a size unless the stretches are short.
    sized = starts is not None and sum(s[5] for s in starts) >= len(starts) * SHORT_STRETCH
    return rows.select(*messages.columns, (F.col("seq") + F.lit(batch_id * BATCH_SPAN)).alias("seq")), sized


def _stretch_starts(lines: DataFrame, longest: int) -> list[tuple] | None:
    """``(feed, time, origin, place, first line, lines, lines of earlier stretches)`` in the order of writes; None if they must be sorted."""
    in_file = F.coalesce(~F.col("origin").rlike(PARTITION) & F.col("ingest_ts").isNotNull() & F.col("place").isNotNull(), F.lit(False))
    keys = {"time": F.unix_micros("ingest_ts"), "origin": F.col("origin"), "place": F.col("place")}
    found = (lines.groupBy("feed", *[F.when(in_file, c).alias(k) for k, c in keys.items()])  # one row for all of a topic
             .agg(F.min("line").alias("first"), F.max("line").alias("last"), F.count(F.lit(1)).alias("n")).collect())
    if any(s["origin"] is None or s["last"] - s["first"] + 1 != s["n"] or s["n"] > longest for s in found):
        return None
    starts, total = [], 0
    for s in sorted(found, key=lambda s: (s["time"], s["feed"], s["origin"], s["place"])):
        starts.append((s["feed"], s["time"], s["origin"], s["place"], s["first"], s["n"], total))
        total += s["n"]
    return starts


# --- notes -------------------------------------------------------------------

def progress(files: Files, before: int | None = None) -> dict:
    """The newest note of a journal, of a batch below ``before`` if that is given."""
    batches = sorted(int(n.removesuffix(".json")) for n in files.names(PROGRESS) if n.endswith(".json"))
    batches = [b for b in batches if before is None or b < before]
    return files.read_note(f"{PROGRESS}/{batches[-1]}.json") if batches else {"newest": None, "positions": {}}


def positions(spark: SparkSession, journal: str, batch_id: int | None = None) -> dict:
    """How far each feed had been read when ``batch_id`` (the newest by default) was stored.

    ``{feed: {"time": microseconds, "origin": file, "offsets": {partition: next offset}}}``: what
    ``file_messages`` and ``topic_messages`` take as ``after``.
    """
    return progress(Files(spark, journal), None if batch_id is None else batch_id + 1)["positions"]


def _note(rows: DataFrame, earlier: dict) -> dict:
    """The newest time and the positions after one batch, from a few aggregate rows and one scan."""
    places = {feed: {**p, "offsets": dict(p["offsets"])} for feed, p in earlier["positions"].items()}
    # First per file and partition: maxima of numbers are hashed, those of text and structs would sort every row.
    per_origin = rows.groupBy("feed", "origin").agg(
        F.max(F.unix_micros("ingest_ts")).alias("time"), F.max("place").alias("place"),
        F.max(F.when(F.col("reason").isNull(), F.unix_micros("ts"))).alias("newest"))
    partition = F.when(F.col("origin").rlike(PARTITION), F.col("origin"))  # one row for each partition, one for all files
    ends = (per_origin.groupBy("feed", partition.alias("partition"))
            .agg(F.max(F.struct("time", "origin")).alias("end"), F.max("place").alias("place"), F.max("newest").alias("newest")).collect())
    for feed, partition, (time, origin), offset, _ in ends:
        place = places.setdefault(feed, {"time": None, "origin": None, "offsets": {}})
        if place["time"] is None or (time, origin) > (place["time"], place["origin"]):
            place.update(time=time, origin=origin)
        if partition is not None:
            place["offsets"][partition] = offset + 1
    known = [n for n in (earlier["newest"], *(e["newest"] for e in ends)) if n is not None]
    return {"newest": max(known, default=None), "positions": places}


def _behind(note: dict, delay: dt.timedelta) -> dt.datetime | None:
    if note["newest"] is None:
        return None
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=note["newest"]) - delay


# --- the sink of the ingesting query -----------------------------------------

def journal_sink(path: str, sinks: Mapping[str, Sink], delay: dt.timedelta) -> Sink:
    """Store every micro-batch of messages in the journal at ``path``, then hand its rows to ``sinks``.

    Every sink is tried; the first failure is raised when all have been, and the batch is repeated.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files = Files(spark, path)
        earlier = progress(files, batch_id)
        if not files.exists(batch_folder("", batch_id)):
            ordered = f"{path}/{ORDERED}"
            messages, sized = number(batch, batch_id, ordered)
            append_batch(parse(messages, _behind(earlier, delay)), path, batch_id, (), sized=sized)
            files.delete(ORDERED)
        if not files.exists(batch_folder("", batch_id)):
            return  # no message came
        rows = read_batch(spark, path, batch_id, (), JOURNAL)
        files.write_note(f"{PROGRESS}/{batch_id}.json", _note(rows, earlier))
        failures = []
        for name, sink in sinks.items():
            note = f"{DONE}/{name}.json"
            if (files.read_note(note) or {"batch": -1})["batch"] >= batch_id:
                continue
            try:
                sink(rows, batch_id)
                files.write_note(note, {"batch": batch_id})
            except Exception as error:  # the other sinks do not wait for this one
                failures.append(error)
        if failures:
            raise failures[0]
    return store


def good(rows: DataFrame, feed: str, late: bool | None = None) -> DataFrame:
    """The good rows of one feed: all of them, the late ones, or the others."""
    found = rows.where((F.col("feed") == feed) & F.col("reason").isNull())
    if late is not None:
        found = found.where(F.col("late") == late)
    values = [STATUS, *METERS] if feed == SENSOR_FEED else [LAB]
    return found.select(*DEVICE, "seq", "ingest_ts", "datetime", "ts", "ts_local", *values)


def cell_sink(path: str) -> Sink:
    """Every reading, late or not, in its minute's cell."""
    def store(rows: DataFrame, batch_id: int) -> None:
        append_batch(cells(both_kinds(good(rows, SENSOR_FEED), good(rows, LAB_FEED))), path, batch_id, CELL_PARTS)
    return store


def dead_letter_sink(path: str) -> Sink:
    def store(rows: DataFrame, batch_id: int) -> None:
        append_batch(dead_rows(rows, ("feed", *DEVICE, "seq", "ingest_ts")), path, batch_id, ())
    return store


def late_sink(path: str) -> Sink:
    """The ledger of late rows, by the day they belong to."""
    def store(rows: DataFrame, batch_id: int) -> None:
        late = rows.where("late").drop("message", "reason", "late").withColumn(DAY, F.to_date("ts_local"))
        append_batch(late, path, batch_id, (DAY,))
    return store


def current_sink(path: str) -> Sink:
    """The newest sensor row of every device: each batch folds its rows into a new version and drops the one before the last."""
    values = [STATUS, *METERS, "seq"]

    def store(rows: DataFrame, batch_id: int) -> None:
        spark, files = rows.sparkSession, Files(rows.sparkSession, path)
        fresh = one_per_time(good(rows, SENSOR_FEED)).select(*DEVICE, "ts", *values)
        versions = _versions(files)
        older = [v for v in versions if v < batch_id]
        if older:
            fresh = spark.read.schema(fresh.schema).parquet(f"{path}/{batch_folder('', older[-1])}").unionByName(fresh)
        append_batch(current_row(fresh, values), path, batch_id, ())
        for version in older[:-1]:
            files.delete(batch_folder("", version))
            files.delete(f"{LISTS}/{version}.json")
    return store


def one_per_time(sensor: DataFrame, values: Sequence[str] = (STATUS, *METERS)) -> DataFrame:
    """Of several rows of a device at one time, the one written last."""
    return sensor.groupBy(*DEVICE, "ts").agg(F.max("seq").alias("seq"), *[F.max_by(v, "seq").alias(v) for v in values])


def _versions(files: Files) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in files.folders() if n.startswith(f"{BATCH}="))


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the current rows."""
    versions = _versions(Files(spark, path))
    if not versions:
        raise FileNotFoundError(f"no current rows at {path}")
    return spark.read.parquet(f"{path}/{batch_folder('', versions[-1])}")


def trim_journal(spark: SparkSession, journal: str, through: int) -> None:
    """Remove the batches up to ``through`` from the journal: for rows that every query behind it has read.

    The newest batch and its note stay, since it may be repeated and the next one begins from its note. Queries that
    read the journal remember which files they have read, so they go on as before.
    """
    files = Files(spark, journal)
    batches = _versions(files)
    for batch in batches[:-1]:
        if batch <= through:
            files.delete(batch_folder("", batch))
            files.delete(f"{LISTS}/{batch}.json")
            files.delete(f"{PROGRESS}/{batch}.json")


def start_ingest(sensor: DataFrame, lab: DataFrame, journal: str, sinks: Mapping[str, Sink], checkpoint: str,
                 delay: dt.timedelta, trigger: dict | None = None) -> StreamingQuery:
    """One query that reads both message feeds and parses each message once."""
    return (both_messages(sensor, lab).writeStream.foreachBatch(adaptive_sink(journal_sink(journal, sinks, delay)))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def journal_feed(spark: SparkSession, journal: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """The journal as a stream: its batches appear whole."""
    return spark.readStream.schema(JOURNAL).options(**(options or {})).parquet(f"{journal}/{BATCH}=*")
