"""Keyed tables that are folded as they grow: settled generations, live batches, key ranges.

Below a table that ``append_batch`` fills:

* ``<parts>/batch_id=N``            the live batches
* ``_settled/generation=G/<parts>`` days with one row per key, cut and sorted by key
* ``_manifest/G.json``              the generation that holds each settled day, and the last batch folded into them

A compaction writes the days that batches have touched since the last one as a new generation and then
the manifest, whose appearance is the one step that puts them in place of the old files and the folded
batches. Readers take the newest manifest: settled days, and the batches after its last one.
What a manifest no longer names is kept until the next compaction, for readers that began before.
One compaction of a table runs at a time; appends and readers may run beside it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnmark.functions.keys import cell_key, running_key
from kilnmark.schemas import DEVICE
from kilnmark.sources.files import Files
from kilnmark.sources.key_ranges import day_range, key_predicates
from kilnmark.sources.tables import BATCH, CELL_KEYS, CELL_PARTS, DAY, LISTS, batch_folder, stored

SETTLED = "_settled"
MANIFESTS = "_manifest"
GENERATION = "generation"
KEY = "key"
#: Rows in a row group are neighbours in key order, so small groups let a reader skip most of a file.
ROW_GROUP_BYTES = 16 << 20
EMPTY = {"generation": 0, "through": None, "days": {}}


@dataclass(frozen=True)
class Layout:
    """What identifies a row of a table, which write wins, and how its text key is built.

    ``parts`` are the partition columns, the day first; ``names`` stand in the key before the day.
    """

    keys: tuple[str, ...]
    values: tuple[str, ...]
    order: str
    parts: tuple[str, ...]
    names: tuple[str, ...]
    key: Callable[[], Column]

    @property
    def day(self) -> str:
        return self.parts[0]


CELLS = Layout(CELL_KEYS, ("value",), "seq", CELL_PARTS, (*DEVICE, "meter"), lambda: cell_key("meter", "minute_ts"))
RUNNING = Layout((*DEVICE, "day", "window_end", "meter"), ("avg",), BATCH, ("day",), DEVICE,
                 lambda: running_key("window_end"))


def manifest(files: Files) -> dict:
    """The newest manifest of a table; that of an empty generation if it was never folded."""
    names = [n for n in files.names(MANIFESTS) if n.endswith(".json")]
    return files.read_note(f"{MANIFESTS}/{names[-1]}") if names else dict(EMPTY)


def _day_folder(layout: Layout, folder: str) -> str:
    """The day's folder of a partition."""
    return folder.split("/")[0]


def _folder_day(folder: str) -> dt.date | None:
    """The date a day's folder is named after; None for rows without a day."""
    try:
        return dt.date.fromisoformat(folder.split("=", 1)[1])
    except ValueError:
        return None


def _columns(layout: Layout) -> list[Column]:
    """The columns of the table whatever file they come from; partition values get their types."""
    order = F.col(layout.order).cast("bigint").alias(layout.order)
    names = [F.col(c).cast("date" if c == layout.day else "string").alias(c) if c in layout.parts else F.col(c)
             for c in dict.fromkeys([*layout.keys, *layout.values])]
    return [*names, order]


def _settled(spark: SparkSession, path: str, layout: Layout, days: dict[str, int]) -> DataFrame | None:
    """The settled files of the named day folders, with their stored key."""
    if not days:
        return None
    root = f"{path}/{SETTLED}"
    return spark.read.option("basePath", root).parquet(
        *[f"{root}/{GENERATION}={generation}/{folder}" for folder, generation in sorted(days.items())])


def _live(spark: SparkSession, path: str, through: int | None) -> DataFrame | None:
    """Batches that are not folded yet; the filter is on a partition column."""
    rows = stored(spark, path)
    return rows if rows is None or through is None else rows.where(F.col(BATCH) > through)


def _newest(rows: DataFrame, layout: Layout) -> DataFrame:
    newest = [F.max_by(v, layout.order).alias(v) for v in layout.values]
    return rows.groupBy(*layout.keys).agg(*newest, F.max(layout.order).alias(layout.order))


def _both(parts: Sequence[DataFrame | None], layout: Layout) -> DataFrame | None:
    found = [p.select(*_columns(layout)) for p in parts if p is not None]
    return None if not found else found[0] if len(found) == 1 else found[0].unionByName(found[1])


def write_clustered(rows: DataFrame, path: str, parts: Sequence[str], order: Sequence[str],
                    row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Rows cut by ranges of partition and key, sorted within: a file holds a stretch of keys of few partitions.

    A partition with very many rows is cut over several files, by key.
    """
    by = [*parts, *[c for c in order if c not in parts]]
    (rows.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .option("parquet.block.size", row_group_bytes).partitionBy(*parts).parquet(path))


def compact(spark: SparkSession, path: str, layout: Layout, through: int | None = None) -> dict:
    """Fold the batches up to ``through`` into a new generation; returns the manifest that now holds.

    By default that is all but the newest batch, since a stream that starts again repeats at
    most its newest one. Only days that the folded batches touch are written. The lists that
    ``append_batch`` writes ahead tell which those are, so no folder is walked.
    """
    files = Files(spark, path)
    before = manifest(files)
    done = -1 if before["through"] is None else before["through"]
    lists = {int(n.removesuffix(".json")): n for n in files.names(LISTS) if n.endswith(".json")}
    if through is None:
        through = max(lists, default=0) - 1
    fold = [b for b in sorted(lists) if done < b <= through]
    if not fold:
        return before
    live = [(part, b) for b in fold for part in files.read_note(f"{LISTS}/{lists[b]}")]
    touched = sorted({_day_folder(layout, part) for part, _ in live})
    generation = before["generation"] + 1
    if live:
        old = _settled(spark, path, layout, {d: g for d, g in before["days"].items() if d in touched})
        new = spark.read.option("basePath", path).parquet(*[f"{path}/{batch_folder(part, b)}" for part, b in live])
        rows = _newest(_both([old, new], layout), layout).withColumn(KEY, layout.key())
        write_clustered(rows, f"{path}/{SETTLED}/{GENERATION}={generation}", layout.parts, [KEY, *layout.keys])
    after = {"generation": generation, "through": through, "days": {**before["days"], **dict.fromkeys(touched, generation)}}
    files.write_note(f"{MANIFESTS}/{generation:012d}.json", after)
    _sweep(files, layout, before, after, lists)
    return after


def _sweep(files: Files, layout: Layout, before: dict, after: dict, lists: dict[int, str]) -> None:
    """Remove what neither of the last two manifests needs."""
    done = -1 if before["through"] is None else before["through"]
    for batch, name in sorted(lists.items()):
        if batch <= done:
            for part in files.read_note(f"{LISTS}/{name}"):
                files.delete(batch_folder(part, batch))
                _drop_empty(files, part)
            files.delete(f"{LISTS}/{name}")
    named = {(g, d) for m in (before, after) for d, g in m["days"].items()}
    for folder in files.folders(SETTLED):
        generation = int(folder.split("=")[1])
        held = files.leaves(f"{SETTLED}/{folder}", 1)
        for day in held:
            if (generation, day) not in named:
                files.delete(f"{SETTLED}/{folder}/{day}")
        if not any((generation, day) in named for day in held):
            files.delete(f"{SETTLED}/{folder}")
    for name in files.names(MANIFESTS)[:-2]:
        files.delete(f"{MANIFESTS}/{name}")


def _drop_empty(files: Files, part: str) -> None:
    """Remove a partition's folder, and those above it, if nothing is left in it."""
    while part and not files.names(part):
        files.delete(part)
        part = part.rpartition("/")[0]


def read_keyed(spark: SparkSession, path: str, layout: Layout, first: dt.date | None = None,
               last: dt.date | None = None) -> DataFrame | None:
    """The newest write of every key: settled days and live batches. ``first`` and ``last`` are days, both included.

    None if nothing was ever written. Days outside the range are not opened. A settled day has one
    row per key, so the fold after the union is small unless live batches are large.
    """
    parts = _in_days(spark, path, layout, first, last)
    rows = _both(parts, layout)
    return None if rows is None else _newest(rows, layout)


def _in_days(spark: SparkSession, path: str, layout: Layout, first: dt.date | None,
             last: dt.date | None) -> list[DataFrame | None]:
    now = manifest(Files(spark, path))

    def within(day: dt.date | None) -> bool:
        if day is None:
            return first is None and last is None
        return (first is None or day >= first) and (last is None or day <= last)

    days = {folder: g for folder, g in now["days"].items() if within(_folder_day(folder))}
    parts = [_settled(spark, path, layout, days), _live(spark, path, now["through"])]
    for bound, test in ((first, "__ge__"), (last, "__le__")):
        if bound is not None:
            parts = [None if p is None else p.where(getattr(F.col(layout.day), test)(F.lit(bound))) for p in parts]
    return parts


def scan_keys(spark: SparkSession, path: str, layout: Layout, start: str, stop: str) -> DataFrame | None:
    """The newest rows with ``start`` <= key < ``stop``, their key included.

    Settled days are chosen by the days that the bounds allow, and their files and row groups by the
    stored key; in live batches, whose keys are built on the way, the partitions are chosen.
    """
    days = day_range(start, stop, len(layout.names)) or (None, None)
    settled, live = _in_days(spark, path, layout, *days)
    if settled is not None:
        settled = settled.where(key_predicates(start, stop, layout.names, layout.day))
    if live is not None:
        live = live.where(key_predicates(start, stop, layout.names, layout.day, layout.key()))
    rows = _both([settled, live], layout)
    return None if rows is None else _newest(rows, layout).withColumn(KEY, layout.key())
