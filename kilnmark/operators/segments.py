"""Averages over the interval that ends at each lab measurement.

Every row belongs to the first marker (row with a lab value) at or after it,
within its device and archive day; rows after the last marker are left out.

The textbook form is one running window per device and day. One busy device
would then sit in one task, so the work is split by time instead:

1. rows of one timestamp are folded into sums and counts (partial aggregation
   runs before the shuffle, so copies of one timestamp never travel);
2. inside a short time slice a running window finds the next marker, and the
   rows of each slice fold into one record per marker;
3. per slice only the part after its last marker (the tail) still lacks a
   marker, and only the part up to its first marker (the head) can still grow.
   A second window over these at most two records per slice hands every tail
   the first marker of a later slice.

Group sizes are bounded by distinct timestamps per slice and by slices per day,
never by the number of rows of a device. Across days (``within=()``) step 3 is
done per day and then over the heads and tails of days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnmark.functions.keys import batch_key
from kilnmark.functions.timestamps import wall_clock
from kilnmark.schemas import DEVICE, LAB, METERS, SEGMENT_COLUMNS

_SLICE = "__slice"
_DAY = "__day"


def _next(level: int) -> str:
    return f"__next{level}"


def _lane(level: int) -> str:
    return f"__lane{level}"


def _columns(names: Sequence[str]) -> str:
    return ", ".join(f"`{name}`" for name in names)


def _expressions(texts: Sequence[str]) -> list[Column]:
    return [F.expr(text) for text in texts]


def _first_fold(meters: Sequence[str], marker: str, local: bool, folded: bool) -> list[Column]:
    """Aggregates that make partial records: of rows, or of rows already ``folded`` per timestamp."""
    folds = ["min(end_ts) AS start_ts", "max(end_ts) AS end_ts", f"max(`{marker}`) AS `{marker}`",
             ("sum(n_rows)" if folded else "count(1)") + " AS n_rows"]
    if local:
        folds += ["min_by(clock, end_ts) AS start_local", "max_by(clock, end_ts) AS end_local"]
    for i, meter in enumerate(meters):
        folds += [f"sum(__sum{i}) AS __sum{i}", f"sum(__n{i}) AS __n{i}"] if folded else _sum_and_count(i, meter)
    return _expressions(folds)


def _sum_and_count(i: int, meter: str) -> list[str]:
    return [f"sum(`{meter}`) AS __sum{i}", f"count(`{meter}`) AS __n{i}"]


def _fold(meters: Sequence[str], marker: str, local: bool) -> list[Column]:
    """Aggregates that merge partial records into larger partial records."""
    folds = ["min(start_ts) AS start_ts", "max(end_ts) AS end_ts", f"max(`{marker}`) AS `{marker}`",
             "sum(n_rows) AS n_rows"]
    if local:
        folds += ["min_by(start_local, start_ts) AS start_local", "max_by(end_local, end_ts) AS end_local"]
    for i, _ in enumerate(meters):
        folds += [f"sum(__sum{i}) AS __sum{i}", f"sum(__n{i}) AS __n{i}"]
    return _expressions(folds)


def _fold_group(parts: DataFrame, group: Sequence[str], candidate: str, folds: Sequence[Column], level: int,
                drop_tail: bool = False) -> DataFrame:
    """Give every record the next marker inside its group and fold records of one marker.

    The result carries a lane. Open records (no marker yet, or the first marker
    of the group) share the NULL lane, where they meet those of neighbouring
    groups later. Records of any other marker are complete: each marker is a
    lane of its own, so they spread evenly and are not held up.
    """
    found, lane = _next(level), _lane(level)
    # Descending order turns "current row to end" into a running frame, which
    # Spark evaluates in one pass instead of once per row.
    parts = parts.selectExpr(
        "*",
        f"""min({candidate}) OVER (PARTITION BY {_columns(group)} ORDER BY end_ts DESC
                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {found}""",
        f"min({candidate}) OVER (PARTITION BY {_columns(group)}) AS __first")
    if drop_tail:
        parts = parts.where(f"{found} IS NOT NULL")
    closed = f"CASE WHEN {found} > __first THEN {found} END"
    if level > 0:
        closed = f"coalesce({_lane(level - 1)}, {closed})"
    # The group is part of the keys, so this needs no further exchange.
    return parts.groupBy(*group, F.expr(f"{closed} AS {lane}"), found).agg(*folds)


def segment_averages(
    rows: DataFrame,
    meters: Sequence[str] = METERS,
    by: Sequence[str] = DEVICE,
    within: Sequence[str] = ("archive_day",),
    ts: str = "ts",
    marker: str = LAB,
    slice_width: str = "15 minutes",
    one_row_per_ts: bool = False,
    local: str | None = None,
) -> DataFrame:
    """``(by, within, start_ts, end_ts, marker, n_rows, avg_<meter>…)``, one row per marker.

    ``within=()`` lets segments run across midnight. ``one_row_per_ts`` skips
    step 1 for rows that are unique per device and timestamp, as an archive is;
    results do not depend on it, only the bound on group sizes does.
    ``local`` names the wall clock that belongs to ``ts``: rows are compared by
    ``ts``, and ``start_local`` and ``end_local`` say what the clock showed.
    ``slice_width`` bounds the largest group: shorten it for feeds with very
    many timestamps per minute, widen it for sparse ones.
    """
    by, within, meters = list(by), list(within), list(meters)
    keys = by + within
    clock = [f"`{local}` AS clock"] if local else []
    points = rows.select(
        *keys, F.window(ts, slice_width)["start"].alias(_SLICE),
        *_expressions([f"`{ts}` AS end_ts", *clock]), marker, *meters)
    if not one_row_per_ts:
        points = points.groupBy(*keys, _SLICE, "end_ts").agg(*_expressions(
            (["min(clock) AS clock"] if local else [])
            + [f"max(`{marker}`) AS `{marker}`", "count(1) AS n_rows"]
            + [text for i, m in enumerate(meters) for text in _sum_and_count(i, m)]))

    outer = [keys]
    if not within:
        points = points.selectExpr("*", f"CAST({_SLICE} AS DATE) AS {_DAY}")
        outer = [by + [_DAY], by]
    has_local = local is not None
    parts = _fold_group(points, [*outer[0], _SLICE], f"CASE WHEN `{marker}` IS NOT NULL THEN end_ts END",
                        _first_fold(meters, marker, has_local, not one_row_per_ts), 0)
    folds = _fold(meters, marker, has_local)
    for level, group in enumerate(outer):
        parts = _fold_group(parts, [*group, _lane(level)], _next(level), folds, level + 1,
                            drop_tail=group == outer[-1])

    clocks = ["start_local", "end_local"] if local else []
    return parts.select(*keys, "start_ts", "end_ts", *clocks, marker, "n_rows", *_expressions(
        [f"CASE WHEN __n{i} > 0 THEN __sum{i} / __n{i} END AS `avg_{m}`" for i, m in enumerate(meters)]))


def markers(rows: DataFrame, marker: str = LAB) -> DataFrame:
    """The rows that carry a lab value."""
    return rows.where(F.col(marker).isNotNull())


def interval(rows: DataFrame, after, until, ts: str = "ts") -> DataFrame:
    """Rows with ``after`` < ts <= ``until``; the comparison reaches the scan."""
    if isinstance(rows.schema[ts].dataType, T.TimestampNTZType):
        after, until = wall_clock(after), wall_clock(until)
    return rows.where((F.col(ts) > after) & (F.col(ts) <= until))


def first_marker_day(rows: DataFrame, by=DEVICE, within=("archive_day",), ts="ts", marker=LAB,
                     local: str | None = None) -> DataFrame:
    """Day of the first marker of every archive unit: the date part of its keys."""
    first = F.min_by(local, ts) if local else F.min(ts)
    return markers(rows, marker).groupBy(*by, *within).agg(F.to_date(first).alias("key_day"))


def first_segment_day(segments: DataFrame, by=DEVICE, within=("archive_day",)) -> DataFrame:
    """Day of the first marker, taken from segments: it ends the first one of every archive unit."""
    end = "end_local" if "end_local" in segments.columns else "end_ts"
    return segments.groupBy(*by, *within).agg(F.to_date(F.min_by(end, "end_ts")).alias("key_day"))


def segment_table(segments: DataFrame, key_day="archive_day", columns=SEGMENT_COLUMNS, by=DEVICE,
                  marker: str = LAB, keep: Sequence[str] = ()) -> DataFrame:
    """Shape segments into the stored batch analysis table: key first, catalog names.

    ``key_day`` is the column with the date part of the key. An archive day is
    the day of its first marker by construction; archives cut at other times
    join ``first_segment_day`` and pass its column. ``keep`` names further columns.
    """
    start, end = ("start_local", "end_local") if "start_local" in segments.columns else ("start_ts", "end_ts")
    return segments.select(
        batch_key(F.col(key_day), start, end, by).alias("key"),
        *by, F.col(key_day).alias("archive_day"),
        F.col(start).alias("startTimestamp"), F.col(end).alias("endTimestamp"), marker,
        *[F.col(f"avg_{meter}").alias(name) for meter, name in columns.items()], *keep)
