"""Chronological order and positions, without passing all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnmark.session import fresh_dir

#: ``monotonically_increasing_id`` numbers the rows of a partition below this bit and the partitions above it.
_ROW_BITS = 33
_PART, _AT, _TIE = "__part", "__at", "__tie"


def chronological(rows: DataFrame, ts: str, ties: Sequence[str]) -> DataFrame:
    """Global sort by time. ``ties`` make the order total, which also lets the
    range partitioner cut through a timestamp that very many rows share."""
    return rows.orderBy(ts, *ties)


def in_parts(rows: DataFrame, order: Sequence[str], path: str | None = None) -> DataFrame:
    """``rows`` stored in the order of ``order``, cut by range, with ``__part`` and ``__at`` (place within the part).

    Ties are spread by the place of a row in its input, so rows that are equal in
    ``order`` are cut over many parts too. The rows are read twice: a sample for the ranges, then the sort. They
    are stored, at ``path`` or in the shared folder, so that later reads see the same places whatever executor is lost.
    """
    by = [F.col(c) for c in (*order, _TIE)]
    placed = (rows.withColumn(_TIE, F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
              .drop(_TIE).withColumn(_AT, F.monotonically_increasing_id()))
    path = path or fresh_dir(rows.sparkSession, "in-order")
    placed.write.mode("overwrite").parquet(path)
    stored = rows.sparkSession.read.schema(placed.schema).parquet(path)
    return stored.withColumns({_PART: F.shiftright(_AT, _ROW_BITS).cast("int"),
                               _AT: F.col(_AT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))})


def _starts(counts: Sequence[T.Row]) -> list[tuple[int, int, int]]:
    """``(part, rows before it, rows before the first time of it)`` from one row per part, in order."""
    starts, total, same, last = [], 0, 0, None
    for c in counts:
        same = same if c["first_ts"] == last else 0  # rows of earlier parts that share this part's first time
        starts.append((c[_PART], total, total - same))
        same = c["n_last"] + (same if c["first_ts"] == c["last_ts"] else 0)
        last = c["last_ts"]
        total += c["n_rows"]
    return starts


def numbered(rows: DataFrame, order: Sequence[str], name: str = "number", path: str | None = None) -> DataFrame:
    """Add a number from 0, without gaps, in the order of ``order`` (nulls first); equal rows have any order.

    Distributed prefix sums: one count per part goes to the driver, and its offset comes back.
    """
    placed = in_parts(rows, order, path)
    counts = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(_PART).collect()
    offsets, total = [], 0
    for part, n in counts:
        offsets.append((part, total))
        total += n
    starts = rows.sparkSession.createDataFrame(offsets, f"{_PART} int, __start long")
    return (placed.join(F.broadcast(starts), _PART)  # one row per part
            .withColumn(name, F.col("__start") + F.col(_AT)).drop(_PART, _AT, "__start"))


def chronological_rank(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """Add ``position``: one more than the number of rows with an earlier timestamp; null where that is null.

    The rows are sorted into parts by time and place, so a timestamp that a third of all rows
    share lies in many parts. Within a part the position of a time is that of its first row; what lies
    before a part, and before the time it begins with, follows from one count per part.
    """
    placed = in_parts(rows.where(F.col(ts).isNotNull()), [ts])
    # In order of ``__at`` the last time's rows are at the end: how many there are needs no second pass over the rows.
    per_time = placed.groupBy(_PART, ts).agg(F.min(_AT).alias("__first"), F.count(F.lit(1)).alias("__n"))
    counts = (per_time.groupBy(_PART).agg(
        F.sum("__n").alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        F.max_by("__n", ts).alias("n_last")).orderBy(_PART).collect())
    starts = rows.sparkSession.createDataFrame(_starts(counts), f"{_PART} int, __start long, __first_start long")
    first = F.min(_AT).over(Window.partitionBy(_PART, ts))
    before = F.when(first == 0, F.col("__first_start")).otherwise(F.col("__start") + first)
    ranked = (placed.join(F.broadcast(starts), _PART)  # one row per part
              .withColumn("position", before + 1).drop(_PART, _AT, "__start", "__first_start"))
    return ranked.unionByName(rows.where(F.col(ts).isNull()).withColumn("position", F.lit(None).cast("bigint")))
