"""Delimited exports: the raw ``;`` file, the cleaned comma file, gzip on both ends."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnmark.functions.timestamps import instant, local_time
from kilnmark.functions.values import empty_to_null
from kilnmark.operators.ordering import chronological
from kilnmark.schemas import RAW, check_readable

CORRUPT = "_corrupt_record"
REASON = "reason"


def read_raw(spark: SparkSession, path: str, sep: str = ";", schema: T.StructType = RAW,
             partitions: int | None = None, time: str = "datetime") -> DataFrame:
    """Typed rows of an export with a header; ``_corrupt_record`` has the text of lines that do not fit.

    ``reason`` says why: ``malformed`` (wrong number of fields), ``bad timestamp`` (text in ``time``
    that is none; an empty one is a missing time and fits) or ``bad number``.

    Cells are read as text and cast here, so that a line is judged by all its
    columns even when a query asks for few of them. A gzip file cannot be
    split: give ``partitions`` to spread its rows after the read.
    """
    check_readable(schema)
    text = T.StructType([T.StructField(name, T.StringType(), True) for name in [*schema.names, CORRUPT]])
    lines = (spark.read.schema(text)
             .option("sep", sep).option("header", True).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False)
             .csv(path))
    if partitions:
        lines = lines.repartition(partitions)
    cells = {f.name: empty_to_null(f.name) for f in schema.fields}
    typed = {f.name: cells[f.name].try_cast(f.dataType) for f in schema.fields}
    bad = reduce(or_, [cells[name].isNotNull() & typed[name].isNull() for name in schema.names])
    bad_time = cells[time].isNotNull() & instant(time).isNull() if time in schema.names else F.lit(False)
    reason = (F.when(F.col(CORRUPT).isNotNull(), "malformed").when(bad_time, "bad timestamp")
              .when(bad, "bad number"))
    whole = F.concat_ws(sep, *[F.coalesce(F.col(name), F.lit("")) for name in schema.names])
    return lines.select(*[typed[name].alias(name) for name in schema.names],
                        F.when(F.col(CORRUPT).isNotNull(), F.col(CORRUPT)).when(bad_time | bad, whole).alias(CORRUPT),
                        reason.alias(REASON))


def with_times(rows: DataFrame, text: str = "datetime") -> DataFrame:
    """Add ``ts`` (instant) and ``ts_local`` (wall clock as written)."""
    return rows.select("*", instant(text).alias("ts"), local_time(text).alias("ts_local"))


def write_clean(rows: DataFrame, path: str, ts: str = "datetime", ties=(), gzip: bool = False,
                columns=RAW.names) -> None:
    """Replace ``path`` with a comma export in time order (part files follow the order).

    ``ts`` is the column to order by; pass ``ts`` of ``with_times`` when offsets vary.
    """
    ordered = chronological(rows, ts, ties or [c for c in columns if c != ts])
    writer = ordered.select(*columns).write.mode("overwrite").option("header", True)
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.csv(path)


def without_corrupt(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT, REASON)


def dead_letters(rows: DataFrame) -> DataFrame:
    """``(message, reason)`` of the lines that do not fit; with ``without_corrupt`` these are all lines."""
    return rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("message"), REASON)
