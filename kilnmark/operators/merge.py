"""Bring sensor and lab events of one device and timestamp together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnmark.operators.skew import join_spread
from kilnmark.schemas import DEVICE, LAB, METERS


def both_feeds(
    sensor: DataFrame,
    lab: DataFrame,
    values: Sequence[str] = METERS,
    by: Sequence[str] = DEVICE,
    ts: str = "ts",
    order: str = "seq",
    marker: str = LAB,
    shared: Sequence[str] = (),
) -> DataFrame:
    """Sensor and lab events in one frame; the columns of the other side are NULL."""
    keys = [*by, ts, *shared]
    return (sensor.select(*keys, *values, order)
            .unionByName(lab.select(*keys, marker), allowMissingColumns=True))


def merge_events(
    events: DataFrame,
    values: Sequence[str] = METERS,
    by: Sequence[str] = DEVICE,
    ts: str = "ts",
    order: str = "seq",
    marker: str = LAB,
    shared: Sequence[str] = (),
) -> DataFrame:
    """``(by, ts, shared…, marker, values…)``: one row per device and timestamp.

    Several sensor rows at one timestamp: the one with the largest ``order``
    wins as a whole. Several lab rows: the largest value wins. A side without
    a row leaves NULLs. Both rules combine before the shuffle, so a key with
    very many copies costs no more than any other, and the same expression
    runs on batch frames and on streams.

    ``shared`` columns are on both sides and go with the timestamp, such as its
    wall clock. ``values`` and ``order`` should be fixed-width (numbers,
    booleans, times): they then stay in hash aggregation.
    """
    return events.groupBy(*by, ts).agg(
        *[F.max(s).alias(s) for s in shared],
        F.max(marker).alias(marker), *[F.max_by(v, order).alias(v) for v in values])


def merge_sensor_lab(
    sensor: DataFrame,
    lab: DataFrame,
    values: Sequence[str] = METERS,
    by: Sequence[str] = DEVICE,
    ts: str = "ts",
    order: str = "seq",
    marker: str = LAB,
    shared: Sequence[str] = (),
) -> DataFrame:
    """Full outer join of the two feeds on device and timestamp, as one grouped union."""
    both = both_feeds(sensor, lab, values, by, ts, order, marker, shared)
    return merge_events(both, values, by, ts, order, marker, shared)


def duplicate_summary(
    sensor: DataFrame,
    lab: DataFrame,
    by: Sequence[str] = DEVICE,
    ts: str = "ts",
    marker: str = LAB,
) -> DataFrame:
    """How many events each side has per ``(by, ts)``, and how far lab values differ.

    A list per key would have to fit in one task; counts and extremes do not.
    ``duplicate_rows`` returns the rows themselves.
    """
    keys = [*by, ts]
    both = (sensor.select(*keys, F.lit(1).alias("__s"))
            .unionByName(lab.select(*keys, marker, F.lit(1).alias("__l")), allowMissingColumns=True))
    return both.groupBy(*keys).agg(
        F.count("__s").alias("n_sensor"), F.count("__l").alias("n_lab"),
        F.min(marker).alias("lab_min"), F.max(marker).alias("lab_max"))


def duplicate_rows(events: DataFrame, by: Sequence[str] = DEVICE, ts: str = "ts", order: str = "seq") -> DataFrame:
    """The events that share their ``(by, ts)`` with another one, with the group's size ``n_rows``.

    A window count would gather each group in one task. Here groups are counted
    (combined before the shuffle) and joined back, each dealt out over many tasks.
    """
    keys = [*by, ts]
    repeated = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    return join_spread(events, repeated, keys, [order])
