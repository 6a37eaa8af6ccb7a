"""A join that does not gather the rows of a busy key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = 32
#: A key is hot if it holds more than one in this many rows.
SHARE = 200
_TRACKED = 4096


def hot_keys(rows: DataFrame, keys: Sequence[str], share: int = SHARE) -> list[int]:
    """The hashes of keys that hold more than 1 / ``share`` of the rows: never more than ``share`` of them.

    A frequent-items sketch per task, merged: its size does not depend on the rows, and so
    many items are tracked that no hot key is missed. Only these hashes reach the driver.
    """
    found = rows.select(F.xxhash64(*keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, {share}, {_TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(item["item"] for item in found["top"] or [] if item["count"] * share > found["n"])


def join_spread(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], deal_by: Sequence[str],
                spread: int = SPREAD, hot: Sequence[int] | None = None) -> DataFrame:
    """Inner join with a ``lookup`` of one row per key.

    Rows of a hot key are dealt out over ``spread`` salts by a hash of ``deal_by``, and the lookup
    row of that key is present under each of them; all other keys keep one lookup row. ``hot`` names
    the hashes of hot keys; by default they are found in ``rows``, in a pass over their keys
    alone. It bears on the work only, never on the result. Adaptive execution splits skewed joins
    only where both sides come straight from a shuffle; a lookup that was just aggregated
    does not. If the lookup turns out small at run time it is broadcast all the same.
    """
    hot = hot_keys(rows, keys) if hot is None else list(hot)
    if not hot or spread < 2:
        return rows.join(lookup, list(keys))
    is_hot: Column = F.xxhash64(*keys).isin(hot)
    salt = F.when(is_hot, F.pmod(F.hash(*deal_by), F.lit(spread))).otherwise(F.lit(0)).alias("__salt")
    salts = F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))).alias("__salt")
    return (rows.select("*", salt).join(lookup.select("*", salts), [*keys, "__salt"])
            .drop("__salt"))
