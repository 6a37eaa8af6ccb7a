"""What two bounds of a text key say about the columns behind it.

A key names its parts in order, ``factory#oven#…#yyyyMMdd…``. Of a range ``[start, stop)`` the parts
that both bounds share are fixed, and if the bounds first differ in the day (or behind it), the
range is one of days too: those reach the partitions, where a comparison of the key as text
cannot. Names in keys hold no separator, as keys could not be told apart otherwise.
"""

from __future__ import annotations

import datetime as dt
import os.path
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from kilnmark.functions.keys import SEPARATOR

_DAYS = range(1, dt.date.max.toordinal() + 1)
_DIGITS = 8


def _text(ordinal: int) -> str:
    day = dt.date.fromordinal(ordinal)
    return f"{day.year:04d}{day.month:02d}{day.day:02d}"


def _first_day(text: str) -> dt.date | None:
    """The first day whose ``yyyyMMdd`` is not below the bound."""
    at = bisect_left(_DAYS, text[:_DIGITS], key=_text)
    return dt.date.fromordinal(_DAYS[at]) if at < len(_DAYS) else None


def _last_day(text: str) -> dt.date | None:
    """The last day of which a key, the day and something behind it, can be below the bound."""
    cut = bisect_right if len(text) > _DIGITS else bisect_left
    at = cut(_DAYS, text[:_DIGITS], key=_text)
    return dt.date.fromordinal(_DAYS[at - 1]) if at else None


def fixed_parts(start: str, stop: str) -> list[str]:
    """The leading parts that every key in ``[start, stop)`` has."""
    return os.path.commonprefix([start, stop]).split(SEPARATOR)[:-1]


def day_range(start: str, stop: str, before: int) -> tuple[dt.date, dt.date] | None:
    """First and last day that keys in ``[start, stop)`` can have, where ``before`` parts stand before the day.

    None if the bounds differ earlier, so that any day can occur. An empty range gives a first day after the last.
    """
    parts = fixed_parts(start, stop)
    if len(parts) < before:
        return None
    skip = sum(len(p) + len(SEPARATOR) for p in parts[:before])
    first, last = _first_day(start[skip:]), _last_day(stop[skip:])
    return (dt.date.max, dt.date.min) if start >= stop or first is None or last is None else (first, last)


def key_predicates(start: str, stop: str, names: Sequence[str], day: str, key: str | Column = "key") -> Column:
    """``start`` <= key < ``stop`` with what follows for the columns ``names``, which stand in the key before the ``day``."""
    text = F.col(key) if isinstance(key, str) else key
    tests = [text >= start, text < stop]
    tests += [F.col(name) == value for name, value in zip(names, fixed_parts(start, stop))]
    days = day_range(start, stop, len(names))
    if days is not None:
        tests += [F.col(day) >= F.lit(days[0]), F.col(day) <= F.lit(days[1])]
    return reduce(and_, tests)
