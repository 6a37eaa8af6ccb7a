"""Cell values: text to typed value, rounding, labels, payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kilnmark.functions.timestamps import _col
from kilnmark.schemas import STATUS_LABELS


def empty_to_null(text) -> Column:
    """Trimmed text, or NULL when nothing is left."""
    return F.nullif(F.trim(_col(text)), F.lit(""))


def number(text) -> Column:
    """Text -> DOUBLE; empty or malformed text -> NULL."""
    return empty_to_null(text).try_cast("double")


def is_on(text) -> Column:
    """``1`` is on, any other text is off; NULL stays NULL."""
    return F.trim(_col(text)) == F.lit("1")


def status_label(text) -> Column:
    """``1`` -> ON, ``0`` -> OFF, anything else -> NULL."""
    label = F.lit(None).cast("string")
    for code, name in STATUS_LABELS.items():
        label = F.when(F.trim(_col(text)) == code, F.lit(name)).otherwise(label)
    return label


def round2(column) -> Column:
    """Two decimals, half up. The inner rounding removes binary noise around ties."""
    return F.round(F.round(_col(column), 6), 2)


def meter_message(meter, value) -> Column:
    """``meter,value`` payload of an average."""
    return F.concat_ws(",", _col(meter), _col(value).cast("string"))


def message_value(payload) -> Column:
    """The number in a ``meter,value`` payload."""
    return number(F.split(_col(payload), ",")[1])


def zero_pad(column, width: int = 3) -> Column:
    """Integer id as text with at least ``width`` digits; longer ids stay whole."""
    text = _col(column).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
