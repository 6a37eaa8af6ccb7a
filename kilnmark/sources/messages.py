"""Comma messages: split an export into two feeds, parse messages, keep what fails apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnmark.functions.timestamps import instant, local_time
from kilnmark.functions.values import empty_to_null, is_on
from kilnmark.schemas import DEVICE, LAB, LAB_EVENT, METERS, SENSOR, STATUS, check_readable

BAD = "_corrupt_record"
REQUIRED_METER = "inputTemperatureProduct"  # a sensor block without it counts as empty


def split_export(rows: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """One wide export -> (sensor rows, lab rows); a lab row only where a value was taken."""
    sensor = rows.select(*keep, *SENSOR.names)
    lab = rows.where(F.col(LAB).isNotNull()).select(*keep, *LAB_EVENT.names)
    return sensor, lab


def drop_empty_sensor_blocks(rows: DataFrame, meter: str = REQUIRED_METER) -> DataFrame:
    return rows.where(F.col(meter).isNotNull())


def to_message(columns: Sequence[str]) -> Column:
    """Comma message of the columns, in order; NULL becomes an empty field."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def parse_messages(messages: DataFrame, schema: T.StructType, text: str = "value",
                   keep: Sequence[str] = DEVICE) -> DataFrame:
    """Typed columns by position; empty fields become NULL.

    ``_corrupt_record`` holds the text of a message with a malformed number or
    the wrong number of fields. The reader is one built-in expression.
    """
    check_readable(schema)
    spec = T.StructType([*schema.fields, T.StructField(BAD, T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD,
               "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    parsed = F.from_csv(F.trim(F.regexp_replace(text, r"[\r\n]+$", "")), _ddl(spec), options)
    # ``inline`` of the one record keeps later filters above the parser. A plain
    # struct would be parsed again for every column a filter mentions.
    return messages.select(*keep, F.col(text).alias("__text"), F.inline(F.array(parsed)))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _judged(parsed: DataFrame, required: str, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    reason = (F.when(F.col("ts").isNull() & empty_to_null("datetime").isNotNull(), "bad timestamp")
              .when(F.col("ts").isNull(), "no timestamp")
              .when(F.col(BAD).isNotNull(), "malformed")
              .when(F.col(required).isNull(), "empty block"))
    return parsed.select(*keep, *columns, F.col("__text").alias("message"), reason.alias("reason"))


def judge_sensor(messages: DataFrame, text: str = "value", keep: Sequence[str] = DEVICE,
                 required: str = REQUIRED_METER) -> DataFrame:
    """Every sensor message, parsed once: typed columns, the ``message`` itself and the ``reason`` it is no good, if any."""
    parsed = parse_messages(messages, SENSOR, text, keep)
    parsed = parsed.select(*keep, "datetime", instant("datetime").alias("ts"),
                           local_time("datetime").alias("ts_local"),
                           is_on(STATUS).alias(STATUS), *METERS, BAD, "__text")
    return _judged(parsed, required, keep, ["datetime", "ts", "ts_local", STATUS, *METERS])


def judge_lab(messages: DataFrame, text: str = "value", keep: Sequence[str] = DEVICE) -> DataFrame:
    """Every lab message, parsed once, as ``judge_sensor`` does."""
    parsed = parse_messages(messages, LAB_EVENT, text, keep)
    parsed = parsed.select(*keep, "datetime", instant("datetime").alias("ts"),
                           local_time("datetime").alias("ts_local"), LAB, BAD, "__text")
    return _judged(parsed, LAB, keep, ["datetime", "ts", "ts_local", LAB])


def good_rows(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNull()).drop("reason", "message")


def dead_rows(judged: DataFrame, keep: Sequence[str]) -> DataFrame:
    return judged.where(F.col("reason").isNotNull()).select(*keep, "message", "reason")


def read_sensor(messages: DataFrame, text: str = "value", keep: Sequence[str] = DEVICE,
                required: str = REQUIRED_METER) -> tuple[DataFrame, DataFrame]:
    """(sensor rows, dead letters). A row has ``ts``, ``ts_local``, a boolean status and six numbers."""
    judged = judge_sensor(messages, text, keep, required)
    return good_rows(judged), dead_rows(judged, keep)


def read_lab(messages: DataFrame, text: str = "value", keep: Sequence[str] = DEVICE) -> tuple[DataFrame, DataFrame]:
    """(lab rows, dead letters)."""
    judged = judge_lab(messages, text, keep)
    return good_rows(judged), dead_rows(judged, keep)


def keyed(messages: DataFrame, text: str = "value", keep: Sequence[str] = DEVICE) -> DataFrame:
    """``(keep, ts_raw, payload)``: the first field as key, the rest as it came."""
    message = F.col(text)
    cut = F.instr(message, ",")
    return messages.select(
        *keep,
        F.when(cut > 0, F.substring(message, F.lit(1), cut - 1)).otherwise(message).alias("ts_raw"),
        F.when(cut > 0, F.substring(message, cut + 1, F.length(message))).otherwise(F.lit("")).alias("payload"))
