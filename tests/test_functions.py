import datetime as dt

import pytest
from pyspark.sql import functions as F

from kilnmark import functions as fn
from kilnmark.schemas import check_readable, load_schema, series_dimension


def one(spark, expression, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(expression).first()[0]


def test_times(spark):
    text = "2014-06-05T06:01:00-07:00"
    assert one(spark, fn.local_time("t"), t=text) == dt.datetime(2014, 6, 5, 6, 1)
    assert one(spark, F.date_format(fn.instant("t"), "HH:mm"), t=text) == "13:01"
    assert one(spark, fn.instant("t"), t="not-a-time") is None
    assert one(spark, fn.local_time("t"), t="") is None
    assert one(spark, fn.day_text(fn.local_time("t")), t=text) == "20140605"
    assert fn.parse_day("20140602") == dt.date(2014, 6, 2)
    with pytest.raises(ValueError):
        fn.parse_day("2014-06-02")
    assert fn.minutes_before(dt.datetime(2019, 11, 3, 0, 5), 12) == dt.datetime(2019, 11, 2, 23, 53)


def test_display_time(spark):
    shown = one(spark, fn.display_time(F.lit("2014-06-05 10:01:00").cast("timestamp_ntz")))
    assert shown == dt.datetime(2014, 6, 5, 6, 1)


def test_keys(spark):
    row = spark.sql("select '001' factory_id, '001' oven_id, timestamp_ntz'2014-05-21 19:07:00' ts, "
                    "timestamp_ntz'2014-05-21 04:54:00' a, timestamp_ntz'2014-05-21 10:58:00' b")
    keys = row.select(fn.cell_key(F.lit("inputTemperatureProduct"), "ts").alias("cell"),
                      fn.batch_key("a", "a", "b").alias("batch"), fn.running_key("ts").alias("running"))
    got = keys.select("*", fn.batch_key_time("batch").alias("bt"), fn.running_key_time("running").alias("rt")).first()
    assert got["cell"] == "001#001#inputTemperatureProduct#20140521#19"
    assert got["batch"] == "001#001#20140521#0454#1058"
    assert got["running"] == "001#001#201405211907"
    assert got["bt"] == dt.datetime(2014, 5, 21, 10, 58) and got["rt"] == dt.datetime(2014, 5, 21, 19, 7)
    assert one(spark, fn.path_label("t"), t="16:21:00.000Z") == "16_21_00.000Z"


def test_values(spark):
    assert one(spark, fn.number("t"), t=" 60.05\r\n") == 60.05
    assert one(spark, fn.number("t"), t="") is None
    assert one(spark, fn.number("t"), t="abc") is None
    assert [one(spark, fn.is_on("t"), t=t) for t in ("1", "0", "true")] == [True, False, False]
    assert [one(spark, fn.status_label("t"), t=t) for t in ("1", "0", "2")] == ["ON", "OFF", None]
    assert one(spark, fn.round2(F.lit(2.675))) == 2.68
    assert one(spark, fn.meter_message(F.lit("m"), F.lit(2.5))) == "m,2.5"
    assert one(spark, fn.message_value("t"), t="m,2.5") == 2.5
    assert [one(spark, fn.zero_pad(F.lit(n))) for n in (7, 42, 1234)] == ["007", "042", "1234"]


def test_schema_files(spark, tmp_path):
    definition = tmp_path / "schema.json"
    definition.write_text('{"type": "record", "fields": [{"name": "timestamp", "type": "string"}, '
                          '{"name": "h", "type": ["null", "float"]}, {"name": "on", "type": "boolean"}]}')
    schema = load_schema(spark, str(definition))
    assert schema.simpleString() == "struct<timestamp:string,h:float,on:boolean>"
    assert schema["h"].nullable and not schema["timestamp"].nullable
    definition.write_text(schema.json())
    assert load_schema(spark, str(definition)) == schema
    definition.write_text('{"fields": [{"name": "x", "type": "bytes"}]}')
    with pytest.raises(ValueError, match="unsupported"):
        load_schema(spark, str(definition))
    with pytest.raises(ValueError, match="unsupported"):
        check_readable(spark.sql("select map('a', 1) m").schema)


def test_series_dimension(spark):
    rows = {r["meter"]: (r["series"], r["panel"]) for r in series_dimension(spark).collect()}
    assert len(rows) == 7 and rows["temperatureProcess2"] == ("process2Temp", "temperature")
