"""Declared schemas, meter names and the chart dimension.

Nothing is inferred from data: every reader passes one of these schemas.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Field names, key constants, series and panel names of the data
# contract. Stored tables and messages are only compatible if these stay as is.
# ---------------------------------------------------------------------------
STATUS = "processIsOn"
LAB = "productHumidity"
METERS = (
    "inputTemperatureProduct",
    "waterFlowProcess",
    "intensityFanProcess",
    "waterTemperatureProcess",
    "temperatureProcess1",
    "temperatureProcess2",
)
# meter -> column of the batch analysis table
SEGMENT_COLUMNS = {
    "waterFlowProcess": "avgWaterFlowProcess",
    "intensityFanProcess": "avgIntensityFanProcess",
    "waterTemperatureProcess": "avgWaterTemperatureProcess",
    "temperatureProcess1": "avgTemperatureProcess1",
    "temperatureProcess2": "avgTemperatureProcess2",
    "inputTemperatureProduct": "avginputTemperatureProduct",
}
# (meter, series, panel)
SERIES = (
    ("productHumidity", "humidity", "humidity"),
    ("inputTemperatureProduct", "productTemp", "temperature"),
    ("temperatureProcess1", "process1Temp", "temperature"),
    ("temperatureProcess2", "process2Temp", "temperature"),
    ("waterTemperatureProcess", "waterTemp", "temperature"),
    ("waterFlowProcess", "waterFlow", "water"),
    ("intensityFanProcess", "fanIntensity", "fan"),
)
DEFAULT_FACTORY = "001"
DEFAULT_OVEN = "001"
STATUS_LABELS = {"1": "ON", "0": "OFF"}
# ---------------------------------------------------------------------------

DEVICE = ("factory_id", "oven_id")


def _fields(names, data_type):
    return [T.StructField(name, data_type, True) for name in names]


RAW = T.StructType(
    [T.StructField("datetime", T.StringType(), True)]
    + _fields([LAB], T.DoubleType())
    + _fields([STATUS], T.StringType())
    + _fields(METERS, T.DoubleType())
)

SENSOR = T.StructType([f for f in RAW.fields if f.name != LAB])

LAB_EVENT = T.StructType([f for f in RAW.fields if f.name in ("datetime", LAB)])

# The archive calls the status flag ``processOn``.
MERGED = T.StructType(
    [T.StructField("timestamp", T.StringType(), True)]
    + _fields([LAB], T.DoubleType())
    + _fields(["processOn"], T.BooleanType())
    + _fields(METERS, T.DoubleType())
)

READABLE_TYPES = (
    T.StringType,
    T.BooleanType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.NullType,
)


def check_readable(schema: T.StructType) -> T.StructType:
    """Refuse a message schema with a field type that text cannot be read into."""
    bad = [f"{f.name}: {f.dataType.simpleString()}" for f in schema.fields
           if not isinstance(f.dataType, READABLE_TYPES)]
    if bad:
        raise ValueError("unsupported field type in schema: " + ", ".join(bad))
    return schema


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    """Read a schema from a JSON definition file (any file system Spark can reach).

    Both Spark's own schema JSON and a flat record definition (``{"fields":
    [{"name": .., "type": ..}]}`` with a union such as ``["null", "float"]``
    for a nullable field) are understood.
    """
    text = spark.read.text(path, wholetext=True).first()[0]
    definition = json.loads(text)
    if definition.get("type") == "struct":
        return check_readable(T.StructType.fromJson(definition))
    names = {"string": "string", "boolean": "boolean", "int": "int", "long": "bigint",
             "float": "float", "double": "double", "null": "void"}
    fields = []
    for field in definition["fields"]:
        union = field["type"] if isinstance(field["type"], list) else [field["type"]]
        kinds = [kind for kind in union if kind != "null"] or ["null"]
        if len(kinds) != 1 or not isinstance(kinds[0], str) or kinds[0] not in names:
            raise ValueError(f"unsupported field type in schema: {field['name']}: {field['type']}")
        fields.append(f"`{field['name']}` {names[kinds[0]]}" + ("" if "null" in union else " NOT NULL"))
    return check_readable(T.StructType.fromDDL(", ".join(fields)))


def series_dimension(spark: SparkSession, series=SERIES) -> DataFrame:
    """One row per charted meter: ``(meter, series, panel)``. Size fixed by ``series``."""
    rows = [F.struct(F.lit(meter).alias("meter"), F.lit(name).alias("series"), F.lit(panel).alias("panel"))
            for meter, name, panel in series]
    return spark.range(1).select(F.inline(F.array(*rows)))
