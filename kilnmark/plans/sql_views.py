"""SQL over the stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> None:
    """Name frames or Parquet paths for ``spark.sql``."""
    for name, table in tables.items():
        frame = spark.read.parquet(table) if isinstance(table, str) else table
        frame.createOrReplaceTempView(name)
