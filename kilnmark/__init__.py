"""Sensor and lab analytics for drying lines, written for Spark.

Sub-packages:

* ``functions``  Column expressions: timestamps, row keys, cell values
* ``sources``    delimited exports, comma messages, archives, keyed tables
* ``operators``  merge, segments, running averages, reshaping, latest values
* ``plans``      the daily batch job, the serving queries, SQL views
* ``streaming``  the same work as Structured Streaming queries
"""
