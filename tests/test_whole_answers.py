"""Answers are neither cut nor dropped."""

import argparse
import datetime as dt

from kilnmark import __main__ as cli
from kilnmark.operators.ordering import chronological_rank
from kilnmark.streaming import jobs
from kilnmark.suite.queries import QUERIES


def test_rank_keeps_rows_without_time(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1), (None, 2), (dt.datetime(2024, 1, 1), 3), (dt.datetime(2024, 1, 2), 4)],
                                 "ts timestamp, v int")
    assert sorted((r.v, r.position) for r in chronological_rank(rows).collect()) == [(1, 1), (2, None), (3, 1), (4, 3)]


def test_answers_are_whole(spark, tmp_path, capsys):
    answer = spark.range(150)
    cli.give(answer, argparse.Namespace(rows=None, output=str(tmp_path / "out")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 150
    cli.give(answer, argparse.Namespace(rows=None, output=None))
    assert "149" in capsys.readouterr().out


def test_finish_waits_without_limit():
    class Query:
        limits = []

        def awaitTermination(self, *limit):
            self.limits.append(limit)
            return True

    jobs.finish(Query())
    assert Query.limits == [()]


def test_hour_range_reaches_the_scan(spark):
    plan = QUERIES["interval_rows"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan


def test_running_table_skips_days_outside(spark, tmp_path):
    path = str(tmp_path / "running")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    rows = [("001", "001", dt.datetime(d.year, d.month, d.day, 9), "m", 1.0, d, 0) for d in days]
    (spark.createDataFrame(rows, "factory_id string, oven_id string, window_end timestamp, meter string, avg double, "
                                 "day date, batch_id long")
     .write.partitionBy("day", "batch_id").parquet(path))
    table = jobs.read_running_table(spark, path, ["m"], days[1], days[1])
    assert [r["window_end"].date() for r in table.collect()] == [days[1]]
    assert jobs.read_running_table(spark, path, ["m"]).count() == 3
