import argparse

from kilnmark import __main__ as cli


def test_week_writes_the_whole_answer_beside_the_table(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli.serving, "batch_week", lambda table, date: spark.range(150))
    monkeypatch.setattr(cli.serving, "in_key_order", lambda answer: answer)
    table = str(tmp_path / "segments")
    cli.week(spark, argparse.Namespace(table=table, date="20240115", rows=None, output=None))
    assert spark.read.parquet(table + ".week").count() == 150
    assert "|" not in capsys.readouterr().out
