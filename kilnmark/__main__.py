"""Command line: ``spark-submit … kilnmark/__main__.py <command>`` or ``python -m kilnmark <command>``."""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

if __package__ in (None, ""):  # started as a script by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kilnmark.functions import minutes_before, parse_day  # noqa: E402
from kilnmark.plans import batch, serving  # noqa: E402
from kilnmark.schemas import DEVICE, RAW  # noqa: E402
from kilnmark.session import build_session  # noqa: E402
from kilnmark.sources import compaction, delimited, messages, tables  # noqa: E402
from kilnmark.streaming import ingest, jobs  # noqa: E402
from kilnmark.streaming.feeds import file_messages, topic_messages  # noqa: E402


def keep_dead(lines, path):
    """Lines that do not fit, with the reason, as JSON."""
    delimited.dead_letters(lines).write.mode("overwrite").json(path)


def clean(spark, args):
    lines = delimited.read_raw(spark, args.input, args.sep, partitions=args.partitions)
    rows = delimited.with_times(delimited.without_corrupt(lines))
    delimited.write_clean(rows, args.output, "ts", gzip=args.gzip)
    keep_dead(lines, args.dead or args.output.rstrip("/") + ".dead")


def split(spark, args):
    lines = delimited.read_raw(spark, args.input, ",")
    rows = delimited.without_corrupt(lines)
    sensor, lab = messages.split_export(messages.drop_empty_sensor_blocks(rows))
    for feed, path in ((sensor, args.sensor), (lab, args.lab)):
        feed.select(messages.to_message(feed.columns)).write.mode("overwrite").text(path)
    keep_dead(lines, args.dead or args.sensor.rstrip("/") + ".dead")


def stream(spark, args):
    places = ingest.positions(spark, args.behind, args.behind_batch) if args.behind else {}

    def source(name, feed):
        if args.servers:
            return topic_messages(spark, args.servers, name, args.from_start, after=places.get(feed))
        return file_messages(spark, name, after=places.get(feed))

    publish = jobs.message_topic(args.servers, args.averages) if args.servers else jobs.message_files(args.averages)
    trigger = {"availableNow": True} if args.once else {"processingTime": args.every}
    queries = jobs.start_all(source(args.sensor, ingest.SENSOR_FEED), source(args.lab, ingest.LAB_FEED), args.tables, publish, args.checkpoint,
                             args.delay, args.size, args.slide, trigger)
    if args.once:
        for query in queries:
            jobs.finish(query)
    else:
        spark.streams.awaitAnyTermination()


def daily(spark, args):
    batch.run_daily(spark, args.archive, args.table, args.first, args.stop, args.format)


def files(spark, args):
    batch.run_files(spark, args.archive, args.table, args.run_number, args.format, args.by_folder)


def give(answer, args):
    """The whole answer, to a folder or to the console; only ``--rows`` cuts what is printed."""
    if args.output:
        answer.write.mode("overwrite").parquet(args.output)
    if args.rows or not args.output:
        answer.show(args.rows or max(1, answer.count()), truncate=False)


def beside(args, name):
    """``args`` with a folder beside the table for the whole answer, unless a folder or ``--rows`` is given."""
    if not args.output and not args.rows:
        args.output = f"{args.table.rstrip('/')}.{name}"
    return args


def past(spark, args):
    now = args.now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    table = jobs.read_running_table(spark, args.table, first=minutes_before(now, args.minutes).date(), last=now.date())
    answer = serving.running_avg_since(table, now, args.minutes)
    give(serving.in_key_order(answer), beside(args, "past"))


def week(spark, args):
    stop = parse_day(args.date)
    table = batch.read_segments(spark, args.table, first=stop - dt.timedelta(days=7), stop=stop)
    give(serving.in_key_order(serving.batch_week(table, args.date)), beside(args, "week"))


def current(spark, args):
    rows = ingest.read_current(spark, args.table)
    give(serving.current_conditions(rows).orderBy(*DEVICE), beside(args, "shown"))


def averages(spark, args):
    give(serving.current_averages(jobs.read_averages(spark, args.table)).orderBy(*DEVICE, "meter"), beside(args, "current"))


def compact(spark, args):
    layout = {"cells": compaction.CELLS, "running": compaction.RUNNING}[args.kind]
    after = compaction.compact(spark, args.table, layout, args.through)
    print(f"generation {after['generation']}, batches through {after['through']}")


def keys(spark, args):
    layout = {"cells": compaction.CELLS, "running": compaction.RUNNING}[args.kind]
    found = compaction.scan_keys(spark, args.table, layout, args.start, args.stop)
    give(found.orderBy("key", *layout.keys), beside(args, "range"))


def look(spark, args):
    tables.preview(spark.read.format(args.format).load(args.path), args.rows).show(args.rows, truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kilnmark", description=__doc__)
    commands = top.add_subparsers(required=True)

    def command(run, text, *options):
        sub = commands.add_parser(run.__name__, help=text)
        for flags, kind in options:
            sub.add_argument(*flags.split("|"), **kind)
        sub.set_defaults(run=run)

    need = {"required": True}
    day = {"type": dt.date.fromisoformat, "default": None}
    rows = ("--rows", {"type": int, "default": 100})
    whole = (("--rows", {"type": int, "default": None, "help": "print this many rows only"}),
             ("--output", {"default": None, "help": "folder for the whole answer as Parquet (beside the table by default)"}))
    dead = ("--dead", {"default": None, "help": "folder for lines that do not fit (beside the output by default)"})
    command(clean, "raw export -> comma export in time order", ("--input", need), ("--output", need),
            ("--sep", {"default": ";"}), ("--gzip", {"action": "store_true"}),
            ("--partitions", {"type": int, "default": None}), dead)
    command(split, f"comma export ({len(RAW)} columns) -> sensor and lab messages", ("--input", need),
            ("--sensor", need), ("--lab", need), dead)
    command(stream, "messages -> archive, cells, running averages",
            ("--sensor", need), ("--lab", need), ("--averages", need), ("--tables", need), ("--checkpoint", need),
            ("--servers", {"default": None, "help": "Kafka servers; sensor, lab and averages are then topics"}),
            ("--from-start", {"action": "store_true"}), ("--once", {"action": "store_true"}),
            ("--every", {"default": "1 minute"}), ("--delay", {"default": jobs.DELAY}),
            ("--size", {"default": jobs.SIZE}), ("--slide", {"default": jobs.SLIDE}),
            ("--behind", {"default": None, "help": "journal of an earlier run: begin where that run's feeds were read to"}),
            ("--behind-batch", {"type": int, "default": None, "help": "the batch of that journal to begin behind"}))
    command(daily, "archive days -> segment table", ("--archive", need), ("--table", need),
            ("--first", day), ("--stop", day), ("--format", {"default": "parquet"}))
    command(files, "archive record files, each on its own -> segment table", ("--archive", need), ("--table", need),
            ("--run-number", {"type": int, "required": True}), ("--format", {"default": "parquet"}),
            ("--by-folder", {"action": "store_true", "help": "all files of a folder are one archive"}))
    command(past, "running averages of the last minutes", ("--table", need),
            ("--now", {"type": dt.datetime.fromisoformat, "default": None}),
            ("--minutes", {"type": int, "default": serving.DAY_MINUTES}), *whole)
    command(week, "segments of the week before a date", ("--table", need), ("--date", need), *whole)
    command(current, "newest row of every device", ("--table", need), *whole)
    command(averages, "newest average of every meter", ("--table", need), *whole)
    kind = ("--kind", {"choices": ["cells", "running"], "required": True})
    command(compact, "fold the batches of a keyed table", ("--table", need), kind,
            ("--through", {"type": int, "default": None, "help": "last batch to fold (all but the newest by default)"}))
    command(keys, "rows of a keyed table whose key is in a range", ("--table", need), kind,
            ("--start", need), ("--stop", need), *whole)
    command(look, "first rows of a table as JSON", ("--path", need), ("--format", {"default": "parquet"}), rows)
    return top


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(), args)


if __name__ == "__main__":
    main()
