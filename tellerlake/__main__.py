"""Command line for the load runs, for use with spark-submit or ``python -m tellerlake``.

  historical  --root R --folder F --checkpoint C      empty the tables and load the folder
  incremental --root R --folder F --checkpoint C      load what has arrived since
  ingest      --root R --folder F --checkpoint C      only load the folder; with --poll, keep on watching it
  daily       --root R [--report-date D]              cleanse, dimensions, facts, checks
  calendar    --root R --start D --end D              fill the calendar
  counts      --root R                                rows per table
  checks      --root R                                run the quality rules, show the result

With --snapshots S --load-id N the two loads read the columnar snapshot tables
of lake S instead of a CSV folder.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from tellerlake.operators import load_stats, quality
from tellerlake.plans import daily
from tellerlake.session import SETTINGS
from tellerlake.sources.lake import Lake
from tellerlake.streaming.file_ingest import utc_now


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tellerlake", description="Load runs of the warehouse.")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("historical", "incremental", "ingest", "daily", "calendar", "counts", "checks"):
        command = commands.add_parser(name)
        command.add_argument("--root", required=True, help="folder of the lake")
        command.add_argument("--date-grain", default="month", choices=["day", "month", "year"])
        if name in ("historical", "incremental", "ingest"):
            command.add_argument("--folder", help="folder with customer, account and transaction")
            command.add_argument("--checkpoint", help="folder for the file streams' progress")
        if name == "ingest":
            command.add_argument("--poll", help="interval between looks at the folder, such as '5 minutes'")
        if name in ("historical", "incremental"):
            command.add_argument("--snapshots", help="root of the lake with the snapshot tables")
            command.add_argument("--load-id", type=int, help="snapshot to load")
        if name in ("historical", "incremental", "daily"):
            command.add_argument("--as-of", type=date.fromisoformat, default=date.today())
        if name == "daily":
            command.add_argument("--report-date", type=date.fromisoformat)
        if name == "calendar":
            command.add_argument("--start", type=date.fromisoformat, required=True)
            command.add_argument("--end", type=date.fromisoformat, required=True)
    args = parser.parse_args(argv)
    if args.command == "ingest" and not (args.folder and args.checkpoint):
        parser.error("give --folder and --checkpoint")
    if args.command in ("historical", "incremental"):
        from_files = bool(args.folder and args.checkpoint)
        from_loads = bool(args.snapshots and args.load_id is not None)
        if from_files == from_loads:
            parser.error("give either --folder and --checkpoint, or --snapshots and --load-id")
    return args


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    builder = SparkSession.builder.appName("tellerlake")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    lake = Lake(spark, args.root, args.date_grain)
    if args.command in ("historical", "incremental"):
        if args.folder:
            load = daily.from_csv_folders(args.folder, args.checkpoint)
        else:
            load = daily.from_snapshots(Lake(spark, args.snapshots), args.load_id, utc_now())
        run = daily.historical_run if args.command == "historical" else daily.incremental_run
        run(lake, load, args.as_of).show(100, truncate=False)
    elif args.command == "ingest" and args.poll:
        daily.watch_csv_folders(lake, args.folder, args.checkpoint, args.poll)
        spark.streams.awaitAnyTermination()
    elif args.command == "ingest":
        daily.from_csv_folders(args.folder, args.checkpoint)(lake)
    elif args.command == "daily":
        daily.daily_run(lake, args.as_of, report_date=args.report_date).show(100, truncate=False)
    elif args.command == "calendar":
        daily.load_calendar(lake, args.start, args.end)
    elif args.command == "checks":
        daily.check_quality(lake, utc_now())
    if args.command == "checks":
        latest = quality.latest_run(lake.read("governance/data_quality_log"))
        quality.severity_summary(latest).show(truncate=False)
        quality.failing_checks(latest).show(truncate=False)
    else:
        counts = daily.lake_counts(lake)
        counts.show(truncate=False)
        load_stats.layer_totals(counts).show(truncate=False)


if __name__ == "__main__":
    main()
