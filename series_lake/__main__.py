"""Runs as commands, for any scheduler. The session takes its settings from the environment.

    python -m series_lake run-historical --raw ... --history ... \
        --wh-table db.table --wh-root ...

Each command prints the load summary as one JSON line.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from series_lake.functions.timeconv import ntz_to_ms
from series_lake.operators.quality import load_summary
from series_lake.plans import runs
from series_lake.sources.files import markets_snapshot, scan_published


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="series_lake")
    commands = parser.add_subparsers(dest="command", required=True)

    prepare = commands.add_parser("prepare-raw", help="land the documents of the largest assets")
    prepare.add_argument("--markets", required=True, help="landed market listings (JSON)")
    prepare.add_argument("--points", required=True, help="flat daily series (Parquet)")
    prepare.add_argument("--landing", required=True)
    prepare.add_argument("--run-type", default="normal")
    prepare.add_argument("--as-of-ms", type=int, required=True)
    prepare.add_argument("--top", type=int, default=runs.PAGE_SIZE, help="assets per page")
    prepare.add_argument("--page", type=int, default=1)
    prepare.add_argument("--currency", help="keep points quoted in this currency only")

    intra = commands.add_parser("run-intra-day", help="replace the intra-day output and its warehouse table")
    intra.add_argument("--raw", required=True, help="path or catalog table")
    intra.add_argument("--table", required=True)
    intra.add_argument("--table-root", required=True)
    intra.add_argument("--strategy", default="join")

    historical = commands.add_parser("run-historical", help="merge documents into the history, reload its warehouse table")
    historical.add_argument("--raw", required=True)
    historical.add_argument("--history", required=True)
    historical.add_argument("--full", action="store_true", help="load the volume as well")

    for command in (intra, historical):
        command.add_argument("--rejects", help="folder for what cannot be read, with the reason")
        command.add_argument("--fail-fast", action="store_true", help="stop at the first unreadable document")
        command.add_argument("--metrics", action="store_true", help="fill the declared metric columns")
        command.add_argument("--wh-table", required=True)
        command.add_argument("--wh-root", required=True)
    return parser


def main(argv: list[str]) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"series-lake {args.command}").getOrCreate()
    if args.command == "prepare-raw":
        points = scan_published(spark, args.points)
        runs.prepare_raw(markets_snapshot(spark, args.markets), points, args.landing, args.run_type, args.as_of_ms, args.top, args.page, args.currency)
        return
    options = {"rejects": args.rejects, "fail_fast": args.fail_fast, "metrics": args.metrics}
    if args.command == "run-intra-day":
        loaded = runs.run_intra_day(spark, args.raw, args.table, args.table_root, args.wh_table, args.wh_root, args.strategy, **options)
    else:
        loaded = runs.run_historical(spark, args.raw, args.history, args.wh_table, args.wh_root, args.full, **options)
    keyed = loaded.select(F.col("id").alias("coin_id"), ntz_to_ms("last_updated").alias("timestamp"))
    print(load_summary(keyed).toJSON().first())


def command() -> None:
    main(sys.argv[1:])


if __name__ == "__main__":
    command()
