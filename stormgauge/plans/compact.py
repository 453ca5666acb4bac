"""Make a live table cheaper to read.

    spark-submit -m stormgauge.plans.compact weather_realtime_sliding \\
        --changelog hdfs:///data/live/sliding --target hdfs:///data/live/sliding-2

    spark-submit -m stormgauge.plans.compact weather_realtime_sliding \\
        --merged-table hdfs:///data/live/sliding-table

A changelog is written to a fresh one that holds only the current rows, from time to time while
the live job is stopped, as reading it costs as much as all epochs it holds; the job then goes
on with the target.  A merged table is compacted in its folder while the job may run, and
versions before the last two are dropped.
"""

from __future__ import annotations

import argparse

from stormgauge.plans.live import LIVE_JOBS
from stormgauge.session import build_session
from stormgauge.sinks.changelog import compact


def main(argv: list[str] | None = None) -> None:
    cli = argparse.ArgumentParser(description=__doc__)
    cli.add_argument("table", choices=sorted(LIVE_JOBS))
    cli.add_argument("--changelog")
    cli.add_argument("--target", help="the fresh changelog")
    cli.add_argument("--merged-table", metavar="FOLDER")
    cli.add_argument("--at-least", type=int, default=2, help="changed files of a day worth a merge")
    args = cli.parse_args(argv)
    if not args.merged_table and not (args.changelog and args.target):
        cli.error("give --changelog and --target, or --merged-table")
    spark = build_session(f"compact_{args.table}")
    job = LIVE_JOBS[args.table]
    if args.changelog:
        compact(spark, args.changelog, args.target, job.table.key)
    if args.merged_table:
        table = job.merged_table(spark, args.merged_table)
        table.compact(args.at_least)
        table.expire()


if __name__ == "__main__":
    main()
